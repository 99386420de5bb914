import ast
import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).parent.parent


def test_nothing_else_imports_the_text_operators():
    for f in (ROOT / "tessella").rglob("*.py"):
        if "llm" in f.relative_to(ROOT / "tessella").parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n or "corpus_pipeline" in n for n in names), f


def test_entry_works_without_them(tmp_path):
    """The entry file, the library without the folder: it imports and has the zonal queries, each with SQL."""
    for f in [ROOT / "__spark_entry__.py", *[f for f in (ROOT / "tessella").rglob("*.py") if "llm" not in f.parts]]:
        to = tmp_path / f.relative_to(ROOT)
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_text(f.read_text())
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 35 and set(o) == set(q), set(q) - set(o); print('good')"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert out.stdout.strip().endswith("good"), out.stderr[-800:]
