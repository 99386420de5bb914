"""Places that driver and executors share.

Intermediate tables and files go to the folder that the cluster names in ``spark.checkpoint.dir``. Only where that
setting is missing (a local session, as in tests) is a folder on this machine taken, and the setting is then made.
"""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder's URI, with its store (a path without one is on the cluster's default file system, not on a worker's
    own disk); a session that names none and runs on one machine gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.startswith(("local-cluster", "spark:", "yarn", "k8s:", "mesos:")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


#: Of what a Python worker gets at once; the usual 64 MB, several times over, is much of a small executor's memory.
ARROW_BYTES = 8 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """df; batches to Python workers hold ARROW_BYTES at most (or a row), unless the session asks for less."""
    key, spark = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession
    now = (spark.conf.get(key, None) or "").rstrip("b")
    if not now.isdigit() or int(now) > ARROW_BYTES:
        spark.conf.set(key, ARROW_BYTES)
    return df


def trimmed(run):
    """run, a function over batches; at its end the worker gives back what freed arrays and texts held. Workers are
    reused: else each keeps the largest size of every operator that ran in it."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
                ctypes.CDLL(None).malloc_trim(0)

    return inner


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tessella/{name}-{uuid.uuid4().hex}"


_made: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch():
    """Deletes, at its end, the tables that `written` made meanwhile; those taken out of the list it gives stay."""
    _made.append(made := [])
    try:
        yield made
    finally:
        _made.remove(made)
        drop(*made)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df, written once as a Parquet table in the shared folder and read again: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    for made in _made[-1:]:
        made.append(out)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that `written` made, once nothing reads them any more."""
    for df in tables:
        jvm, context = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext
        p = jvm.org.apache.hadoop.fs.Path(df.written_path)
        p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)


def released(spark: SparkSession) -> None:
    """Lets go of the shuffle files of finished work. Spark deletes them when the driver's objects of them are collected, which
    a driver with memory to spare does seldom, so they would pile up beside the written tables."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def local_path(uri: str) -> str | None:
    """The path to open for a file: URI or a plain path; None for other stores."""
    u = urlparse(uri)
    return u.path if u.scheme in ("", "file") else None


def write_file(uri: str, data: bytes) -> None:
    """Write a file whole or not at all: under another name first, then renamed. Tasks that run twice write the same."""
    if (path := local_path(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


def mapped(uri: str, dtype: str):
    """A file as a memory-mapped array. From a store other than a mounted folder it is fetched to a scratch file, which
    is unlinked at once: the mapping keeps it until the worker drops the array."""
    import numpy as np

    if (path := local_path(uri)) is not None:
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with tempfile.NamedTemporaryFile() as f:
        with store.open_input_stream(path) as src:
            while chunk := src.read(8 << 20):
                f.write(chunk)
        f.flush()
        return np.memmap(f.name, dtype=dtype, mode="r") if f.tell() else np.empty(0, dtype)
