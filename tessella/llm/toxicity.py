"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as classes: insult (with a weight), threat, target, negation, report, other. Five transducers read the
classes of a clause side by side: insults; a threat verb that reaches a target; a target near an insult; the scope of a
negation; reported speech after a verb of saying or inside quotation marks. They are composed lazily: a composed state is
made when first met and its moves are kept. The composition puts out, for each match, the kind of clause it stands in
and its weight; a document's features are the sums by kind, and a logistic model turns them into a score.

Learning, from labelled rows outside the held-out third, never from lang, source, id or quality:
* insults: words and word beginnings (4 to 8 signs) found in significantly many toxic and far fewer clean texts of a
  bounded sample (TOXIC_ROWS and CLEAN_ROWS, by hash order). Near copies of a toxic text count once; the test allows for
  the number of candidates. A beginning gives way to a longer one that covers the same texts. The weight is the log odds.
* the logistic model: a maximum a posteriori fit on the same sample; its prior holds where a kind never occurs.

Cases: null and empty texts match nothing and get the model's lowest score; labels may repeat or name no row; null labels
and ids with labels that differ teach nothing; an id with several rows teaches its least text once; with no labels the prior and the seed words decide; repeated rows score alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import storage

TOXIC_ROWS, CLEAN_ROWS = 1500, 7500
THRESHOLD = 0.7
MAX_WORDS = 400_000
PREFIXES = (4, 5, 6, 7, 8)
#: How many times likelier an atom must be in toxic texts than in clean ones.
LIKELIER = 15.0
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, OPEN, CLOSE, STOP = range(9)
SEED_INSULTS = "idiot moron stupid loser scum dumb fool imbecile pathetic worthless".split()
WORD_CLASSES = {
    THREAT: "kill hurt murder destroy crush beat stab shoot burn hang töten umbringen tuer frapper matar golpear".split(),
    TARGET: "you your yours yourself u ya he she him her they them their du dich dir euch ihr tu te toi vous usted ustedes ti ellos".split(),
    NEGATION: "not no never none neither nor cannot nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún ninguna".split(),
    REPORT: "said says say told tells called calls wrote writes reported claimed quoted sagte sagt dit disait dijo dice".split(),
}
MARKS = {'"': OPEN, "“": OPEN, "«": OPEN, "„": OPEN, "”": CLOSE, "»": CLOSE} | dict.fromkeys(".!?;:\n", STOP)
tokens_of = re.compile(r"[^\W_]+(?:'t)?|[.!?;:\n\"“”«»„]").findall
SCOPE = 3
KINDS = ("plain", "aimed", "negated", "reported", "threat")
#: Prior means and precisions: bias, log of all weight, log of the weight of each kind but plain.
PRIOR = np.array([-4.0, 3.0, 0.5, -0.5, -0.5, 3.0])
PRECISION = np.array([0.01, 0.05, 1.0, 1.0, 1.0, 1.0])


# ---------------------------------------------------------------- the grammar


def _threat(state: int, c: int) -> tuple[int, bool]:
    """Places left for a target after a threat verb."""
    if c == THREAT:
        return SCOPE, False
    return (0, True) if c == TARGET and state else (max(state - 1, 0), False)


def _target(state: int, c: int) -> tuple[int, bool]:
    """Places left in which an insult is aimed at the target before it."""
    return (SCOPE + 1, False) if c == TARGET else (max(state - 1, 0), c == INSULT and state > 0)


def _negation(state: int, c: int) -> tuple[int, bool]:
    return (SCOPE, False) if c == NEGATION else (max(state - 1, 0), c == INSULT and state > 0)


def _report(state: int, c: int) -> tuple[int, bool]:
    """1: after a verb of saying, to the clause's end; 2: in quotation marks, across clauses."""
    if c == OPEN:
        return (0 if state == 2 else 2), False
    if c == CLOSE:
        return 0, False
    if c == STOP:
        return (2 if state == 2 else 0), False
    return (state or int(c == REPORT)), c == INSULT and state > 0


class Grammar:
    """The composition: (threat, target, negation, report) states, numbered as they are met."""

    def __init__(self):
        self.number: dict[tuple, int] = {(0, 0, 0, 0): 0}
        self.states: list[tuple] = [(0, 0, 0, 0)]
        self.moves: dict[tuple[int, int], tuple[int, int]] = {}

    def move(self, state: int, c: int) -> tuple[int, int]:
        """(next state, kind put out or -1)."""
        if (state, c) not in self.moves:
            threat, target, negation, report = self.states[state]
            (threat, hit), (target, aimed), (negation, negated), (report, reported) = _threat(threat, c), _target(target, c), _negation(negation, c), _report(report, c)
            after = (0, 0, 0, report) if c == STOP else (threat, target, negation, report)
            if after not in self.number:
                self.number[after] = len(self.states)
                self.states.append(after)
            out = 4 if hit else -1 if c != INSULT else 3 if reported else 2 if negated else 1 if aimed else 0
            self.moves[state, c] = self.number[after], out
        return self.moves[state, c]

    def features(self, classes: list[tuple[int, float]]) -> list[float]:
        """Weights by kind of the clauses matched."""
        sums, state, held = [0.0] * 5, 0, 0.0
        for c, weight in classes:
            held = weight if c == THREAT else held
            state, out = self.move(state, c)
            if out >= 0:
                sums[out] += held if out == 4 else weight
        return sums


class Reader(dict):
    """Class and weight of a word, worked out when first met."""

    def __init__(self, atoms: dict[str, float]):
        super().__init__()
        self.atoms = atoms
        self.fixed = {w: (c, 2.0) for c, words in WORD_CLASSES.items() for w in words} | {m: (c, 0.0) for m, c in MARKS.items()}
        self.none = (OTHER, 0.0)

    def __missing__(self, word: str) -> tuple[int, float]:
        if (found := self.fixed.get(word)) is None:
            weight = max((self.atoms.get(a, 0.0) for a in candidates(word)), default=0.0)
            found = (INSULT, weight) if weight else (NEGATION, 0.0) if word.endswith("n't") else self.none
        self[word] = found
        return found


def candidates(word: str) -> list[str]:
    """What can stand for a word in the lexicon: itself, and its beginnings marked with a star."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


class Scorer:
    def __init__(self, atoms: dict[str, float], weights: np.ndarray):
        self.atoms, self.weights, self.grammar, self.reader = atoms, weights, Grammar(), Reader(atoms)

    def kinds(self, text: str | None) -> list[float]:
        if len(self.reader) > MAX_WORDS:
            self.reader.clear()
        classes = list(map(self.reader.__getitem__, tokens_of((text or "").lower())))
        if not any(c[0] in (INSULT, THREAT) for c in set(classes)):
            return [0.0] * 5
        return self.grammar.features(classes)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(design(np.array([self.kinds(text)])) @ self.weights, -30, 30)))[0])


def design(kinds: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(kinds)), np.log1p(kinds.sum(1)), np.log1p(kinds[:, 1:])])


# ---------------------------------------------------------------- learning


def held_out(doc_id: Column, modulus: int = 3, rest: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most toxic_rows and clean_rows labelled ids that are not held out, first by hash of
    doc_id. An id is one row, whatever its rows in docs: its least text. Labels of one id that differ teach nothing."""
    known = labels.selectExpr("cast(doc_id as bigint) doc_id", "cast(toxic as int) toxic").where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("doc_id", "toxic")
    first = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = F.broadcast(first[0].unionByName(first[1]))  # at most toxic_rows + clean_rows ids
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").join(chosen, "doc_id")
    return storage.written(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")), "toxicity-sample")


def _sketch(words: list[str]) -> list[int]:
    """Four minima over the shingles of five words: near copies share one."""
    shingles = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    h = np.array([xxhash.xxh64_intdigest(s) for s in shingles], np.uint64)
    return [int(((h ^ (h >> np.uint64(31))) * np.uint64(m)).min()) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]


def _word_sets(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list] = ([], [])
            for t in b.column(0):
                words = [w for w in tokens_of((t.as_py() or "").lower()) if w not in MARKS]
                out[0].append(sorted(set(words)))
                out[1].append(np.array(_sketch(words) if words else [0] * 4, np.uint64).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.string())), pa.array(out[1], pa.list_(pa.int64()))], ["words", "sketch"])

    return storage.in_batches(rows.select("text")).mapInArrow(storage.trimmed(run), "words array<string>, sketch array<bigint>")


def _groups(sketches: Iterable[list[int]]) -> list[int]:
    """A number for each group of near copies."""
    parent: list[int] = []
    seen: dict[tuple, int] = {}

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, sketch in enumerate(sketches):
        parent.append(k)
        for key in enumerate(sketch):
            parent[root(k)] = root(seen.setdefault(key, k))
    return [root(k) for k in range(len(parent))]


def _tail(n: int, t: int, p: float) -> float:
    """Log of the chance of t or more out of n."""
    terms = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(t, n + 1)]
    top = max(terms)
    return top + math.log(sum(math.exp(x - top) for x in terms))


def learn_insults(rows: DataFrame, alpha: float = 0.5) -> dict[str, float]:
    """Weights of words and word beginnings, from a bounded sample of (text, toxic)."""
    toxic = _word_sets(rows.where("toxic = 1")).collect()
    atoms = dict.fromkeys(SEED_INSULTS, 2.0)
    if not toxic:
        return atoms
    groups = _groups(r["sketch"] for r in toxic)
    merged: dict[int, set[str]] = defaultdict(set)
    for g, r in zip(groups, toxic, strict=True):
        merged[g].update(a for w in r["words"] for a in candidates(w))
    seen = Counter(a for s in merged.values() for a in s)
    tested = sum(n > 1 for n in seen.values())
    likely = sorted(a for a, n in seen.items() if n > 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among, found, n = frozenset(likely), Counter(), 0
        for b in batches:
            for t in b.column(0):
                n += 1
                found.update({a for w in set(tokens_of((t.as_py() or "").lower())) for a in candidates(w)} & among)
        found[""] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["atom", "n"])

    clean = {r["atom"]: r["n"] for r in rows.where("toxic = 0").select("text").mapInArrow(count, "atom string, n bigint").groupBy("atom").agg(F.sum("n").alias("n")).collect()}
    n_toxic, n_clean = len(merged), clean.get("", 0)
    p = n_toxic / (n_toxic + n_clean) if n_clean else 0.5
    kept = {}
    for a in likely:
        t, c = seen[a], clean.get(a, 0)
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        if odds >= math.log(LIKELIER) and _tail(t + c, t, p) + math.log(max(tested, 1)) < math.log(alpha):
            kept[a] = odds
        elif a in atoms and t + c > 5:
            del atoms[a]  # the data speak against a seed
    for a in list(kept):
        longer = [b for b in kept if b != a and a.endswith("*") and b.rstrip("*").startswith(a[:-1]) and len(b.rstrip("*")) > len(a) - 1]
        if any(seen[b] >= 0.97 * seen[a] for b in longer):
            del kept[a]
    return atoms | kept


def fit(kinds: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method for the logistic posterior."""
    w = PRIOR.copy()
    if not len(y):
        return w
    x = design(kinds)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(PRECISION), x.T @ (y - p) - PRECISION * (w - PRIOR))
        size = np.abs(step).max()
        w = w + step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    rows = sample(docs, labels)
    atoms = learn_insults(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(atoms, PRIOR)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([scorer.kinds(t.as_py()) for t in b.column(0)], pa.list_(pa.float64())), b.column(1)], ["kinds", "toxic"])

    got = rows.select("text", "toxic").mapInArrow(run, "kinds array<double>, toxic int").collect()
    storage.drop(rows)
    return Scorer(atoms, fit(np.array([r["kinds"] for r in got]).reshape(-1, 5), np.array([r["toxic"] for r in got], float)))


def scored(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score and predicted added, under other names if given (any columns of these names give way)."""
    from pyspark.sql.types import DoubleType, IntegerType, StructType

    keep = [c for c in docs.columns if c not in names]
    schema = StructType(docs.select(keep).schema.fields).add(names[0], DoubleType()).add(names[1], IntegerType())
    atoms, weights, at = scorer.atoms, scorer.weights, keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Scorer(atoms, weights)
        for b in batches:
            kinds = np.array([mine.kinds(t.as_py()) for t in b.column(at)]).reshape(-1, 5)
            score = 1 / (1 + np.exp(-np.clip(design(kinds) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*keep, *names])

    return storage.in_batches(docs.select(keep)).mapInArrow(storage.trimmed(run), schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    out = scored(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
