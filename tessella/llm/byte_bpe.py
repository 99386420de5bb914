"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming UTF-8 decoder.

Why a transducer can do it: the merges of a text give tokens t1..tn such that every neighbouring pair is stable (merging
the two tokens' bytes alone gives the same two tokens), and no other split of the text has that property. So each prefix
of a word has exactly one tokenisation. Reading bytes from the left, the machine keeps for every place where a token may
have begun the walk in the trie of token bytes and the last token before it; walks that no token goes on from are
dropped. A walk that ends in a token that is stable after its predecessor closes the prefix, and the move puts out that
token, the last of the prefix. Sets of walks are numbered when first met and their moves remembered.

Lookahead: what all open walks have behind them is settled. It is read back from the last tokens at a word's end, and in
longer words after every LOOKAHEAD bytes, so a word of any length is encoded with bounded memory.

Memory: at MAX_STATES numbered sets the table is emptied and filled anew; every word runs on numbered sets alone. (At 60,000
sets a table takes about 50 MB of a worker.)

Cases: null text counts as empty and has no tokens; any valid text round-trips; repeated rows stay; columns other than
doc_id and text pass through `encode_documents` if asked for.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm import splitting, storage

MAX_STATES = 60_000
LOOKAHEAD = 256
MAX_PAIRS = 500_000
MAX_WORDS = 250_000
BATCH_CHARS = 2 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class State(dict):
    """A numbered set of walks: byte -> the state after it, made when first asked for."""

    __slots__ = ("walks", "last", "machine")

    def __init__(self, walks: tuple, last: int, machine: MergeTransducer):
        self.walks, self.last, self.machine = walks, last, machine

    def __missing__(self, byte: int) -> State:
        return self.machine.move(self, byte)


class MergeTransducer:
    """Encodes one pre-split word at a time; a word that is itself an entry is that token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.children: list[dict[int, int]] = [{}]  # of each node of the trie, byte -> node; the root is 0
        self.token_at: list[int] = [-1]
        self.depth: list[int] = [0]
        leaf: dict[int, int] = {}
        for token, rank in ranks.items():
            node = 0
            for b in token:
                there = self.children[node].get(b)
                if there is None:
                    there = len(self.token_at)
                    if self.children[node] is leaf:
                        self.children[node] = {}
                    self.children[node][b] = there
                    self.children.append(leaf)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = there
            self.token_at[node] = rank
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.borders: tuple[dict, dict] = {}, {}
        self.stable: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self.reset()

    def reset(self) -> None:
        for state in self.states.values():
            state.clear()  # states may lead to each other in circles
        walks = ((0, -1),)
        self.start = State(walks, -1, self)
        self.states = {walks: self.start}

    # -- which tokens can follow each other

    def parts_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; (token, token) for a single byte, None if merges never reach it."""
        if token not in self.halves:
            word = self.token_bytes[token]
            parts = [bytes([b]) for b in word]
            while len(parts) > 2:
                best = min(((self.ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(1 << 60, 0))
                if best[0] >= token:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            self.halves[token] = (token, token) if len(word) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the bytes of tokens a and b gives a and b again.

        Undoes merges on both sides of the border, the latest first. A pair across the border that would have merged
        before the merge just undone refutes the split.
        """
        key = a << 32 | b
        if (known := self.stable.get(key)) is None:
            if len(self.stable) > MAX_PAIRS:
                self.stable.clear()
            known = self.stable[key] = self._follows(a, b)
        return known

    def _border(self, token: int, side: int) -> tuple[list[int], list[bytes]]:
        """The tokens that touch a token's left (0) or right (1) border as it is merged, the shortest first, and their bytes."""
        if (found := self.borders[side].get(token)) is None:
            chain = [token]
            while self.size[chain[-1]] > 1:
                chain.append(self.parts_of(chain[-1])[side])
            chain.reverse()
            found = self.borders[side][token] = chain, [self.token_bytes[t] for t in chain]
        return found

    def _follows(self, a: int, b: int) -> bool:
        if self.parts_of(a) is None or self.parts_of(b) is None:
            return False
        # Forward in time: both borders grow by the merge of the lower rank. While l and r touch, their own merge wins if
        # its rank is below that of the next merge on either side; at equal ranks the merge further left comes first.
        (left, left_bytes), (right, right_bytes) = self._border(a, 1), self._border(b, 0)
        never, rank, i, j = 1 << 60, self.ranks.get, 0, 0
        while True:
            across = rank(left_bytes[i] + right_bytes[j], never)
            grow_left = left[i + 1] if i + 1 < len(left) else never
            grow_right = right[j + 1] if j + 1 < len(right) else never
            if across < grow_left and across <= grow_right and across != never:
                return False
            if grow_left <= grow_right:
                if grow_left == never:
                    return True
                i += 1
            else:
                j += 1

    # -- the machine

    def move(self, state: State, byte: int) -> State:
        """The state after one more byte, numbered if it is new; a full table is emptied first."""
        children, token_at, known = self.children, self.token_at, self.stable.get
        going, last = [], -1
        for walk in state.walks:
            node, before = walk
            there = children[node].get(byte)
            if there is None:
                continue
            if children[there]:
                going.append((there, before))
            token = token_at[there]
            if token >= 0 and last < 0:
                good = self.parts_of(token) is not None if before < 0 else known(before << 32 | token)
                if self.follows(before, token) if good is None else good:
                    last = token
        if last >= 0:
            going.append((0, last))
        walks = tuple(going)
        after = self.states.get(walks)
        if after is None:
            if len(self.states) >= MAX_STATES:
                self.reset()
                state = {}  # the state before is no longer numbered
            after = self.states[walks] = State(walks, last, self)
        state[byte] = after
        return after

    def _settled(self, state: State, lasts: list[int]) -> int:
        """How much of what was read is split alike whatever follows: where the tokens before all open walks meet."""
        ends = {len(lasts) - self.depth[node] for node, _ in state.walks}
        while len(ends) > 1:
            ends.add((far := max(ends)) - self.size[lasts[far - 1]])
            ends.remove(far)
        return ends.pop() if ends else 0

    def _read_back(self, lasts: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            token = lasts[end - 1]
            if token < 0:
                raise ValueError("the vocabulary has no tokens for these bytes")
            out.append(token)
            end -= self.size[token]
        out.reverse()
        return out

    def encode(self, word: bytes) -> list[int]:
        if (whole := self.ranks.get(word)) is not None:
            return [whole]
        state, out = self.start, []
        lasts: list[int] = []
        add = lasts.append
        for k in range(0, len(word), LOOKAHEAD):
            for b in word[k : k + LOOKAHEAD]:
                state = state[b]
                add(state.last)
            if k + LOOKAHEAD < len(word) and (n := self._settled(state, lasts)) > 0:
                out += self._read_back(lasts, n)
                del lasts[:n]
        return out + self._read_back(lasts, len(lasts))


def _whole(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


class Utf8Stream:
    """Tokens to text, chunk by chunk: bytes of a sign that is not complete wait for the next chunk.

    The machine has a state for each way to be inside a sign. For each token its effect on every state is worked out
    once, so a chunk costs a step a token, and none where the chunk begins and ends with whole signs.
    """

    #: (lowest, highest) first byte -> ranges of the bytes that must follow; from the Unicode standard's table 3-7.
    SHAPES = [
        ((0x00, 0x7F), ()), ((0xC2, 0xDF), ((0x80, 0xBF),)), ((0xE0, 0xE0), ((0xA0, 0xBF), (0x80, 0xBF))), ((0xE1, 0xEC), ((0x80, 0xBF),) * 2), ((0xED, 0xED), ((0x80, 0x9F), (0x80, 0xBF))),
        ((0xEE, 0xEF), ((0x80, 0xBF),) * 2), ((0xF0, 0xF0), ((0x90, 0xBF), (0x80, 0xBF), (0x80, 0xBF))), ((0xF1, 0xF3), ((0x80, 0xBF),) * 3), ((0xF4, 0xF4), ((0x80, 0x8F), (0x80, 0xBF), (0x80, 0xBF))),
    ]

    def __init__(self, token_bytes: dict[int, bytes]):
        self.token_bytes = token_bytes
        self.whole = {t for t, b in token_bytes.items() if _whole(b)}
        self.effect: dict[tuple, tuple | None] = {}
        self.restart()

    def restart(self) -> None:
        self.state: tuple = ()  # ranges that the next bytes must be in
        self.waiting = b""

    @classmethod
    def step(cls, state: tuple, byte: int) -> tuple | None:
        if state:
            return state[1:] if state[0][0] <= byte <= state[0][1] else None
        return next((rest for (a, z), rest in cls.SHAPES if a <= byte <= z), None)

    def feed(self, tokens: list[int]) -> bytes:
        """The bytes of the signs completed so far."""
        data = self.waiting + b"".join(map(self.token_bytes.__getitem__, tokens))
        if not self.state and _whole(data):
            return data
        for t in tokens:
            if self.state or t not in self.whole:
                key = (self.state, t)
                if key not in self.effect:
                    state = self.state
                    for b in self.token_bytes[t]:
                        state = self.step(state, b)
                        if state is None:
                            break
                    self.effect[key] = state
                self.state = self.effect[key]
                if self.state is None:
                    raise ValueError("tokens are not valid UTF-8")
        keep = 0
        if self.state:  # find the start of the sign that is still open
            keep = next(k for k in range(1, 5) if data[-k] >= 0xC0)
        self.waiting = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep]

    def end(self) -> None:
        if self.state:
            raise ValueError("the text ends inside a sign")


class _Words(dict):
    """Words met before and their tokens; a new word goes through the transducer."""

    def __init__(self, machine: MergeTransducer):
        self.machine = machine

    def __missing__(self, word: str) -> tuple[int, ...]:
        self[word] = ids = tuple(self.machine.encode(word.encode()))
        return ids


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = MergeTransducer(ranks)
        self.split = splitting.compiled(pattern)
        self.words = _Words(self.machine)
        self.stream = Utf8Stream(self.machine.token_bytes)

    def encode(self, text: str) -> list[int]:
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        return list(chain.from_iterable(map(self.words.__getitem__, self.split(text))))

    def decode(self, ids: list[int], chunk: int = 4096) -> bytes:
        self.stream.restart()
        out = b"".join(self.stream.feed(ids[k : k + chunk]) for k in range(0, len(ids), chunk))
        self.stream.end()
        return out


@lru_cache(maxsize=2)
def coder_of(ranks_path: str, pattern: str) -> ByteBpe:
    """One coder a worker process: what it has met in one task serves the next."""
    coder = ByteBpe(load_ranks(ranks_path), pattern)
    gc.freeze()  # the vocabulary stays; words come and go without cycles
    return coder


DIGEST_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _texts(batch: pa.RecordBatch) -> Iterable[tuple]:
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        yield i, t.as_py() or ""


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int> of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks_path, pattern)
        for b in batches:
            rows = [(i, coder.encode(t)) for i, t in _texts(b)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return storage.in_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(storage.trimmed(run), "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, text of encoded documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks_path, ".")
        for b in batches:
            texts = [coder.decode(ids).decode() for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, the digest of the ids and the digest of the bytes decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks_path, pattern)
        decimal = {t: str(t) for t in coder.machine.token_bytes}.__getitem__
        for b in batches:
            rows = []
            for i, t in _texts(b):
                ids = coder.encode(t)
                rows.append((i, len(ids), hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) if rows else pa.RecordBatch.from_pylist(
                [], schema=pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
            )

    return storage.in_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(storage.trimmed(run), DIGEST_SCHEMA)
