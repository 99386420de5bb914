import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import byte_bpe as bb

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bb.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = bb.ByteBpe(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abeinrst hT'\n.éü", max_size=80)))
def test_equal_to_the_library(t):
    ids = CODER.encode(t)
    assert ids == LIBRARY.encode_ordinary(t)
    assert CODER.decode(ids, chunk=2) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdé", min_size=1, max_size=30))
def test_machine_on_words(w):
    assert CODER.machine.encode(w.encode()) == LIBRARY.encode_ordinary(w)


def test_long_words_are_settled_in_pieces(monkeypatch):
    r = random.Random(2)
    word = "".join(r.choice(["anti", "dis", "ment", "aria", "ko", "é", "x", "ing"]) for _ in range(4000))
    want = LIBRARY.encode_ordinary(word)
    machine, held = CODER.machine, []
    read = machine._read_back
    monkeypatch.setattr(machine, "_read_back", lambda lasts, end: held.append(len(lasts)) or read(lasts, end))
    for ahead in (1, 7, 256):
        monkeypatch.setattr(bb, "LOOKAHEAD", ahead)
        assert machine.encode(word.encode()) == want
    assert max(held) < 600


def test_a_vocabulary_without_some_bytes():
    machine = bb.MergeTransducer({b"a": 0, b"b": 1, b"ab": 2})
    assert machine.encode(b"aabab") == [0, 2, 2]
    with pytest.raises(ValueError, match="no tokens"):
        machine.encode(b"abc")


def test_bounded_states(monkeypatch):
    monkeypatch.setattr(bb, "MAX_STATES", 20)
    small = bb.ByteBpe(RANKS, public_tokenizers.PATTERN)
    t = "unbelievable reconsiderations of antidisestablishmentarianism " * 3 + "x" * 5000
    assert small.encode(t) == LIBRARY.encode_ordinary(t)
    assert len(small.machine.states) <= 20


def test_stream_waits_for_whole_signs():
    single = {b: RANKS[bytes([b])] for b in range(256)}
    stream = bb.Utf8Stream(CODER.machine.token_bytes)
    out = [stream.feed([single[b]]) for b in "é🎉".encode()]
    assert out == [b"", "é".encode(), b"", b"", b"", "🎉".encode()]
    stream.end()
    stream.feed([single[0xF0]])
    with pytest.raises(ValueError):
        stream.end()
    stream.restart()
    with pytest.raises(ValueError):
        stream.feed([single[0xED], single[0xA0]])


def test_documents(spark):
    data = [(1, "Hello wörld"), (2, ""), (3, None), (1, "Hello wörld"), (None, "x " * 9000)]
    df = spark.createDataFrame([(*r, "y", 1) for r in data], "doc_id bigint, text string, n_tokens string, extra int")
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, bb.digests(df, PATH, public_tokenizers.PATTERN).collect()), key=key)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in data:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=key)
    back = bb.decode_documents(bb.encode_documents(df, PATH, public_tokenizers.PATTERN), PATH)
    assert sorted(map(tuple, back.collect()), key=key) == sorted(((i, t or "") for i, t in data), key=key)
    assert bb.digests(df.where("false"), PATH, public_tokenizers.PATTERN).collect() == []
