"""Audio features: polyphase resampling, overlapped log-mel filterbanks and energy segments with hysteresis.

Media are WAV files of 8-bit samples, one channel, RATE a second. A signal is read in blocks, so a sample of any length
needs bounded memory: each block is resampled by UP / DOWN with one filter a phase, as one product of windows and phases;
overlapping frames get a Hann window, a Fourier transform and triangular mel filters. A segment begins where a frame's
level, relative to the signal's mean level, reaches ENTER decibels and ends where it falls to LEAVE.

`features` makes a row of each medium: its digests, its log-mels as tensors of the fixed shape (FRAMES, MELS), each with
its time span and the last one padded with the floor, and its segments' time spans. What is reported later (`described`)
is read from those rows. `tensor_rows` and `as_tensors` give the tensors one by one, in Arrow's extension type. Every
document is computed alone, so equal media give equal features.

Cases: null and empty texts are 64 zero bytes; silence has the floor as level and no segments; a broken WAV header is an
error; repeated rows repeat; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import storage

RATE, UP, DOWN, TAPS = 8000, 3, 4, 24
FRAME, HOP, MELS, FRAMES = 256, 128, 24, 64
FLOOR = 1e-8
ENTER, LEAVE = 0.4, -0.2
BLOCK = 1 << 18
#: Stored log-mels are multiples of 1 / GRAIN (0.03 decibels), which take half the space.
GRAIN = 128


def wav(samples: bytes) -> bytes:
    """A RIFF file of unsigned 8-bit samples."""
    return b"RIFF" + struct.pack("<I", 36 + len(samples)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples


def samples_of(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt " or media[36:40] != b"data" or struct.unpack("<HHI", media[20:28]) != (1, 1, RATE):
        raise ValueError("not a WAV file of this rate and form")
    return media[44 : 44 + struct.unpack("<I", media[40:44])[0]]


def payload(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + bytes(-len(data) % 64 or (0 if data else 64))


@cache
def _phases() -> np.ndarray:
    """(TAPS, UP): the low-pass filter of the resampler, a column for each output phase."""
    k = np.arange(TAPS)
    out = np.empty((TAPS, UP))
    cut = min(1.0, UP / DOWN) * 0.94
    for p in range(UP):
        t = k - (TAPS // 2 - 1) - p * DOWN / UP
        out[:, p] = cut * np.sinc(cut * t) * np.where(np.abs(t) <= TAPS / 2, 0.5 + 0.5 * np.cos(2 * np.pi * t / TAPS), 0)
    return (out / out.sum(axis=0)).astype(np.float32)


@cache
def _filters() -> np.ndarray:
    """(FRAME // 2 + 1, MELS) triangular filters, evenly spaced in mels."""
    rate = RATE * UP / DOWN
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1) * FRAME / rate
    bins = np.arange(FRAME // 2 + 1)[:, None]
    return np.maximum(0, np.minimum((bins - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - bins) / (edges[2:] - edges[1:-1]))).astype(np.float32)


def resampled(data: bytes) -> Iterator[np.ndarray]:
    """The signal at RATE * UP / DOWN, in blocks."""
    raw = np.frombuffer(data, np.uint8)
    before = TAPS // 2 - 1
    for a in range(0, len(raw), BLOCK):
        z = min(len(raw), a + BLOCK)
        lo, hi = max(0, a - before), min(len(raw), z + TAPS)
        x = np.zeros(before + (z - a) + TAPS, np.float32)
        x[lo - a + before : hi - a + before] = (raw[lo:hi].astype(np.float32) - 128) / 128
        windows = np.lib.stride_tricks.sliding_window_view(x, TAPS)[: z - a : DOWN]
        yield (np.ascontiguousarray(windows) @ _phases()).ravel()


def log_mels(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frames x MELS log-mel energies, level of each frame in decibels)."""
    window = np.hanning(FRAME + 1)[:-1].astype(np.float32)
    held, mels, levels = np.empty(0, np.float32), [], []

    def take(signal: np.ndarray) -> None:
        frames = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP]
        power = np.abs(np.fft.rfft(frames * window, axis=1)).astype(np.float32) ** 2 / FRAME
        mels.append(np.log(power @ _filters() + np.float32(FLOOR)))
        levels.append(10 * np.log10((frames.astype(np.float64) ** 2).mean(axis=1) + FLOOR))

    for block in resampled(data):
        held = np.concatenate([held, block])
        if (n := (len(held) - FRAME) // HOP + 1) > 0:
            take(held[: (n - 1) * HOP + FRAME])
            held = held[n * HOP :]
    if not mels:  # shorter than a frame
        take(np.concatenate([held, np.zeros(FRAME - len(held), np.float32)]))
    return np.concatenate(mels), np.concatenate(levels)


def segments(levels: np.ndarray) -> list[tuple[float, float]]:
    """Time spans in seconds of what is louder than the signal's mean level, by two thresholds."""
    relative = levels - levels.mean()
    said = np.where(relative >= ENTER, 1, np.where(relative <= LEAVE, 0, -1))
    last = np.maximum.accumulate(np.where(said >= 0, np.arange(len(said)), 0))
    on = (said[last] == 1).view(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], on, [0])))) * (HOP / (RATE * UP / DOWN))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def tensors(mels: np.ndarray) -> np.ndarray:
    """(n, FRAMES, MELS): the frames in fixed shapes, padded with the floor; values to the nearest 1 / GRAIN."""
    n = -(-len(mels) // FRAMES)
    out = np.full((n * FRAMES, MELS), np.log(np.float32(FLOOR)), np.float32)
    out[: len(mels)] = mels
    return (np.round(out * GRAIN) / GRAIN).astype(np.float32).reshape(n, FRAMES, MELS)


def as_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text's bytes as the samples of a WAV file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                texts = [t.as_py() or "" for t in b.column(1).slice(k, 512)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(k, 512), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([wav(payload(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"]
                )

    return storage.in_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(storage.trimmed(run), "doc_id bigint, n_bytes bigint, media binary")


SPAN = "begin_s:double,end_s:double"
FEATURE_SCHEMA = (
    "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, "
    f"tensors array<struct<{SPAN},mels:array<float>>>, segments array<struct<{SPAN}>>"
)
STEP = HOP / (RATE * UP / DOWN)


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), pa.int32()), values)


def _spans(begin: np.ndarray, end: np.ndarray, *more: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(begin, pa.float64()), pa.array(end, pa.float64()), *more], ["begin_s", "end_s", *["mels"][: len(more)]])


def features(media: DataFrame) -> DataFrame:
    """A row for each medium (FEATURE_SCHEMA), all from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said: list[list] = [[] for _ in range(5)]
            cubes, frames, segs = [], [], []
            for m in b.column(2):
                media = m.as_py()
                data = samples_of(media)
                for column, v in zip(said, (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(media), hashlib.sha256(media).hexdigest()), strict=True):
                    column.append(v)
                mels, levels = log_mels(data)
                cubes.append(tensors(mels))
                frames.append(len(mels))
                segs.append(segments(levels))
            sizes = [len(c) for c in cubes]
            part = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.empty(0)
            end = np.minimum((part + 1) * FRAMES, np.repeat(frames, sizes)) * STEP
            flat = pa.array(np.concatenate([c.ravel() for c in cubes]) if cubes else np.empty(0, np.float32))
            of = _lists(sizes, _spans(part * FRAMES * STEP, end, _lists([FRAMES * MELS] * len(part), flat)))
            both = np.array([x for s in segs for x in s], float).reshape(-1, 2)
            spans = _lists([len(s) for s in segs], _spans(both[:, 0], both[:, 1]))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, said, kinds), of, spans], ["doc_id", "n_bytes", *names, "tensors", "segments"])

    return storage.in_batches(media.select("doc_id", "n_bytes", "media")).mapInArrow(storage.trimmed(run), FEATURE_SCHEMA)


def tensor_rows(found: DataFrame) -> DataFrame:
    """A row for each tensor: doc_id, part, its time span and its FRAMES x MELS values, rows first."""
    return found.select("doc_id", F.posexplode("tensors").alias("part", "t")).select("doc_id", "part", "t.begin_s", "t.end_s", "t.mels")


def as_tensors(table: pa.Table) -> pa.Table:
    """An Arrow table of `tensor_rows` with mels as the fixed-shape tensor type."""
    kind = pa.fixed_shape_tensor(pa.float32(), (FRAMES, MELS), dim_names=("frame", "mel"))
    flat = pa.chunked_array([pa.ExtensionArray.from_storage(kind, c.cast(pa.list_(pa.float32(), FRAMES * MELS))) for c in table["mels"].chunks], kind)
    return table.set_column(table.schema.get_field_index("mels"), "mels", flat)


def described(found: DataFrame) -> DataFrame:
    """The rows of `features` with feature in place of tensors and segments: frames, segments, seconds within them, and a
    digest of the log-mels in multiples of 1 / GRAIN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for of, spans in zip(b.column("tensors"), b.column("segments"), strict=True):
                t, s = of.values, spans.values.flatten()
                values = np.round(t.field("mels").flatten().to_numpy().astype(np.float64) * GRAIN).astype("<i4").tobytes()
                inside = sum(z - a for a, z in zip(s[0].to_pylist(), s[1].to_pylist(), strict=True))
                out.append(f"{round(t.field('end_s')[-1].as_py() / STEP)}f {len(s[0])}s {inside:.3f} {hashlib.sha256(values).hexdigest()[:16]}")
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(out, pa.string())], [*keep, "feature"])

    keep = [c for c in found.columns if c not in ("tensors", "segments")]
    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in keep) + ", feature string"
    return storage.in_batches(found.select(*keep, "tensors", "segments")).mapInArrow(storage.trimmed(run), schema)
