"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: str) -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def chunks(texts: Iterable[str], limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Texts in order, as (position of the first, texts) with about ``limit`` characters
    together, so that memory follows the limit or the longest text, not the batch."""
    held: list[str] = []
    size = first = 0
    for i, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts, one after the other, and where each text starts
    (with the total length at the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return points, starts


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        run = np.full(max(n, 1 << 20), base & (2**64 - 1), U64)
        run[0] = 1
        held = _powers[name] = np.multiply.accumulate(run)
    return held[:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, ASCII letters lower-cased, and
    the number of words of each text.

    One pass over the bytes: prefix sums of ``byte * base**position`` give every word's
    polynomial by a subtraction; it is shifted to position 0 and scrambled.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b" ".join([b"", *encoded, b""]), np.uint8)
    space = _SPACE[raw]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    sums = np.zeros(len(raw) + 1, U64)
    np.cumsum((_LOWER[raw].astype(U64) + U64(1)) * _power("up", _BASE, len(raw)), out=sums[1:])
    inverse = _power("down", pow(_BASE, -1, 2**64), len(raw))
    words = (sums[end] - sums[begin]) * inverse[begin]
    words = mix(words + (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))
    firsts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])])
    return words, np.diff(np.searchsorted(begin, firsts + 1))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The whole texts of a batch; a null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def viterbi(runs: list[np.ndarray], moves: np.ndarray, opening: np.ndarray) -> list[np.ndarray]:
    """The best labels of every run of emissions (steps x labels), given the scores of moves
    between labels and of the first label; step t advances all runs that long."""
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    lengths = np.array([len(runs[i]) for i in order], np.int64)
    if not len(order):
        return []
    emit = np.concatenate([runs[i] for i in order])
    firsts = np.cumsum(lengths) - lengths
    back = np.zeros(emit.shape, np.int8)
    value = emit[firsts] + opening
    for t in range(1, int(lengths[0])):
        a = np.searchsorted(-lengths, -t, side="left")
        paths = value[:a, :, None] + moves
        back[firsts[:a] + t] = paths.argmax(axis=1)
        value[:a] = paths.max(axis=1) + emit[firsts[:a] + t]
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
    for k, i in enumerate(order):
        labels = np.zeros(lengths[k], np.int64)
        labels[-1] = value[k].argmax()
        for t in range(lengths[k] - 1, 0, -1):
            labels[t - 1] = back[firsts[k] + t, labels[t]]
        found[i] = labels
    return found
