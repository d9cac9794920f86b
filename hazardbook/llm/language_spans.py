"""Language identification of mixed texts.

A model counts letter trigrams of labelled documents by language, and which scripts a
language uses. A word's script narrows the candidates; each candidate scores the word
by its trigrams. Viterbi with a penalty for switching then labels every word of a text,
and runs of one label are the spans. The document's language is the one with most
letters, its score the share of letters.

Defined results: a text that is null or has no letter is ``und`` with score 0 and has no
spans, and so is every text when there is nothing to learn from; of languages with
equally many letters the first by name is taken. The model is learnt from about
``sample`` documents a language, taken by a hash of the id; its size is bounded by the
number of languages, and everything is labelled in whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardbook.llm.common import U64, chunks, code_points, texts_of
from hazardbook.session import stage

BUCKETS = 1 << 15
SWITCH = 12.0
SAMPLE = 3000
MANY_LANGUAGES = 10_000  # as many rows of the shares are broadcast at most
UNKNOWN = "und"

# First and last code point of the blocks of a script.
SCRIPTS = (
    ("Latin", 0x0041, 0x024F), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Tamil", 0x0B80, 0x0BFF),
    ("Thai", 0x0E00, 0x0E7F), ("Georgian", 0x10A0, 0x10FF), ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
)
_NAMES = sorted({name for name, _, _ in SCRIPTS})
N_SCRIPTS = len(_NAMES) + 1  # the last is any other script

_tables: dict[str, np.ndarray] = {}


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower-case form if it is a letter, else 0; and its script."""
    if not _tables:
        lower = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                small = char.lower()
                lower[point] = ord(small) if len(small) == 1 else point
        script = np.full(0x110000, N_SCRIPTS - 1, np.int8)
        for name, first, last in SCRIPTS:
            script[first : last + 1] = _NAMES.index(name)
        _tables.update(lower=lower, script=script)
    return _tables["lower"], _tables["script"]


def _trigrams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts that end in a non-letter: the positions of letters, the bucket of the
    trigram around each, and its script."""
    lower, script = _letters()
    small = lower[points]
    at = np.flatnonzero(small)
    padded = np.concatenate([[0], small, [0]]).astype(U64)
    h = padded[at] * U64(0x9E3779B1) + padded[at + 1] * U64(0x85EBCA77C2B2AE63) + padded[at + 2] * U64(0xC2B2AE3D27D4EB4F)
    return at, ((h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(49)).astype(np.int64), script[points[at]]


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # languages x buckets, logarithms
    uses: np.ndarray  # languages x scripts


def learn(docs: DataFrame, doc_id: str, text: str, lang: str, sample: int = SAMPLE) -> Model:
    """A model from the labelled ones of ``docs``; at most languages x buckets counts
    come to the driver."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    share = stage(
        labelled.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    )
    # One row a language: texts stay where they are, whatever language a third of them has.
    few = share.count() <= MANY_LANGUAGES
    drawn = labelled.join(F.broadcast(share) if few else share, "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.col("share") * 1_000_003
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in chunks(texts_of(batch)):
                points, starts = code_points([t + "\n" for t in texts])
                at, bucket, script = _trigrams(points)
                cuts = np.searchsorted(at, starts)
                for i, _ in enumerate(texts):
                    held = seen.setdefault(langs[first + i], np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                    here = slice(cuts[i], cuts[i + 1])
                    held[:BUCKETS] += np.bincount(bucket[here], minlength=BUCKETS)
                    held[BUCKETS:] += np.bincount(script[here], minlength=N_SCRIPTS)
        for name, held in seen.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(held[at])], ["lang", "bucket", "n"]
            )

    counts = drawn.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long")
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    held = np.zeros((len(languages), BUCKETS + N_SCRIPTS))
    for i, name in enumerate(languages):
        of = table[table["lang"] == name]
        held[i, of["bucket"]] = of["n"]
    seen, scripts = held[:, :BUCKETS] + 0.5, held[:, BUCKETS:]
    scores = np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32)
    uses = scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, scores, uses)


def word_scores(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scores (words x languages) of all words, their starts and ends within their texts,
    and the number of words of each text."""
    points, starts = code_points([t + "\n" for t in texts])
    at, bucket, script = _trigrams(points)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return np.zeros((0, len(model.languages)), np.float32), empty, empty, np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    begin = at[first]
    end = at[np.concatenate([first[1:] - 1, [len(at) - 1]])] + 1
    scores = np.stack([np.add.reduceat(row[bucket], first) for row in model.scores], axis=1)
    uses = model.uses[:, script[first]].T
    scores -= np.where(uses | ~uses.any(axis=1, keepdims=True), 0, 1e3).astype(np.float32)
    cuts = np.searchsorted(begin, starts)
    of = np.repeat(starts[:-1], np.diff(cuts))
    return scores, begin - of, end - of, np.diff(cuts)


def best_paths(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word, by Viterbi over all texts side by side: step t
    advances every text that has more than t words."""
    order = np.argsort(-counts, kind="stable")
    counts, firsts = counts[order], (np.cumsum(counts) - counts)[order]
    steps = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(steps), side="left")
    labels = np.zeros(len(scores), np.int8)
    back = np.zeros(scores.shape, np.int8)
    value = np.zeros((len(counts), scores.shape[1]), np.float32)
    own = np.arange(scores.shape[1], dtype=np.int8)
    for t in range(steps):
        a = active[t]
        held, rows = value[:a], firsts[:a] + t
        best = held.argmax(axis=1)
        jump = held[np.arange(a), best] - switch
        stay = held >= jump[:, None]
        back[rows] = np.where(stay, own, best[:, None])
        value[:a] = np.where(stay, held, jump[:, None]) + scores[rows]
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        rows = firsts[: active[t]] + t
        if t + 1 < steps:  # texts that go on were labelled at t + 1
            go_on = active[t + 1]
            state[:go_on] = back[rows[:go_on] + 1, state[:go_on]]
        labels[rows] = state[: active[t]]
    return labels


def label(texts: list[str], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans of every text."""
    if not model.languages:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    parts = [word_scores(some, model) for _, some in chunks(texts)]
    if not parts:
        return []
    scores, begin, end, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
    labels = best_paths(scores, counts, switch)
    found, first, n = [], 0, len(model.languages)
    for count in counts:
        if not count:
            found.append((UNKNOWN, 0.0, []))
            continue
        some, b, e = (x[first : first + count] for x in (labels, begin, end))
        letters = np.bincount(some, weights=e - b, minlength=n)
        cut = np.flatnonzero(np.diff(some, prepend=-1))
        last = np.concatenate([cut[1:] - 1, [count - 1]])
        spans = [
            {"start": int(b[i]), "end": int(e[j]), "lang": model.languages[some[i]]}
            for i, j in zip(cut, last, strict=True)
        ]
        top = int(letters.argmax())
        found.append((model.languages[top], float(letters[top] / letters.sum()), spans))
        first += count
    return found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def identify(docs: DataFrame, doc_id: str, text: str, model: Model, switch: float = SWITCH) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` (code points) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label(texts_of(batch), model, switch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], SPANS),
                ],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
    )


def identified(docs: DataFrame, text: str, model: Model, least: float = 0.5, switch: float = SWITCH) -> DataFrame:
    """The rows whose text has a language that covers at least ``least`` of its letters,
    with all their columns. Rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label(texts_of(batch, text), model, switch)
            yield batch.filter(pa.array([x[0] != UNKNOWN and x[1] >= least for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
