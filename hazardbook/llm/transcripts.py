"""Transcript parsing by a hidden Markov model, and canonical rendering of turns.

A transcript is a sequence of lines. Its hidden states say whose turn a line belongs to
and whether it opens the turn. What shows of a line is its speaker marker, such as
``Human:`` or ``### Assistant``, whether it ends in a question, and how long it is.
Viterbi recovers the states; a turn is an opening line with those that go on, and is
rendered the same way however the transcript was written.

The model counts states, moves and features over all turns whose role is known. Long
transcripts come in pieces of ``PIECE`` turns, so no task holds a whole one; a piece that
begins without a marker starts from the model's first-state probabilities.

Defined results: a null role has no marker in the transcript, its role is inferred; a
null text is an empty line; turns of one number are ordered by role and text; without any
known role there is no model, and every piece is one turn of the role ``unknown``; a row
without a transcript id belongs to the transcript null; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardbook.llm.common import viterbi
from hazardbook.session import stage

PIECE = 64
SMOOTH = 0.01

# Words that open a turn, and the role that they mean.
SPEAKERS = {
    "user": "user", "human": "user", "customer": "user", "prompter": "user",
    "assistant": "assistant", "bot": "assistant", "ai": "assistant", "agent": "assistant",
    "system": "system", "instructions": "system",
    "tool": "tool", "function": "tool",
}
_MARKER = re.compile(r"(?:#{1,4} +|\*\*|<\|)?([A-Za-z]{2,20})(?: *:\*\*|\*\*:|\|>|:)(?: |$)")

Line = tuple[str, str]  # the speaker a marker names or "", and the rest of the line


def parsed(line: str) -> Line:
    m = _MARKER.match(line)
    if not m:
        return "", line
    word = m[1].lower()
    return SPEAKERS.get(word, "other"), line[m.end() :]


def traits(line: Line) -> tuple[str, int, int]:
    """Marker, question, and length class."""
    marker, rest = line
    return marker, int(rest.rstrip().endswith("?")), min(len(rest).bit_length(), 12)


@dataclass
class Model:
    roles: list[str]
    opening: np.ndarray
    moves: np.ndarray
    markers: dict[str, np.ndarray]
    question: np.ndarray  # 2 x states
    length: np.ndarray  # 13 x states

    def emissions(self, lines: list[Line]) -> np.ndarray:
        none = np.full(2 * len(self.roles), np.log(SMOOTH))
        return np.stack([
            self.markers.get(marker, none) + self.question[q] + self.length[n]
            for marker, q, n in map(traits, lines)
        ])


def pieces(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id``, ``piece`` and its turns in order as (role, lines of the transcript).

    A row with a known role is written with a marker in one of three styles, as
    transcripts of different origin are. More than ``PIECE`` rows of one number, which
    repeated or missing turn or conversation numbers make, have no order among
    themselves; they are dealt into as many pieces of that number as they need.
    """
    word = F.initcap(F.col(role))
    style = F.pmod(F.xxhash64(F.col(conv)), F.lit(3))
    other = F.when(F.col(role) == "user", "Human").when(F.col(role) == "assistant", "AI").otherwise(word)
    marker = F.when(style == 0, F.concat(word, F.lit(": "))).when(
        style == 1, F.concat(F.lit("### "), other, F.lit(": "))
    ).otherwise(F.concat(F.lit("**"), word, F.lit(":** ")))
    written = F.concat(F.coalesce(marker, F.lit("")), F.coalesce(F.col(text), F.lit("")))
    row = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), written.alias("written"))
    number = F.coalesce(F.col(turn), F.lit(0))
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.floor(number / PIECE).cast("long").alias("piece"), row.alias("row"),
        F.monotonically_increasing_id().alias("at"),
    )
    crowded = stage(
        rows.groupBy("conv_id", "piece").agg(F.count("*").alias("held")).where(F.col("held") > PIECE)
        .select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), F.ceil(F.col("held") / (PIECE * 0.75)).alias("parts"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))
    part = F.coalesce(F.pmod(F.xxhash64("at"), F.col("parts")), F.lit(0)).alias("part")
    dealt = rows.join(crowded, same, "left").select("conv_id", "piece", part, "row")
    return dealt.groupBy("conv_id", "piece", "part").agg(
        F.array_sort(F.collect_list("row")).alias("turns")
    ).drop("part")


def learn(cut: DataFrame) -> Model | None:
    """A model from the turns with a known role; the counts that come to the driver are
    bounded by states and traits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str, str], int] = {}

        def add(what: str, a: str, b: str) -> None:
            seen[what, a, b] = seen.get((what, a, b), 0) + 1

        for batch in batches:
            for turns in batch.column("turns").to_pylist():
                before = ""
                for t in turns:
                    if t["role"] is None:
                        before = ""
                        continue
                    for i, line in enumerate(t["written"].split("\n")):
                        state = f"{'g' if i else 'o'} {t['role']}"
                        marker, question, length = traits(parsed(line))
                        add("move" if before else "first", before, state)
                        add("marker", marker, state)
                        add("question", str(question), state)
                        add("length", str(length), state)
                        before = state
        rows = [(*k, n) for k, n in seen.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = [pa.string()] * 3 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["what", "a", "b", "n"]
        )

    counts = cut.select("turns").mapInArrow(count, "what string, a string, b string, n long")
    table = counts.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    roles = sorted({row["b"][2:] for row in table})
    if not roles:
        return None
    states = [f"{kind} {role}" for role in roles for kind in "og"]
    place = {s: i for i, s in enumerate(states)}
    n = len(states)
    moves, opening = np.full((n, n), SMOOTH), np.full(n, SMOOTH)
    question, length = np.full((2, n), 1.0), np.full((13, n), 1.0)
    markers: dict[str, np.ndarray] = {m: np.full(n, SMOOTH) for m in ("", "other", *SPEAKERS.values())}
    for what, a, b, k in table:
        at = place[b]
        if what == "move":
            moves[place[a], at] += k
        elif what == "first":
            opening[at] += k
        elif what == "marker":
            markers[a][at] += k
        elif what == "question":
            question[int(a), at] += k
        else:
            length[int(a), at] += k
    for i, state in enumerate(states):  # a turn goes on only as its own
        if state[0] == "g":
            for j, other in enumerate(states):
                if other[2:] != state[2:]:
                    moves[j, i] = 1e-30
    total = sum(markers.values())
    return Model(
        roles, np.log(opening / opening.sum()), np.log(moves / moves.sum(axis=1, keepdims=True)),
        {m: np.log(v / total) for m, v in markers.items()},
        np.log(question / question.sum(axis=0)), np.log(length / length.sum(axis=0)),
    )


def rendered(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def turns_of(transcripts: list[list[str]], model: Model | None) -> list[list[tuple[str, str, int]]]:
    """Role, text and number of lines of every turn of every transcript."""
    if model is None:
        return [[("unknown", "\n".join(lines), len(lines))] for lines in transcripts]
    split = [[parsed(line) for line in lines] for lines in transcripts]
    paths = viterbi([model.emissions(lines) for lines in split], model.moves, model.opening)
    found = []
    for lines, raw, states in zip(split, transcripts, paths, strict=True):
        turns: list[tuple[str, list[str]]] = []
        for (marker, rest), line, state in zip(lines, raw, states, strict=True):
            role = model.roles[state // 2]
            if state % 2 == 0 or not turns:
                # A marker of the state's own role is not part of what was said.
                turns.append((role, [rest if marker and marker != "other" else line]))
            else:
                turns[-1][1].append(line)
        found.append([(role, "\n".join(said), len(said)) for role, said in turns])
    return found


def parse(cut: DataFrame, model: Model | None) -> DataFrame:
    """One row a recovered turn: ``conv_id``, ``piece``, ``turn`` (from 0 in its piece),
    ``role``, ``n_lines`` and the ``rendered`` turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = ["\n".join(t["written"] for t in turns).split("\n") for turns in batch.column("turns").to_pylist()]
            found = turns_of(raw, model) if raw else []
            rows = [(i, k, role, n, rendered(role, said)) for i, turns in enumerate(found) for k, (role, said, n) in enumerate(turns)]
            at, *rest = zip(*rows, strict=True) if rows else [[]] * 5
            at = pa.array(list(at), pa.int64())
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").take(at), batch.column("piece").take(at),
                 *(pa.array(list(c), k) for c, k in zip(rest, kinds, strict=True))],
                ["conv_id", "piece", "turn", "role", "n_lines", "rendered"],
            )

    kind = cut.schema["conv_id"].dataType.simpleString()
    return cut.mapInArrow(
        run, f"conv_id {kind}, piece long, turn long, role string, n_lines long, rendered string"
    )
