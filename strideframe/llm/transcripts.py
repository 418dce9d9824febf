"""Chat formatting: roles of raw transcripts by a hidden Markov model.

Every line of a transcript has a hidden role. What is seen of it is its speaker
marker, if it has one, whether a blank line stands before it, and a few features of the
line; roles tend to stay until a marker or a blank line comes. The most likely roles
are found by Viterbi over the whole transcript; a new turn begins where the role
changes or a marker names the role that was found, and turns are rendered in one
canonical form.

The probabilities are counted on lines with known roles; the counts are small tables
that do not grow with the data.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")

# Speaker names as they stand in transcripts, by role.
SPEAKERS = {
    "system": "system instructions instruction context sys",
    "user": "user human question q customer me prompter",
    "assistant": "assistant ai bot answer a agent model gpt",
}
_SPEAKER = {name: role for role, names in SPEAKERS.items() for name in names.split()}
_MARKER = re.compile(r"\s*(?:#{1,4}\s*|\[|<\|?|\*\*)?\s*([A-Za-z]{1,14})\s*(?:\|?>|\]|\*\*)?\s*(:|-(?=\s)|>(?=\s)|$)\s*")
_WRAPPED = re.compile(r"\s*(?:#{1,4}\s*([A-Za-z]{1,14})\s*:?\s*$|\[([A-Za-z]{1,14})\]:?\s*|<\|([A-Za-z]{1,14})\|>\s*|\*\*([A-Za-z]{1,14}):?\*\*:?\s*)")
MARKERS = (*ROLES, "none")
OPENS = 8
KINDS = 16
#: What a marker of the own role counts before any line is seen, and what staying within a
#: paragraph does: a role that was seen in single lines only keeps its other lines, too.
PRIOR = 8.0
STAY = 1_000.0
#: What a marker of another role counts: it takes much to believe that a marker lies.
WRONG = 0.001


def marker(line: str) -> tuple[str, str]:
    """The role that a line's marker names, or "none", and the line after the marker."""
    m = _WRAPPED.match(line)
    name = next((g for g in m.groups() if g), "") if m else ""
    if not m:
        m = _MARKER.match(line)
        name = m.group(1) if m and m.group(2) else ""
    role = _SPEAKER.get(name.lower(), "none")
    return (role, line[m.end() :]) if role != "none" else ("none", line)


def kind(text: str, first: bool, opens: bool = False) -> int:
    """A line's features as one number: behind a blank line, first of its transcript, a
    question, long."""
    return OPENS * opens + 4 * first + 2 * text.rstrip().endswith("?") + (len(text) > 240)


def boundary(marked: bool, kind: int) -> int:
    """Which table of moves leads to a line: 1 by a marker, 2 by a blank line alone, else 0."""
    return 1 if marked else 2 if kind >= OPENS else 0


@dataclass(frozen=True)
class Line:
    raw: str
    marker: str
    rest: str
    kind: int
    blanks: int


def observe(transcript: str, first: bool = True, opens: bool = False) -> list[Line]:
    """The lines that say something, each with the number of blank ones before it. Where blank
    lines set marked lines apart, a marker inside a paragraph is text."""
    out, blanks = [], 0
    for line in transcript.split("\n"):
        if line.strip():
            m, rest = marker(line)
            out.append((line, m, rest, blanks, blanks > 0 if out else opens))
            blanks = 0
        else:
            blanks += 1
    apart = opens or any(m != "none" and o for _, m, _, _, o in out)
    lines = []
    for i, (line, m, rest, before, o) in enumerate(out):
        if i and apart and not o:
            m, rest = "none", line
        lines.append(Line(line, m, rest, kind(rest, first and not i, o), before))
    return lines


@dataclass(frozen=True)
class RoleModel:
    """Log probabilities: the first role, role to role by :func:`boundary`, and
    markers and line kinds by role."""

    start: list[float]
    move: list[list[list[float]]]
    marker: list[list[float]]
    kind: list[list[float]]

    def roles(self, lines: list[tuple[str, int]]) -> list[int]:
        """The most likely roles of ``(marker, kind)`` lines; ties go to the earlier role."""
        n = range(len(ROLES))
        seen = [[self.marker[r][MARKERS.index(m)] + self.kind[r][k] for r in n] for m, k in lines]
        best, back = [self.start[r] + seen[0][r] for r in n] if seen else [], []
        for (m, k), own in zip(lines[1:], seen[1:], strict=True):
            move = self.move[boundary(m != "none", k)]
            came = [max(n, key=lambda p, r=r: best[p] + move[p][r]) for r in n]
            best = [best[came[r]] + move[came[r]][r] + own[r] for r in n]
            back.append(came)
        path = [max(n, key=lambda r: best[r])] if seen else []
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]


def parse(transcript: str | None, model: RoleModel) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns; none for a text without lines that say anything.

    A marker is cut where it names the role that was found, and stays as text elsewhere. A
    marked turn without text is a turn with an empty text."""
    lines = observe(transcript or "")
    turns: list[tuple[int, list[str]]] = []
    for line, role in zip(lines, model.roles([(x.marker, x.kind) for x in lines]), strict=True):
        named = line.marker == ROLES[role]
        if not turns or named or role != turns[-1][0]:
            turns.append((role, []))
        else:
            turns[-1][1].extend([""] * line.blanks)
        turns[-1][1].append(line.rest if named else line.raw)
    return [(ROLES[r], "\n".join(own).strip("\n ")) for r, own in turns]


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form: a role line, the text and an end line for each turn."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def fit(lines: DataFrame) -> RoleModel:
    """From ``role, before, marker, kind`` of lines with known roles: ``before`` is the
    role of the line before, null for a first line. Other roles are left out; every
    count gets one more, but :data:`PRIOR` where a marker names the role, :data:`STAY` where
    a line goes on within a paragraph, and :data:`WRONG` where a marker names another role."""
    known = lines.where(F.col("role").isin(*ROLES)).groupBy("role", "before", "marker", "kind").count().collect()
    start = [1.0] * 3
    move = [[[1.0] * 3 for _ in ROLES] for _ in range(3)]
    marks, kinds = [[WRONG] * 3 + [1.0] for _ in ROLES], [[1.0] * KINDS for _ in ROLES]
    for role in range(len(ROLES)):
        marks[role][role], move[0][role][role] = PRIOR, STAY
    for r in known:
        role = ROLES.index(r["role"])
        marks[role][MARKERS.index(r["marker"])] += r["count"]
        kinds[role][r["kind"]] += r["count"]
        if r["before"] is None:
            start[role] += r["count"]
        elif r["before"] in ROLES:
            move[boundary(r["marker"] != "none", r["kind"])][ROLES.index(r["before"])][role] += r["count"]

    def logs(row: list[float]) -> list[float]:
        return [math.log(x / sum(row)) for x in row]

    return RoleModel(logs(start), [[logs(r) for r in m] for m in move], [logs(r) for r in marks], [logs(r) for r in kinds])


def labelled_lines(turns: DataFrame, transcript_turn: str = "raw", role: str = "role", conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Lines for :func:`fit` from turns as they stand in a transcript, a blank line between
    any two, with their roles. Null and empty turns have no lines; rows with null roles are
    lines that :func:`fit` leaves out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for own, last, first, raw in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                for i, line in enumerate(observe(raw or "", first, not first)):
                    rows.append((own, own if i else last, line.marker, line.kind))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["role", "before", "marker", "kind"])

    from pyspark.sql import Window as W

    order = W.partitionBy(conversation).orderBy(turn, role, transcript_turn)
    before = turns.select(F.col(role).alias("role"), F.lag(role).over(order).alias("last"), (F.row_number().over(order) == 1).alias("first"), F.col(transcript_turn).alias("raw"))
    return before.mapInArrow(run, "role string, before string, marker string, kind int")


def parse_transcripts(transcripts: DataFrame, model: RoleModel, id: str = "conv_id", text: str = "transcript") -> DataFrame:
    """``id, turn, role, text, rendered``: the turns of each transcript, numbered from 0,
    each with its canonical form. Null and empty transcripts have no turns; equal ids
    give turns under one id."""
    kind_of = dict(transcripts.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, rows = [], []
            for name, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                turns = parse(t, model)
                names += [name] * len(turns)
                rows += [(i, role, own, render([(role, own)])) for i, (role, own) in enumerate(turns)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, b.column("id").type), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["id", "turn", "role", "text", "rendered"],
            )

    named = transcripts.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(run, f"id {kind_of}, turn long, role string, text string, rendered string").withColumnRenamed("id", id)
