"""Conversation structure repair: the cheapest edits that make roles alternate.

Roles must read ``(s?(ua)+)?`` by their initials. Turns may be kept (0), given another
role (3) or deleted (4), and empty turns may be inserted (3); blank and duplicate turns
must go, and a truncated turn that stays costs 3 more. Of all cheapest edit strings the
ASCII-least is taken.

The cost to the end from each of the grammar's four states is a vector for every place in
a conversation. Of these vectors only those at checkpoints are stored, one for every
square root of the conversation's turns; between two checkpoints they are computed anew
while the edits are walked forward. Here a block is what lies between two checkpoints, and
blocks are rows that Spark deals out:

1. each block gives the least costs from its states at the start to those at its end;
2. these small tables are chained backwards, which gives the vectors at the checkpoints;
3. each block, with the vector at its end, recomputes its own vectors and walks forward
   along tight edits, from every state it might be entered in;
4. the states that are really entered are chained forwards, and pick the edits.

So a conversation of n turns never puts more than about the square root of n blocks, or of
n turns, into one task, with the exception of results that are one value by definition (the
edit string) and of the digest, which is streamed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import cut
from strideframe.llm.digests import ordered_sha256
from strideframe.operators.series import number_rows

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 40

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
#: ``NEXT`` is the state after a turn in the role that an insertion or another role gives.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
GIVEN = (None, None, "user", "assistant")
#: State after keeping a turn with initial s, u, a or another.
KEEP = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
#: Costs at the end of a conversation: a user turn lacks its answer, a system turn both.
AT_END = (0, 2 * INSERT, INSERT, 0)

NONE, BLANK, DUPLICATE, CUT_SHORT = range(4)

_VISIBLE = r"[^\x20\x09-\x0D]"


def _step(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a turn from the one after it. ``code`` is 4 * fault + initial."""
    fault, initial = divmod(code, 4)
    own = []
    for s in range(4):
        best = DELETE + after[s]
        if fault not in (BLANK, DUPLICATE):
            stay = TRUNCATED if fault == CUT_SHORT else 0
            kept = KEEP[s][initial]
            best = min(best, stay + REROLE + after[NEXT[s]], stay + after[kept] if kept is not None else FAR)
        own.append(best)
    u, a = own[USER], own[ASSISTANT]
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(own[START], INSERT + u), min(own[SYSTEM], INSERT + u), u, a


#: Blocks of at most so many turns are remembered; most conversations are short and alike.
REMEMBERED_TURNS = 16


def _remember(f):
    """Cache ``f`` for short blocks only, so that the cache stays small."""
    short = lru_cache(maxsize=1 << 14)(f)
    return wraps(f)(lambda codes, *rest: (short if len(codes) <= REMEMBERED_TURNS else f)(codes, *rest))


@_remember
def block_costs(codes: tuple[int, ...]) -> tuple[tuple[int, ...], ...]:
    """``[state at the end][state at the start]``: least costs over the block's turns."""
    out = []
    for end in range(4):
        vector = tuple(0 if s == end else FAR for s in range(4))
        for code in reversed(codes):
            vector = tuple(min(FAR, c) for c in _step(code, vector))
        out.append(vector)
    return tuple(out)


def checkpoints(costs: list[tuple[tuple[int, ...], ...]]) -> tuple[list[tuple[int, ...]], int]:
    """The vector at the end of each block, and the cost of the whole conversation."""
    vector, ends = AT_END, []
    for block in reversed(costs):
        ends.append(vector)
        vector = tuple(min(block[e][s] + vector[e] for e in range(4)) for s in range(4))
    return ends[::-1], vector[START]


@_remember
def walk(codes: tuple[int, ...], at_end: tuple[int, ...], last: bool, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits of a block from ``state``, and the state they end in.

    ``at_end`` is the checkpoint's vector less its least value: only differences matter.
    """
    vectors = [at_end]
    for code in reversed(codes):
        vectors.append(_step(code, vectors[-1]))
    vectors.reverse()
    edits = []
    for i, code in enumerate(codes):
        fault, initial = divmod(code, 4)
        stay = TRUNCATED if fault == CUT_SHORT else 0
        while True:
            here, after = vectors[i], vectors[i + 1]
            if DELETE + after[state] == here[state]:
                edits.append("D")
                break
            if INSERT + here[NEXT[state]] == here[state]:
                edits.append("I")
                state = NEXT[state]
                continue
            kept = KEEP[state][initial]
            if fault not in (BLANK, DUPLICATE) and kept is not None and stay + after[kept] == here[state]:
                edits.append("K")
                state = kept
            else:
                edits.append("R")
                state = NEXT[state]
            break
    while last and AT_END[state]:
        edits.append("I")
        state = NEXT[state]
    return "".join(edits), state


def _key(c: Column) -> Column:
    """A conversation's key that is never null; null ids are one conversation."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), c.cast("string")))


def with_faults(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(turns, faults)``: ``k, conv, turn, role, text, pos, n`` in order, and ``k, pos, n, code,
    illegal`` for each. Both are written once.

    Order is by turn, nulls first; ties go by role, then text. Null roles and texts count as
    one space. A turn's first fault counts: blank, then duplicate (role and text seen
    earlier in the conversation), then truncated.
    """
    c = {n: F.col(f"`{v}`") for n, v in (("conv", conv), ("turn", turn), ("role", role), ("text", text))}
    space = F.lit(" ")
    rows = turns.select(_key(c["conv"]).alias("k"), c["conv"].alias("conv"), c["turn"].alias("turn"), F.coalesce(c["role"], space).alias("role"), F.coalesce(c["text"], space).alias("text"))
    rows = rows.withColumn("ini", F.substring("role", 1, 1))
    placed = number_rows(rows, ["k"], ["turn", "role", "text"], "pos", lags=("ini",), length="n")
    seen = F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)
    alone = F.when(~F.col("text").rlike(_VISIBLE), BLANK).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_SHORT).otherwise(NONE)
    pair = F.concat("prev_ini", "ini")
    placed = placed.select(
        "k", "conv", "turn", "role", "text", "pos", "n",
        F.when(F.col("ini") == "s", 0).when(F.col("ini") == "u", 1).when(F.col("ini") == "a", 2).otherwise(3).alias("initial"),
        alone.alias("alone"), seen.alias("seen"),
        (F.col("prev_ini").isNotNull() & ~pair.isin("su", "ua", "au")).cast("long").alias("illegal"),
    )
    placed = cut(placed, "turns")
    first = placed.where(F.col("alone") != BLANK).groupBy("k", "seen").agg(F.min("pos").alias("pos")).select("k", "pos", F.lit(True).alias("is_first"))
    fault = F.when((F.col("alone") != BLANK) & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("alone"))
    joined = placed.select("k", "pos", "n", "initial", "alone", "illegal").join(first, ["k", "pos"], "left")
    return placed, cut(joined.select("k", "pos", "n", (4 * fault + F.col("initial")).cast("int").alias("code"), "illegal"), "faults")


def edits(faults: DataFrame) -> DataFrame:
    """``k, block, first, codes, state, edits, cost``: every block's edits, from the state it
    is entered in. ``first`` is its first turn's place; ``cost`` is the conversation's. Written once."""
    size = F.ceil(F.sqrt("n")).cast("long")
    own = F.array_sort(F.collect_list(F.struct("pos", "code")))
    blocks = (
        faults.select("k", "pos", "code", F.floor(F.col("pos") / size).cast("long").alias("block"))
        .groupBy("k", "block")
        .agg(own.alias("own"))
        .select("k", "block", F.col("own")[0]["pos"].alias("first"), F.col("own.code").alias("codes"))
    )
    blocks = cut(blocks, "blocks")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [[x for row in block_costs(tuple(c)) for x in row] for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("block"), pa.array(flat, pa.list_(pa.int64()))], names=["k", "block", "costs"])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k, chain in zip(batch.column("k").to_pylist(), batch.column("chain").to_pylist(), strict=True):
                ends, cost = checkpoints([tuple(tuple(b["costs"][4 * e : 4 * e + 4]) for e in range(4)) for b in chain])
                for i, (b, end) in enumerate(zip(chain, ends, strict=True)):
                    for column, x in zip(out, (k, b["block"], list(end), i == len(chain) - 1, cost), strict=True):
                        column.append(x)
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["k", "block", "at_end", "last", "cost"])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, leaves = [], []
            for codes, end, last in zip(*(batch.column(n).to_pylist() for n in ("codes", "at_end", "last")), strict=True):
                least = min(end)
                walked = [walk(tuple(codes), tuple(x - least for x in end), last, s) for s in range(4)]
                ways.append([w for w, _ in walked])
                leaves.append([s for _, s in walked])
            kept = [batch.column(n) for n in ("k", "block", "first", "codes", "cost")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ways, pa.list_(pa.string())), pa.array(leaves, pa.list_(pa.int32()))], names=["k", "block", "first", "codes", "cost", "ways", "leaves"])

    costs = blocks.mapInArrow(tables, "k string, block long, costs array<long>")
    chains = costs.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("chain"))
    marks = chains.mapInArrow(backward, "k string, block long, at_end array<long>, last boolean, cost long")
    walked = cut(
        blocks.join(marks, ["k", "block"]).mapInArrow(forward, "k string, block long, first long, codes array<int>, cost long, ways array<string>, leaves array<int>"),
        "walked-blocks",
    )
    # the states entered, from block to block: one small number for each block
    entered = F.aggregate(
        F.array_sort(F.collect_list(F.struct("block", "leaves"))),
        F.expr("struct(0 AS state, CAST(array() AS array<struct<block: bigint, state: int>>) AS seen)"),
        lambda acc, b: F.struct(b["leaves"][acc["state"]].alias("state"), F.concat(acc["seen"], F.array(F.struct(b["block"].alias("block"), acc["state"].alias("state")))).alias("seen")),
    )
    states = walked.groupBy("k").agg(entered["seen"].alias("seen")).select("k", F.explode("seen").alias("e")).select("k", "e.block", "e.state")
    picked = walked.join(states, ["k", "block"])
    return cut(picked.select("k", "block", "first", "codes", "state", F.col("ways")[F.col("state")].alias("edits"), "cost"), "edits")


def repaired(placed: DataFrame, planned: DataFrame) -> DataFrame:
    """``k, block, step, edit, pos, role, text``: the turns that are left, in (block, step) order.
    Inserted turns have no place of their own (null ``pos``) and empty text."""

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for k, block, first, codes, state, string in zip(*(batch.column(n).to_pylist() for n in ("k", "block", "first", "codes", "state", "edits")), strict=True):
                at = 0
                for step, edit in enumerate(string):
                    place, given = None if edit == "I" else first + at, None
                    if edit != "I":
                        code, at = codes[at], at + 1
                    if edit == "D":
                        continue
                    state = KEEP[state][code % 4] if edit == "K" else NEXT[state]
                    if edit != "K":
                        given = GIVEN[state]
                    for column, x in zip(out, (k, block, step, edit, place, given), strict=True):
                        column.append(x)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["k", "block", "step", "edit", "pos", "given"])

    steps = planned.mapInArrow(unroll, "k string, block long, step long, edit string, pos long, given string")
    placed = steps.where("pos IS NOT NULL").join(placed.select("k", "pos", "role", "text"), ["k", "pos"])
    new = steps.where("pos IS NULL").select("k", "pos", "block", "step", "edit", "given", F.lit("").alias("role"), F.lit("").alias("text"))
    return placed.unionByName(new).select("k", "block", "step", "edit", "pos", F.coalesce("given", "role").alias("role"), "text")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(report, repaired turns)`` of all conversations that have a turn.

    The report has one row per conversation: ``k``, the id, ``gaps`` (turn numbers missing
    between the least and the greatest), ``blank, duplicate, truncated, illegal`` (adjacent
    roles that may not follow each other), ``cost`` and ``audit`` (the edits' initials).
    Null ids are one conversation; an empty table gives empty tables; repeated rows are
    duplicates; other columns are ignored.
    """
    placed, faults = with_faults(turns, conv, turn, role, text)
    planned = edits(faults)
    fault = F.floor(F.col("code") / 4)
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = [F.sum((fault == f).cast("long")).alias(name) for f, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT_SHORT, "truncated"))]
    span = placed.groupBy("k").agg(F.first("conv", ignorenulls=True).alias(conv), F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"))
    found = faults.groupBy("k").agg(*counted, F.sum("illegal").alias("illegal"))
    whole = planned.groupBy("k").agg(F.first("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "edits"))), lambda b: b["edits"]), "").alias("audit"))
    return span.join(found, "k").join(whole, "k"), repaired(placed, planned)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in by the CRC-32 of ``conv_id:turn`` (null: one space) modulo 20:
    0 drops a turn, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes it the user's. Null roles and texts are one space."""
    space = F.lit(" ")
    part = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20).alias("fault"))
    rows = rows.where("fault != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's row for each id of ``conversations``, after ``damaged``."""
    report, left = repair(damaged(conversations))
    line = F.concat("role", F.lit(":"), "text")
    hashes = ordered_sha256(left.select("k", "block", "step", line.alias("line")), ["k"], ["block", "step"], "line", "\n", "repaired_sha256")
    ids = conversations.select("conv_id").distinct().withColumn("k", _key(F.col("conv_id")))
    zero, none = F.lit(0).cast("long"), F.sha2(F.lit("").cast("binary"), 256)
    counts = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = ids.join(report.drop("conv_id"), "k", "left").join(hashes, "k", "left")
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
