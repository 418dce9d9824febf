"""Conversation prefix trie: which conversations share their first turns, and what that saves.

Every distinct sequence of first turns is a node. A prefix is named by 128 bits: the XOR of
two 64-bit hashes of each turn together with its place, so that names of all prefixes come
from running XORs, and long conversations can be cut into segments that go to any task.

Tasks insert their segments into z-fast tries, in batches. A z-fast trie keeps compacted
nodes only, each hashed under the name of one prefix on its edge: the one whose depth is
the edge's two-fattest number. A conversation's exit node is located by fat binary search
over depths, with one look-up for a step; the edge is split where the conversation leaves
it. A full batch expands its edges into one row for each distinct prefix, and Spark adds
the rows of all batches up by name. Prefixes that many conversations share are thus one row
for each batch, however hot they are.

Subtree sums go along chains: a node belongs to its smallest member, and the nodes of one
owner are one path that hangs from a node of a smaller owner. Sums are taken along chains
by running totals, and passed from chains to the ones they hang from, one level of chains
a round; what arrives at the same node is added up before it moves on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.llm.common import cut
from strideframe.llm.digests import ordered_sha256
from strideframe.operators.series import hot_groups, number_rows

#: Turns in a segment, and turns that a task inserts before it expands its trie.
SEGMENT_TURNS = 4_096
BATCH_TURNS = 400_000
#: Conversations of one family share the first turns of its first member.
FAMILY, SHARED = 20, 4

_WORD = r"[^\x20\x09-\x0D]+"


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class ZFastTrie:
    """A forest of compacted tries over strings of prefix names, one for each root name.

    A string is its list of names ``names[i]`` at depths ``base + i``; ``names[0]`` is the
    root it starts from. Node ``v`` covers depths ``above[v] < d <= depth[v]``, and ``at[v]``
    is a string through it.
    """

    def __init__(self) -> None:
        self.roots: dict = {}
        self.handles: dict = {}  # name at the two-fattest depth of an edge -> its node
        self.firsts: dict = {}  # name at the first depth of an edge -> its node
        self.above: list[int] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.at: list[int] = []
        self.count: list[int] = []
        self.least: list[int] = []
        self.strings: list[tuple[int, list, list]] = []
        self.turns = 0

    def _node(self, parent: int, above: int, depth: int, at: int) -> int:
        for column, x in zip((self.parent, self.above, self.depth, self.at, self.count, self.least), (parent, above, depth, at, 0, None), strict=True):
            column.append(x)
        return len(self.depth) - 1

    def _name(self, v: int, depth: int):
        base, names, _ = self.strings[self.at[v]]
        return names[depth - base]

    def _hang(self, v: int) -> None:
        """Enter an edge in both tables."""
        self.handles[self._name(v, two_fattest(self.above[v], self.depth[v]))] = v
        self.firsts[self._name(v, self.above[v] + 1)] = v

    def locate(self, root: int, base: int, names: list) -> tuple[int, int, int | None]:
        """``(node, depth, exit node)``: the deepest node the string passes whole, the depth to
        which it follows the trie, and the node on whose edge it leaves (None: on no edge)."""
        node, low, high, leaves = root, base, base + len(names) - 1, None
        while low < high:
            f = two_fattest(low, high)
            v = self.handles.get(names[f - base])
            if v is None:
                high = f - 1
            elif self.depth[v] < base + len(names) and names[self.depth[v] - base] == self._name(v, self.depth[v]):
                node, low = v, self.depth[v]
            else:
                leaves = v
                break
        end = base + len(names) - 1
        if leaves is None and low < end:
            leaves = self.firsts.get(names[low + 1 - base])
        if leaves is None:
            return node, low, None
        same, differ = low + 1, min(self.depth[leaves], end) + 1  # the last equal depth lies in [same, differ)
        while differ - same > 1:
            middle = (same + differ) // 2
            if names[middle - base] == self._name(leaves, middle):
                same = middle
            else:
                differ = middle
        return node, same, leaves

    def insert(self, conv: int, base: int, names: list, words: list) -> None:
        at = len(self.strings)
        self.strings.append((base, names, words))
        self.turns += len(names)
        root = self.roots.get((base, names[0]))
        if root is None:
            root = self.roots[base, names[0]] = self._node(-1, base, base, at)
        node, depth, leaves = self.locate(root, base, names)
        if leaves is not None:
            if depth < self.depth[leaves]:
                upper = self._node(self.parent[leaves], self.above[leaves], depth, self.at[leaves])
                del self.handles[self._name(leaves, two_fattest(self.above[leaves], self.depth[leaves]))]
                self.parent[leaves], self.above[leaves] = upper, depth
                self._hang(upper)
                self._hang(leaves)
                node = upper
            else:
                node = leaves
        end = base + len(names) - 1
        if depth < end:
            node = self._node(node, depth, end, at)
            self._hang(node)
        self.count[node] += 1
        self.least[node] = conv if self.least[node] is None else min(conv, self.least[node])

    def expand(self) -> dict[str, list]:
        """One entry for each prefix on an edge, and for the empty prefix: its name, the one
        before it, its depth, and its conversations' number and least id."""
        out: dict[str, list] = {n: [] for n in ("name", "before", "depth", "n", "owner", "words")}
        for v in sorted(range(len(self.depth)), key=self.depth.__getitem__, reverse=True):
            up = self.parent[v]
            if up >= 0:
                self.count[up] += self.count[v]
                self.least[up] = self.least[v] if self.least[up] is None else min(self.least[v], self.least[up])
        for v, depth in enumerate(self.depth):
            base, names, words = self.strings[self.at[v]]
            if depth == 0:  # the textless root
                span, before, own = [names[0]], [None], [0]
                depths = [0]
            else:
                a, b = self.above[v] - base, depth - base
                span, before, own = names[a + 1 : b + 1], names[a:b], words[a:b]
                depths = range(self.above[v] + 1, depth + 1)
            k = len(span)
            for column, x in zip(out.values(), (span, before, depths, [self.count[v]] * k, [self.least[v]] * k, own), strict=True):
                column.extend(x)
        return out


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)``: ``conv, d, t, words`` for each turn of the rebuilt
    conversations, and ``conv, m`` with their lengths. Both are written once.

    A conversation c is the first h turns of c - c % 20 and then its own turns after its
    first h, h being the CRC-32 of its decimal id modulo 4. Turns go by turn, nulls first,
    then by a hash of role and text. Null roles and texts are empty; rows with a null id
    belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("t"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    placed = cut(number_rows(cut(own, "turn-names"), ["conv"], ["turn", "t"], "rank", length="n"), "ranked-turns")
    c = F.col("conv")
    sizes = placed.where("rank = 0").select("conv", "n", (F.crc32(c.cast("string")) % SHARED).alias("h"), (c - c % FAMILY).alias("base"))
    bases = sizes.where("base = conv").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = cut(sizes.join(bases, "base", "left").select("conv", "base", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("m")), "rebuilt-conversations")
    kept = placed.join(convs.select("conv", "h", "shared"), "conv").where("rank >= h").select("conv", (F.col("rank") - F.col("h") + F.col("shared") + 1).alias("d"), "t", "words")
    given = placed.where((F.col("rank") < SHARED - 1) & (c % FAMILY == 0)).select(c.alias("base"), "rank", "t", "words")
    taken = convs.select("conv", "base", "shared").join(given, "base").where("rank < shared").select("conv", (F.col("rank") + 1).alias("d"), "t", "words")
    return cut(kept.unionByName(taken), "rebuilt-turns"), convs.select("conv", "m")


def _names() -> list[Column]:
    """Two hashes of a turn and its place."""
    return [F.xxhash64("d", "t").alias("g1"), F.xxhash64("t", "d").alias("g2")]


def _segments(turns: DataFrame, convs: DataFrame, length: int) -> DataFrame:
    """``conv, base, x1, x2, turns``: runs of up to ``length`` turns with the depth and the
    name of the prefix before them; a conversation without turns has one empty segment."""
    own = turns.select("conv", "d", *_names(), "words", F.floor((F.col("d") - 1) / length).cast("long").alias("seg"))
    runs = own.groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list(F.struct("d", "g1", "g2", "words"))).alias("turns")
    )
    # one row for each segment: the name of the prefix before it
    sums = own.groupBy("conv", "seg").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    before = W.partitionBy("conv").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("conv", "seg", F.bit_xor("s1").over(before).alias("x1"), F.bit_xor("s2").over(before).alias("x2")).where("seg > 0")
    zero = F.lit(0).cast("long")
    cuts = runs.join(starts, ["conv", "seg"], "left").select(
        "conv", (F.col("seg") * length).alias("base"), F.coalesce("x1", zero).alias("x1"), F.coalesce("x2", zero).alias("x2"), "turns"
    )
    none = F.array().cast("array<struct<d: bigint, g1: bigint, g2: bigint, words: bigint>>")
    return cuts.unionByName(convs.where("m = 0").select("conv", zero.alias("base"), zero.alias("x1"), zero.alias("x2"), none.alias("turns")))


def _batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Z-fast tries over segments, a full one expanded before the next is begun."""
    trie = ZFastTrie()
    for batch in batches:
        lists = batch.column("turns")
        flat = lists.flatten()
        g = [flat.field(n).to_numpy(zero_copy_only=False) for n in ("g1", "g2")]
        words = flat.field("words").to_pylist()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
        begin = 0
        for conv, base, x1, x2, end in zip(*(batch.column(n).to_pylist() for n in ("conv", "base", "x1", "x2")), ends, strict=True):
            runs = [np.bitwise_xor.accumulate(np.concatenate(([x], own[begin:end]))).tolist() for x, own in zip((x1, x2), g, strict=True)]
            trie.insert(conv, base, list(zip(*runs, strict=True)), words[begin:end])
            begin = end
            if trie.turns >= limit:
                yield from _expanded(trie)
                trie = ZFastTrie()
    if trie.strings:
        yield from _expanded(trie)


def _expanded(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
    rows = trie.expand()
    long = pa.int64()
    columns = [
        pa.array([n[0] for n in rows["name"]], long),
        pa.array([n[1] for n in rows["name"]], long),
        pa.array([n and n[0] for n in rows["before"]], long),
        pa.array([n and n[1] for n in rows["before"]], long),
        *(pa.array(rows[n], long) for n in ("depth", "n", "owner", "words")),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["p1", "p2", "q1", "q2", "depth", "n", "owner", "words"])


def nodes(turns: DataFrame, convs: DataFrame, segment_turns: int = SEGMENT_TURNS, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """``p1, p2, q1, q2, depth, n, owner, words, children``: every node with the name of its
    parent, its members' number and least id, its last turn's words, its children. Written once."""
    kind = "p1 long, p2 long, q1 long, q2 long, depth long, n long, owner long, words long"
    local = _segments(turns, convs, segment_turns).mapInArrow(partial(_batches, limit=batch_turns), kind)
    merged = cut(local.groupBy("p1", "p2").agg(*[f(c).alias(c) for c, f in (("q1", F.max), ("q2", F.max), ("depth", F.max), ("n", F.sum), ("owner", F.min), ("words", F.max))]), "trie-nodes")
    kids = merged.where("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("children"))
    return cut(merged.join(kids, ["p1", "p2"], "left").fillna({"children": 0}), "trie")


def _carried(trie: DataFrame, chains: DataFrame) -> DataFrame:
    """``owner, depth, saved, leaves``: what hangs at a node by way of other owners' chains."""
    links = cut(chains.where("parent_owner IS NOT NULL").select("owner", "parent_owner", (F.col("top") - 1).alias("hung")), "chain-links")
    sending = trie.groupBy("owner").agg(F.sum("own_saved").alias("saved"), F.sum("own_leaf").alias("leaves"))
    rounds = []
    while True:
        sent = cut(
            sending.join(links, "owner").groupBy("parent_owner", "hung").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).withColumnsRenamed({"parent_owner": "owner", "hung": "depth"}),
            "carried",
        )
        rounds.append(sent)
        if sent.isEmpty():
            break
        sending = sent.groupBy("owner").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    whole = rounds[0]
    for r in rounds[1:]:
        whole = whole.unionByName(r)
    return whole.groupBy("owner", "depth").agg(F.sum("saved").alias("carried_saved"), F.sum("leaves").alias("carried_leaves"))


def prefix_trie(conversations: DataFrame, segment_turns: int = SEGMENT_TURNS, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """One row for each node, in no order; see ``rebuilt`` for nulls and ties.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (words of last turns that need no repetition, over
    the subtree), ``ends_sha256`` (of the ids that end here). Repeated rows are turns like
    any others; an empty table gives no rows; columns beyond the four are ignored.
    """
    turns, convs = rebuilt(conversations)
    trie = nodes(turns, convs, segment_turns, batch_turns).select("*", ((F.col("n") - 1) * F.col("words")).alias("own_saved"), (F.col("children") == 0).cast("long").alias("own_leaf"))

    # an owner's nodes are one path; the parent of the top one has another owner
    heads = trie.groupBy("owner").agg(F.min(F.struct("depth", "q1", "q2")).alias("h")).select("owner", F.col("h.depth").alias("top"), "h.q1", "h.q2")
    parents = trie.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("owner").alias("parent_owner"))
    root = F.broadcast(parents.where("q1 = 0 AND q2 = 0"))  # one row, the parent of most heads
    low = heads.where("top = 1").join(root, ["q1", "q2"])
    high = heads.where("top > 1").join(parents, ["q1", "q2"])
    only = heads.where("top = 0").withColumn("parent_owner", F.lit(None).cast("long"))
    chains = low.unionByName(high).unionByName(only).select("owner", "top", "parent_owner")
    chains = cut(chains, "chains")

    carried = _carried(trie, chains)
    total = [(F.col(f"own_{c}") + F.coalesce(F.col(f"carried_{k}"), F.lit(0).cast("long"))).alias(k) for c, k in (("saved", "saved"), ("leaf", "leaves"))]
    valued = trie.join(carried, ["owner", "depth"], "left").select("p1", "p2", "owner", "depth", (-F.col("depth")).alias("up"), "n", "children", *total)
    valued = cut(valued, "valued-nodes")
    hot = hot_groups(valued, ["owner"])
    summed = number_rows(valued, ["owner"], ["up"], "saved_below", weight="saved", hot=hot)
    summed = number_rows(summed, ["owner"], ["up"], "leaves_below", weight="leaves", hot=hot)

    ends = turns.select("conv", *_names()).groupBy("conv").agg(F.bit_xor("g1").alias("p1"), F.bit_xor("g2").alias("p2"))
    zero = F.lit(0).cast("long")
    ends = ends.unionByName(convs.where("m = 0").select("conv", zero.alias("p1"), zero.alias("p2")))
    ends = cut(ends, "ends")
    hashes = ordered_sha256(ends.select("p1", "p2", "conv", F.col("conv").cast("string").alias("id")), ["p1", "p2"], ["conv"], "id", ",", "ends_sha256")
    parent = F.when(F.col("depth") > F.col("top"), F.col("owner")).otherwise(F.col("parent_owner"))
    return (
        summed.join(chains, "owner")
        .join(hashes, ["p1", "p2"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            parent.alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            (F.col("leaves") + F.col("leaves_below")).alias("n_leaves"),
            (F.col("saved") + F.col("saved_below")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
