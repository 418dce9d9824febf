"""The trie against direct counting, small segments and batches, odd rows."""

import hashlib
import random
import zlib

import pytest

from strideframe.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, owner long, depth long, p1 string"


def counted(rows):
    """The contract, node by node."""
    talks = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            talks.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    talks = {c: [x[2:] for x in sorted(own)] for c, own in talks.items()}
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(talks.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, own in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(own) - 1) * (len(p[-1][1].split()) if p else 0)
            leaves[p[:d]] += p not in kids
    return sorted(
        (
            min(own), len(p), -1 if not p else min(members[p[:-1]]), len(own), len(kids.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if len(whole[c]) == len(p)).encode()).hexdigest(),
        )
        for p, own in members.items()
    )


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[c] is None else r[c] for c in columns) for r in df.select(*columns).collect())


def talks(seed, convs, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "bot"]), " ".join(rng.choices(words, k=rng.randrange(1, 3))), 1, 2, "p"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "batch"), [(4_096, 400_000), (3, 7), (1, 1)])
def test_trie_is_the_counted_one(spark, segment, batch):
    rows = talks(segment, [*range(-25, 60), 100, 105, 999], 9, ["a", "b"])
    rows += [(200 + i, t, "user", "same", 0, 0, "") for i in range(45) for t in range(12 + i % 3)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(pt.prefix_trie(table, segment, batch)) == counted(rows)


def test_nulls_repeats_and_no_rows(spark):
    rows = [(None, 1, "user", "gone"), (20, None, None, None), (20, 1, "user", "a  b\tc"), (21, None, "", ""), (21, 1, "user", "a  b\tc"), (21, 1, "user", "a  b\tc"), (33, 4, "x", None)]
    rows = [(*r, 0, 0, "") for r in rows]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(pt.prefix_trie(table)) == counted(rows)
    assert pt.prefix_trie(table.limit(0)).count() == 0
    assert pt.prefix_trie(table.where("conv_id IS NULL")).count() == 0


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 60):
            assert pt.two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda x: x & -x)


@pytest.mark.parametrize("seed", range(20))
def test_located_nodes_and_expanded_edges(seed):
    rng = random.Random(seed)
    trie, seen = pt.ZFastTrie(), []
    for i in range(120):
        if seen and rng.random() < 0.7:
            string = rng.choice(seen)
            string = string[: rng.randrange(1, len(string) + 1)] + tuple(rng.randrange(2) for _ in range(rng.randrange(30)))
        else:
            string = (0, *(rng.randrange(2) for _ in range(rng.randrange(40))))
        names = [string[: d + 1] for d in range(len(string))]
        if seen:
            node, depth, leaves = trie.locate(trie.roots[0, names[0]], 0, names)
            true = max(d for d in range(len(names)) if any(s[: d + 1] == names[d] for s in seen))
            assert depth == true
            assert trie.depth[node] <= depth and (leaves is not None) == (trie.depth[node] < depth)
        trie.insert(i, 0, names, [1] * (len(names) - 1))
        seen.append(string)
    # each compacted node has its handle, and no other
    edges = [v for v in range(len(trie.depth)) if trie.parent[v] >= 0]
    assert len(trie.handles) == len(trie.firsts) == len(edges)
    for v in edges:
        assert trie.handles[trie._name(v, pt.two_fattest(trie.above[v], trie.depth[v]))] == v
    out = trie.expand()
    want = {}
    for i, s in enumerate(seen):
        for d in range(len(s)):
            want.setdefault(s[: d + 1], []).append(i)
    assert dict(zip(out["name"], zip(out["n"], out["owner"], strict=True), strict=True)) == {p: (len(own), min(own)) for p, own in want.items()}
    assert len(out["name"]) == len(want)
