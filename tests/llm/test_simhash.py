"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strideframe.llm import simhash
from strideframe.llm.graph import connected_components


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints):
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" abAB\tÉ日\n", max_size=60))
def test_fingerprint_is_the_definition(text):
    assert simhash.simhash(text) & (1 << 64) - 1 == slow_print(text)


def test_budgets_are_proportional():
    assert simhash.budgets() == [0, 1, 2, 3, 4]


def test_every_close_pair_meets_under_a_key_and_passes_its_chain():
    rng = random.Random(3)
    for _ in range(3_000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        x = np.array([a ^ b], dtype=np.uint64)
        starts = []
        for i, (width, offset) in enumerate(zip(simhash.SEGMENTS, simhash.OFFSETS, strict=True)):
            j = (i + 1) % 5
            same = (a ^ b) >> offset & (1 << width) - 1 == 0
            near = ((a ^ b) >> simhash.OFFSETS[j] & (1 << simhash.SEGMENTS[j]) - 1).bit_count() <= 1
            if same and near and simhash.linked(x, i)[0]:
                starts.append(i)
        assert starts


@pytest.fixture(scope="module")
def clustered():
    """Fingerprints in chains and dense balls, and far ones."""
    rng = random.Random(5)
    out = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                f ^= 1 << bit
            out.append(f)
        for _ in range(15):
            for bit in rng.sample(range(64), 4):
                centre ^= 1 << bit
            out.append(centre)
    return out + [rng.getrandbits(64) for _ in range(200)] + [0, 1, (1 << 64) - 1]


def test_links_connect_what_brute_force_connects(spark, clustered):
    prints = sorted(set(clustered))
    signed = [simhash._signed(f) for f in prints]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.fingerprint_links(df)
    assert links.count() <= 5 * 2 * len(prints)
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 4 for r in links.collect())
    roots = {r.node: r.root for r in connected_components(links).collect()}
    slow = slow_components(list(range(len(prints))), prints)
    groups = {}
    for f, s in zip(signed, slow, strict=True):
        groups.setdefault(s, set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1_000, 1_000 + i) for i in range(1, 300)]
    df = spark.createDataFrame([*path, *hub, (5, 5), (None, 3), (7, 6), (6, 7)], "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1_000 for i in range(1_000, 1_300)}
    assert connected_components(df.where("false")).count() == 0


def test_documents_against_brute_force(spark, docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(12)]
    pairs = []
    for i in range(90):
        text = list(base[i % 12])
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        pairs.append((1_000 - i, " ".join(text)))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(pairs)).collect()}
    prints = [slow_print(t) for _, t in pairs]
    assert [got[i].fingerprint for i, _ in pairs] == [f"{f:016x}" for f in prints]
    assert [got[i].component_id for i, _ in pairs] == slow_components([i for i, _ in pairs], prints)


def test_odd_rows(odd):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    prints = [slow_print(t) for _, t in rows]
    want = zip([i for i, _ in rows], [f"{f:016x}" for f in prints], slow_components([i for i, _ in rows], prints), strict=True)
    assert got == sorted(want, key=repr)


def test_keep_one_keeps_columns_and_the_smallest_id(odd):
    left = simhash.keep_one(odd)
    assert left.columns == odd.columns
    ids = sorted((r.doc_id for r in left.collect()), key=repr)
    # 0 stands for all texts without words, 4 for its copy; the unlike text under id 4 is no
    # copy of anything; rows without an id all stay
    assert [i for i in ids if i is not None] == [0, 3, 4, 4, 6, 7, 8]
    assert ids.count(None) == 2


def test_keep_one_keeps_the_row_of_an_id_that_is_no_copy(docs):
    copied, *own = (" ".join(f"w{k}x{i}" for i in range(60)) for k in range(11))
    pairs = [(i + 5, t) for i, t in enumerate(own)]
    left = simhash.keep_one(docs([(3, copied), *[(i, copied) for i, _ in pairs], *pairs]))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(3, copied), *pairs]


def test_keep_one_of_equal_rows_and_under_clashing_names(spark, docs):
    own = " ".join(f"w{i}" for i in range(40))
    rows = docs([(1, own), (1, own), (2, own)]).withColumnRenamed("key", "hash_of_text").withColumnRenamed("fp", "row_of_text")
    left = simhash.keep_one(rows)
    assert left.columns == rows.columns and [r.doc_id for r in left.collect()] == [1]


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.keep_one(docs([])).collect() == []
