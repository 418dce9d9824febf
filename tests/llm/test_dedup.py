"""Line dedup and substring dedup against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strideframe.llm import line_dedup, superkmer

BLANKS = " \t\n\x0b\f\r"


def slow_lines(rows, min_length=40, min_docs=5):
    """(id, text) rows to kept texts and counts, from the definition."""
    keyed = defaultdict(set)
    split = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(BLANKS)) for x in lines]
        split.append((i, lines, keys))
        for k in keys:
            if len(k) >= min_length:
                keyed[k].add(i)
    order = lambda i: (i is not None, i or 0)
    out = []
    for i, lines, keys in split:
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < min_length or len(keyed[k]) < min_docs or i == max(keyed[k], key=order)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def got_lines(df, **rule):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.apply_bitmaps(df, **rule).collect()), key=repr)


def random_lines(seed, n=80):
    rng = random.Random(seed)
    shared = [f"{'shared line with a number of words in it ' * 2}{i}" for i in range(6)] + ["É" * 45, "x" * 39, "y" * 40]
    out = []
    for i in range(n):
        lines = [rng.choice(shared) if rng.random() < 0.5 else f"own {i} {rng.random()}" for _ in range(rng.randint(1, 12))]
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\r", " \x0b"]) for x in lines]
        out.append((i, "\n".join(lines)))
    return out


def test_lines_against_brute_force(docs):
    for seed in range(3):
        pairs = random_lines(seed)
        assert got_lines(docs(pairs)) == sorted(slow_lines(pairs), key=repr)


def test_lines_do_not_depend_on_what_the_sketch_names(docs, monkeypatch):
    pairs = random_lines(7)
    want = sorted(slow_lines(pairs), key=repr)
    nothing = line_dedup.heavy_keys
    monkeypatch.setattr(line_dedup, "heavy_keys", lambda lines: nothing(lines).where("false"))
    assert got_lines(docs(pairs)) == want
    monkeypatch.setattr(line_dedup, "heavy_keys", lambda lines: lines.select("h1").distinct())
    assert got_lines(docs(pairs)) == want


def test_line_boundaries(docs):
    key = "k" * 40
    assert got_lines(docs([(i, key) for i in range(4)])) == [(i, 1, 0, key) for i in range(4)]
    assert got_lines(docs([(i, key) for i in range(5)])) == [(i, 1, 1, "") for i in range(4)] + [(4, 1, 0, key)]
    twice = docs([(i, f"{key}\n\n{key}") for i in range(5)])
    assert got_lines(twice) == [(i, 3, 2, "") for i in range(4)] + [(4, 3, 0, f"{key}\n\n{key}")]


def test_a_key_repeated_in_one_document_counts_once(docs, monkeypatch):
    key = "k" * 40
    pairs = [(0, "\n".join([key] * 7)), (1, f"{key}\nown\n{key}"), *((i, "l" * 50) for i in range(2, 6)), (6, "\n".join(["l" * 50] * 3))]
    pairs += random_lines(11, 30)[7:]
    nothing = line_dedup.heavy_keys
    for names in (nothing, lambda lines: nothing(lines).where("false")):
        monkeypatch.setattr(line_dedup, "heavy_keys", names)
        assert got_lines(docs(pairs)) == sorted(slow_lines(pairs), key=repr)


def test_odd_rows_lose_nothing_and_keep_their_columns(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got_lines(odd, min_length=0, min_docs=3) == sorted(slow_lines(rows, 0, 3), key=repr)
    left = line_dedup.apply_bitmaps(odd)
    assert set(odd.columns) <= set(left.columns) and left.where("text is null").count() == 2
    assert line_dedup.apply_bitmaps(odd.where("false")).collect() == []


def test_bitmap_is_runs(docs):
    bitmaps = line_dedup.keep_bitmaps(docs([(i, "\n".join(["own%d" % i, "z" * 50, "w" * 50, "own", "z" * 50])) for i in range(6)]))
    first = bitmaps.where("id = 0").first()
    assert first.n_dropped == 3 and [tuple(r) for r in first.dropped] == [(1, 2), (4, 1)]


def test_line_plan_has_no_python(docs):
    plan = line_dedup.apply_bitmaps(docs(random_lines(1, 10)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def slow_windows(rows, size=20):
    """Kept words by the definition; rows sorted as the operator orders documents."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen, gone = set(), []
    for _, words in split:
        own = set()
        for at in range(len(words) - size + 1):
            window = tuple(words[at : at + size])
            if window in seen:
                own.update(range(at, at + size))
            seen.add(window)
        gone.append(own)
    return [(i, len(w), len(g), b" ".join(x for k, x in enumerate(w) if k not in g).decode()) for (i, w), g in zip(split, gone, strict=True)]


def got_windows(df, **rule):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in superkmer.remove_repeats(df, **rule).collect()), key=repr)


def random_passages(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randint(15, 70))] for _ in range(6)]
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 30))]
        out.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    return out + [(n, "a " * 200), (n + 1, "a b " * 50)]


def test_windows_against_brute_force(docs):
    for seed in range(3):
        pairs = random_passages(seed)
        assert got_windows(docs(pairs).repartition(5)) == sorted(slow_windows(pairs), key=repr)


def test_windows_with_every_minimiser_split_and_tiny_slices(docs, monkeypatch):
    pairs = random_passages(4, vocabulary=5)
    monkeypatch.setattr(superkmer, "HOT_SHARE", 0.0)
    monkeypatch.setattr(superkmer, "SPLIT_SHARE", 0.0)
    monkeypatch.setattr(superkmer, "BUCKET_BYTES", 1_000)
    assert got_windows(docs(pairs).repartition(3)) == sorted(slow_windows(pairs), key=repr)


def test_windows_told_apart_where_hashes_collide():
    import numpy as np

    codes = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], dtype=np.int32)
    places = np.array([0, 3, 6])
    same = np.zeros(3, dtype=np.uint64)
    assert superkmer._repeats(same, places, codes, 3).tolist() == [False, False, True]


def test_window_rules_for_odd_rows(odd, spark):
    rows = [(r.doc_id, r.text) for r in odd.distinct().withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_last(), "h").collect()]
    want = slow_windows(rows)
    assert got_windows(odd.distinct()) == sorted(want, key=repr)
    # a repeated row is one document, twice in the result
    assert len(got_windows(odd)) == odd.count()
    assert got_windows(odd.where("false")) == []


def test_repeats_within_one_document_and_across_ids(docs):
    text = " ".join(f"u{i}" for i in range(25))
    got = got_windows(docs([(9, text), (2, f"{text} end {text}"), (5, f"x {text}")]))
    assert [(i, n, gone) for i, n, gone, _ in got] == [(2, 51, 25), (5, 26, 25), (9, 25, 25)]
    assert got[1][3] == "x"


def test_equal_rows_are_one_document(docs):
    text, own = (" ".join(f"{c}{i}" for i in range(25)) for c in "uv")
    for pairs in ([(1, text), (1, text)], [(None, text), (None, text)]):
        for df in (docs(pairs).coalesce(1), docs(pairs[:1]).coalesce(1).unionByName(docs(pairs[1:]).coalesce(1))):
            assert got_windows(df) == [(pairs[0][0], 25, 0, text)] * 2
    # what such a document repeats goes from each of its rows, and from later documents
    pairs = [(1, own), (3, f"{text} {own} {text}"), (4, text)]
    want = [(1, 25, 0, own), (3, 75, 50, text), (3, 75, 50, text), (4, 25, 25, "")]
    assert got_windows(docs([*pairs, pairs[1]]).coalesce(1)) == want
    assert got_windows(docs(pairs).coalesce(1).unionByName(docs(pairs[1:2]).coalesce(1))) == want


@pytest.mark.parametrize("names", [("_n", "_dropped", "_id"), ("n_lines", "n_dropped", "bitmap_id"), ("bitmap_runs", "N_Lines", "hash")])
def test_line_dedup_under_clashing_names(spark, names):
    long = "one long line that many documents share in common"
    rows = [(i, f"{long}\nown {i}", "a", "b", "c") for i in range(6)] + [(None, None, "a", "b", "c"), (9, "", "a", "b", "c")]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}")
    stage = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, "")
    assert stage.columns == docs.columns
    left = sorted((tuple(r) for r in stage.collect()), key=repr)
    want = [(i, f"{long}\nown {i}" if i == 5 else f"own {i}", "a", "b", "c") for i in range(6)] + [(None, None, "a", "b", "c"), (9, "", "a", "b", "c")]
    assert left == sorted(want, key=repr)
    counted = line_dedup.apply_bitmaps(docs)
    assert {c.lower() for c in counted.columns} == {"doc_id", "text", "n_lines", "n_dropped", *(n.lower() for n in names)}
    assert {r.doc_id: r.n_dropped for r in counted.collect()} == {**dict.fromkeys(range(5), 1), 5: 0, None: 0, 9: 0}


def test_the_stage_lets_n_chars_follow_and_keeps_its_type(spark):
    long = "one long line that many documents share in common"
    docs = spark.createDataFrame([(i, f"{long}\nown {i}", 56) for i in range(6)], "doc_id long, text string, n_chars int")
    stage = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, "")
    assert stage.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert sorted(r.n_chars for r in stage.collect()) == [5] * 5 + [56]


def test_words_travel_whole_and_hash_alike_wherever_they_stand():
    words = ["a", "ab", "ba", "é", "x" * 64, "x" * 65, "long" * 5_000, "a\u00a0b"]
    some = pa.array([w.encode() for w in words], pa.binary())
    assert superkmer._split_words(superkmer._joined_words(superkmer._spaced(some))).to_pylist() == [w.encode() + b" " for w in words]
    hashes = superkmer._word_hashes(some)
    assert len(set(hashes.tolist())) == len(words)
    assert superkmer._word_hashes(some[2:]).tolist() == hashes[2:].tolist()
    none = pa.array([], pa.binary())
    assert len(superkmer._word_hashes(none)) == len(superkmer._joined_words(superkmer._spaced(none))) == len(superkmer._split_words(np.zeros(0, np.uint8))) == 0
