"""The suffix automaton and the contamination rule against brute force."""

import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from strideframe.llm import decontaminate as d


def slow(text, items, window=13):
    """Hit words and item ids by comparing every window with every place."""
    words = d.normal_words(text)
    hit, found = set(), set()
    for item, t in items:
        own = d.normal_words(t)
        size = min(window, len(own))
        for at in range(len(own) - size + 1) if size else ():
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[at : at + size]:
                    hit.update(range(p, p + size))
                    found.add(str(item))
    return len(words), hit, sorted(found)


_TEXT = st.lists(st.sampled_from("abc"), max_size=40).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(_TEXT, st.lists(_TEXT, max_size=4), st.integers(1, 6))
def test_automaton_is_the_definition(text, items, window):
    named = list(enumerate(items))
    automaton = d.build(named, window)
    runs, found = automaton.scan(d.normal_words(text))
    _, hit, ids = slow(text, named, window)
    assert {p for a, n in runs for p in range(a, a + n)} == hit
    assert sorted(str(i) for i in found) == ids
    assert all(a + n < b for (a, n), (b, _) in zip(runs, runs[1:], strict=False))


def test_words():
    assert d.normal_words("It's A-Z_09 É日!x\x7fy") == [b"it", b"s", b"a", b"z", b"09", "É日".encode(), b"x", b"y"]
    assert d.normal_words(None) == []


def test_automaton_is_linear_in_the_items():
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("ab") for _ in range(200))) for i in range(20)]
    assert len(d.build(items).length) <= 2 * 20 * 200


def bench(spark, items):
    return spark.createDataFrame([(str(i) if i is not None else None, t, "x") for i, t in items], "item_id string, text string, n_hit string")


def make_items(rng):
    word = lambda: f"w{rng.randrange(30)}"
    return [(i, " ".join(word() for _ in range(rng.choice([3, 12, 13, 14, 40])))) for i in range(12)]


def rows_of(marked):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in marked.collect()), key=repr)


def want_rows(pairs, items):
    out = []
    for i, t in pairs:
        n, hit, ids = slow(t, items)
        out.append((i, n, len(hit), ids, bool(hit) and 20 * len(hit) >= n))
    return sorted(out, key=repr)


def test_documents_against_brute_force(spark, docs):
    rng = random.Random(2)
    items = make_items(rng)
    pairs = []
    for i in range(60):
        parts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(60)))]
        if i % 2:
            own = rng.choice(items)[1].split()
            parts.append(", ".join(own[rng.randrange(3) :]).upper())
        pairs.append((i, ". ".join(parts)))
    df = docs(pairs)
    marked = d.contamination(df, bench(spark, items))
    assert rows_of(marked) == want_rows(pairs, items)
    # many blocks give what one block gives
    assert rows_of(d.contamination(df, bench(spark, items), block_bytes=200)) == want_rows(pairs, items)
    left = d.drop_contaminated(df, bench(spark, items))
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _, _, _, bad in want_rows(pairs, items) if not bad)


def test_clean_text_has_no_hit_left(spark, docs):
    item = " ".join(f"q{i}" for i in range(20))
    text = f"before, {item.upper()}! after it"
    row = d.contamination(docs([(1, text)]), bench(spark, [(5, item)])).first()
    assert row.clean_text == "before, ! after it" and [tuple(r) for r in row.hit_runs] == [(1, 20)]


def test_odd_rows(spark, odd, docs):
    items = [(1, None), (2, ""), (3, "..."), (4, "one"), (4, "one"), (None, "same words"), (6, "a b " * 20)]
    marked = d.contamination(odd, bench(spark, items))
    want = want_rows([(r.doc_id, r.text) for r in odd.collect()], items)
    assert rows_of(marked) == sorted(((i, n, h, [x for x in ids if x != "None"], bad) for i, n, h, ids, bad in want), key=repr)
    assert {"key", "fp", "id"} <= set(marked.columns) and marked.columns.count("items") == 1
    assert d.contamination(docs([]), bench(spark, items)).collect() == []
    assert d.contamination(odd, bench(spark, [])).where("n_hit > 0").collect() == []


@pytest.mark.parametrize(("hit", "words", "bad"), [(7, 140, True), (7, 141, False), (3, 60, True), (3, 61, False)])
def test_exactly_a_twentieth_is_contaminated(spark, docs, hit, words, bad):
    item = " ".join(f"q{i}" for i in range(hit))
    text = " ".join([item, *(f"w{i}" for i in range(words - hit))])
    row = d.contamination(docs([(1, text)]), bench(spark, [(5, item)] * 3)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (words, hit, bad)
