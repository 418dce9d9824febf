"""The word CRF against enumeration, held-out accuracy, code-switched text, odd rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import types as T

from strideframe.llm import language_crf as crf
from strideframe.llm import queries

SF = "/root/testdata/sf0.01"


def enumerated(scores, first, move, start):
    """Probabilities and expected moves by summing over every labelling of every text."""
    n, k = scores.shape
    post, moves = np.zeros((n, k)), np.zeros((k, k))
    cuts = [*np.flatnonzero(first), n]
    for a, b in itertools.pairwise(cuts):
        weights = {}
        for path in itertools.product(range(k), repeat=b - a):
            total = start[path[0]] + sum(scores[a + i, y] for i, y in enumerate(path)) + sum(move[x, y] for x, y in itertools.pairwise(path))
            weights[path] = np.exp(total)
        z = sum(weights.values())
        for path, w in weights.items():
            for i, y in enumerate(path):
                post[a + i, y] += w / z
            for x, y in itertools.pairwise(path):
                moves[x, y] += w / z
    return post, moves


@pytest.mark.parametrize("seed", range(4))
def test_forward_backward_is_the_sum_over_labellings(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 7, 6)
    n, k = lengths.sum(), 3
    first = np.zeros(n, dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    scores, move, start = rng.normal(0, 3, (n, k)), rng.normal(0, 2, (k, k)), rng.normal(0, 2, k)
    got = crf.forward_backward(scores, first, move, start, count=True)
    for g, w in zip(got, enumerated(scores, first, move, start), strict=True):
        assert np.allclose(g, w)


def test_one_long_text_and_no_text():
    scores = np.tile([[0.0, 900.0], [900.0, 0.0]], (5_000, 1))
    first = np.zeros(10_000, dtype=bool)
    first[0] = True
    post, _ = crf.forward_backward(scores, first, np.zeros((2, 2)), np.zeros(2))
    assert (post.argmax(1) == np.tile([1, 0], 5_000)).all() and np.allclose(post.sum(1), 1)
    assert len(crf.forward_backward(np.zeros((0, 2)), np.zeros(0, bool), np.zeros((2, 2)), np.zeros(2))[0]) == 0


def test_words_and_their_ngrams():
    words = crf.read_words(["Ab, c!", None, "12 3", "ab"])
    assert words.lengths.tolist() == [2, 1, 2] and words.text.tolist() == [0, 0, 3]
    assert words.has_letter.tolist() == [True, False, False, True]
    assert words.at[0] == words.at[2] != words.at[1] and len(words.opens) == 2
    alone = crf.read_words(["c"])
    k = words.at[1]
    span = slice(words.opens[k], words.opens[k] + 2)
    # one letter: ^c and c$ as pairs, c alone, ^c$ as a triple
    assert [b[span].tolist() for b in words.buckets] == [b.tolist() for b in alone.buckets]
    assert sum(int((b[span] != crf.BUCKETS).sum()) for b in words.buckets) == 4


SPANS = [("the house and the garden with the dog", "en"), ("das haus und der garten mit dem hund", "de"), ("la casa y el jardin con el perro", "es")]


def test_learned_languages_switch_within_a_text():
    model = crf.learn([s for s, _ in SPANS] * 4, [g for _, g in SPANS] * 4)
    assert model.languages == ("de", "en", "es")
    words, post = model.words(["the dog and the garden, das haus und der hund"])
    assert [model.languages[i] for i in post.argmax(1)] == ["en"] * 5 + ["de"] * 5
    assert (np.diag(model.move)[:, None] > model.move)[~np.eye(3, dtype=bool)].all()
    assert model.predict(["the dog", "der hund", None, "", "1 2", "el perro"])[0] == ["en", "de", "und", "und", "und", "es"]
    assert crf.learn([], []) is None and crf.learn(["12"], ["en"]) is None


def test_held_out_accuracy(spark):
    got = queries.op11_language_crf(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    both = got.merge(docs, on="doc_id")
    held = both[both["held_out"]]
    assert len(held) > 100 and (held["lang_pred"] == held["lang"]).mean() >= 0.97


def test_odd_rows(spark, odd):
    schema = T.StructType([*odd.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("Score", T.StringType())])
    rows = [(*r, "own", "own") for r in odd.collect()]
    docs = spark.createDataFrame(rows, schema)
    model = crf.learn([s for s, _ in SPANS], [g for _, g in SPANS])
    got = crf.with_language(docs, model)
    assert got.columns == [*odd.columns, "lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.languages and 0 < r.score <= 1
    assert crf.with_language(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in crf.with_language(odd, None).collect()} == {"und"}


def test_training_takes_a_bounded_share_of_each_language(spark):
    def word(i):
        return format(i, "b").translate({48: "a", 49: "b"})

    rows = [(i, f"{word(i)} and", "en" if i % 4 else None) for i in range(2_000)] + [(i, f"{word(i)} und", "de") for i in range(2_000, 2_040)] + [(None, "x", "en"), (5, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = crf.training_spans(docs, texts=100, span=2).toPandas()
    sizes = got.groupby("lang").size()
    assert 60 < sizes["en"] < 140 and sizes["de"] >= 15
    assert got["span"].str.split().str.len().max() == 2
    assert crf.fit(docs.limit(0)) is None
