"""Toxicity, quality and transcripts: grammar and risk by hand, held-out accuracy on the tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.llm import pu_quality, queries, toxicity, transcripts

SF = "/root/testdata/sf0.1"


def area(label, score):
    """Chance that a positive scores above a negative, ties half."""
    rank = score.rank()
    n = int(label.sum())
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


LEXICON = {"idiot": 2.0, "scum": 3.0}
THREATS = {"kill": 1.5, "burn": 1.0, "beat": 1.0, "shoot": 2.0}
KEYS = toxicity.ToxicityModel(LEXICON, THREATS, (), 0.0).keys()
@pytest.mark.parametrize(
    ("clause", "score"),
    [
        ("the idiot", 2.0),
        ("you are an idiot", 2.5),
        ("you are not an idiot", 2.0 * 0.3 + 0.5),
        ("he said idiot", 2.0 * 0.5 + 0.5),
        ("idiot scum", 2.0 + 3.0 * 1.5),
        ("nothing here", 0.0),
        ("kill time", 0.0),
        ("kill you", 1.5),
        ("you will kill", 0.0),
        ("not now but later and then an idiot", 2.0),
    ],
)
def test_grammar(clause, score):
    assert toxicity.clause_score(clause.split(), LEXICON, THREATS) == pytest.approx(score)


@pytest.mark.parametrize(
    ("text", "score"),
    [
        ("I will kill you", 1.5),
        ("burn them", 1.0),
        ("you I will kill", 0.0),
        ("we burn them all", 1.0),
        ("you will kill them", 1.5),
        ("I will kill and burn all of you", 1.0),
        ("I will kill time before the show and see you", 0.0),
        ("I will never kill you", 1.5 * 0.3),
        ("he said I kill you", 1.5 * 0.5),
        ("I won't kill you", 1.5 * 0.3),
        ("you aren't an idiot", 2.0 * 0.3 + 0.5),
        ("You AREN’T an idiot", 2.0 * 0.3 + 0.5),
        ("this isn't the idiot", 2.0 * 0.3),
        ("don't be an idiot", 2.0 * 0.3),
        ("model t idiot", 2.0),
    ],
)
def test_threats_before_their_target_and_contracted_negation(text, score):
    assert toxicity.features(text, LEXICON, THREATS, KEYS)[0] == pytest.approx(score)


def slow_score(words):
    """What the grammar says, word by word, by looking back each time."""
    classes = {"you": "target", "them": "target", "not": "negation", "said": "report"}
    kinds = ["insult" if w in LEXICON else "threat" if w in THREATS else classes.get(w, "other") for w in words]

    def damped(i):
        near = any(k == "negation" for k in kinds[max(i - 3, 0) : i])
        return (0.3 if near else 1.0) * (0.5 if "report" in kinds[:i] else 1.0)

    total = 0.0
    for i, (w, k) in enumerate(zip(words, kinds, strict=True)):
        if k == "insult":
            again = 1.5 if "insult" in kinds[:i] else 1.0
            total += LEXICON[w] * again * damped(i) + (0.5 if "target" in kinds[max(i - 4, 0) : i] else 0.0)
        if k == "target":
            for j in range(i - 1, max(i - 5, -1), -1):
                if kinds[j] == "target":
                    break
                if kinds[j] == "threat":
                    total += THREATS[words[j]] * damped(j)
                    break
    return total


def test_grammar_against_a_slow_scorer():
    rng = np.random.default_rng(3)
    words = ["idiot", "scum", "kill", "burn", "you", "them", "not", "said", "the", "a", "of"]
    for _ in range(3_000):
        clause = [words[i] for i in rng.integers(0, len(words), rng.integers(1, 12))]
        assert toxicity.clause_score(clause, LEXICON, THREATS) == pytest.approx(slow_score(clause)), clause


HARMLESS = [
    "The striker beat the keeper. They beat the record. You beat eggs.",
    "You can beat the deadline if you plan.",
    "We shoot photographs of people at the zoo.",
    "Kill the process and start the server again.",
    "Let us kill time until the train comes.",
    "Burn the disc at low speed.",
    "She will shoot the last scene in May.",
    "They burn wood in winter.",
    "He beat the eggs and the sugar.",
    "You should kill the lights before the film.",
]


def test_threats_are_learned_where_labels_support_them(spark):
    rng = np.random.default_rng(9)
    filler = ["i", "will", "the", "garden", "house", "tree", "river", "stone", "light", "cloud", "road", "bread"]

    def plain():
        return " ".join(rng.choice(filler, 12))

    rows = []
    for i in range(240):
        verb = ["kill", "shoot", "burn", "beat"][i % 4]
        rows.append((1, f"{plain()}. I will {verb} {['you', 'them'][i // 4 % 2]}. {plain()}") if i < 60 else (0, f"{plain()}. {HARMLESS[i % 10]}"))
    model = toxicity.fit(spark.createDataFrame(rows, "y int, text string"))
    # "beat the deadline if you" is as good as "beat you"
    assert {"kill", "shoot", "burn"} <= set(model.threats) and "beat" not in model.threats and not set(model.threats) & set(model.lexicon)
    texts = spark.createDataFrame(list(enumerate([*HARMLESS, "kill you", "kill time", "I will burn them"])), "i int, text string")
    score = {r.text: r.toxicity for r in toxicity.with_toxicity(texts, model).collect()}
    assert max(score[t] for t in HARMLESS) < 0.5 < min(score["kill you"], score["I will burn them"])
    assert score["kill you"] > score["kill time"]


def test_clauses_are_read_apart():
    total, most, rate = toxicity.features("You idiot. Not you; SCUM!", LEXICON, {}, KEYS)
    assert (total, most) == (pytest.approx(2.5 + 3.0), 3.0) and rate == pytest.approx(110.0)
    assert toxicity.features(None, LEXICON, {}, KEYS) == toxicity.features("fine", LEXICON, {}, KEYS) == (0.0, 0.0, 0.0)


def test_composition_is_the_product_of_its_machines():
    machines = [toxicity.INSULTS, toxicity._fading(toxicity.NEGATION, 2, 0.5, 0.0)]
    table = toxicity.compose(machines)
    assert len(table) == 2 * 3 * 6
    for (states, symbol), (to, factor, bonus) in table.items():
        arcs = [m.arcs.get((s, symbol), (s, 1.0, 0.0)) for s, m in zip(states, machines, strict=True)]
        assert to == tuple(a[0] for a in arcs) and factor == arcs[0][1] * arcs[1][1] and bonus == 0.0


@pytest.mark.parametrize(("name", "label", "least"), [("op10_toxicity", "toxic", 0.93), ("op2_pu_quality", "quality", 0.98)])
def test_held_out_accuracy(spark, name, label, least):
    got = queries.ALL[name](spark, SF).toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    known = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert area(known[label], known.score) > least
    assert (known.predicted == known[label]).mean() > 0.97


def test_models_do_not_see_the_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for fold, fit in (
        (toxicity.HELD_OUT, lambda n: toxicity.fit(toxicity.training_rows(docs, n, "toxic", toxicity.HELD_OUT))),
        (pu_quality.HELD_OUT, lambda n: pu_quality.fit(docs, n)),
    ):
        turned = labels.withColumn("toxic", F.when(fold(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
        turned = turned.withColumn("quality", F.when(fold(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
        a, b = fit(labels), fit(turned)
        assert np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def test_risk_finds_positives_among_unlabelled():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.0, 1.0, (6_000, 3)), rng.normal(-1.0, 1.0, (2_000, 3))
    model = pu_quality.fit_pu(good[:2_000], np.concatenate([good[2_000:], bad]), 4 / 6)
    assert (model.probability(good) > 0.5).mean() > 0.93 and (model.probability(bad) < 0.5).mean() > 0.85


def test_shapes():
    assert pu_quality.shapes("Abc 12 x&&& ÉTÉ") == [b"Aa", b"0", b"a&", b"aAa"]
    assert pu_quality.shapes("") == [] and not np.isnan(pu_quality.vector(None)).any()


def test_scoring_odd_rows(odd, spark):
    toxic = toxicity.ToxicityModel(LEXICON, {}, (1.0, 1.0, 0.0), -3.0)
    scored = toxicity.with_toxicity(odd, toxic, score="key")
    assert scored.count() == odd.count() and scored.columns.count("key") == 1 and scored.where("key is null").count() == 0
    assert toxicity.drop_toxic(odd, toxic).columns == odd.columns
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    for model in (pu_quality.fit(docs, labels), None):
        assert pu_quality.with_quality(odd, model).where("quality_score is null").count() == 0
        assert pu_quality.with_quality(odd.where("false"), model).collect() == []
    nobody = labels.where("false")
    assert pu_quality.fit(docs, nobody) is None
    assert toxicity.fit(toxicity.training_rows(docs, nobody, "toxic", toxicity.HELD_OUT)).lexicon == {}


def test_markers():
    assert transcripts.marker("User: hello") == ("user", "hello")
    assert transcripts.marker("### Assistant") == ("assistant", "")
    assert transcripts.marker("[bot] hi") == ("assistant", "hi")
    assert transcripts.marker("<|system|>") == ("system", "")
    assert transcripts.marker("**Question:** why?") == ("user", "why?")
    assert transcripts.marker("note: this is text") == ("none", "note: this is text")
    assert transcripts.marker("") == ("none", "")


def test_viterbi_against_all_paths(spark):
    from itertools import product

    turns = queries.raw_turns(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    model = transcripts.fit(transcripts.labelled_lines(turns))

    def worth(path, lines):
        total = model.start[path[0]]
        for i, (r, (m, k)) in enumerate(zip(path, lines, strict=True)):
            total += model.marker[r][transcripts.MARKERS.index(m)] + model.kind[r][k]
            total += model.move[m != "none"][path[i - 1]][r] if i else 0
        return total

    rng = np.random.default_rng(4)
    for _ in range(30):
        lines = [(transcripts.MARKERS[rng.integers(4)], int(rng.integers(8))) for _ in range(6)]
        best = max(worth(p, lines) for p in product(range(3), repeat=6))
        assert worth(model.roles(lines), lines) == pytest.approx(best)
    assert model.roles([]) == []


@pytest.mark.parametrize(("unmarked", "share"), [(0, 0.98), (30, 0.9), (50, 0.8)])
def test_transcripts_recover_roles(spark, unmarked, share):
    sf = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    want = turns.where(queries.judged_transcript(F.col("conv_id"))).toPandas()
    got = queries.op5_chat_formatting(spark, sf, unmarked).toPandas()
    both = want.merge(got, on=["conv_id", "turn"], how="left", suffixes=("", "_got"))
    right = ((both.role == both.role_got) & (both.text == both.text_got)).mean()
    assert right >= share, right


def test_markers_are_cut_where_roles_agree(spark):
    turns = queries.raw_turns(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    model = transcripts.fit(transcripts.labelled_lines(turns))
    text = "User: what is it?\n\nAssistant: I add.\nAnswer: the sum is 4\n\nUser:\n\nAssistant: more\n\nwhy so?"
    assert transcripts.parse(text, model) == [
        ("user", "what is it?"),
        ("assistant", "I add.\nAnswer: the sum is 4"),
        ("user", ""),
        ("assistant", "more"),
        ("user", "why so?"),
    ]


def test_odd_transcripts(spark):
    model = transcripts.fit(spark.createDataFrame([], "role string, before string, marker string, kind int"))
    df = spark.createDataFrame([(1, None), (2, ""), (None, "User: a\nb\nBot: c"), (3, "x"), (3, "Q: " + "long " * 20_000)], "conv_id long, transcript string")
    got = [(r.conv_id, r.turn, r.text[:6]) for r in transcripts.parse_transcripts(df, model).collect()]
    assert (None, 0, "a\nb") in got and (None, 1, "c") in got and [g[0] for g in got].count(3) == 2 and len(got) == 4
    assert transcripts.parse_transcripts(df.where("false"), model).collect() == []
    assert transcripts.render([("user", "hi")]) == "<|user|>\nhi\n<|end|>\n"
