"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult and threat (both with a learned weight), target, negation,
report, or other. Small transducers read them: one weighs insults, one adds for a target
just before an insult, one holds a threat open until the target that it is made to, one
damps what a negation governs, one damps what is reported speech. They are composed into
one machine, which reads every clause that holds an insult or a threat.

Insults are words that toxic rows hold more often than others do. Threats are words of
which that is true only where a target follows them in the clause. No word is either by
a list: one that no label supports weighs nothing. The words, their weights and the curve
from clause scores to a probability are learned from at most ``TRAIN_ROWS`` labelled rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import ALNUM, bounded_sample, cut, without

#: Labelled rows that the lexicon and the curve are fitted on, by the hash of their id.
TRAIN_ROWS = 20_000
#: Learned words that are kept, by weight.
LEXICON_WORDS = 2_000
#: Least log-odds of a learned word, at its lower bound. The bound is as many standard errors
#: below the log-odds as the largest of so many words' errors would be by chance, times this.
MIN_LOG_ODDS = 2.0
BOUND = 0.31

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Closed-class words of the grammar in English, German, French and Spanish.
CLASSES = {
    TARGET: "you your yourself u he she him her they them du dich dir ihr euch sie tu toi vous te tí usted ustedes",
    NEGATION: "not no never nobody none isn't aren't don't nicht kein keine nie pas jamais aucun nunca ningún jamás",
    REPORT: "said says called quoted wrote reported claimed sagte sagten schrieb dit disait écrit dijo decía escribió",
}
# What stands before "n't"; the splitter leaves "isn" and "t" of "isn't", and "isn’t" whole.
_CONTRACTED = "isn aren wasn weren don doesn didn can couldn won wouldn shouldn haven hasn hadn mustn needn ain"
_CLASS = {w: c for c, words in CLASSES.items() for w in words.split()}
_CLASS |= {f"{w}{mark}t": NEGATION for w in _CONTRACTED.split() for mark in "'’"}
_CLAUSE = re.compile(rb"[.,;:!?\n()]+")


@dataclass(frozen=True)
class Transducer:
    """``arcs[state, symbol] = (state, factor, bonus)``; a symbol without an arc stays put.

    A word's output is its weight times the factors plus the bonuses of its arcs.
    """

    states: int
    arcs: dict = field(default_factory=dict)


def compose(machines: list[Transducer]) -> dict:
    """The product machine: a tuple of states reads a symbol in all of them at once."""
    out = {}
    for states in itertools.product(*(range(m.states) for m in machines)):
        for symbol in range(6):
            arcs = [m.arcs.get((s, symbol), (s, 1.0, 0.0)) for s, m in zip(states, machines, strict=True)]
            factor = math.prod(a[1] for a in arcs)
            out[states, symbol] = (tuple(a[0] for a in arcs), factor, sum(a[2] for a in arcs))
    return out


def _fading(opens: int, reach: int, factor: float, bonus: float, on: tuple[int, ...] = (INSULT, THREAT)) -> Transducer:
    """After ``opens``, the symbols of ``on`` within ``reach`` words get factor and bonus."""
    arcs: dict = {}
    for s in range(reach + 1):
        left = max(s - 1, 0)
        for symbol in range(6):
            acts = s > 0 and symbol in on
            arcs[s, symbol] = (reach if symbol == opens else left, factor if acts else 1.0, bonus if acts else 0.0)
    return Transducer(reach + 1, arcs)


def _waiting(reach: int) -> Transducer:
    """A threat stays open for ``reach`` words; the first target among them closes it with a
    bonus, which stands for the threat's own weight."""
    arcs: dict = {}
    for s in range(reach + 1):
        for symbol in range(6):
            left = reach if symbol == THREAT else 0 if symbol == TARGET else max(s - 1, 0)
            arcs[s, symbol] = (left, 1.0, 1.0 if symbol == TARGET and s > 0 else 0.0)
    return Transducer(reach + 1, arcs)


#: Insults count once each; a second one in a clause counts half more.
INSULTS = Transducer(2, {(0, INSULT): (1, 1.0, 0.0), (1, INSULT): (1, 1.5, 0.0)})
REACH, NEGATED, TARGETED, REPORTED = 4, 3, 0.5, 0.5
GRAMMAR = compose(
    [
        INSULTS,
        _fading(TARGET, REACH, 1.0, TARGETED, (INSULT,)),
        _waiting(REACH),
        _fading(NEGATION, NEGATED, 0.3, 0.0),
        Transducer(2, {(0, REPORT): (1, 1.0, 0.0), (1, INSULT): (1, REPORTED, 0.0), (1, THREAT): (1, REPORTED, 0.0)}),
    ]
)
START = (0, 0, 0, 0, 0)


def _rejoined(words: list[str]) -> list[str]:
    """``words`` with "isn", "t" and the like as one word again."""
    out: list[str] = []
    for w in words:
        if w == "t" and out and f"{out[-1]}'t" in _CLASS:
            out[-1] += "'t"
        else:
            out.append(w)
    return out


def clause_score(words: list[str], lexicon: dict[str, float], threats: dict[str, float] | None = None) -> float:
    """Total output of the composed machine over one clause.

    A threat's weight, damped where it stands, is paid by the target that follows it.
    """
    state, total, open_threat = START, 0.0, 0.0
    for w in _rejoined(words):
        weight, threat = lexicon.get(w), (threats or {}).get(w)
        symbol = INSULT if weight is not None else THREAT if threat is not None else _CLASS.get(w, OTHER)
        state, factor, bonus = GRAMMAR[state, symbol]
        if symbol == INSULT:
            total += weight * factor + bonus
        elif symbol == THREAT:
            open_threat = threat * factor
        else:
            total += open_threat * bonus
    return total


def addressed(words: list[str]) -> set[str]:
    """Words of a clause that a target follows within ``REACH`` words, with no other target
    between: what may be a threat."""
    words, out, open_words = _rejoined(words), set(), []
    for w in words:
        kind = _CLASS.get(w, OTHER)
        if kind == TARGET:
            out.update(open_words)
            open_words = []
        else:
            open_words = [*open_words, w][-REACH:] if kind == OTHER else [*open_words, ""][-REACH:]
    return out - {""}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(ALNUM).split()


def clauses(text: str | None) -> Iterator[list[bytes]]:
    for clause in _CLAUSE.split((text or "").encode()):
        if own := clause.translate(ALNUM).split():
            yield own


def features(text: str | None, lexicon: dict[str, float], threats: dict[str, float], keys: frozenset[bytes]) -> tuple[float, float, float]:
    """Sum and maximum of the clause scores, and their sum for a hundred words."""
    words = words_of(text)
    if keys.isdisjoint(words):
        return 0.0, 0.0, 0.0
    scores = [clause_score([w.decode() for w in own], lexicon, threats) for own in clauses(text) if not keys.isdisjoint(own)]
    total = sum(scores)
    return total, max(scores, default=0.0), 100.0 * total / len(words)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    threats: dict[str, float]
    weights: tuple[float, ...]
    bias: float

    def keys(self) -> frozenset[bytes]:
        return frozenset(w.encode() for w in (*self.lexicon, *self.threats))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def _rising(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], float]:
    """The same with no weight below zero: a text never scores less for a larger feature."""
    used = list(range(x.shape[1]))
    while True:
        own, bias = _logistic(x[:, used], y)
        if not len(used) or own.min() >= 0:
            break
        del used[int(own.argmin())]
    weights = dict(zip(used, own.tolist(), strict=True))
    return tuple(weights.get(i, 0.0) for i in range(x.shape[1])), bias


def training_rows(docs: DataFrame, labels: DataFrame, label: str, held_out_of: tuple[int, bool], id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """``label, text`` of at most ``rows`` labelled documents outside the held-out fold.

    ``held_out_of`` is the fold's test on the id. Labels of one id count once, the
    largest. The sample's ids are at most ``rows``, so they may be broadcast.
    """
    named = labels.select(F.col(id).cast("long").alias("i"), F.col(label).cast("int").alias("y")).where("i IS NOT NULL AND y IS NOT NULL")
    named = named.where(~held_out_of(F.col("i")))
    chosen = cut(bounded_sample(cut(named.groupBy("i").agg(F.max("y").alias("y")), "labelled-ids"), "i", rows), "training-ids")
    texts = docs.select(F.col(f"`{id}`").cast("long").alias("i"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "i").select("y", "text")


def fold(divisor: int, remainder: int):
    """Test for ids whose text has this CRC-32 remainder."""
    return lambda c: F.crc32(c.cast("string")) % divisor == remainder


HELD_OUT = fold(5, 0)


def fit(train: DataFrame) -> ToxicityModel:
    """Learn the lexicons from word counts, then the curve from clause scores."""
    train = cut(train, "toxicity-training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good, totals = Counter(), Counter(), [0, 0]
        for batch in batches:
            for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = bad if y else good
                own.update({(w.decode(), False) for w in set(words_of(t))})
                own.update({(w, True) for w in set().union(*(addressed([w.decode() for w in c]) for c in clauses(t)))})
                totals[1 if y else 0] += 1
        words = list(bad.keys() | good.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *(w for w, _ in words)], pa.string()),
                pa.array([False, *(a for _, a in words)], pa.bool_()),
                pa.array([totals[1], *(bad[w] for w in words)], pa.int64()),
                pa.array([totals[0], *(good[w] for w in words)], pa.int64()),
            ],
            names=["word", "addressed", "bad", "good"],
        )

    counted = train.mapInArrow(count, "word string, addressed boolean, bad long, good long").groupBy("word", "addressed")
    counts = cut(counted.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxic-words")
    total = counts.where("word IS NULL").first()
    if not total or not total["bad"] or not total["good"]:
        share = float(bool(total and total["bad"]))
        return ToxicityModel({}, {}, (0.0, 0.0, 0.0), 30.0 if share else -30.0)
    seen = counts.where("word IS NOT NULL AND bad > 0")
    width = BOUND * math.sqrt(2 * math.log(max(seen.count(), 2)))
    b, g = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(b / (total["bad"] + 1)) - F.log(g / (total["good"] + 1)) - width * F.sqrt(1 / b + 1 / g)
    top = seen.withColumn("w", odds).where(F.col("w") >= MIN_LOG_ODDS)
    found = top.orderBy(F.desc("w"), "word", "addressed").limit(2 * LEXICON_WORDS).collect()
    lexicon = {r["word"]: float(r["w"]) for r in found if not r["addressed"]}
    threats = {r["word"]: float(r["w"]) for r in found if r["addressed"] and r["word"] not in lexicon}
    model = ToxicityModel(lexicon, threats, (0.0, 0.0, 0.0), 0.0)
    rows = _featured(train, model).select("y", "total", "most", "rate").toPandas()  # at most TRAIN_ROWS
    x = np.log1p(rows[["total", "most", "rate"]].to_numpy())
    weights, bias = _rising(x, rows["y"].to_numpy() > 0)
    return ToxicityModel(lexicon, threats, weights, bias)


def _featured(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    lexicon, threats, keys = model.lexicon, model.threats, model.keys()

    @F.pandas_udf("struct<total: double, most: double, rate: double>")
    def read(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(t, lexicon, threats, keys) for t in texts], columns=["total", "most", "rate"], dtype=float)

    return docs.withColumn("_f", read("text")).select("*", "_f.*")


def with_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "toxicity") -> DataFrame:
    """Add a probability in ``score``, written over a column of that name.

    Null and empty texts, and texts without a matched clause, get the curve's value at 0.
    """
    lexicon, threats, keys = model.lexicon, model.threats, model.keys()
    weights, bias = np.array(model.weights), model.bias

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        x = np.log1p(np.array([features(t, lexicon, threats, keys) for t in texts]).reshape(-1, 3))
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30))))

    value = probability(F.col(f"`{text}`"))
    return without(docs, score).select("*", value.alias(score)) if score != text else docs.withColumn(text, value)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, unchanged. Null and empty texts stay
    where the curve's value at 0 is under it; repeated rows all stay or all go."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = with_toxicity(docs.select(whole, F.col(f"`{text}`").alias("text")), model, "text", "score")
    return scored.where(F.col("score") < threshold).select("row.*")
