"""Language identification by a linear-chain conditional random field over words.

Every word of a text has a language. What speaks for it are features of the word: its
character n-grams of one to four characters with the word's edges as characters (so that
affixes are n-grams that hold an edge), and the word itself where the learned lexicon has
it. Learned transitions tie the languages of neighbouring words, so that a text may change
its language on the way. Forward-backward gives every word's probabilities; a text's
language is the one with the largest expected share of its characters.

Labels are known for whole texts only, and texts hold foreign words. Learning maximises
the likelihood of the labels with the words' languages hidden: a word's language agrees
with its text's label by a factor ``exp(AGREE)``. The gradient is the difference of two
forward-backward passes, with and without the labels.

Forward-backward runs over the concatenated words of many texts at once, cut into a
number of rows that grows with its square root: transfer matrices of the rows first, then all rows in step.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm.common import cut, slices, without
from strideframe.llm.toxicity import fold

#: Labelled texts of each language that are learned from (in the mean, by the hash of id and
#: text), and the words in the span that is taken from each, at a place chosen by its hash.
TRAIN_TEXTS = 250
SPAN_WORDS = 160
#: Hashed n-grams, and the times a word must occur in the sample to be in the lexicon.
BUCKETS = 1 << 16
LEXICON_COUNT = 3
AGREE = 2.0
STEPS, RATE, RIDGE = 14, 0.3, 1e-3
#: Bytes of text whose words are worked on at a time.
PART_BYTES = 2 * 1024 * 1024

UNKNOWN = "und"
HELD_OUT = fold(5, 0)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: part of a word (a letter or a mark); a letter."""
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    out = []
    for pattern in (r"[\p{L}\p{M}]+", r"\p{L}+"):
        table = np.zeros(0x110000, dtype=bool)
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = True
        out.append(table)
    return out[0], out[1]


@dataclass
class Words:
    """The words of some texts: each word's number among the different words, its length and its
    text; texts with a letter; and of the different words their hashes (ascending), the n-gram
    buckets of their characters one word after another, and where each opens there."""

    at: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    has_letter: np.ndarray
    hashes: np.ndarray
    buckets: list[np.ndarray]
    opens: np.ndarray


def read_words(texts: list[str | None]) -> Words:
    """Lower-case and cut texts into runs of letters and marks, and hash their n-grams."""
    part_of_word, letter = _tables()
    low = [(t or "").lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in low])
    points = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = part_of_word[points]
    letters = np.flatnonzero(letter[points])
    has = np.zeros(len(texts), dtype=bool)
    has[np.searchsorted(ends, letters - 1, side="right")] = True
    # words with one edge before each, and edges after the last
    keep = inside.copy()
    keep[:-1] |= inside[1:]
    where = np.flatnonzero(keep)
    z = np.where(inside[where], points[where], 0).astype(np.uint64)
    n = len(z)
    opens = np.flatnonzero(z == 0)
    text = np.searchsorted(ends, where[opens], side="right")
    prime = np.uint64(0x9E3779B97F4A7C15)
    sizes = np.diff(np.append(opens, n))
    place = (np.arange(n) - np.repeat(opens, sizes)).astype(np.uint64)
    mixed = (z * prime) ^ (place * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    every = np.add.reduceat(mixed, opens) if n else np.zeros(0, dtype=np.uint64)
    hashes, one, at = np.unique(every, return_index=True, return_inverse=True)
    # n-grams of one occurrence of each word
    own = sizes[one]
    begins = np.cumsum(own) - own
    total = int(own.sum())
    z = np.concatenate([z[np.repeat(opens[one] - begins, own) + np.arange(total)], np.zeros(4, dtype=np.uint64)])
    edge = z == 0
    gram, buckets = np.zeros(total, dtype=np.uint64), []
    for k in range(1, 5):
        gram = (gram + z[k - 1 : total + k - 1] + np.uint64(k)) * prime
        gram ^= gram >> np.uint64(31)
        bucket = (gram >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
        crossed = edge[:total].copy() if k == 1 else np.zeros(total, dtype=bool)
        for inner in range(1, k - 1):
            crossed |= edge[inner : total + inner]
        bucket[crossed] = BUCKETS
        buckets.append(bucket)
    return Words(at, sizes - 1, text, has, hashes, buckets, begins)


def word_scores(words: Words, grams: np.ndarray, lexicon: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Each different word's score for each language. ``grams`` has a last row of zeros."""
    if not len(words.opens):
        return np.zeros((0, grams.shape[1]))
    each = grams[words.buckets[0]]
    for b in words.buckets[1:]:
        each += grams[b]
    scores = np.add.reduceat(each, words.opens, axis=0).astype(np.float64)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, words.hashes), len(lexicon) - 1)
        known = lexicon[at] == words.hashes
        scores[known] += own[at[known]]
    return scores


def forward_backward(scores: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray, count: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Each word's probabilities and, on demand, the expected number of moves between languages.

    ``scores`` are of all texts' words one after another; ``first`` marks where texts begin.
    """
    n, k = scores.shape
    if n == 0:
        return scores.copy(), np.zeros((k, k))
    rows = math.ceil(2 * math.sqrt(n))
    steps = math.ceil(n / rows)
    pot = np.ones((rows * steps, k))
    pot[:n] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -40.0))
    new = np.ones(rows * steps, dtype=bool)
    new[:n] = first
    pot = np.ascontiguousarray(pot.reshape(rows, steps, k).transpose(1, 0, 2))
    new = np.ascontiguousarray(new.reshape(rows, steps).T)
    a, s = np.exp(move - move.max()), np.exp(start - start.max())
    any_new = new.any(axis=1)

    # transfer matrices of the rows
    m = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
    for c in range(steps):
        step = (m.reshape(rows * k, k) @ a).reshape(rows, k, k)
        if any_new[c]:
            step[new[c]] = m[new[c]].sum(axis=2, keepdims=True) * s
        m = step * pot[c][:, None, :]
        if c % 4 == 3 or c == steps - 1:
            m /= m.max(axis=(1, 2), keepdims=True)
    into, out = np.empty((rows, k)), np.empty((rows, k))
    v = np.ones(k)
    for r in range(rows):
        into[r] = v
        v = v @ m[r]
        v /= v.sum()
    v = np.ones(k)
    for r in range(rows - 1, -1, -1):
        out[r] = v
        v = m[r] @ v
        v /= v.max()

    ahead = np.empty((steps + 1, rows, k))
    ahead[0] = alpha = into
    for c in range(steps):
        step = alpha @ a
        if any_new[c]:
            step[new[c]] = alpha[new[c]].sum(axis=1, keepdims=True) * s
        alpha = step * pot[c]
        alpha /= alpha.sum(axis=1, keepdims=True)
        ahead[c + 1] = alpha
    post, beta, moves = np.empty((steps, rows, k)), out, np.zeros((k, k))
    for c in range(steps - 1, -1, -1):
        both = ahead[c + 1] * beta
        post[c] = both / both.sum(axis=1, keepdims=True)
        back = pot[c] * beta
        step = back @ a.T
        if count:
            old = ~new[c]
            weight = (ahead[c] * step).sum(axis=1)
            moves += (ahead[c][old] / weight[old, None]).T @ back[old]
        if any_new[c]:
            step[new[c]] = (back[new[c]] @ s)[:, None]
        beta = step / step.max(axis=1, keepdims=True)
    return post.transpose(1, 0, 2).reshape(rows * steps, k)[:n], moves * a


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    grams: np.ndarray
    lexicon: np.ndarray
    own: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def words(self, texts: list[str | None]) -> tuple[Words, np.ndarray]:
        """The texts' words, and each word's probabilities."""
        words = read_words(texts)
        scores = word_scores(words, self.grams, self.lexicon, self.own)[words.at]
        return words, forward_backward(scores, _firsts(words.text), self.move, self.start)[0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Each text's language and its expected share of the text's characters."""
        words, post = self.words(texts)
        share = np.zeros((len(texts), len(self.languages)))
        np.add.at(share, words.text, post * words.lengths[:, None])
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        known = words.has_letter & (total > 0)
        score = np.where(known, share[np.arange(len(texts)), best] / np.where(total > 0, total, 1.0), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.clip(score, 0.0, 1.0).tolist()


def _firsts(text: np.ndarray) -> np.ndarray:
    first = np.ones(len(text), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    return first


def learn(spans: list[str], labels: list[str], steps: int = STEPS) -> LanguageModel | None:
    """Fit on spans of words and their texts' languages; None without a word."""
    languages = tuple(sorted(set(labels)))
    whole = read_words(spans)
    if not len(whole.at):
        return None
    k, at, kinds, opens = len(languages), whole.at, whole.buckets, whole.opens
    different, length = len(opens), len(kinds[0])
    kind_of = np.repeat(np.arange(different), np.diff(np.append(opens, length)))
    in_lexicon = np.bincount(at, minlength=different) >= LEXICON_COUNT
    every = np.concatenate(kinds)
    by_bucket = np.argsort(every, kind="stable")
    used, begins = np.unique(every[by_bucket], return_index=True)
    owners = np.tile(kind_of, len(kinds))[by_bucket]

    gold = np.array([languages.index(x) for x in labels])[whole.text]
    first = _firsts(whole.text)
    agree = np.zeros((len(gold), k))
    agree[np.arange(len(gold)), gold] = AGREE

    values = {"grams": np.zeros((BUCKETS + 1, k)), "own": np.zeros((different, k)), "move": np.zeros((k, k)), "start": np.zeros(k)}
    seen = {n: np.zeros_like(v) for n, v in values.items()}
    speed = {n: np.zeros_like(v) for n, v in values.items()}
    for t in range(1, steps + 1):
        each = sum(values["grams"][b] for b in kinds)
        scores = (np.add.reduceat(each, opens, axis=0) + values["own"])[at]
        free, moves = forward_backward(scores, first, values["move"], values["start"], True)
        told, told_moves = forward_backward(scores + agree, first, values["move"], values["start"], True)
        pull = told - free
        by_word = np.stack([np.bincount(at, weights=pull[:, c], minlength=different) for c in range(k)], axis=1)
        grams = np.zeros_like(values["grams"])
        grams[used] = np.add.reduceat(by_word[owners], begins, axis=0)
        grams[BUCKETS] = 0.0
        gradient = {"grams": grams, "own": by_word * in_lexicon[:, None], "move": told_moves - moves, "start": pull[first].sum(axis=0)}
        rate = RATE * 0.5 * (1 + math.cos(math.pi * (t - 1) / steps))
        for name, g in gradient.items():
            g = g - RIDGE * len(gold) / 100 * values[name] * (g != 0)
            seen[name] = 0.9 * seen[name] + 0.1 * g
            speed[name] = 0.99 * speed[name] + 0.01 * g * g
            values[name] = values[name] + rate * (seen[name] / (1 - 0.9**t)) / (np.sqrt(speed[name] / (1 - 0.99**t)) + 1e-8)
        values["grams"][BUCKETS] = 0.0
    return LanguageModel(languages, values["grams"].astype(np.float32), whole.hashes[in_lexicon], values["own"][in_lexicon], values["move"], values["start"])


def training_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", held_out=HELD_OUT, texts: int = TRAIN_TEXTS, span: int = SPAN_WORDS) -> DataFrame:
    """``lang, span``: about ``texts`` labelled texts of each language outside the held-out
    fold, chosen by the hash of id and text, and a span of each of at most ``span`` words.

    Rows without id, text or language are not learned from; repeated rows count once.
    """
    rows = docs.select(F.col(f"`{id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("i IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.where(~held_out(F.col("i")))
    sizes = cut(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    scale = 1 << 30
    chosen = rows.withColumn("h", F.xxhash64("i", "text")).join(sizes, "lang").where(F.pmod("h", F.lit(scale)) < F.lit(float(scale * texts)) / F.col("n"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = regex.compile(r"[\p{L}\p{M}]+")
        for batch in batches:
            out = []
            for t, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                own = word.findall(t)
                at = h % max(len(own) - span + 1, 1)
                out.append(" ".join(own[at : at + span]))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.string())], names=["lang", "span"])

    return chosen.select("lang", "text", "h").mapInArrow(spans, "lang string, span string").where("span != ''").distinct()


def fit(docs: DataFrame, **options) -> LanguageModel | None:
    """Learn from the sample of ``training_spans``; None where it is empty."""
    sample = sorted((r["lang"], r["span"]) for r in cut(training_spans(docs, **options), "language-spans").collect())
    return learn([s for _, s in sample], [g for g, _ in sample])


def with_language(docs: DataFrame, model: LanguageModel | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add each text's language and its expected share of the characters, written over
    columns of those names.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text
    where there is no model. Whole texts are read; rows, ties and other columns stay.
    """
    rest = without(docs, lang, score)
    if text not in rest.columns:
        raise ValueError(f"the text column {text} cannot be written over")
    schema = T.StructType([*rest.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def score_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, PART_BYTES):
            texts = part.column(text).to_pylist()
            found, share = model.predict(texts) if model else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(share, pa.float64())], names=[*part.schema.names, lang, score])

    return rest.mapInArrow(score_all, schema)
