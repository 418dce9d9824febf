"""From raw documents to packed training sequences, in five stages.

Toxic documents go; repeated long lines go; of near-duplicate documents one stays;
documents contaminated by the benchmark go; what is left is packed into sequences.
Each stage is judged on what the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.llm import decontaminate, line_dedup, packing, simhash, toxicity
from strideframe.llm.common import cut, table

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the model is learned outside the held-out fold.

    Null and empty texts score as texts without a toxic clause; equal rows stay or go together;
    without labels, or with labels of one kind, all or none stay."""
    train = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.HELD_OUT)
    return toxicity.drop_toxic(docs, toxicity.fit(train))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that many share; ``n_chars`` follows the text
    where there is such a column. Null and empty texts, null ids and equal rows stay."""
    return line_dedup.without_repeated_lines(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates; of equal rows one. Texts without words are
    one group; rows without an id all stay."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words benchmark windows cover less than a twentieth. Null and empty texts
    stay, equal rows stay or go together, and an empty benchmark drops nothing."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4,096 tokens; null and empty texts have
    the end id only, and each row is a document."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The learned toxicity scores and the tokenizer are not SQL.
ORACLE_SQL = None
