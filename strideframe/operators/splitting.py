"""Splits by subject and samples that do not depend on the data's layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.operators.series import HotGroups, number_rows

SPLITS = ("train", "val", "test")
#: Where subjects go that given counts leave over.
UNUSED = "unused"


def subject_split(
    df: DataFrame,
    subject: str = "subject_id",
    fractions: Sequence[float] | None = (0.6, 0.2, 0.2),
    counts: Sequence[int] | None = None,
    names: Sequence[str] = SPLITS,
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """Give every distinct subject, in ascending order, one split: (subject, split).

    With ``fractions`` the cuts lie at ``int(n * share)`` of the n subjects and
    the last split takes the rest; with ``counts`` the splits take that many
    subjects each and the subjects beyond them are in the split ``unused``.
    """
    shares = counts if counts is not None else fractions
    if shares is None or len(shares) != len(names):
        raise ValueError("one fraction or count per split name is needed")
    subjects = df.select(subject).where(F.col(subject).isNotNull()).distinct()
    ranked = number_rows(
        subjects, [], [subject], position="_rank", length="_subjects", hot=hot
    )

    chosen = None
    total = 0
    for i, (name, share) in enumerate(zip(names, shares)):
        total += share
        last = i == len(names) - 1
        if counts is not None:
            below = F.col("_rank") < total
        elif last:
            below = F.lit(True)
        else:
            # the sum of shares carries binary dust (0.6 + 0.2), the cut must not
            below = F.col("_rank") < F.floor(F.col("_subjects") * F.lit(round(total, 12)))
        chosen = F.when(below, name) if chosen is None else chosen.when(below, name)
    return ranked.select(subject, F.coalesce(chosen, F.lit(UNUSED)).alias("split"))


def split_rows(df: DataFrame, split: DataFrame, name: str, subject: str = "subject_id") -> DataFrame:
    """The rows of ``df`` whose subject is in the split called ``name``."""
    members = split.where(F.col("split") == name).select(subject)
    return df.join(members, subject, "left_semi")


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("subjects"))


def hash_sample(df: DataFrame, key: str | Sequence[str], fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, chosen by key only: the same rows under any
    partitioning, and all rows of a key or none."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1 and dict(df.dtypes)[keys[0]] in ("tinyint", "smallint", "int", "bigint"):
        number = F.col(keys[0]).cast("long")
    else:
        number = F.xxhash64(*keys)
    # 31 bits times a 32-bit odd constant stays below 2**63
    hashed = F.pmod(number, F.lit(2**31).cast("long")) * F.lit(2654435761).cast("long") % F.lit(2**32).cast("long")
    return df.where(hashed < F.lit(int(fraction * 2**32)).cast("long"))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Each row with probability ``fraction``; which rows depends on the partitioning."""
    return df.sample(fraction=fraction, seed=seed)


def shuffle_key(columns: Sequence[str], seed: int = 42) -> Column:
    """A number that scatters rows by the values of ``columns`` and ``seed``."""
    return F.xxhash64(*columns, F.lit(seed))


def shuffled(df: DataFrame, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """The rows in an order that looks random and is the same under any partitioning.

    ``key`` names columns that tell rows apart; by default all do.
    """
    columns = list(key) if key else df.columns
    return df.orderBy(shuffle_key(columns, seed), *columns)
