"""Counts, distributions, correlations and box summaries, all as small DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions import decode, nan_to_null
from strideframe.operators.series import HotGroups, number_rows
from strideframe.schemas import ACTIVITIES, META_COLUMNS, feature_columns
from strideframe.sources.storage import materialize

#: Sketch accuracy of ``percentile_approx``: ranks are off by at most n / SKETCH.
SKETCH = 10_000
#: Base-2 logarithm of the places in a distinct-count sketch.
SKETCH_LG_K = 14
#: Half width of the narrowest rank bracket around a quartile, ten times the sketch's error,
#: and how much wider each next one is; the last one is the whole group.
BRACKET = 10 / SKETCH
WIDENING = 4
#: Ranks that a bracket should reach to either side of its quartile.
REACH_RANKS = 4
QUARTILES = (0.25, 0.5, 0.75)
#: Correlations that one aggregation holds: with six moments each, and its keys, it stays below
#: the 100 columns up to which Spark generates code.
CORRELATIONS = 16


def overview(
    df: DataFrame,
    subject: str = "subject_id",
    label: str = "activity_label",
    meta: frozenset[str] = META_COLUMNS,
    approximate: bool = False,
) -> DataFrame:
    """One row: rows, features, columns, distinct subjects, distinct labels."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(feature_columns(df, meta))).cast("long").alias("features"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        distinct(F.col(subject)).alias("subjects"),
        distinct(F.col(label)).alias("activities"),
    )


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One HyperLogLog sketch of each column per group of ``by``: ``by, <c>_sketch``.

    Sketches are small binary values to be stored. However rows are cut into parts, the union
    of the parts' sketches is the same. The standard error of an estimate is about 0.8 / sqrt(2 ** lg_k).
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"{c}_sketch") for c in cols])


def united_distinct(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct counts estimated from the union of stored sketches: ``by, <c>``."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(c) for c in cols])


def counts_by(df: DataFrame, by: str, count: str = "rows") -> DataFrame:
    """Rows per value of ``by``, in order."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(count)).orderBy(by)


def activity_counts(
    df: DataFrame, label: str = "activity_label", names: Mapping[str, str] = ACTIVITIES
) -> DataFrame:
    """Rows per activity with its name."""
    return with_activity_name(counts_by(df, label), label, names)


def subject_counts(df: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Rows per subject, and the mean over all subjects next to each."""
    counts = df.groupBy(subject).agg(F.count(F.lit(1)).alias("rows"))
    mean = counts.agg(F.avg("rows")).scalar()
    return counts.select(subject, "rows", mean.alias("mean_rows")).orderBy(subject)


def with_activity_name(
    df: DataFrame,
    label: str = "activity_label",
    names: Mapping[str, str] | DataFrame = ACTIVITIES,
    name: str = "activity_name",
) -> DataFrame:
    """Add the readable name; a code without one keeps its code.

    ``names`` is a small literal mapping, or a DataFrame of (label, name) for a
    dictionary that lives in a table.
    """
    if isinstance(names, DataFrame):
        code, readable = names.columns[:2]
        # one name for each code, the first in order, so that no row is multiplied
        dictionary = names.groupBy(F.col(code).alias("_code")).agg(F.min(readable).alias("_name"))
        joined = df.join(dictionary, F.col(label) == F.col("_code"), "left")
        return joined.select(*df.columns, F.coalesce("_name", F.col(label).cast("string")).alias(name))
    return df.withColumn(name, F.coalesce(decode(label, names), F.col(label)))


def category_names(
    df: DataFrame, label: str = "activity_label", names: Mapping[str, str] = ACTIVITIES
) -> DataFrame:
    """The distinct readable names, sorted."""
    return with_activity_name(df.select(label).distinct(), label, names).select("activity_name").distinct().orderBy(
        "activity_name"
    )


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, min and max, one row per column."""
    values = df.selectExpr(*[f"cast(`{c}` AS double) AS _{i}" for i, c in enumerate(cols)])
    statistics = ("count", "avg", "stddev_samp", "min", "max")
    one = values.agg(*[F.expr(f"{f}(_{i}) AS {f}_{i}") for i in range(len(cols)) for f in statistics])
    rows = [f"{_text(c)}, " + ", ".join(f"{f}_{i}" for f in statistics) for i, c in enumerate(cols)]
    return one.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (column, count, mean, stddev, min, max)")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair: (col_a, col_b, corr), both triangles.

    Each pair uses the rows where both values are present. One pass, no shuffle beyond one
    partial row per task and column: a row is taken once for each of its columns, which is
    set against all of them, as the moments of all pairs side by side are more columns than
    Spark generates code for.
    """
    places = range(len(cols))
    values = df.selectExpr(*[f"nullif(cast(`{c}` AS double), double('NaN')) AS _{i}" for i, c in enumerate(cols)])
    taken = values.selectExpr("*", f"posexplode(array({', '.join(f'_{i}' for i in places)})) AS (_a, _x)")
    merged = [taken.groupBy("_a").agg(*[F.expr(f"corr(_x, _{j}) AS r_{j}") for j in part]) for part in _parts(places)]
    told = [
        m.selectExpr("_a", f"stack({len(part)}, {', '.join(f'{j}, r_{j}' for j in part)}) AS (_b, corr)")
        for m, part in zip(merged, _parts(places), strict=True)
    ]
    # a single row, also where there are no rows; one of a pair's two numbers serves both triangles
    found = reduce(DataFrame.unionByName, told).where("_a <= _b")
    one = found.agg(F.expr(f"map_from_entries(collect_list(struct(_a * {len(cols)} + _b, corr))) AS r"))
    rows = [
        f"{_text(cols[a])}, {_text(cols[b])}, try_element_at(r, {min(a, b) * len(cols) + max(a, b)})" for a in places for b in places
    ]
    return one.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (col_a, col_b, corr)")


def _parts(places: range) -> list[range]:
    """``places`` in parts whose correlations fit into generated code."""
    return [places[k : k + CORRELATIONS] for k in range(0, len(places), CORRELATIONS)]


def _text(name: str) -> str:
    """``name`` as a SQL string literal."""
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def box_summary(
    df: DataFrame,
    cols: Sequence[str],
    by: str = "activity_label",
    method: str = "exact",
    hot: HotGroups | None | str = "auto",
    bracket: float = BRACKET,
    reach: int = REACH_RANKS,
    written: bool = False,
) -> DataFrame:
    """What a box plot shows, per group and column.

    (by, column, count, q1, median, q3, whisker_low, whisker_high, outliers).
    Quartiles interpolate linearly; whiskers end at the last value within 1.5
    times the quartile range, or at the box where no value lies between. Nulls,
    NaNs and rows without a group are left out.

    ``method="exact"`` narrows each quartile to a bracket of ranks with a sketch,
    and counts exactly inside the brackets, so rows are never sorted or shuffled
    as a whole. A bracket that turns out not to hold its quartile is widened and counted
    again, until all are found. ``"approx"`` takes the sketch's quartiles as they are.
    ``df`` runs once: the values are written, and read for each pass. One that is a ``written``
    table is read itself.
    """
    rows = df.where(F.col(by).isNotNull()).select(
        F.col(by).alias("_by"),
        *[nan_to_null(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(cols)],
    )
    if not written:
        rows = materialize(rows, "box-values")
    if method == "approx":
        wide = rows.groupBy("_by").agg(
            *[
                F.percentile_approx(f"_v{i}", list(QUARTILES), SKETCH).alias(f"_q{i}")
                for i in range(len(cols))
            ],
        )
    elif method == "exact":
        wide = _exact_quartiles(rows, len(cols), hot, bracket, reach)
    else:
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")

    # One row per group. Written down, its size is known, and Spark broadcasts it
    # where it is small enough; the rows are then never shuffled.
    joined = rows.join(materialize(wide, "box-quartiles"), "_by")
    aggs = []
    for i in range(len(cols)):
        v, q = F.col(f"_v{i}"), F.col(f"_q{i}")
        q1, q3 = q[0], q[2]
        reach = (q3 - q1) * 1.5
        low, high = q1 - reach, q3 + reach
        aggs += [
            F.count(v).alias(f"n{i}"),
            # single numbers, so that a hash aggregation can hold them
            *[F.any_value(q[j]).alias(f"q{i}_{j}") for j in range(len(QUARTILES))],
            F.min(F.when(v >= low, v)).alias(f"lo{i}"),
            F.max(F.when(v <= high, v)).alias(f"hi{i}"),
            F.count(F.when((v < low) | (v > high), v)).alias(f"out{i}"),
        ]
    boxes = joined.groupBy("_by").agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        q = [F.col(f"q{i}_{j}") for j in range(len(QUARTILES))]
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("count"),
                q[0].alias("q1"),
                q[1].alias("median"),
                q[2].alias("q3"),
                F.least(F.col(f"lo{i}"), q[0]).alias("whisker_low"),
                F.greatest(F.col(f"hi{i}"), q[2]).alias("whisker_high"),
                F.col(f"out{i}").alias("outliers"),
            )
        )
    return boxes.select(F.col("_by").alias(by), F.inline(F.array(*structs))).where(F.col("count") > 0)


def _exact_quartiles(rows: DataFrame, n_cols: int, hot: HotGroups | None | str, bracket: float, reach: int) -> DataFrame:
    """Exact quartiles as arrays ``_q0, _q1, ...`` per ``_by``."""
    widths = [bracket]
    while widths[-1] < 1:
        widths.append(min(widths[-1] * WIDENING, 1.0))
    ranks = sorted({min(max(q + d, 0.0), 1.0) for q in QUARTILES for w in widths for d in (-w, w)})
    place = {r: k for k, r in enumerate(ranks)}
    # A sketch may come out differently when it is computed again, so it is written down
    # before anything is counted against it.
    sketched = rows.groupBy("_by").agg(
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in range(n_cols)],
        *[F.percentile_approx(f"_v{i}", ranks, SKETCH).alias(f"_c{i}") for i in range(n_cols)],
        *[F.min(f"_v{i}").alias(f"_l{i}") for i in range(n_cols)],
        *[F.max(f"_v{i}").alias(f"_h{i}") for i in range(n_cols)],
    )
    per_column = [F.struct(F.lit(i).alias("_col"), *[F.col(f"_{x}{i}").alias(f"_{x}") for x in "nclh"]) for i in range(n_cols)]
    ladder = materialize(sketched.select("_by", F.inline(F.array(*per_column))).where("_n > 0"), "box-ladder")

    def at_level(level: Column) -> Column:
        """The three brackets of a level; the last level's reach from end to end."""
        levels = []
        for w in widths[:-1]:
            cuts = [(F.col("_c")[place[max(q - w, 0.0)]], F.col("_c")[place[min(q + w, 1.0)]]) for q in QUARTILES]
            levels.append(F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in cuts]))
        levels.append(F.array(*[F.struct(F.col("_l").alias("lo"), F.col("_h").alias("hi"))] * len(QUARTILES)))
        return F.array(*levels)[level]

    # the narrowest bracket that reaches some ranks to either side
    first = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        first = F.when(F.col("_n") * widths[k] >= reach, k).otherwise(first)
    tried = ladder.withColumn("_level", first)
    found = []
    for _ in widths:
        brackets = materialize(tried.select("_by", "_col", "_n", "_level", at_level(F.col("_level")).alias("_b")), "box-brackets")
        placed = _ranked_cells(rows, brackets, n_cols, hot)
        answers = materialize(brackets.drop("_b").join(placed, ["_by", "_col"]), "box-quartiles")
        missed = F.exists("_q", lambda q: q.isNull())
        found.append(answers.where(~missed).select("_by", "_col", "_q"))
        again = answers.where(missed).select("_by", "_col", (F.col("_level") + 1).alias("_level"))
        if again.isEmpty():
            break
        tried = ladder.join(again, ["_by", "_col"])
    quartiles = found[0]
    for f in found[1:]:
        quartiles = quartiles.unionByName(f)
    return quartiles.groupBy("_by").agg(
        *[F.max(F.when(F.col("_col") == i, F.col("_q"))).alias(f"_q{i}") for i in range(n_cols)]
    )


def _ranked_cells(rows: DataFrame, brackets: DataFrame, n_cols: int, hot: HotGroups | None | str) -> DataFrame:
    """``_by, _col, _q``: the quartiles as counted against ``brackets``, null where one is missed."""
    # Values inside a bracket keep themselves as cell; all values between two
    # brackets fall into one null cell that sorts before the next bracket.
    wide = brackets.groupBy("_by").agg(*[F.max(F.when(F.col("_col") == i, F.col("_b"))).alias(f"_b{i}") for i in range(n_cols)])
    # one value at a time is held against its brackets, after the join: all of a row's columns at
    # once make a method that the JVM does not compile
    values = rows.join(wide, "_by").select(
        "_by",
        F.inline(F.array(*[F.struct(F.lit(i).alias("_col"), F.col(f"_v{i}").alias("_v"), F.col(f"_b{i}").alias("_b")) for i in range(n_cols)])),
    )
    cells = values.select("_by", "_col", *_zone_and_cell(F.col("_v"), F.col("_b"))).where(F.col("_zone").isNotNull())
    histogram = materialize(
        cells.groupBy("_by", "_col", "_zone", "_cell").agg(F.count(F.lit(1)).alias("_rows")), "box-cells"
    )

    running = number_rows(
        histogram, ["_by", "_col"], ["_zone", "_cell"], position="_before", weight="_rows", hot=hot
    )
    placed = running.join(brackets.select("_by", "_col", "_n"), ["_by", "_col"])

    def rank(q: float) -> Column:
        return (F.col("_n") - 1) * F.lit(q)

    def at(index: Column) -> Column:
        """The value of the cell that holds the 0-based rank ``index``."""
        holds = (F.col("_before") <= index) & (index < F.col("_before") + F.col("_rows"))
        return F.max(F.when(holds, F.col("_cell")))

    found = placed.groupBy("_by", "_col").agg(
        F.any_value("_n").alias("_n"),
        *[at(F.floor(rank(q))).alias(f"_at{j}_lo") for j, q in enumerate(QUARTILES)],
        *[at(F.ceil(rank(q))).alias(f"_at{j}_hi") for j, q in enumerate(QUARTILES)],
    )

    def quartile(j: int, q: float) -> Column:
        lo, hi = F.col(f"_at{j}_lo"), F.col(f"_at{j}_hi")
        return lo + (hi - lo) * (rank(q) - F.floor(rank(q)))

    return found.select("_by", "_col", F.array(*[quartile(j, q) for j, q in enumerate(QUARTILES)]).alias("_q"))


def _zone_and_cell(v: Column, brackets: Column) -> list[Column]:
    passed = [F.when(F.get(brackets, F.lit(j)).getField("hi") < v, 1).otherwise(0) for j in range(len(QUARTILES))]
    inside = None
    for j in range(len(QUARTILES)):
        b = F.get(brackets, F.lit(j))
        hit = F.coalesce(v.between(b.getField("lo"), b.getField("hi")), F.lit(False))
        inside = hit if inside is None else inside | hit
    zone = F.when(v.isNotNull() & brackets.isNotNull(), passed[0] + passed[1] + passed[2])
    return [zone.alias("_zone"), F.when(inside, v).alias("_cell")]
