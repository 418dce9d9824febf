"""The SQL twin of each query, for DuckDB over the same tables."""

from __future__ import annotations

SERIES = """
lr AS (
  SELECT l_suppkey AS subject_id, l_returnflag AS activity_label,
         epoch_us(l_shipdate) AS "timestamp",
         l_quantity AS x, l_extendedprice AS y, l_discount AS z, l_tax AS t,
         l_linestatus AS side, l_orderkey, l_linenumber, l_partkey
  FROM lineitem
)"""

ORDER = '"timestamp", l_orderkey, l_linenumber, l_partkey'

FEATURES = f"""{SERIES},
lagged AS (
  SELECT *,
    row_number() OVER s AS rn,
    ("timestamp" - lag("timestamp") OVER s) / 1e6::DOUBLE AS dt,
    coalesce(x - lag(x) OVER s, 0.0::DOUBLE) AS dx,
    coalesce(y - lag(y) OVER s, 0.0::DOUBLE) AS dy,
    coalesce(z - lag(z) OVER s, 0.0::DOUBLE) AS dz
  FROM lr WINDOW s AS (PARTITION BY subject_id, activity_label ORDER BY {ORDER})
),
rates AS (
  SELECT *,
    CASE WHEN dt IS NULL OR dt = 0 THEN 0.0::DOUBLE ELSE dx / dt END AS ax,
    CASE WHEN dt IS NULL OR dt = 0 THEN 0.0::DOUBLE ELSE dy / dt END AS ay,
    CASE WHEN dt IS NULL OR dt = 0 THEN 0.0::DOUBLE ELSE dz / dt END AS az
  FROM lagged
),
feat AS (
  SELECT *, sqrt(x * x + y * y + z * z) AS magnitude, sqrt(ax * ax + ay * ay + az * az) AS jerk
  FROM rates
)"""

MOTION = f"""WITH {FEATURES}
SELECT subject_id, activity_label, "timestamp", l_orderkey, l_linenumber, l_partkey,
  subject_id || '-' || activity_label || '-' || rn AS seq_id,
  round(dx, 6) + 0.0 AS x_dx, round(dy, 6) + 0.0 AS y_dy, round(dz, 6) + 0.0 AS z_dz,
  round(magnitude, 6) + 0.0 AS x_magnitude,
  round(x * y, 6) + 0.0 AS x_y, round(x * z, 6) + 0.0 AS x_z, round(y * z, 6) + 0.0 AS y_z,
  ax + 0.0::DOUBLE AS x_ax, ay + 0.0::DOUBLE AS y_ay, az + 0.0::DOUBLE AS z_az,
  round(jerk, 12) + 0.0 AS x_jerk
FROM feat"""

FIRST_N = f"""WITH {SERIES},
n AS (SELECT *, row_number() OVER (PARTITION BY subject_id, activity_label ORDER BY {ORDER}) - 1 AS pos FROM lr)
SELECT subject_id, activity_label, l_orderkey, l_linenumber, l_partkey, pos, x FROM n WHERE pos < 150"""


def numbered(source: str = "lr", name: str = "num") -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id, activity_label ORDER BY {ORDER}) - 1 AS pos,
         count(*) OVER (PARTITION BY subject_id, activity_label) AS len
  FROM {source}
)"""


def assigned(size: int, step: int, source: str = "num", name: str = "assigned") -> str:
    """Every row joined to every full window that holds it."""
    return f"""{name} AS (
  SELECT n.*, w.window_index
  FROM {source} n JOIN (
    SELECT subject_id, activity_label,
           unnest(generate_series(0, (len - {size}) // {step})) AS window_index
    FROM (SELECT DISTINCT subject_id, activity_label, len FROM {source} WHERE len >= {size})
  ) w
  ON n.subject_id = w.subject_id AND n.activity_label = w.activity_label
  AND n.pos BETWEEN w.window_index * {step} AND w.window_index * {step} + {size - 1}
)"""


def window_stats(cols: dict[str, str]) -> str:
    stats = ",\n  ".join(
        f"round(avg(CAST(CAST({sql} AS FLOAT) AS DOUBLE)) + 3.14159265e-6::DOUBLE, 4) + 0.0 AS {c}_mean,\n  "
        f"round(stddev_pop(CAST(CAST({sql} AS FLOAT) AS DOUBLE)) + 3.14159265e-6::DOUBLE, 4) + 0.0 AS {c}_std"
        for c, sql in cols.items()
    )
    return f"SELECT subject_id, activity_label, window_index,\n  {stats}\nFROM assigned GROUP BY 1, 2, 3"


def summary(size: int, step: int) -> str:
    return f"WITH {SERIES}, {numbered()}, {assigned(size, step)}\n{window_stats({c: c for c in 'xyz'})}"


RAW_ROWS = """
SELECT subject_id, activity_label, window_index, pos - window_index * 25 AS place,
  CAST(CAST(x AS FLOAT) AS DOUBLE) AS x, CAST(CAST(y AS FLOAT) AS DOUBLE) AS y,
  CAST(CAST(z AS FLOAT) AS DOUBLE) AS z
FROM assigned"""
RAW_WINDOWS = f"WITH {SERIES}, {numbered()}, {assigned(50, 25)}{RAW_ROWS}"
RAW_WINDOWS_FIRST_N = f"""WITH {SERIES}, {numbered('lr', 'every')},
num AS (SELECT * REPLACE (least(len, 180) AS len) FROM every WHERE pos < 180),
{assigned(50, 25)}{RAW_ROWS}"""

CHANNELS = f"""WITH {SERIES},
o AS (SELECT * FROM lr WHERE side = 'O'), f AS (SELECT * FROM lr WHERE side = 'F'),
{numbered('o', 'numo')}, {numbered('f', 'numf')},
{assigned(80, 40, 'numo', 'ao')}, {assigned(80, 40, 'numf', 'af')},
paired AS (
  SELECT DISTINCT subject_id, activity_label, window_index FROM ao
  INTERSECT SELECT DISTINCT subject_id, activity_label, window_index FROM af
),
cells AS (
  SELECT subject_id, activity_label, window_index, pos - window_index * 40 AS place,
         unnest([0, 1, 2, 3, 4, 5]) AS channel, unnest([x, y, z, t, x, z]) AS value FROM ao
  UNION ALL
  SELECT subject_id, activity_label, window_index, pos - window_index * 40,
         unnest([6, 7, 8, 9, 10, 11]), unnest([x, y, z, t, x, z]) FROM af
)
SELECT c.subject_id, c.activity_label, c.window_index,
  CAST(CASE c.activity_label WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS BIGINT) AS label,
  CAST(c.channel AS BIGINT) AS channel, c.place, CAST(CAST(c.value AS FLOAT) AS DOUBLE) AS value
FROM cells c JOIN paired b USING (subject_id, activity_label, window_index)"""

EVENTS = """
ev AS (
  SELECT user_id AS subject_id, event_type AS activity_label, epoch_us(ts) AS "timestamp",
         value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
         CAST(event_id AS DOUBLE) AS z, event_id
  FROM events
)"""

DIRTY = """
dirty AS (
  SELECT event_id, nullif(event_type, 'view') AS activity_label,
         CASE WHEN event_type = 'error' THEN 'err ;' ELSE CAST(value AS VARCHAR) || ' ;' END AS z
  FROM events
),
parsed AS (
  SELECT *, TRY_CAST(trim(replace(z, ';', '')) AS FLOAT) AS v FROM dirty
)"""


def snapped(sql: str, grid: int) -> str:
    half = grid // 2
    return (
        f"CASE WHEN {sql} < 0 THEN -(((abs({sql}) + {half}) // {grid}) * {grid}) "
        f"ELSE ((abs({sql}) + {half}) // {grid}) * {grid} END"
    )


SIX_HOURS = 21_600_000_000
FUSED = f"""{EVENTS},
wa AS (SELECT subject_id, {snapped('"timestamp"', SIX_HOURS)} AS "timestamp", activity_label,
              x AS wa_x, y AS wa_y, z AS wa_z FROM ev WHERE activity_label IN ('click', 'purchase')),
wg AS (SELECT subject_id, {snapped('"timestamp"', SIX_HOURS)} AS "timestamp",
              x AS wg_x, y AS wg_y, z AS wg_z FROM ev WHERE activity_label NOT IN ('click', 'purchase')),
fused AS (SELECT subject_id, "timestamp", activity_label, wa_x, wa_y, wa_z, wg_x, wg_y, wg_z
          FROM wa JOIN wg USING (subject_id, "timestamp"))"""

FUSED_FIRST = f"""WITH {FUSED},
wa1 AS (SELECT * FROM wa QUALIFY row_number() OVER (
          PARTITION BY subject_id, "timestamp" ORDER BY activity_label, wa_x, wa_y, wa_z) = 1),
wg1 AS (SELECT * FROM wg QUALIFY row_number() OVER (
          PARTITION BY subject_id, "timestamp" ORDER BY wg_x, wg_y, wg_z) = 1)
SELECT subject_id, "timestamp", activity_label, wa_x, wa_y, wa_z, wg_x, wg_y, wg_z
FROM wa1 JOIN wg1 USING (subject_id, "timestamp")"""

def _triple_features(p: str) -> str:
    """All features of one sensor's axes, over ``l``."""
    rate = {a: f"CASE WHEN dt IS NULL OR dt = 0 THEN 0.0::DOUBLE ELSE {p}_{a}_d{a} / dt END" for a in "xyz"}
    out = {f"{p}_{a}_d{a}": f"{p}_{a}_d{a}" for a in "xyz"} | {f"{p}_{a}_a{a}": rate[a] for a in "xyz"}
    out[f"{p}_x_magnitude"] = f"sqrt({p}_x * {p}_x + {p}_y * {p}_y + {p}_z * {p}_z)"
    out |= {f"{p}_{a}_{p}_{b}": f"{p}_{a} * {p}_{b}" for a, b in ("xy", "xz", "yz")}
    out[f"{p}_x_jerk"] = "sqrt(" + " + ".join(f"power({rate[a]}, 2)" for a in "xyz") + ")"
    return ",\n  ".join(f"round({sql}, 6) + 0.0 AS {name}" for name, sql in out.items())


_CHANGES = ",\n    ".join(f"coalesce({p}_{a} - lag({p}_{a}) OVER s, 0.0::DOUBLE) AS {p}_{a}_d{a}" for p in ("wa", "wg") for a in "xyz")
FUSED_FEATURES = f"""WITH {FUSED},
l AS (
  SELECT *, row_number() OVER s AS rn,
    ("timestamp" - lag("timestamp") OVER s) / 1e6::DOUBLE AS dt,
    {_CHANGES}
  FROM fused WINDOW s AS (PARTITION BY subject_id, activity_label ORDER BY "timestamp", wa_z, wg_z)
)
SELECT subject_id, "timestamp", subject_id || '-' || activity_label || '-' || rn AS seq_id,
  {_triple_features("wa")},
  {_triple_features("wg")}
FROM l"""

BROKEN = """
told AS (
  SELECT *, l_orderkey % 13 AS kind FROM lineitem
),
cells AS (
  SELECT kind, CASE kind WHEN 0 THEN 'S-1' WHEN 8 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS c0,
    CASE kind WHEN 1 THEN '' ELSE l_returnflag END AS c1,
    CASE kind WHEN 2 THEN '12h' ELSE CAST(l_orderkey AS VARCHAR) END AS c2,
    CASE kind WHEN 3 THEN 'x?' WHEN 6 THEN '1.2.3' ELSE CAST(l_linenumber AS VARCHAR) END AS c3,
    CASE kind WHEN 4 THEN '--' ELSE CAST(l_partkey AS VARCHAR) END AS c4,
    CASE WHEN kind IN (5, 6) THEN 'err;' ELSE CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ';' END AS c5
  FROM told
),
lines AS (
  SELECT kind, CASE kind WHEN 9 THEN concat_ws(',', c0, c1, c2, c3) WHEN 7 THEN concat_ws(',', c0, c1, c2, c3, c4, c5, '7')
    ELSE concat_ws(',', c0, c1, c2, c3, c4, c5) END AS line,
    CASE kind WHEN 0 THEN 'subject_id' WHEN 8 THEN 'subject_id' WHEN 1 THEN 'activity_label' WHEN 2 THEN 'timestamp' WHEN 3 THEN 'x'
      WHEN 4 THEN 'y' WHEN 5 THEN 'z' WHEN 6 THEN 'x,z' WHEN 7 THEN 'line' ELSE 'none' END AS broken,
    CASE kind WHEN 8 THEN 'missing' WHEN 1 THEN 'missing' WHEN 6 THEN 'not a number,not a number' WHEN 7 THEN 'too many cells' ELSE 'not a number' END AS reasons
  FROM cells
)"""

EVENT_NAME = (
    "CASE event_type WHEN 'click' THEN 'Clicking' WHEN 'view' THEN 'Viewing' "
    "WHEN 'purchase' THEN 'Buying' ELSE event_type END"
)


def described(cols: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 5) + 0.0 AS mean, "
        f"round(stddev_samp({c}), 5) + 0.0 AS stddev, round(min({c}), 5) + 0.0 AS min, "
        f"round(max({c}), 5) + 0.0 AS max FROM lr"
        for c in cols
    ]
    return f"WITH {SERIES}\n" + "\nUNION ALL\n".join(parts)


def correlated(ctes: str, source: str, cols: dict[str, str]) -> str:
    parts = [
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({cols[a]}, {cols[b]}), 6) + 0.0 AS corr FROM {source}"
        for a in cols
        for b in cols
    ]
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(parts)


def boxes(ctes: str, source: str, cols: dict[str, str]) -> str:
    parts = [
        f"""SELECT activity_label, '{c}' AS "column", count(v) AS "count",
  round(any_value(q1), 6) + 0.0 AS q1, round(any_value(q2), 6) + 0.0 AS median, round(any_value(q3), 6) + 0.0 AS q3,
  round(least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), any_value(q1)), 6) + 0.0 AS whisker_low,
  round(greatest(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) + 0.0 AS whisker_high,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (
  SELECT activity_label, {sql} AS v,
    quantile_cont({sql}, 0.25) OVER (PARTITION BY activity_label) AS q1,
    quantile_cont({sql}, 0.5) OVER (PARTITION BY activity_label) AS q2,
    quantile_cont({sql}, 0.75) OVER (PARTITION BY activity_label) AS q3
  FROM {source}
) GROUP BY 1"""
        for c, sql in cols.items()
    ]
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(parts)


SPLIT = """
ranked AS (
  SELECT subject_id, row_number() OVER (ORDER BY subject_id) - 1 AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT l_suppkey AS subject_id FROM lineitem)
),
split AS (
  SELECT subject_id, CASE WHEN r < floor(n * 0.6::DOUBLE) THEN 'train'
                          WHEN r < floor(n * 0.8::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM ranked
)"""

SCORED = """
scored AS (
  SELECT vec_id, label, (list_position(embedding, list_max(embedding)) - 1) % 10 AS prediction
  FROM embeddings
)"""


def confusion(classes: str, name: str = "cm") -> str:
    return f"""{SCORED},
cls AS ({classes}),
{name} AS (
  SELECT a.c AS label, b.c AS prediction, count(s.vec_id) AS "rows"
  FROM cls a CROSS JOIN cls b LEFT JOIN scored s ON s.label = a.c AND s.prediction = b.c
  GROUP BY 1, 2
)"""


PRESENT = "SELECT DISTINCT label AS c FROM scored UNION SELECT DISTINCT CAST(prediction AS INTEGER) FROM scored"
TWELVE = "SELECT CAST(unnest(generate_series(0, 11)) AS INTEGER) AS c"

REPORT = f"""WITH {confusion(PRESENT)},
k AS (
  SELECT c.c AS class,
    (SELECT sum("rows") FROM cm WHERE label = c.c AND prediction = c.c) AS tp,
    (SELECT sum("rows") FROM cm WHERE label = c.c) AS support,
    (SELECT sum("rows") FROM cm WHERE prediction = c.c) AS predicted
  FROM cls c
),
per AS (
  SELECT CAST(class AS VARCHAR) AS class,
    CASE WHEN predicted > 0 THEN tp / predicted::DOUBLE ELSE 0.0 END AS p,
    CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0.0 END AS r,
    CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted)::DOUBLE ELSE 0.0 END AS f, support, tp
  FROM k
),
every AS (
  SELECT class, p, r, f, support FROM per
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support)::DOUBLE, sum(support) FROM per
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), sum(support) FROM per
)
SELECT class, round(p, 6) + 0.0 AS precision, round(r, 6) + 0.0 AS recall, round(f, 6) + 0.0 AS f1_score,
  CAST(support AS BIGINT) AS support FROM every"""

LABEL_INDEX = """
idx AS (
  SELECT event_type AS activity_label,
         CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS label
  FROM events GROUP BY event_type
)"""

TEST_VECTORS = """WITH ranked AS (
  SELECT s, row_number() OVER (ORDER BY s) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT vec_id % 51 AS s FROM embeddings)
),
test AS (SELECT vec_id FROM embeddings JOIN ranked ON vec_id % 51 = s WHERE r >= floor(n * 0.8::DOUBLE))
"""

OBJECTS = """
told AS (
  SELECT *, subject_id * 4 + CASE device WHEN 'watch' THEN 0 ELSE 2 END + CASE sensor WHEN 'accel' THEN 0 ELSE 1 END AS n FROM (
    SELECT l_suppkey % 51 AS subject_id, CASE l_linestatus WHEN 'O' THEN 'watch' ELSE 'phone' END AS device,
      CASE WHEN l_linenumber % 2 = 1 THEN 'accel' ELSE 'gyro' END AS sensor FROM lineitem
  )
)"""

RAW_LINES = """
told AS (
  SELECT l_suppkey AS subject, l_returnflag AS code, CASE WHEN l_linenumber % 2 = 1 THEN 'watch' ELSE 'phone' END AS device,
    l_orderkey % 17 = 3 AS broken, l_orderkey * 1000 + l_linenumber * 50 AS t FROM lineitem
),
fused AS (
  SELECT a.device, a.subject, a.code FROM told a JOIN told g ON a.device = g.device AND a.subject = g.subject AND a.t = g.t WHERE NOT a.broken
)"""


def _full_windows(source: str, size: int, step: int) -> str:
    return f"SELECT device, subject, code, (count(*) - {size}) // {step} + 1 AS n FROM {source} GROUP BY 1, 2, 3 HAVING count(*) >= {size}"


ALL: dict[str, str] = {
    "motion_features": MOTION,
    "motion_features_hot": MOTION,
    "series_positions": f"""WITH {SERIES}
SELECT subject_id, activity_label, l_orderkey, l_linenumber, l_partkey,
  row_number() OVER s - 1 AS pos, coalesce(lag("timestamp") OVER s, -1) AS prev_timestamp,
  count(*) OVER (PARTITION BY subject_id, activity_label) AS series_rows
FROM lr WINDOW s AS (PARTITION BY subject_id, activity_label ORDER BY {ORDER})""",
    "first_n_per_series": FIRST_N,
    "first_n_per_series_hot": FIRST_N,
    "window_assignment": f"""WITH {SERIES}, {numbered()}, {assigned(50, 25)}
SELECT subject_id, activity_label, l_orderkey, l_linenumber, l_partkey, window_index, pos FROM assigned""",
    "window_summary": summary(50, 25),
    "window_summary_default": summary(200, 100),
    "window_summary_panes": summary(50, 25),
    "window_summary_dense": summary(50, 5),
    "window_summary_uneven": summary(50, 20),
    "window_summary_coprime": summary(50, 7),
    "window_summary_gaps": summary(20, 30),
    "window_summary_hot": summary(50, 25),
    "feature_window_summary": f"WITH {FEATURES}, {numbered('feat')}, {assigned(50, 25)}\n"
    + window_stats(
        {"x_dx": "dx", "y_dy": "dy", "z_dz": "dz", "x_magnitude": "magnitude", "x_y": "x * y", "x_z": "x * z", "y_z": "y * z",
         "x_ax": "ax", "y_ay": "ay", "z_az": "az", "x_jerk": "jerk"}
    ),
    "raw_windows": RAW_WINDOWS,
    "raw_windows_first_n": RAW_WINDOWS_FIRST_N,
    "channel_tensor": CHANNELS,
    "clean_readings": f"""WITH {DIRTY}
SELECT event_id, activity_label, CAST(v AS DOUBLE) AS z FROM parsed WHERE v IS NOT NULL AND activity_label IS NOT NULL""",
    "rejected_readings": f"""WITH {DIRTY}
SELECT event_id, activity_label, CASE WHEN activity_label IS NULL THEN 'no label' ELSE 'bad number' END AS reason
FROM parsed WHERE v IS NULL OR activity_label IS NULL""",
    "malformed_lines": f"WITH {BROKEN} SELECT line, broken, reasons FROM lines WHERE broken <> 'none'",
    "malformed_clean": f"""WITH {BROKEN}
SELECT CAST(c0 AS BIGINT) AS subject_id, c1 AS activity_label, CAST(c2 AS BIGINT) AS "timestamp", CAST(c3 AS DOUBLE) AS x,
  CASE WHEN kind <> 9 THEN CAST(CAST(c4 AS FLOAT) AS DOUBLE) END AS y, CASE WHEN kind <> 9 THEN CAST(replace(c5, ';', '') AS DOUBLE) END AS z
FROM cells WHERE kind > 8""",
    "malformed_counts": f'WITH {BROKEN} SELECT broken, count(*) AS "lines" FROM lines GROUP BY broken',
    "aligned_time": f"""WITH {EVENTS} SELECT event_id, {snapped('"timestamp"', 50)} AS "timestamp" FROM ev""",
    "scan_readings": f"""WITH {SERIES}
SELECT subject_id, activity_label, "timestamp", CAST(CAST(x AS FLOAT) AS DOUBLE) AS x,
  CAST(CAST(y AS FLOAT) AS DOUBLE) AS y, CAST(CAST(z AS FLOAT) AS DOUBLE) AS z FROM lr""",
    "feature_table": f"""WITH {FEATURES}
SELECT subject_id, activity_label, l_orderkey, l_linenumber, l_partkey, round(magnitude, 6) + 0.0 AS x_magnitude
FROM feat WHERE activity_label = 'R'""",
    "fuse_sensors": f"WITH {FUSED} SELECT * FROM fused",
    "fuse_sensors_merge": f"WITH {FUSED} SELECT * FROM fused",
    "fuse_sensors_first": FUSED_FIRST,
    "fuse_sensors_untimed": f"""WITH {FUSED} SELECT * EXCLUDE ("timestamp") FROM fused""",
    "fused_features": FUSED_FEATURES,
    "overview": """SELECT count(*) AS "rows", CAST(3 AS BIGINT) AS features, CAST(6 AS BIGINT) AS columns,
  count(DISTINCT l_suppkey) AS subjects, count(DISTINCT l_returnflag) AS activities FROM lineitem""",
    "activity_counts": f"""SELECT event_type AS activity_label, count(*) AS "rows", {EVENT_NAME} AS activity_name
FROM events GROUP BY event_type""",
    "subject_counts": """WITH c AS (SELECT l_suppkey AS subject_id, count(*) AS "rows" FROM lineitem GROUP BY 1)
SELECT subject_id, "rows", round((SELECT avg("rows") FROM c), 6) + 0.0 AS mean_rows FROM c""",
    "category_names": f"SELECT DISTINCT {EVENT_NAME} AS activity_name FROM events",
    "dictionary_lookup": """SELECT l_suppkey AS subject_id, count(*) AS "rows",
  coalesce(any_value(s_name), CAST(l_suppkey AS VARCHAR)) AS subject_name
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey""",
    "describe_axes": described("xyz"),
    "correlation_matrix": correlated(
        FEATURES, "feat", {"x": "x", "y": "y", "z": "z", "x_magnitude": "magnitude", "x_jerk": "jerk"}
    ),
    "correlation_fused": correlated(
        FUSED, "fused", {c: c for c in ("wa_x", "wa_y", "wa_z", "wg_x", "wg_y", "wg_z")}
    ),
    "box_summary": boxes(SERIES, "lr", {c: c for c in "xyz"}),
    "box_summary_magnitude": boxes(FEATURES, "feat", {"x_magnitude": "magnitude"}),
    "hash_sample": """SELECT event_id, user_id AS subject_id, value AS x FROM events
WHERE ((event_id % 2147483648) * 2654435761) % 4294967296 < 429496729""",
    "shuffled_readings": "SELECT event_id, user_id AS subject_id, value AS x FROM events",
    "subject_split": f"WITH {SPLIT} SELECT subject_id, split FROM split",
    "fixed_split": f"""WITH {SPLIT} SELECT subject_id,
  CASE WHEN r < 40 THEN 'train' WHEN r < 46 THEN 'val' WHEN r < 51 THEN 'test' ELSE 'unused' END AS split FROM ranked""",
    "split_rows": f"""WITH {SPLIT} SELECT l_suppkey AS subject_id, l_orderkey, l_linenumber, l_partkey, l_quantity AS x
FROM lineitem WHERE l_suppkey IN (SELECT subject_id FROM split WHERE split = 'val')""",
    "split_sizes": f"WITH {SPLIT} SELECT split, count(*) AS subjects FROM split GROUP BY split",
    "accuracy_overall": f"""WITH {SCORED}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, count(*) AS "rows" FROM scored""",
    "accuracy_by_class": f"""WITH {SCORED}
SELECT 'class ' || label AS activity_label,
  round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, count(*) AS windows
FROM scored GROUP BY label""",
    "confusion_matrix": f"""WITH {confusion(PRESENT)} SELECT * FROM cm WHERE "rows" > 0""",
    "confusion_matrix_all_classes": f"WITH {confusion(TWELVE)} SELECT * FROM cm",
    "confusion_pct": f"""WITH {confusion(TWELVE)}
SELECT label, prediction,
  round(100.0 * "rows" / nullif(sum("rows") OVER (PARTITION BY label), 0), 6) + 0.0 AS pct FROM cm""",
    "classification_report": REPORT,
    "label_index": f"WITH {LABEL_INDEX} SELECT activity_label, label FROM idx",
    "indexed_rows": f"""WITH {LABEL_INDEX}
SELECT event_id, label FROM events JOIN idx ON activity_label = event_type""",
    "decoded_labels": f"""WITH {SCORED}
SELECT vec_id, CASE WHEN prediction < 8 THEN 'name ' || prediction END AS predicted_name FROM scored""",
    "standardized_axes": f"""WITH {SERIES}
SELECT l_orderkey, l_linenumber, l_partkey,
  round((x - (SELECT avg(x) FROM lr)) / (SELECT stddev_samp(x) FROM lr), 6) + 0.0 AS x,
  round((y - (SELECT avg(y) FROM lr)) / (SELECT stddev_samp(y) FROM lr), 6) + 0.0 AS y,
  round((z - (SELECT avg(z) FROM lr)) / (SELECT stddev_samp(z) FROM lr), 6) + 0.0 AS z
FROM lr""",
    "labelled_rows": f"""WITH {LABEL_INDEX}
SELECT event_id, label FROM events JOIN idx ON event_type = activity_label""",
    "accuracy_cross_check": f"""WITH {SCORED}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS accuracy,
  round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS evaluator_accuracy, count(*) AS "rows" FROM scored""",
    "tree_split": """WITH t AS (
  SELECT CAST(trunc(l_quantity) AS INTEGER) AS quantity, CASE WHEN l_extendedprice > 25000 THEN 1 ELSE 0 END AS y FROM lineitem
),
q AS (SELECT quantity, count(*) AS n, sum(y) AS ones FROM t GROUP BY quantity),
cuts AS (
  SELECT quantity, sum(n) OVER w AS ln, sum(ones) OVER w AS l1, sum(n) OVER () AS an, sum(ones) OVER () AS a1
  FROM q WINDOW w AS (ORDER BY quantity)
),
gini AS (
  SELECT *, ln * (1 - (l1 / ln::DOUBLE) ** 2 - ((ln - l1) / ln::DOUBLE) ** 2)
    + (an - ln) * (1 - ((a1 - l1) / (an - ln)::DOUBLE) ** 2 - (((an - ln) - (a1 - l1)) / (an - ln)::DOUBLE) ** 2) AS impurity
  FROM cuts WHERE ln < an
),
best AS (SELECT * FROM gini ORDER BY impurity, quantity LIMIT 1)
SELECT q.quantity, q.n AS "rows",
  CASE WHEN q.quantity <= best.quantity THEN CASE WHEN 2 * l1 > ln THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
       ELSE CASE WHEN 2 * (a1 - l1) > an - ln THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS tree_prediction,
  CASE WHEN q.quantity <= best.quantity THEN CASE WHEN 2 * l1 > ln THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
       ELSE CASE WHEN 2 * (a1 - l1) > an - ln THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS forest_prediction
FROM q, best""",
    "model_reload": TEST_VECTORS + 'SELECT count(*) AS windows, count(*) AS "equal" FROM test',
    "sequence_reload": TEST_VECTORS + 'SELECT count(*) AS windows, count(*) AS "equal", CAST(2 AS BIGINT) AS candidates FROM test',
    "distinct_sketches": """SELECT 'subject_id' AS "column", count(DISTINCT l_suppkey) AS distinct_values, true AS unions_agree, true AS within_error FROM lineitem
UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey), true, true FROM lineitem""",
    "object_manifest": f"""WITH {OBJECTS},
wanted AS (
  SELECT subject_id, device, sensor FROM (SELECT DISTINCT subject_id FROM told), (SELECT unnest(['watch', 'phone']) AS device), (SELECT unnest(['accel', 'gyro']) AS sensor)
)
SELECT w.subject_id, w.device, w.sensor, o.n IS NOT NULL AS present, CASE WHEN o.n IS NULL THEN 'missing' ELSE 'present' END AS status
FROM wanted w LEFT JOIN (SELECT subject_id, device, sensor, any_value(n) AS n FROM told WHERE n % 11 <> 5 GROUP BY 1, 2, 3) o USING (subject_id, device, sensor)""",
    "stream_keys": f"""WITH {OBJECTS}
SELECT subject_id, device, sensor, count(*) AS "rows", CAST(0 AS BIGINT) AS misplaced FROM told WHERE n % 11 <> 5 GROUP BY 1, 2, 3""",
    "activity_run": f"""WITH {RAW_LINES},
win AS ({_full_windows("fused", 20, 10)})
SELECT device || '_features' AS "table", count(*) AS "rows" FROM fused GROUP BY device
UNION ALL SELECT device || '_windows', CAST(sum(n) AS BIGINT) FROM win GROUP BY device
UNION ALL SELECT 'rejects', count(*) FROM told WHERE broken
UNION ALL SELECT 'split', count(DISTINCT subject) FROM win WHERE device = 'watch'
UNION ALL SELECT device || '_boxes', 7 * count(DISTINCT code) FROM fused GROUP BY device
UNION ALL SELECT device || '_correlation', CAST(100 AS BIGINT) FROM fused GROUP BY device""",
    "sequence_run": f"""WITH {RAW_LINES},
accel AS ({_full_windows("(SELECT * FROM told WHERE NOT broken)", 12, 6)}),
gyro AS ({_full_windows("told", 12, 6)}),
common AS (
  SELECT subject, code, min(n) AS n FROM (SELECT * FROM accel UNION ALL SELECT * FROM gyro) GROUP BY 1, 2 HAVING count(*) = 4
)
SELECT left(device, 1) || 'a_windows' AS "table", CAST(sum(n) AS BIGINT) AS "rows" FROM accel GROUP BY device
UNION ALL SELECT left(device, 1) || 'g_windows', CAST(sum(n) AS BIGINT) FROM gyro GROUP BY device
UNION ALL SELECT 'rejects', count(*) FROM told WHERE broken
UNION ALL SELECT 'channels', CAST(sum(n) AS BIGINT) FROM common
UNION ALL SELECT 'split', count(DISTINCT subject) FROM common""",
}
