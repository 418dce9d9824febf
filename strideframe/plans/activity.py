"""The two activity pipelines from raw text to scored windows."""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strideframe import operators as ops
from strideframe.functions import decode
from strideframe.plans.exploration import explore_device, explore_fused
from strideframe.schemas import CLASS_INDEX, SERIES_KEYS, STREAMS, WINDOW_META_COLUMNS, axes, feature_columns
from strideframe.sources import (
    drop_table,
    materialize,
    read_marked,
    read_table,
    rows_written,
    scratch,
    shuffles_removed,
    table_exists,
    write_table,
)
from strideframe.sources.storage import FINISHED, new_table_path

log = logging.getLogger(__name__)

#: Rows of whole series that are numbered at a time, so that shuffles on disk do not grow with the run.
SLICE_ROWS = 5_000_000
#: Subjects up to which their splits are sent to all tasks and no window is shuffled to meet them.
FEW_SUBJECTS = 1_000_000
#: How the tables of a run are written.
CODEC = {"compression": "zstd"}


@dataclass(frozen=True)
class PipelineConfig:
    """Where the data lies and how it is cut. Paths are any Hadoop paths."""

    raw: str
    work: str
    grid: int = 50
    ticks_per_second: float = 1e9
    dedupe: str = "none"
    size: int = 200
    step: int = 100
    fractions: tuple[float, ...] = (0.6, 0.2, 0.2)
    trees: int = 100
    seed: int = 42
    #: Readings of a series that the sequence pipeline looks at; None for all.
    max_rows: int | None = None
    #: Subjects in each split of the sequence pipeline; None to split by ``fractions``.
    counts: tuple[int, ...] | None = None
    subjects: Sequence[int] | None = None
    candidates: tuple[ops.SequenceCandidate, ...] = (
        ops.SequenceCandidate(40, (64,), 100),
        ops.SequenceCandidate(80, (64,), 100),
    )
    #: Remove the text of a stream once its lines are judged and written, where it was made for
    #: this run only.
    drop_raw: bool = False

    def at(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"


DEVICES = {"watch": ("wa", "wg"), "phone": ("pa", "pg")}


@contextmanager
def _timed(step: str):
    log.info("%s: started", step)
    start = time.monotonic()
    yield
    log.info("%s: done in %.1f s", step, time.monotonic() - start)


class Run:
    """The tables of one run, each written below ``cfg.work`` and read back, and its manifest:
    the step that wrote a table, its rows by the footers of its files, and the seconds."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg = spark, cfg
        self.tables: dict[str, DataFrame] = {}
        self.manifest: list[tuple[str, str, int | None, float]] = []
        self._judged: dict[tuple[str, str], tuple[str, StructType]] = {}
        self._rejects: dict[tuple[str, str], tuple[str, StructType]] = {}
        self._parts: dict[str, list[DataFrame]] = {}

    def put(self, step: str, name: str, table: DataFrame, at: str | None = None) -> DataFrame:
        start = time.monotonic()
        write_table(table, self.cfg.at(at or name), **CODEC)
        return self._noted(step, name, table, at or name, start)

    def put_by_series(self, step: str, name: str, parts: Sequence[DataFrame], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``make(part)`` of one part after the other, each of whole series, as one table: what a
        part shuffles and cuts is removed before the next."""
        start, path, before, made = time.monotonic(), self.cfg.at(name), set(), []
        for i, part in enumerate(parts):
            with scratch():
                table = make(part)
                how = {FINISHED: str(i == len(parts) - 1).lower(), **CODEC}
                write_table(table, path, mode="append" if i else "overwrite", **how)
            files = set(read_table(self.spark, path, table.schema).inputFiles())
            if own := [unquote(f) for f in sorted(files - before)]:
                made.append(self.spark.read.schema(table.schema).parquet(*own))
            before = files
        self._parts[name] = made
        return self._noted(step, name, table, name, start)

    def parts(self, name: str) -> list[DataFrame]:
        """A table in parts of whole series, as it was written, or else as ``slices`` cuts it."""
        return self._parts.get(name) or slices(self.tables[name])

    def _noted(self, step: str, name: str, table: DataFrame, at: str, start: float) -> DataFrame:
        rows = rows_written(self.spark, self.cfg.at(at))
        self.manifest.append((step, name, rows, time.monotonic() - start))
        self.tables[name] = read_table(self.spark, self.cfg.at(at), table.schema)
        return self.tables[name]

    def keep(self, step: str, name: str) -> DataFrame:
        """A table that an earlier run wrote; its rows were noted then."""
        self.manifest.append((step, name, None, 0.0))
        self.tables[name] = read_table(self.spark, self.cfg.at(name))
        return self.tables[name]

    def lines(self, device: str, sensor: str) -> tuple[DataFrame, DataFrame]:
        """Clean rows and rejects of a stream; its text is read and judged once in a run."""
        if (device, sensor) not in self._judged:
            marked = ops.mark_malformed(_marked(self.spark, self.cfg, device, sensor))
            self._judged[device, sensor] = self._aside("judged-lines", ops.settle_malformed(marked))
            if self.cfg.drop_raw:
                drop_table(self.spark, _folder(self.cfg, device, sensor))
        return ops.split_malformed(read_table(self.spark, *self._judged[device, sensor]))

    def _aside(self, name: str, table: DataFrame) -> tuple[str, StructType]:
        path = new_table_path(self.spark, name)
        write_table(table, path, **CODEC)
        return path, table.schema

    def drop_clean_lines(self, device: str) -> None:
        """Keep only the rejects of a device's judged lines."""
        for stream in [s for s in self._judged if s[0] == device]:
            self._rejects[stream] = self._aside("rejected-lines", self.lines(*stream)[1])
            drop_table(self.spark, self._judged.pop(stream)[0])

    def rejects(self) -> DataFrame:
        """The broken lines of all streams, with the columns that broke and why."""
        parts = []
        for device, sensor in STREAMS:
            kept = self._rejects.get((device, sensor))
            told = read_table(self.spark, *kept) if kept else self.lines(device, sensor)[1]
            parts.append(told.select(F.lit(device).alias("device"), F.lit(sensor).alias("sensor"), "*"))
        return reduce(DataFrame.unionByName, parts)

    def drop_lines(self) -> None:
        """Remove what was set aside of all lines."""
        for path, _ in [*self._judged.values(), *self._rejects.values()]:
            drop_table(self.spark, path)
        self._judged, self._rejects = {}, {}

    def finish(self, reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the reports and the manifest; returns all tables."""
        for name, table in reports.items():
            self.put("reports", name, table, f"reports/{name}")
        rows = [(i, *r) for i, r in enumerate(self.manifest)]
        manifest = self.spark.createDataFrame(rows, "place int, step string, table string, rows long, seconds double")
        write_table(manifest, self.cfg.at("reports/manifest"))
        self.tables["manifest"] = read_table(self.spark, self.cfg.at("reports/manifest"))
        return self.tables


def slices(table: DataFrame) -> list[DataFrame]:
    """The rows of a written table in parts of whole series and about ``SLICE_ROWS`` rows."""
    n = math.ceil(table.count() / SLICE_ROWS)
    return [table.where(F.pmod(F.xxhash64(*SERIES_KEYS), F.lit(n)) == i) for i in range(n)] if n > 1 else [table]


def _folder(cfg: PipelineConfig, device: str, sensor: str) -> str:
    return f"{cfg.raw.rstrip('/')}/{device}/{sensor}"


def _marked(spark: SparkSession, cfg: PipelineConfig, device: str, sensor: str) -> DataFrame:
    return read_marked(spark, f"{_folder(cfg, device, sensor)}/*.txt")


def fused_device(spark: SparkSession, cfg: PipelineConfig, device: str, run: Run | None = None) -> DataFrame:
    """Cleaned, aligned and joined sensors of one device."""
    accel, gyro = (
        ops.align_time((run.lines(device, sensor) if run else ops.split_malformed(_marked(spark, cfg, device, sensor)))[0], cfg.grid)
        for sensor in ("accel", "gyro")
    )
    return ops.fuse_sensors(accel, gyro, DEVICES[device], dedupe=cfg.dedupe)


def device_features(fused: DataFrame, cfg: PipelineConfig, device: str) -> DataFrame:
    return ops.engineer_features(
        fused,
        [axes(p) for p in DEVICES[device]],
        order_by=("timestamp", *axes(DEVICES[device][0]), *axes(DEVICES[device][1])),
        ticks_per_second=cfg.ticks_per_second,
    )


def run_pipeline(
    spark: SparkSession, cfg: PipelineConfig, skip_features: bool = False, eda: bool = False
) -> dict[str, DataFrame]:
    """Features, windows, split, stacked model and its scores, step by step.

    Every step's table is written below ``cfg.work``, and ``manifest`` has a row for each; what only
    leads to them is removed as soon as it is used up.
    ``skip_features`` keeps the feature tables if both are there. A failing step ends the run.
    """
    with shuffles_removed(spark):
        return _run_pipeline(spark, cfg, skip_features, eda)


def _run_pipeline(spark: SparkSession, cfg: PipelineConfig, skip_features: bool, eda: bool) -> dict[str, DataFrame]:
    run, reports = Run(spark, cfg), {}
    features, windows = {}, {}
    with _timed("features"):
        skip = skip_features and all(table_exists(spark, cfg.at(f"{d}_features")) for d in DEVICES)
        for device in DEVICES:
            name = f"{device}_features"
            if skip:
                features[device] = run.keep("features", name)
                continue
            with scratch():
                # The join is written down: series are counted on it before they are numbered.
                fused = materialize(fused_device(spark, cfg, device, run), f"{device}-fused", **CODEC)
                run.drop_clean_lines(device)
                features[device] = run.put_by_series("features", name, slices(fused), lambda rows, d=device: device_features(rows, cfg, d))
        run.put("features", "rejects", run.rejects())
        run.drop_lines()

    with _timed("windows"):
        for device, prefixes in DEVICES.items():
            how = {"order_by": ("timestamp", *[a for p in prefixes for a in axes(p)]), "size": cfg.size, "step": cfg.step}
            windows[device] = run.put_by_series(
                "windows",
                f"{device}_windows",
                run.parts(f"{device}_features"),
                lambda rows, how=how: ops.summarize_windows(rows, feature_columns(rows), **how),
            )
        watch, phone = windows["watch"], windows["phone"]
        split = run.put("windows", "split", ops.subject_split(watch, fractions=cfg.fractions))
        members = F.broadcast(split) if split.count() <= FEW_SUBJECTS else split

    with _timed("training"):
        model = ops.stack_fit(watch, phone, members, trees=cfg.trees, seed=cfg.seed)
        model.save(cfg.at("stacked_model"))

    with _timed("scoring"):
        for device, fitted in (("watch", model.watch), ("phone", model.phone)):
            scored = fitted.transform(ops.split_rows(windows[device], members, "val"))
            validation = run.put("scoring", f"{device}_validation", scored.select("activity_label", "label", "prediction"))
            reports[f"{device}_accuracy"] = ops.accuracy_cross_check(validation)
            reports[f"{device}_accuracy_by_activity"] = ops.with_activity_name(ops.accuracy_by(validation))
            reports[f"{device}_importance"] = ops.feature_importance(fitted, feature_columns(windows[device], WINDOW_META_COLUMNS))
        test = model.transform(*[ops.split_rows(d, members, "test") for d in (watch, phone)])
        predictions = run.put("scoring", "predictions", test.select(*model.on, "label", "prediction", "probability", "activity", "predicted_activity"))
        reports["stacked_accuracy"] = ops.accuracy_cross_check(predictions)
        reports["stacked_accuracy_by_activity"] = ops.accuracy_by(predictions, "activity")

    with scratch(), _timed("reports"):
        if eda:
            for device, prefixes in DEVICES.items():
                reports |= {f"{device}_{name}": table for name, table in explore_device(features[device], *prefixes).items()}
        reports["split_sizes"] = ops.split_sizes(split)
        return run.finish(reports)


def run_sequence(spark: SparkSession, cfg: PipelineConfig, eda: bool = False) -> dict[str, DataFrame]:
    """Raw windows of all four sensors, joined to channels, and a classifier on them.

    Rejected lines, the manifest and reports are written next to the other tables.
    """
    run, reports = Run(spark, cfg), {}
    with _timed("raw windows"):
        windows = []
        for (device, sensor), prefix in STREAMS.items():
            cut = ops.collect_windows(
                run.lines(device, sensor)[0],
                order_by=("timestamp", "x", "y", "z"),
                size=cfg.size,
                step=cfg.step,
                max_rows=cfg.max_rows,
            )
            windows.append(run.put("raw windows", f"{prefix}_windows", cut, f"windowed/{device}_{sensor}"))
        run.put("raw windows", "rejects", run.rejects())
        channels = run.put("raw windows", "channels", ops.stack_channels(windows))

    with _timed("sequence training"):
        everyone = channels if cfg.subjects is None else spark.createDataFrame([(int(s),) for s in cfg.subjects], "subject_id int")
        split = run.put("sequence training", "split", ops.subject_split(everyone, fractions=cfg.fractions, counts=cfg.counts), "sequence_split")
        parts = {name: ops.split_rows(channels, split, name) for name in ("train", "val", "test")}
        best = ops.sequence_fit(
            parts["train"], parts["val"], len(CLASS_INDEX), cfg.candidates, seed=cfg.seed, save_to=cfg.at("sequence_model")
        )

    with _timed("sequence scoring"):
        names = {float(i): code for code, i in CLASS_INDEX.items()}
        keys = ("subject_id", "activity_label", "window_index", "label", "prediction")
        scored = best.transform(parts["test"]).select(*keys, decode("prediction", names).alias("predicted_activity"))
        predictions = run.put("sequence scoring", "predictions", scored, "sequence_predictions")
        confusion = ops.confusion_matrix(predictions, label="activity_label", prediction="predicted_activity")
        reports["accuracy"] = ops.accuracy_cross_check(predictions)
        reports["confusion"] = confusion
        reports["confusion_pct"] = ops.confusion_pct(confusion)
        reports["report"] = ops.classification_report(confusion)
        rows = [(c.components, str(list(c.hidden)), c.iterations, float(a)) for c, a in best.history]
        reports["history"] = spark.createDataFrame(rows, "components int, hidden string, iterations int, validation_accuracy double")
    if eda:
        for device in DEVICES:
            fused = materialize(fused_device(spark, cfg, device, run), f"{device}-fused")
            reports |= {f"{device}_{name}": table for name, table in explore_fused(fused).items()}
    reports["split_sizes"] = ops.split_sizes(split)
    with _timed("reports"):
        return run.finish(reports)
