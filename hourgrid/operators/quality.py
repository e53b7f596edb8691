"""Data checks as tables: each check reads the frame once."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hourgrid.functions.calendar import hour_index
from hourgrid.operators import windows
from hourgrid.operators.shape import require_columns

# Completeness limits, span, coverage and panel columns.
MAX_CORE_MISSING = 0.01
MAX_CRITICAL_MISSING = 0.10
MIN_HOURS = 168
MIN_COVERAGE = 0.95
EXCESS_ZERO_FACTOR = 1.5
REPORT_TOP = 20
CRITICAL_COLUMNS = ("temp_f", "grid_density_7d", "area_avg_30d", "hour_sin", "hour_cos", "day_number")
PANEL_COLUMNS = (
    "hour_ts", "area", "temp_f", "is_raining", "is_hot", "is_cold", "grid_density_7d", "area_avg_30d",
    "hour_sin", "hour_cos", "day_number", "day_of_week",
)
PANEL_LAGS = tuple(f"lag_{n}" for n in windows.LAGS)


def _unpivot(wide: DataFrame, ids: Sequence[str], names: Sequence[str], variable: str, value: str) -> DataFrame:
    return wide.unpivot(list(ids), list(names), variable, value)


CHECK_ROW = "step string, check string, status string, measured double, threshold double"


def check_table(df: DataFrame, step: str, key: str | None = "incident_number",
                box: dict | None = None, lat: str = "latitude", lon: str = "longitude",
                core: Iterable[str] = ("report_date", "offense"), domain: Iterable[str] | None = None,
                area: str = "area") -> DataFrame:
    """Key uniqueness, coordinate box, completeness and category domain as
    (step, check, status, measured, threshold) in one aggregation.

    ``box`` maps ``lat`` and ``lon`` to (least, largest); without it places are not checked. Checks whose columns are
    missing have no row."""
    measures: list[tuple[str, Column, float, str]] = []
    if key in df.columns:
        nulls = F.count_if(F.col(key).isNull())
        distinct = F.count_distinct(F.col(key)) + F.when(nulls > 0, 1).otherwise(0)
        measures.append((f"unique {key}", (F.count(F.lit(1)) - distinct).cast("double"), 0.0, "FAIL"))
    if box and lat in df.columns and lon in df.columns:
        outside = ~(F.col(lat).between(*box["lat"]) & F.col(lon).between(*box["lon"]))
        measures.append(("inside box", F.count_if(outside).cast("double"), 0.0, "WARNING"))
    for c in core:
        if c in df.columns:
            share = F.count_if(F.col(c).isNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))
            measures.append((f"complete {c}", share, MAX_CORE_MISSING, "FAIL"))
    if domain is not None and area in df.columns:
        strange = F.count_if(~F.upper(F.col(area)).isin(list(domain)))
        measures.append((f"domain {area}", strange.cast("double"), 0.0, "FAIL"))
    if not measures:
        return df.sparkSession.createDataFrame([], CHECK_ROW)
    wide = df.agg(*[m.alias(f"m{i}") for i, (_, m, _, _) in enumerate(measures)])
    rows = F.array(*[
        F.struct(F.lit(step).alias("step"), F.lit(name).alias("check"),
                 F.when(F.col(f"m{i}") > limit, bad).otherwise("PASS").alias("status"),
                 F.col(f"m{i}").alias("measured"), F.lit(limit).alias("threshold"))
        for i, (name, _, limit, bad) in enumerate(measures)])
    return wide.select(F.inline(rows))


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, pct) for every column in one aggregation."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(wide, ["_rows"], columns, "column", "missing").select(
        "column", "missing",
        F.when(F.col("_rows") > 0, F.col("missing") * 100.0 / F.col("_rows")).alias("pct"))


def missingness_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two missingness tables side by side, with the number of values filled."""
    b = before.select("column", F.col("missing").alias("before"), F.col("pct").alias("before_pct"))
    a = after.select("column", F.col("missing").alias("after"), F.col("pct").alias("after_pct"))
    return b.join(a, "column").withColumn("filled", F.col("before") - F.col("after"))


def panel_report(df: DataFrame, top: int = REPORT_TOP) -> DataFrame:
    """Columns with most missing values, and all lag columns, as (section, column, missing, pct)."""
    table = missingness(df)
    most = (
        table.where("missing > 0").orderBy(F.desc("missing"), "column").limit(top)
        .select(F.lit("top").alias("section"), "column", "missing", "pct"))
    lags = table.where(F.col("column").isin(list(PANEL_LAGS))).select(
        F.lit("lag").alias("section"), "column", "missing", "pct")
    return most.unionByName(lags)


def schema_report(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, type, status) for required columns; type is null where a column is missing."""
    types = dict(df.dtypes)
    rows = [(c, types.get(c), "PASS" if c in types else "FAIL") for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, type string, status string")


def completeness_report(df: DataFrame, max_missing: float = MAX_CRITICAL_MISSING,
                        columns: Iterable[str] = CRITICAL_COLUMNS) -> DataFrame:
    """(column, missing, pct, status) for those of the columns that are there."""
    table = missingness(df, [c for c in columns if c in df.columns])
    return table.withColumn("status", F.when(F.col("pct") > max_missing * 100, "FAIL").otherwise("PASS"))


def validate_schema(df: DataFrame, target: str, require_lags: bool = True,
                    columns: Iterable[str] = PANEL_COLUMNS) -> DataFrame:
    return require_columns(df, [target, *columns, *(PANEL_LAGS if require_lags else ())])


def validate_completeness(df: DataFrame, max_missing: float = MAX_CRITICAL_MISSING,
                          columns: Iterable[str] = CRITICAL_COLUMNS) -> DataFrame:
    if any(c in df.columns for c in columns):
        bad = completeness_report(df, max_missing, columns).where("status = 'FAIL'").collect()
        if bad:
            raise ValueError(f"too many missing values: {sorted((r['column'], r['pct']) for r in bad)}")
    return df


def time_range(df: DataFrame, ts: str = "hour_ts", min_hours: int = MIN_HOURS) -> DataFrame:
    """(hours, first, last, span_hours, status)."""
    return df.agg(
        F.count_distinct(ts).alias("hours"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour")
    ).select(
        "hours", "first_hour", "last_hour",
        (hour_index(F.col("last_hour")) - hour_index(F.col("first_hour"))).alias("span_hours"),
        F.when(F.col("hours") >= min_hours, "PASS").otherwise("FAIL").alias("status"))


def validate_time_range(df: DataFrame, ts: str = "hour_ts", min_hours: int = MIN_HOURS) -> DataFrame:
    found = time_range(df, ts, min_hours).first()
    if found["status"] == "FAIL":
        raise ValueError(f"{found['hours']} distinct hours, {min_hours} needed")
    return df


def validate_panel(df: DataFrame, target: str, require_lags: bool = True) -> DataFrame:
    """All raising checks of a panel; returns the panel report."""
    validate_schema(df, target, require_lags)
    validate_completeness(df)
    validate_time_range(df)
    return panel_report(df)


def continuity_gaps(panel: DataFrame, area: str = "area", ts: str = "hour_ts") -> DataFrame:
    """Missing stretches inside each area's hours: (area, hour before, hour after, hours missing)."""
    w = windows.row_window([area], ts)
    step = hour_index(F.col("next_hour")) - hour_index(F.col(ts))
    return (
        panel.select(area, ts).withColumn("next_hour", F.lead(ts).over(w))
        .where(step > 1).withColumn("missing_hours", step - 1)
    )


def lag_integrity(panel: DataFrame, target: str, lags: Sequence[int], area: str = "area",
                  ts: str = "hour_ts") -> DataFrame:
    """Stored lags against the count found that many hours earlier: (lag, rows, mismatches).

    Counts are moved forward in time and meet the stored rows in one aggregation by
    (area, hour), where every group holds at most one row per lag.
    """
    hour, kind = hour_index(F.col(ts)), panel.schema[target].dataType
    stored = panel.select(
        area, hour.alias("_h"), *[F.col(f"lag_{n}").alias(f"s{n}") for n in lags],
        *[F.lit(None).cast(kind).alias(f"f{n}") for n in lags])
    moved = panel.select(
        area, hour.alias("_h0"), F.col(target).alias("_y"),
        F.explode(F.array(*[F.lit(n) for n in lags])).alias("_n"),
    ).select(
        area, (F.col("_h0") + F.col("_n")).alias("_h"),
        *[F.lit(None).cast(panel.schema[f"lag_{n}"].dataType).alias(f"s{n}") for n in lags],
        *[F.when(F.col("_n") == n, F.col("_y")).alias(f"f{n}") for n in lags])
    met = stored.unionByName(moved).groupBy(area, "_h").agg(
        *[F.max(f"{side}{n}").alias(f"{side}{n}") for n in lags for side in "sf"])
    wide = met.agg(*[e for n in lags for e in (
        F.count(f"s{n}").alias(f"rows_{n}"),
        F.count_if(F.col(f"s{n}").isNotNull() & ~F.col(f"s{n}").eqNullSafe(F.col(f"f{n}"))).alias(f"bad_{n}"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("lag"), F.col(f"rows_{n}").alias("rows"), F.col(f"bad_{n}").alias("mismatches"))
        for n in lags])))


def dataset_checks(panel: DataFrame, target: str, area: str = "area", ts: str = "hour_ts",
                   weather: str = "temp_f") -> DataFrame:
    """Unique keys, counts not negative, weather coverage, hours per area complete."""
    per_area = panel.groupBy(area).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(ts).alias("hours"),
        F.count_if(F.col(target) < 0).alias("negative"), F.count(weather).alias("covered"),
        (hour_index(F.max(ts)) - hour_index(F.min(ts)) + 1).alias("span"))
    wide = per_area.agg(
        F.sum(F.col("rows") - F.col("hours")).cast("double").alias("m0"),
        F.sum("negative").cast("double").alias("m1"),
        (F.sum("covered") / F.sum("rows")).alias("m2"),
        F.sum(F.col("span") - F.col("hours")).cast("double").alias("m3"))
    names = ("unique key", "negative counts", "weather coverage", "missing hours")
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            F.when((F.col(f"m{i}") >= MIN_COVERAGE) if i == 2 else (F.col(f"m{i}") == 0), "PASS")
            .otherwise("FAIL").alias("status"),
            F.col(f"m{i}").alias("measured"))
        for i, name in enumerate(names)])))


def leak_report(panel: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Share of zero or null feature values where the count is zero and where it is not."""
    quiet, busy = F.col(target) == 0, F.col(target) > 0
    empty = {c: F.coalesce(F.col(c) == 0, F.lit(True)) for c in features}
    wide = panel.agg(*[e for i, c in enumerate(features) for e in (
        F.avg(F.when(quiet, empty[c].cast("int"))).alias(f"q{i}"),
        F.avg(F.when(busy, empty[c].cast("int"))).alias(f"b{i}"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"q{i}").alias("empty_share_zero"),
                 F.col(f"b{i}").alias("empty_share_positive")) for i, c in enumerate(features)])))


def excess_zeros(df: DataFrame, target: str, factor: float = EXCESS_ZERO_FACTOR) -> DataFrame:
    """Observed share of zeros against the Poisson share at the same mean."""
    return df.agg(
        F.avg(F.col(target)).alias("mean"), F.avg((F.col(target) == 0).cast("int")).alias("zero_share")
    ).select(
        "mean", "zero_share", F.exp(-F.col("mean")).alias("poisson_share"),
        (F.col("zero_share") > factor * F.exp(-F.col("mean"))).alias("zero_inflated"))


def profile(df: DataFrame, ts: str, area: str) -> DataFrame:
    """One row about the table: rows, columns, time range, areas."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count_distinct(area).alias("areas"))


def missing_categories(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values that never occur."""
    return expected.join(df.select(column).distinct(), column, "left_anti")


class StepLog:
    """Rows and columns after each step, counted while the steps run.

    ``watch`` hooks a counter into the plan; no job is started for it. The table is
    complete once the watched frames have been computed.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation, int]] = []

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"step {len(self._steps)}: {step}")
        self._steps.append((step, seen, len(df.columns)))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def table(self, spark, patience_s: float = 20.0) -> DataFrame:
        """Raises if a watched frame was not computed; counters arrive a moment after the job."""
        end = time.monotonic() + patience_s
        for _, seen, _ in self._steps:
            while not (seen._jo and seen._jo.future().isCompleted()):
                if time.monotonic() > end:
                    raise RuntimeError(f"{seen._name} was watched but never computed")
                time.sleep(0.05)
        rows = [(i, step, seen.get["rows"], width) for i, (step, seen, width) in enumerate(self._steps)]
        return spark.createDataFrame(rows, "position int, step string, rows bigint, columns int")

    def clear(self) -> None:
        self._steps.clear()
