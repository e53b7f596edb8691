"""Raw incidents to enriched, filtered incidents and panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from hourgrid.functions import text
from hourgrid.functions.features import calendar_features, finalize
from hourgrid.operators import density, encode, panel, quality, shape, spatial, weather
from hourgrid.operators.dedupe import first_per_key
from hourgrid.session import configure, materialise


# Area codes and the name for places without one.
AREA_CODES = tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
OUTSIDE = "OUTSIDE"


@dataclass
class Dimensions:
    """Small tables around the incidents."""

    areas: DataFrame
    sites: DataFrame
    layers: Mapping[str, DataFrame] = field(default_factory=dict)
    nearest_layers: Mapping[str, DataFrame] = field(default_factory=dict)
    hourly: DataFrame | None = None
    daily: DataFrame | None = None
    site_cutoff_m: float = 2414.016
    #: Codes that an area may have; incidents of others are left out.
    area_codes: Sequence[str] = AREA_CODES
    #: Column of watch names that becomes one flag per name, where the incidents have it.
    watch: str = "event_watch"


def clean(raw: DataFrame, ts: str = "report_date", offense: str = "offense",
          texts: Sequence[str] = ("offense", "location_type", "street_address", "nhood_name")) -> DataFrame:
    """Drop unused columns, normalise texts, parse the date and drop rows without one."""
    df = raw.drop(*shape.UNUSED_RAW)
    df = df.withColumns({c: text.lower_trim(F.col(c)) for c in texts if c in df.columns})
    df = shape.keep_raw(df, {"nhood_name": "neighborhood_raw"})
    if "location_type" in df.columns:
        df = encode.count_encode(df, "location_type")
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn("raw_report_date", F.trim(ts)).withColumn(ts, text.parse_datetime(F.col(ts)))
    return df.where(F.col(ts).isNotNull()).withColumn("offense_category", text.classify(F.col(offense)))


def unique(rows: DataFrame, key: str = "incident_number") -> DataFrame:
    """First row per incident in file order; rows equal in that are ordered by their content."""
    order = [c for c in ("source_file", "source_position", "report_date") if c in rows.columns]
    rest = F.xxhash64(*[c for c, kind in rows.dtypes if c not in order and not kind.startswith("map")])
    return first_per_key(rows, [key], [*order, rest])


def repaired(df: DataFrame, dims: Dimensions) -> DataFrame:
    """Incidents without an area or layer label take that of the polygon that holds or touches their place; areas
    beyond the codes go."""
    gaps = {"area": (text.is_blank_area(F.col("area")), dims.areas),
            **{name: (F.col(name).isNull(), layer) for name, layer in dims.layers.items()}}
    found = df.agg(*[F.count_if(missing).alias(name) for name, (missing, _) in gaps.items()]).first()
    out = df
    for name, (missing, layer) in gaps.items():
        if found[name]:
            out = spatial.repair(out, name, missing, layer)
    out = out.withColumn("area", text.normalise_area(F.col("area"), dims.area_codes, OUTSIDE))
    return out.where(F.col("area") != OUTSIDE)


def enrich(df: DataFrame, dims: Dimensions, log: quality.StepLog | None = None) -> DataFrame:
    """Labels, their repair, calendar, weather, densities, site distance and watch flags for all incidents.

    The dimensions are broadcast; only the two daily aggregates shuffle.
    """
    def step(name: str, frame: DataFrame) -> DataFrame:
        return log.watch(name, frame) if log else frame

    out = step("spatial", spatial.spatial_features(
        df, dims.areas, dict(dims.layers), dict(dims.nearest_layers)))
    out = step("repair", repaired(materialise(out, "labelled"), dims))
    if dims.watch in out.columns:
        out = encode.one_hot(out, dims.watch)
    out = step("calendar", calendar_features(out))
    # The quantiles and the daily counts read single columns of the incidents again.
    out = materialise(weather.merge_weather(out, dims.hourly, dims.daily), "incidents")
    if "temp_f" in out.columns:
        out = weather.weather_flags(out)
    out = step("weather", out)
    out = density.area_average(density.grid_density(out))
    out = spatial.site_features(out, dims.sites, dims.site_cutoff_m)
    return step("features", out)


def target_incidents(enriched: DataFrame, offense: str = "offense", key: str = "incident_number",
                     terms: Sequence[str] = text.TARGET_TERMS, codes: Sequence[str] | None = None,
                     code_column: str = "offense_code") -> DataFrame:
    """Target offences by term (or by code pattern), first row per incident, final columns.

    Where no incident has a second row, which its key alone tells, the wide rows are neither sorted nor moved, only
    picked; else the first ones are written once.
    """
    if codes is None:
        hit = text.matches_any(F.col(offense), terms)
    else:
        hit = text.matches_code(F.col(code_column), codes)
    found = enriched.where(hit)
    repeats = found.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    return finalize(found if repeats.isEmpty() else materialise(unique(found, key), "target-incidents"))


def panels(incidents: DataFrame, target: str = "incident_count", order: str = "sparse-first",
           numeric: Sequence[str] = panel.NUMERIC_COLUMNS,
           categories: Sequence[str] | None = None, flags: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Target, sparse and dense panel; by default flags of watches and near sites are among the categories.

    ``flags`` are categories that are known to hold only 0 and 1.

    ``sparse-first`` derives sparse and dense panels from all observed rows; ``reference``
    from the rows that are left after those with missing lags are dropped.
    """
    if order not in ("sparse-first", "reference"):
        raise ValueError(order)
    full = materialise(panel.target_panel(
        incidents, target=target, numeric=numeric, categories=panel.category_columns(incidents) if categories is None else categories,
        drop_incomplete=False, flags=flags))
    lags = [c for c in full.columns if c.startswith("lag_")]
    complete = full.dropna(subset=lags)
    base = panel.sparse_panel(complete if order == "reference" else full, target)
    return {
        "target": shape.clean_booleans(complete, panel.FLAG_COLUMNS),
        "sparse": shape.clean_booleans(base, panel.FLAG_COLUMNS),
        "dense": panel.dense_panel(base),
    }


def stored(enriched: DataFrame, dims: Dimensions) -> DataFrame:
    """``enriched`` as a table. The flags of near sites only repeat the site's label: they are read off it, not written."""
    names = encode.categories(dims.sites, "name")
    table = materialise(enriched.drop(*[encode.indicator_name(name) for name in names]), "enriched")
    return encode.indicators(table, "site_label", names)


def made_flags(enriched: DataFrame, known: DataFrame, dims: Dimensions) -> list[str]:
    """Flags of watches and near sites that the enrichment has made, so that they hold only 0 and 1."""
    given = {c for df in (known, dims.hourly, dims.daily) if df is not None for c in df.columns}
    return [c for c in enriched.columns if c not in given and c.startswith((f"{dims.watch}_", "near_"))]


def run(raw: DataFrame, dims: Dimensions, key: str = "incident_number",
        terms: Sequence[str] = text.TARGET_TERMS, box: dict | None = None) -> dict[str, DataFrame]:
    """Raw incidents to all tables, with the check tables after the enrichment (``box``: see ``check_table``).

    The first rows per incident are written once: the extent of the places and the spatial joins both read them. So are
    the enriched ones; the target incidents are picked from that table.
    """
    configure(raw.sparkSession)
    known = materialise(unique(clean(raw), key), "unique-incidents")
    enriched = stored(enrich(known, dims), dims)
    target = target_incidents(enriched, key=key, terms=terms)
    return {
        "all_incidents": enriched,
        "target_incidents": target,
        "checks": quality.check_table(target, "final", key=key, box=box),
        **panels(target, flags=made_flags(enriched, known, dims)),
    }
