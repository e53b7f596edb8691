"""Column selection, renaming, null filling and type narrowing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hourgrid.functions.text import clean_name

# Suffixes left by merges, raw columns not used further, final drops.
MERGE_SUFFIXES = ("_left", "_right", "_x", "_y")
UNUSED_RAW = (
    "report_number", "fire_arm_involved", "object_id", "occurred_from_date", "occurred_to_date",
    "part", "vic_count", "is_bias_motivation_involved", "x", "y", "beat_text",
)

_INTEGERS = (("tinyint", -2**7, 2**7 - 1), ("smallint", -2**15, 2**15 - 1), ("int", -2**31, 2**31 - 1))


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case all names; of columns that then collide the first one stays."""
    return first_of_equal_names(df.toDF(*[clean_name(c) for c in df.columns]))


def first_of_equal_names(df: DataFrame) -> DataFrame:
    names = df.columns
    positional = df.toDF(*[f"_c{i}" for i in range(len(names))])
    first = {}
    for i, name in enumerate(names):
        first.setdefault(name, i)
    return positional.select(*[F.col(f"_c{i}").alias(name) for name, i in first.items()])


def drop_suffixed(df: DataFrame, suffixes: tuple[str, ...] = MERGE_SUFFIXES) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.endswith(suffixes)])


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def keep_raw(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Move columns aside under their raw names."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]],
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Give every canonical column the first non-null of its aliases that exist.

    A canonical column without any alias gets its default constant.
    """
    defaults = defaults or {}
    used = {a for names in aliases.values() for a in names}
    out: list[Column] = [F.col(c) for c in df.columns if c not in used and c not in aliases]
    for name, candidates in aliases.items():
        found = [F.col(c) for c in candidates if c in df.columns]
        value = F.coalesce(*found) if found else F.lit(defaults.get(name))
        out.append(value.alias(name))
    return df.select(*out)


def numeric_features(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    exclude = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def fill_by_type(df: DataFrame, number: float = 0, text: str = "MISSING",
                 keep: Iterable[str] = ()) -> DataFrame:
    """Numbers become 0, text and booleans become text with a marker for null."""
    keep = set(keep)
    out = []
    for field in df.schema:
        col = F.col(field.name)
        if field.name in keep:
            pass
        elif isinstance(field.dataType, T.NumericType):
            col = F.coalesce(col, F.lit(number).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            col = F.coalesce(col, F.lit(text))
        elif isinstance(field.dataType, T.BooleanType):
            col = F.coalesce(F.initcap(col.cast("string")), F.lit(text))
        out.append(col.alias(field.name))
    return df.select(*out)


def clean_booleans(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Flags in any spelling to 0/1; null, the marker and unreadable text become 0."""
    present = [c for c in columns if c in df.columns]
    types = dict(df.dtypes)
    flags = {}
    for c in present:
        if types[c] == "string":
            value = F.coalesce(F.col(c).try_cast("boolean"), F.col(c).try_cast("double") != 0)
        else:
            value = F.col(c).cast("boolean")
        flags[c] = F.coalesce(value, F.lit(False)).cast("tinyint")
    return df.withColumns(flags) if flags else df


# Fixed value: how far a double may move when it becomes a float.
FLOAT_SLACK = 5e-4


def narrow_types(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast integers to the smallest type that holds their range, and doubles to float where no value
    moves by more than ``FLOAT_SLACK``.

    One aggregation over these columns finds all ranges and the largest move.
    """
    wanted = set(columns) if columns is not None else set(df.columns)
    integers = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType) and f.name in wanted]
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType) and f.name in wanted]
    casts = {}

    def move(c: str) -> Column:
        """Infinite where the value leaves the range of floats; NaN and infinity stay what they are."""
        value, narrow = F.col(c), F.col(c).cast("float").cast("double")
        return F.when(value.eqNullSafe(narrow), 0.0).otherwise(F.abs(value - narrow))

    if integers or doubles:
        bounds = df.agg(*[g(c).alias(f"{g.__name__}_{c}") for c in integers for g in (F.min, F.max)],
                        *[F.max(move(c)).alias(f"move_{c}") for c in doubles]).first()
        casts = {c: F.col(c).cast("float") for c in doubles if (bounds[f"move_{c}"] or 0.0) <= FLOAT_SLACK}
        for c in integers:
            low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
            if low is not None:
                fit = next((t for t, a, b in _INTEGERS if a <= low and high <= b), "bigint")
                casts[c] = F.col(c).cast(fit)
    return df.withColumns(casts) if casts else df
