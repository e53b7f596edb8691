"""Names, strings and text dates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# Offence terms that make up the target incidents (spelling as given).
TARGET_TERMS = (
    "larceny", "theft", "robbery", "burglary", "prowling", "shoplifting", "fraud",
    "swindle", "embezzelment", "credit card", "wire fraud", "impersonation",
    "motor vehicle theft",
)

# Offence classes, first match wins.
OFFENSE_CLASSES = (
    ("burglary|robbery", "Burglary/Robbery"),
    ("motor vehicle theft", "Motor Vehicle Theft"),
    ("theft|larceny|shoplift|fraud|swindle|embezzelment|stolen property|false pretenses",
     "Theft/Larceny/Fraud"),
    ("assault|murder|rape|battery|intimidation|extortion|kidnapping", "Violent Crime"),
)
OTHER_OFFENSE = "Other/Misc."

# Text date layouts as (shape, Spark pattern), tried in order.
DATE_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AP]M$", "M/d/yyyy h:mm:ss a"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AP]M$", "M/d/yyyy h:mm a"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}", "yyyy/M/d H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^[A-Z]{3} \d{1,2},? \d{4}$", "MMM d yyyy"),
    (r"^[A-Z]{4,9} \d{1,2},? \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2} [A-Z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
)
ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"

_CASE_BREAK = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")
_SEPARATORS = re.compile(r"[\s\-.,()\[\]{}_]+")


def clean_name(name: str) -> str:
    """Column name to snake case: camel humps and punctuation become underscores."""
    words = _SEPARATORS.split(_CASE_BREAK.sub("_", name).lower())
    return "_".join(w for w in (re.sub(r"\W", "", word) for word in words) if w)


def lower_trim(col: Column) -> Column:
    return F.lower(F.trim(col))


def area_code(col: Column) -> Column:
    return F.upper(F.trim(col))


def first_number(col: Column) -> Column:
    """First run of digits as a number; null when there is none."""
    return F.regexp_extract(col, r"(\d+)", 1).try_cast("int")


def matches_any(col: Column, terms: Iterable[str]) -> Column:
    """Case-insensitive search for any term; null text does not match."""
    return F.coalesce(col.rlike("(?i)" + "|".join(terms)), F.lit(False))


def matches_code(col: Column, codes: Iterable[str]) -> Column:
    """Whole-value match of any code pattern, e.g. ``220`` or ``23.*``; null does not match."""
    return F.coalesce(col.cast("string").rlike("^(" + "|".join(codes) + ")$"), F.lit(False))


def classify(col: Column, classes: Sequence[tuple[str, str]] = OFFENSE_CLASSES,
             default: str = OTHER_OFFENSE) -> Column:
    """Label of the first pattern found in the text."""
    out = None
    for pattern, label in classes:
        hit = matches_any(col, [pattern])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def parse_datetime(col: Column, layouts=DATE_LAYOUTS) -> Column:
    """Text in mixed layouts to a naive timestamp; unreadable text gives null."""
    text = F.upper(F.trim(col))
    months = F.initcap(F.lower(F.regexp_replace(text, ",", "")))
    tries = []
    for shape, pattern in layouts:
        source = months if "MMM" in pattern else text
        tries.append(F.when(text.rlike(shape), F.try_to_timestamp(source, F.lit(pattern))))
    tries.append(F.when(text.rlike(ISO_SHAPE), text.try_cast("timestamp")))
    return F.coalesce(*tries).cast("timestamp_ntz")


def normalise_area(col: Column, valid: Sequence[str], outside: str) -> Column:
    """Upper-cased area when it is a known one, else the sentinel."""
    code = area_code(col)
    return F.when(code.isin(list(valid)), code).otherwise(outside)


def is_blank_area(col: Column) -> Column:
    """Missing area: null, empty, zero or the text of a missing value."""
    return col.isNull() | area_code(col).isin("", "0", "NAN")


def map_values(col: Column, mapping: dict, default) -> Column:
    """Dictionary look-up with a default for unknown and null values."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(default))
