"""Calendar parts, hour blocks, cyclic encodings and rule-built holidays."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Hour blocks, right-open edges and the two label sets in use.
BLOCK_EDGES = (0, 5, 9, 13, 17, 21, 24)
BLOCK_LABELS = (
    "Early Night (0–4)", "Early Morning (5–8)", "Late Morning (9–12)",
    "Afternoon (13–16)", "Evening (17–20)", "Late Night (21–24)",
)
MODEL_BLOCK_LABELS = (
    "Late Night (0-4)", "Early Morning (5-8)", "Late Morning (9-12)",
    "Afternoon (13-16)", "Evening (17-20)", "Late Night (21-24)",
)

# Holiday rules. ("date", month, day, first year) or
# ("weekday", month, Monday-based weekday, n-th or -1 for last, first year). The third Monday of February and
# movable state days are not among them: states differ, so they come by the ``rules`` parameter.
HOLIDAY_RULES = (
    ("date", 1, 1, 1870),
    ("weekday", 1, 0, 3, 1986),
    ("weekday", 5, 0, -1, 1971),
    ("date", 6, 19, 2021),
    ("date", 7, 4, 1870),
    ("weekday", 9, 0, 1, 1894),
    ("weekday", 10, 0, 2, 1971),
    ("date", 11, 11, 1938),
    ("weekday", 11, 3, 4, 1942),
    ("date", 12, 25, 1870),
)


# Names in the order of the rules above.
HOLIDAY_NAMES = ("New Year", "Martin Luther King Day", "Memorial Day", "Juneteenth", "Independence Day", "Labor Day",
                 "Columbus Day", "Veterans Day", "Thanksgiving", "Christmas")


def floor_hour(ts: Column) -> Column:
    """Start of the wall-clock hour, whatever the session's time zone."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), zero, zero)


def hour_index(ts: Column) -> Column:
    """Wall-clock hours since the epoch: consecutive integers on an hourly series, in every session time zone."""
    return (F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(ts)).cast("long")


def hours_later(ts: Column, hours: Column) -> Column:
    return (ts + F.make_dt_interval(F.lit(0), hours.cast("int"))).cast("timestamp_ntz")


def local_hour(epoch_seconds: Column, zone: str) -> Column:
    """UTC epoch seconds to the naive wall-clock hour of ``zone``."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch_seconds), zone).cast("timestamp_ntz")


def bucket(col: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Right-open bins; values outside all bins give null."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        hit = (col >= low) & (col < high)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def hour_block(hour: Column, labels: Sequence[str] = BLOCK_LABELS) -> Column:
    return bucket(hour, BLOCK_EDGES, labels)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def hour_of_week(ts: Column) -> Column:
    """0 is Sunday midnight."""
    return (F.dayofweek(ts) - 1) * 24 + F.hour(ts)


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def _on_rule(day: Column, rule: tuple) -> Column:
    month, first_year = rule[1], rule[-1]
    base = (F.month(day) == month) & (F.year(day) >= first_year)
    if rule[0] == "date":
        return base & (F.dayofmonth(day) == rule[2])
    weekday, nth = rule[2], rule[3]
    base = base & (F.weekday(day) == weekday)
    if nth == -1:
        return base & (F.month(F.date_add(day, 7)) != month)
    return base & (F.ceil(F.dayofmonth(day) / 7) == nth)


def is_holiday(day: Column, rules: Sequence[tuple] = HOLIDAY_RULES, observed: bool = True) -> Column:
    """True on a rule's day and, for fixed dates, on the weekday that stands in for it."""
    day = day.cast("date")
    hits = [_on_rule(day, rule) for rule in rules]
    if observed:
        for rule in rules:
            if rule[0] == "date":
                hits.append((F.weekday(day) == 4) & _on_rule(F.date_add(day, 1), rule))
                hits.append((F.weekday(day) == 0) & _on_rule(F.date_sub(day, 1), rule))
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return F.coalesce(out, F.lit(False))


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar."""
    def whole(x: Column) -> Column:
        return F.floor(x).cast("int")

    golden, century = year % 19, whole(year / 100)
    # how far the full moon after 20 March is from 21 March
    epact = (19 * golden + century - whole(century / 4) - whole((century - whole((century + 8) / 25) + 1) / 3) + 15) % 30
    to_sunday = (32 + 2 * (century % 4) + 2 * whole((year % 100) / 4) - epact - (year % 100) % 4) % 7
    late = whole((golden + 11 * epact + 22 * to_sunday) / 451)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), epact + to_sunday - 7 * late)


def _rule_day(year: Column, rule: tuple) -> Column:
    """The day of a rule in a year, null before its first year.

    ("date", month, day, first year), ("weekday", month, Monday-based weekday, n-th or -1 for last, first year),
    ("easter", days after Easter Sunday, first year), ("after", rule, days).
    """
    if rule[0] == "after":
        return F.date_add(_rule_day(year, rule[1]), rule[2])
    if rule[0] == "easter":
        day = F.date_add(easter(year), rule[1])
    elif rule[0] == "date":
        day = F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
    else:
        _, month, weekday, nth, _ = rule
        first = F.make_date(year, F.lit(month), F.lit(1))
        if nth == -1:
            last = F.last_day(first)
            day = F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))
        else:
            day = F.date_add(first, F.pmod(weekday - F.weekday(first), F.lit(7)) + 7 * (nth - 1))
    return F.when(year >= rule[-1], day)


def holiday_table(spark: SparkSession, first_year: int, last_year: int, rules: Sequence[tuple] = HOLIDAY_RULES,
                  names: Sequence[str] = HOLIDAY_NAMES, observed: bool = True) -> DataFrame:
    """``date, name, observed``: the holidays of the years, one row per day and name.

    A state's calendar is the federal rules and names with its own appended, movable feasts as "easter" or "after" rules.
    With ``observed`` the weekday that stands in for a fixed date on a weekend is listed too, marked so.
    """
    if len(rules) != len(names):
        raise ValueError("one name per rule")
    # a year more on both sides: days that stand in may lie in the year before or after
    years = spark.range(1).select(F.explode(F.sequence(F.lit(first_year - 1), F.lit(last_year + 1))).alias("year"))
    year, made = F.col("year"), []
    for rule, name in zip(rules, names):
        day = _rule_day(year, rule)
        made.append(F.struct(day.alias("date"), F.lit(name).alias("name"), F.lit(False).alias("observed")))
        if observed and rule[0] == "date":
            stand_in = F.when(F.weekday(day) == 5, F.date_sub(day, 1)).when(F.weekday(day) == 6, F.date_add(day, 1))
            made.append(F.struct(stand_in.alias("date"), F.lit(name).alias("name"), F.lit(True).alias("observed")))
    days = years.select(F.explode(F.array(*made)).alias("d")).select("d.*").where("date IS NOT NULL")
    return days.where(F.year("date").between(first_year, last_year))


def with_holidays(df: DataFrame, ts: str, holidays: DataFrame, flag: str = "is_holiday", name: str | None = None) -> DataFrame:
    """A flag (and the first name in the alphabet) of the row's day, from a table of holidays; null times are no holidays.

    The table has a few rows a year, so it is broadcast.
    """
    days = holidays.groupBy(F.col("date").alias("_day")).agg(F.min("name").alias("_name"))
    out = df.withColumn("_date", F.col(ts).cast("date")).join(F.broadcast(days), F.col("_date") == F.col("_day"), "left")
    out = out.withColumn(flag, F.col("_day").isNotNull())
    return (out.withColumn(name, F.col("_name")) if name else out).drop("_date", "_day", "_name")
