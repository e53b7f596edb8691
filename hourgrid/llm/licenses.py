"""Licence detection by ordered signature rules, in DataFrame functions only.

Texts that hold none of the rules' keywords are done after one scan. In the others words are laid out with a
space on either side, each rule whose keyword is there marks its matches, and marks become intervals of
words. An interval inside one of better priority, or inside a longer one of the same priority, is dropped.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import col, lower_ascii, numbered
from hourgrid.llm.license_rules import rules as default_rules

#: How sure a finding of each priority is.
SURE = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.6}
PHRASE = 0.95
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Short keywords are part of many words, so they are looked for as words.
_SHORT = 4


def spread(regex: str) -> str:
    """A rule's regex for words that each have a space on either side, so that neighbours can both match."""
    return f" {regex.replace(' ', '  ')} "


def spread_optional(regex: str) -> str:
    """``non ?commercial``: the space before ``?`` stays optional as a whole."""
    return re.sub(r" \?", "(?: )?", regex)


def _gate(lower: Column, keywords: list[str]) -> Column:
    """True if one of the keywords may be in the text. Long ones are searched as they are."""
    found = F.lit(False)
    for word in sorted(k for k in keywords if len(k) > _SHORT):
        if not any(other != word and other in word for other in keywords if len(other) > _SHORT):
            found = found | F.contains(lower, F.lit(word))
    short = sorted(k for k in keywords if len(k) <= _SHORT)
    if short:
        some = F.lit(False)
        for word in short:
            some = some | F.contains(lower, F.lit(word))
        found = found | (some & lower.rlike(r"(?:^|[\x00-\x2F\x3A-\x60\x7B-\x7F])(?:" + "|".join(short) + r")(?:$|[\x00-\x2F\x3A-\x60\x7B-\x7F])"))
    return found


def _places(words: Column, phrase: str) -> Column:
    """All places where the words of ``phrase`` stand in a row."""
    parts = phrase.split()
    hits = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))),
                    lambda i: F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts)))
    return F.when(F.contains(F.array_join(words, "  "), F.lit("  ".join(parts))), hits).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, phrases: dict[str, str], key: str = "doc_id", text: str = "text", rules: list[dict] | None = None) -> DataFrame:
    """Findings per row of ``docs``.

    Columns: ``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels`` and ``labels`` (sorted, comma-joined, empty
    if none), ``score`` (the surest finding, 0 without any) and ``found``, the intervals of words that stay with their
    labels. ``phrases`` maps phrases to labels that are found wherever the phrase stands and are never
    dropped. Null and empty texts have no words; every row counts for itself, also where rows or keys repeat.
    Very long texts are scanned whole. An empty table gives no rows; other columns are not read, so names cannot clash.
    """
    rules = default_rules() if rules is None else rules
    words = F.coalesce(col(docs, text), F.lit(""))
    parts = F.split(words, _SEPARATORS)
    keywords = sorted({r["keyword"] for r in rules} | {max(p.split(), key=len) for p in phrases})
    first, last = F.element_at("parts", 1) == "", (F.element_at("parts", -1) == "") & (F.size("parts") > 1)
    named = docs.select(col(docs, key).alias("key"), F.explode(F.array(parts)).alias("parts"), _gate(F.lower(words), keywords).alias("gate"))
    layout = F.when(F.col("gate"), lower_ascii(F.trim(F.array_join("parts", "  "))))
    rows = numbered(named.select("key", (F.size("parts") - first.cast("int") - last.cast("int")).cast("long").alias("n_words"),
                                 layout.alias("layout")), "row", "license-words")

    listed = [{**r, "regex": spread(spread_optional(r["regex"]))} for r in rules]
    kind = "array<struct<rank:int,priority:int,label:string,keyword:string,regex:string>>"
    gated = rows.where("layout IS NOT NULL").select("row", F.concat(F.lit(" "), "layout", F.lit(" ")).alias("layout"))
    tried = gated.select("row", "layout", F.explode(F.filter(F.from_json(F.lit(json.dumps(listed)), kind), lambda r: F.contains(
        F.col("layout"), F.concat(F.lit(" "), r["keyword"], F.lit(" "))))).alias("rule"))
    rule = ["rank", "priority", "label"]
    marked = tried.select("row", "layout", "rule.*").select(
        "row", *rule, F.regexp_replace("layout", F.col("regex"), F.lit(" \u0001 $0 \u0002 ")).alias("marked"))
    marked = marked.where(F.contains("marked", F.lit("\u0001"))).select(
        "row", *rule, F.explode(F.array(F.split(F.trim("marked"), " +"))).alias("words"))
    at = lambda mark: F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i) == mark)
    bounds = marked.select("row", *rule, at("\u0001").alias("a"), at("\u0002").alias("b"))
    spans = bounds.select("row", *rule, F.posexplode(F.arrays_zip("a", "b")).alias("k", "m")).select(
        "row", *rule, (F.col("m.a") - 2 * F.col("k")).alias("start"), (F.col("m.b") - 2 * F.col("k") - 1).alias("end"))

    # the furthest end of the intervals that begin at or before this one, by priority
    upto = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("row", "priority").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    beside, same = Window.partitionBy("row", "priority", "start"), Window.partitionBy("row", "priority", "start", "end")
    better = F.greatest(F.lit(-1), *[F.when(F.col("priority") > p, F.coalesce(F.max(F.when(F.col("priority") == p, F.col("end"))).over(upto), F.lit(-1)))
                                     .otherwise(-1) for p in sorted({r["priority"] for r in rules})])
    longer = F.coalesce(F.max("end").over(before), F.lit(-1))
    stays = ((better < F.col("end")) & (longer < F.col("end")) & (F.max("end").over(beside) == F.col("end"))
             & (F.min("rank").over(same) == F.col("rank")))
    kept = spans.withColumn("stays", stays).where("stays").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "priority"))).alias("found"))

    tokens = gated.select("row", F.explode(F.array(F.split(F.trim("layout"), "  "))).alias("words"))
    base = tokens.select("row", F.explode(F.concat(*[F.transform(_places(F.col("words"), phrase), _labelled(label))
                                                    for phrase, label in phrases.items()])).alias("p"))
    base = base.groupBy("row").agg(F.count("*").alias("n_base"), F.min("p.start").alias("first_word"), F.max("p.start").alias("last_word"),
                                   F.collect_set("p.label").alias("base"))
    out = rows.select("row", "key", "n_words").join(kept, "row", "left").join(base, "row", "left")
    none = F.array().cast("array<string>")
    own = F.coalesce(F.transform("found", lambda f: f["label"]), none)
    sure = F.array_max(F.transform("found", lambda f: F.element_at(F.create_map(*[F.lit(x) for pair in SURE.items() for x in pair]), f["priority"])))
    return out.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(F.coalesce("base", none), own)), ",").alias("labels"),
        F.greatest(F.coalesce(sure, F.lit(0.0)), F.when(F.col("n_base") > 0, PHRASE).otherwise(0.0)).alias("score"),
        F.coalesce("found", F.array().cast("array<struct<start:int,end:int,label:string,priority:int>>")).alias("found"))


def _labelled(label: str):
    return lambda start: F.struct(start.alias("start"), F.lit(label).alias("label"))
