"""URL rules by hashed host-suffix and path-prefix expressions.

A URL becomes the expressions a rule could fit it by: each of its host's suffixes that some rule has, with each beginning of
its path that is as long as the path of such a rule. Suffixes and expressions meet rules over the first 32 bits of their
digests; the full digests confirm, and the longest rule wins. The plan is the same for any number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import SMALL, col, lower_ascii, numbered
from hourgrid.session import materialise

#: Hex digits of a digest that make up the join key.
PREFIX = 8
ALLOW = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for texts without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(F.lit(" "), url), "://", 1))
    rest = F.coalesce(F.substring(url, F.length(rest) + 3, F.length(url)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``verdict, host, path``. A rule fits its host and all its subdomains if the URL's path starts with
    its path; the longest rule (host and path) wins, then the longest host; of equal rules the one that blocks.
    Without a fitting rule ``rule`` is null and the verdict ``default``. Null URLs have empty host and path; rows
    that repeat a key or have none are judged one by one. Rules without host or path count as empty there;
    a rule with an empty host fits only URLs with an empty host. Empty tables of pages give no rows, without rules every
    verdict is ``default``; of the pages' other columns none is used, so their names cannot clash.
    """
    host, path = host_and_path(col(pages, url))
    named = numbered(pages.select(col(pages, key).alias("key"), host.alias("host"), path.alias("path")), "row", "urls")
    given = rules.select("verdict", lower_ascii(F.coalesce("host", F.lit(""))).alias("rule_host"),
                         F.coalesce("path", F.lit("")).alias("rule_path"))
    given = materialise(given.groupBy("rule_host", "rule_path").agg(F.max(F.struct(
        (F.col("verdict") != ALLOW).alias("blocks"), "verdict")).getField("verdict").alias("verdict")).select(
            "*", F.length("rule_path").alias("chars"), _digest(F.col("rule_host"), F.lit("")).alias("host_digest"),
            _digest(F.col("rule_host"), F.col("rule_path")).alias("digest")), "rules")
    known = given.select(F.substring("digest", 1, PREFIX).alias("short"), "digest", "rule_host", "rule_path", "verdict")
    # the lengths of a host's paths are whole numbers up to the longest URL, however many rules it has
    hosts = materialise(given.groupBy("host_digest").agg(F.array_sort(F.collect_set("chars")).alias("lengths")).select(
        F.substring("host_digest", 1, PREFIX).alias("short"), "host_digest", "lengths"), "rule-hosts")
    if given.count() <= SMALL:
        known, hosts = F.broadcast(known), F.broadcast(hosts)
    parts, n = F.split("host", r"\."), F.size(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    # host suffixes that some rule has, and only of them the path beginnings that are as long as a rule's path
    at_hosts = named.select("row", "path", F.explode(suffixes).alias("suffix")).withColumn("full", _digest(F.col("suffix"), F.lit("")))
    at_hosts = at_hosts.withColumn("short", F.substring("full", 1, PREFIX)).join(hosts, "short").where(F.col("full") == F.col("host_digest"))
    asked = at_hosts.select("row", "suffix", "path", F.explode(F.filter("lengths", lambda k: k <= F.length("path"))).alias("chars"))
    asked = asked.select("row", _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("chars"))).alias("full"))
    asked = asked.withColumn("short", F.substring("full", 1, PREFIX))
    fits = asked.join(known, "short").where(F.col("full") == F.col("digest"))
    rule = F.concat("rule_host", "rule_path")
    won = fits.groupBy("row").agg(F.max_by(
        F.struct(rule.alias("rule"), "verdict"),
        F.struct(F.length(rule).alias("chars"), F.length("rule_host").alias("host"), rule.alias("rule"))).alias("won"))
    return named.join(won, "row", "left").select(
        F.col("key").alias(key), "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
