"""Near duplicates by SimHash.

Fingerprints are embedded as counts of set bits per two-bit segment. The Manhattan distance of two such
vectors is at most the Hamming distance of the fingerprints, so a range join over the vectors finds every
link: the segments are cut into ``bits // 2 + 1`` parts, in one of which linked vectors are at most 1 apart,
and each part is joined over grid cells one step wide. What passes is verified on the fingerprints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from hourgrid.llm.common import HOT_SHARE, col, fresh, numbered, spread_lookup
from hourgrid.session import materialise

SEGMENTS = 32
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text as a signed number.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer words than a shingle is one
    shingle; a text without words, or null, has fingerprint zero. Long texts are hashed in blocks, so memory
    stays bounded by the text.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[at:at + _BLOCK], "<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, LongType())(text)


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def embedding(fp: Column) -> Column:
    """Set bits per segment, each count written in unary (0: 00, 1: 01, 2: 11).

    So the Manhattan distance of two embeddings is the number of bits in which they differ.
    """
    low = _long(0x5555555555555555)
    other = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(other).bitwiseAND(low)
    both = fp.bitwiseAND(other).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _parts(bits: int) -> list[list[int]]:
    n = bits // 2 + 1
    return [list(range(SEGMENTS * k // n, SEGMENTS * (k + 1) // n)) for k in range(n)]


def links(prints: DataFrame, fp: str, bits: int = 3) -> DataFrame:
    """Pairs ``(low, high)`` of different fingerprints with at most ``bits`` differing bits, each once.

    ``prints`` holds each fingerprint once, so copies of a text cost nothing here. A fingerprint goes to its own
    cell of each part and, as a probe, to the cells one count higher: of two vectors one step apart the lower
    one meets the upper. There is no limit on cells or partners.
    """
    rows = prints.select(F.col(fp).alias("fp"), embedding(F.col(fp)).alias("at"))
    homes, probes = [], []
    for k, lanes in enumerate(_parts(bits)):
        cell = F.col("at").bitwiseAND(_long(sum(3 << 2 * lane for lane in lanes)))
        homes.append(F.struct(F.lit(k).alias("part"), cell.alias("cell")))
        steps = [F.when(cell.bitwiseAND(_long(2 << 2 * lane)) == 0,
                        cell.bitwiseXOR(F.when(cell.bitwiseAND(_long(1 << 2 * lane)) == 0, _long(1 << 2 * lane))
                                        .otherwise(_long(2 << 2 * lane)))) for lane in lanes] if bits > 0 else []
        probes += [F.struct(F.lit(k).alias("part"), c.alias("cell")) for c in (cell, *steps)]
    home = rows.select(F.col("fp").alias("a"), F.col("at").alias("a_at"), F.explode(F.array(*homes)).alias("p")).select("a", "a_at", "p.*")
    probe = rows.select(F.col("fp").alias("b"), F.col("at").alias("b_at"), F.explode(F.array(*probes)).alias("p")).select("b", "b_at", "p.*")
    probe = probe.where(F.col("cell").isNotNull())
    apart = F.bit_count(F.col("a_at").bitwiseXOR(F.col("b_at")))
    own = F.col("b_at").bitwiseAND(F.element_at(F.array(*[_long(sum(3 << 2 * x for x in p)) for p in _parts(bits)]), F.col("part") + 1))
    found = home.join(probe, ["part", "cell"]).where(
        (F.col("a") != F.col("b")) & ((F.col("cell") != own) | (F.col("a") < F.col("b")))
        & (apart <= bits) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits))
    return found.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``edges (low, high)``.

    Alternates large and small stars until nothing changes; each round is a table in the shared folder, the
    driver sees only a checksum. Minima are aggregated before they are joined back, so a node with very many
    neighbours is not gathered in one task.
    """
    stars = materialise(edges.select(F.col("high").alias("node"), F.col("low").alias("root")), "links")
    seen = None
    while True:
        state = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
        seen = state
        both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least")).withColumn("least", F.least("node", "least"))
        large = (both.join(least, "node").where(F.col("root") > F.col("node"))
                 .select(F.col("root").alias("node"), F.col("least").alias("root")).distinct())
        large = materialise(large, "large-star")
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        moved = large.join(least, "node").where(F.col("root") != F.col("least")).select(
            F.col("root").alias("node"), F.col("least").alias("root"))
        stars = materialise(moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct(), "small-star")


def clusters(rows: DataFrame, fp: str, order: Column, bits: int = 3) -> tuple[DataFrame, DataFrame]:
    """Per fingerprint of ``rows`` its class, and the hot fingerprints.

    The first result has ``fp``, ``root`` (smallest fingerprint of the class) and ``first``, the least ``order`` among all
    rows of the class; the second the fingerprints of more than 1/``HOT_SHARE`` of the rows.
    """
    each = materialise(rows.groupBy(fp).agg(F.min(order).alias("first"), F.count("*").alias("times")), "fingerprints")
    joined = components(links(each, fp, bits)).withColumnRenamed("node", fp)
    members = materialise(each.join(joined, fp, "left").select(
        fp, F.coalesce("root", fp).alias("root"), "first", "times", F.col("root").isNotNull().alias("linked")), "members")
    total = each.agg(F.sum("times")).first()[0] or 0
    firsts = members.where("linked").groupBy("root").agg(F.min("first").alias("least"))
    classes = members.join(firsts, "root", "left").select(fp, "root", F.coalesce("least", "first").alias("first"))
    return classes, members.where(F.col("times") * HOT_SHARE > total).select(fp)


def label(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, bits: int = 3) -> DataFrame:
    """``key, fingerprint, component_id`` for every row: the least key among all rows reachable over links.

    Rows with a null key are linked as any other and are never the least key; a class of null keys only has a
    null component. Repeated rows are repeated. Texts without words have fingerprint zero.
    Very long texts count with all their shingles. An empty table gives no rows; other columns are not read, so names cannot clash.
    """
    rows = materialise(docs.select(col(docs, key).alias("key"), fingerprints(col(docs, text), shingle).alias("fp")), "prints")
    classes, hot = clusters(rows, "fp", F.col("key"), bits)
    out = spread_lookup(rows, classes, "fp", hot, F.col("key"))
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("first").alias("component_id"))


def accepted(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row of each class of near duplicates, with the columns of ``docs``: the one with the least key.

    Null keys come last; among rows that repeat a key, one stays. An empty table stays empty.
    """
    row, fp = fresh([*docs.columns, "order", "first", "root", "times", "linked", "least"], "row", "fp")
    rows = numbered(docs.withColumn(fp, fingerprints(col(docs, text), shingle)), row, "prints")
    order = F.struct(col(rows, key).isNull().alias("none"), col(rows, key).alias("key"), col(rows, row).alias("row"))
    classes, _ = clusters(rows.select(col(rows, fp), order.alias("order")), fp, F.col("order"), bits)
    winners = classes.select(F.col("first.row").alias(row)).distinct()
    return rows.join(winners, row, "left_semi").select(*[col(rows, c) for c in docs.columns])
