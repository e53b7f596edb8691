"""Ranked lexical search over a sharded inverted index.

Documents are indexed in shards of bounded size, one row per shard, for the terms that the items use. A shard answers an
item in two steps. Its short lists are taken term at a time into summed accumulators; these become one sorted
iterator with a bound per block of documents. That iterator and the long lists are then read document at a time, block by block:
a block whose bounds cannot reach the worst score kept so far is skipped in all lists. Tasks carry the best documents of
each item from shard to shard, so the bar rises and every task emits at most ``top`` rows per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hourgrid.llm.common import col, numbered, prepare
from hourgrid.session import materialise

#: Documents of a shard at most, and postings after which a shard is closed.
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 1 << 21
#: Documents of a block; lists with fewer than one entry per block count as short.
BLOCK = 64
#: Blocks that are scored together before the bar is looked at again.
WAVE = 32
#: Bytes of item texts that are searched together; more items are searched in further passes.
ITEM_BYTES = 8 << 20
#: Fixed value: the characters between terms are blanks, A-Z is lower-cased, bytes beyond ASCII belong to terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, with repeats; a null text has none."""
    return text.translate(_TERM).split() if text else []


def _index(vocabulary):
    """Shards of the documents with at least one term."""
    def shard(keys, lengths, docs, slots, tfs, kind) -> pa.RecordBatch:
        doc, slot = np.concatenate([np.empty(0, np.int32), *docs]), np.concatenate([np.empty(0, np.int32), *slots])
        tf = np.concatenate([np.empty(0, np.int64), *tfs])
        order = np.argsort(slot, kind="stable")
        used, first = np.unique(slot[order], return_index=True)
        size = np.diff(np.append(first, len(slot)))
        one = [pa.array([keys], pa.list_(kind)), *[pa.array([v], pa.list_(k)) for v, k in (
            (np.array(lengths, np.int64), pa.int64()), (used, pa.int32()), (size, pa.int32()), (doc[order], pa.int32()), (tf[order], pa.int64()))]]
        return pa.RecordBatch.from_arrays(one, ["keys", "lengths", "terms", "sizes", "docs", "tfs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        keys, lengths, docs, slots, tfs, postings, kind = [], [], [], [], [], 0, None
        for batch in batches:
            kind = batch.schema.field("key").type
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                words = terms(text)
                if not words:
                    continue
                counts: dict[int, int] = {}
                for slot in map(known.get, words):
                    if slot is not None:
                        counts[slot] = counts.get(slot, 0) + 1
                docs.append(np.full(len(counts), len(keys), np.int32))
                slots.append(np.fromiter(counts, np.int32, len(counts)))
                tfs.append(np.fromiter(counts.values(), np.int64, len(counts)))
                keys.append(key)
                lengths.append(len(words))
                postings += len(counts)
                if len(keys) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield shard(keys, lengths, docs, slots, tfs, kind)
                    keys, lengths, docs, slots, tfs, postings = [], [], [], [], [], 0
        if keys:
            yield shard(keys, lengths, docs, slots, tfs, kind)
    return run


@dataclass(frozen=True)
class Statistics:
    """Documents with terms, all their terms, and the weight of each term of the vocabulary."""

    documents: int
    terms: int
    weight: np.ndarray


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Best:
    """The best documents of one item so far: scores falling, equal scores by rising key, null keys last."""

    top: int
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    keys: list = field(default_factory=list)

    def bar(self) -> int:
        """Scores below this cannot enter; equal ones may, by their key."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, keys: list) -> None:
        if len(scores) > 4 * self.top:  # what ties with the last one stays for the order by key
            least = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            some = np.flatnonzero(scores >= least)
            scores, keys = scores[some], [keys[i] for i in some.tolist()]
        rows = sorted(chain(zip(self.scores.tolist(), self.keys), zip(scores.tolist(), keys)),
                      key=lambda r: (-r[0], r[1] is None, r[1]))[:self.top]
        self.scores, self.keys = np.array([s for s, _ in rows], np.int64), [k for _, k in rows]


class Shard:
    """One shard with the score that each posting adds."""

    def __init__(self, lengths, used, sizes, docs, tfs, statistics: Statistics):
        m = 50 + 50 * lengths * statistics.documents // statistics.terms
        self.n = len(lengths)
        self.blocks = -(-self.n // BLOCK)
        self.docs = docs
        value = np.repeat(statistics.weight[used], sizes)
        self.value = value * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[docs]))
        ends = np.cumsum(sizes)
        self.lists = {t: slice(b - n, b) for t, n, b in zip(used.tolist(), sizes.tolist(), ends.tolist())}
        self.long: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def is_long(self, term: int) -> bool:
        place = self.lists[term]
        return place.stop - place.start >= self.blocks

    def bounds(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each block begins in a long list, and the most that a posting of the block adds."""
        if term not in self.long:
            place = self.lists[term]
            begin = np.searchsorted(self.docs[place], np.arange(self.blocks + 1) * BLOCK)
            most = np.zeros(self.blocks, np.int64)
            full = np.flatnonzero(begin[1:] > begin[:-1])
            most[full] = np.maximum.reduceat(self.value[place], begin[full])
            self.long[term] = (begin + place.start, most)
        return self.long[term]

    def search(self, item: list[int], best: Best, keys: list) -> None:
        here = [t for t in item if t in self.lists]
        long = [t for t in here if self.is_long(t)]
        sums = np.zeros(self.blocks * BLOCK, np.int64)
        for t in here:
            if t not in long:  # term at a time: documents of one list are distinct
                place = self.lists[t]
                sums[self.docs[place]] += self.value[place]
        bound = sums.reshape(-1, BLOCK).max(1) if self.n else np.empty(0, np.int64)
        lists = [(*self.bounds(t), t) for t in long]
        for _, most, _ in lists:
            bound = bound + most
        blocks = np.flatnonzero(bound >= best.bar())
        at = 0
        while at < len(blocks):
            wave = blocks[at:at + WAVE]
            at += len(wave)
            wave = wave[bound[wave] >= best.bar()]
            if not len(wave):
                continue
            for begin, most, _ in lists:
                for a, b in zip(begin[wave].tolist(), begin[wave + 1].tolist()) if len(wave) < WAVE // 4 else _runs(begin, wave):
                    sums[self.docs[a:b]] += self.value[a:b]
            scores = sums.reshape(-1, BLOCK)[wave].ravel()
            doc = (wave[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            good = np.flatnonzero(scores >= best.bar())
            if len(good):
                best.add(scores[good], [keys[d] for d in doc[good].tolist()])


def _runs(begin: np.ndarray, wave: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a list for blocks that follow one another, joined."""
    gap = np.flatnonzero(np.diff(wave) > 1)
    first, last = wave[np.append(0, gap + 1)], wave[np.append(gap, len(wave) - 1)]
    return zip(begin[first].tolist(), begin[last + 1].tolist())


def _search(query, statistics, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, counts, best, kind = query.value, statistics.value, {}, pa.null()
        for batch in batches:
            kind = batch.schema.field("keys").type.value_type
            for i in range(batch.num_rows):
                keys, *lists = [batch.column(c)[i].values for c in ("keys", "lengths", "terms", "sizes", "docs", "tfs")]
                shard = Shard(*[v.to_numpy(zero_copy_only=False) for v in lists], counts)
                keys = keys.to_pylist()
                for row, own in items:
                    shard.search(own, best.setdefault(row, Best(top)), keys)
        out = [(row, s, k) for row, b in best.items() for s, k in zip(b.scores.tolist(), b.keys)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], kind)], ["row", "score", "key"])
    return run


def search(docs: DataFrame, items: DataFrame, top: int = 50, text: str = "text", key: str = "doc_id", item: str = "item_id",
           item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for every row of ``items``.

    Columns: the item's id, ``rank`` (from 1), the document's key and ``score``; equal scores go by rising key, null keys last.
    Items are searched in blocks of about ``item_bytes`` of text, each block over all documents: what a block sends to
    the tasks has that bound. Every row of ``items`` is an item of its own, also where ids are null or
    repeated; documents likewise. Null, empty and termless texts are no documents and find nothing; very long texts count
    whole. Empty tables give no rows. Other columns are not used.
    """
    spark = docs.sparkSession
    prepare(spark)
    asked = numbered(items.select(col(items, item).alias("item"), col(items, item_text).cast("binary").alias("text")), "row", "items")
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // item_bytes)
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block) if blocks > 1 else asked
        hits = _search_block(docs, part, top, text, key)
        found = hits if found is None else found.unionByName(hits)
    kind = docs.schema[key].dataType
    if found is None:
        found = docs.select(F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("score"), col(docs, key).alias("key")).where(F.lit(False))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (ranked.join(asked.select("row", "item"), "row")
            .select(F.col("item").alias(item), "rank", F.col("key").cast(kind).alias(key), "score"))


def _search_block(docs: DataFrame, asked: DataFrame, top: int, text: str, key: str) -> DataFrame:
    """``row, score, key``: the best documents of each item of one block and task."""
    spark = docs.sparkSession
    slots: dict[bytes, int] = {}
    query = []
    for r in asked.collect():
        own = dict.fromkeys(terms(bytes(r["text"]) if r["text"] is not None else None))
        query.append((r["row"], [slots.setdefault(t, len(slots)) for t in own]))
    context = spark.sparkContext
    kind = StructType([StructField("keys", docs.schema[key].dataType)]).simpleString().removeprefix("struct<keys:")[:-1]
    index = materialise(
        docs.select(col(docs, key).alias("key"), col(docs, text).cast("binary").alias("text")).mapInArrow(
            _index(context.broadcast(slots)),
            f"keys array<{kind}>, lengths array<long>, terms array<int>, sizes array<int>, docs array<int>, tfs array<long>"), "index")
    total = index.agg(F.sum(F.size("keys")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    # one row per term of the block's items
    df = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(F.sum("t.sizes").alias("df")).collect()
    weights = np.zeros(len(slots), np.int64)
    for r in df:
        weights[r["terms"]] = weight(total[0], r["df"])
    counts = context.broadcast(Statistics(total[0] or 0, total[1] or 0, weights))
    return index.mapInArrow(_search(context.broadcast(query), counts, top), f"row long, score long, key {kind}")
