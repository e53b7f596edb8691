"""Packing by lexical retrieval.

Documents are dealt into shards of bounded size, those that share a MinHash of their tokens side by side. A shard holds a
BM25 inverted index whose document frequencies and mean length are those of the whole corpus. Each unused document in
turn opens a window, its index returns unused neighbours, and these fill the window greedily: what fits goes in whole,
and the best neighbour that does not fit is cut to close the window; its rest stays in the index.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hourgrid.llm.common import col, prepare
from hourgrid.llm.pretokens import Encoder, once_per_worker
from hourgrid.session import materialise

#: Tokens of one shard, about; an index entry takes some 20 bytes.
SHARD_TOKENS = 1 << 22
#: Bytes of text that are encoded in one call, about.
TOGETHER = 8 << 20
#: Heaviest terms of a seed that make its query, and neighbours taken from the index at a time.
QUERY_TERMS = 24
NEIGHBOURS = 48
K1, B = 1.2, 0.75
#: BM25 weights are whole numbers of this unit, so sums do not depend on the order of terms.
UNIT = 1 << 20
_SLOTS = 1 << 20
_MIX = np.uint32(2654435761)


@dataclass(frozen=True)
class Corpus:
    """Counts over all documents: weight of each term, mean length in tokens."""

    idf: np.ndarray
    mean: float


def _encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with the ids of its texts; about ``TOGETHER`` bytes of batches are encoded in one call."""
    held, size = [], 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            size += batch.column("text").nbytes
        if held and (batch is None or size >= TOGETHER):
            texts = pa.chunked_array([b.column("text") for b in held]).fill_null("").combine_chunks()
            ids = iter(encoder.encode_all(texts))
            for b in held:
                yield b, list(itertools.islice(ids, b.num_rows))
            held, size = [], 0


def _tokenise(path: str, end: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(("encoder", path), lambda: Encoder(path))
        kind, seen = encoder.kind, np.zeros(encoder.size, np.int64)
        mixed = np.arange(encoder.size, dtype=np.uint32) * _MIX
        place, line = np.zeros(encoder.size, np.int64), np.arange(0)
        last = b"" if end is None else np.array([end], kind).tobytes()
        for batch, encoded in _encoded(encoder, batches):
            ids, sketches, terms = [], [], []
            for data in encoded:
                own = np.frombuffer(data, kind).astype(np.int64)
                if len(own) > len(line):
                    line = np.arange(2 * len(own))
                sketches.append(int(own[np.argmin(mixed[own])]) if len(own) else -1)
                # of equal ids the one stays whose place was noted
                place[own] = line[:len(own)]
                terms.append(own[place[own] == line[:len(own)]])
                ids.append(data + last)
            if terms:
                seen += np.bincount(np.concatenate(terms), minlength=len(seen))
            n = [len(i) // kind.itemsize for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(sketches, pa.int32()),
                 pa.nulls(len(n), pa.list_(pa.int32())), pa.nulls(len(n), pa.list_(pa.int64()))],
                ["key", "row", "ids", "n", "sketch", "terms", "counts"])
            schema = batch.schema
        terms = np.flatnonzero(seen)
        if len(terms):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema.field("key").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                 pa.nulls(1, pa.int32()), pa.array([terms.tolist()], pa.list_(pa.int32())), pa.array([seen[terms].tolist()], pa.list_(pa.int64()))],
                ["key", "row", "ids", "n", "sketch", "terms", "counts"])
    return run


def weights(tf: np.ndarray, idf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weight of a term in a document, in whole units."""
    return np.rint(UNIT * idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean)))


class Index:
    """The inverted index of one shard: per term its documents and their weights."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus):
        pairs = [np.unique(ids, return_counts=True) for ids in docs]
        sizes = np.array([len(terms) for terms, _ in pairs], np.int64)
        term = np.concatenate([terms for terms, _ in pairs]).astype(np.int64)
        owner = np.repeat(np.arange(len(docs)), sizes)
        length = np.array([len(ids) for ids in docs], np.float64)
        self.weight = weights(np.concatenate([tf for _, tf in pairs]), corpus.idf[term], length[owner], corpus.mean)
        order = np.argsort(term, kind="stable")
        known, self.slot = np.unique(term, return_inverse=True)
        self.begin = np.append(np.searchsorted(term[order], known), len(term))
        self.owner, self.value = owner[order], self.weight[order]
        self.first = np.append(0, np.cumsum(sizes))
        self.n = len(docs)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Up to ``NEIGHBOURS`` unused documents by falling score, equal scores by position."""
        own = slice(self.first[seed], self.first[seed + 1])
        heavy = np.argsort(-self.weight[own], kind="stable")[:QUERY_TERMS]
        slots = self.slot[own][heavy]
        lists = [slice(a, b) for a, b in zip(self.begin[slots].tolist(), self.begin[slots + 1].tolist())]
        if not lists:
            return np.empty(0, np.int64)
        score = np.bincount(np.concatenate([self.owner[x] for x in lists]), np.concatenate([self.value[x] for x in lists]), self.n) * unused
        found = np.flatnonzero(score)
        if len(found) > NEIGHBOURS:
            least = np.partition(score[found], len(found) - NEIGHBOURS)[len(found) - NEIGHBOURS]
            found = found[score[found] >= least]
        return found[np.lexsort((found, -score[found]))][:NEIGHBOURS]


def pack_shard(docs: list[np.ndarray], corpus: Corpus, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)``; all are full but those of the very last window, cut at powers of two.

    Every id of every document, its end mark included, lies in exactly one piece. Windows that one document fills alone
    come first; seeds follow by falling rest of their document.
    """
    size = np.array([len(ids) for ids in docs], np.int64)
    left, start = size % window, size // window * window
    out = [[(d, at, window)] for d in range(len(docs)) for at in range(0, int(start[d]), window)]
    index, unused = Index(docs, corpus), left > 0
    order = np.lexsort((np.arange(len(docs)), -left)).tolist()
    spare = 0

    def take(d: int, space: int) -> tuple[int, int, int]:
        n = min(int(left[d]), space)
        piece = (d, int(start[d]), n)
        start[d] += n
        left[d] -= n
        unused[d] = left[d] > 0
        return piece

    for seed in order:
        while unused[seed]:  # a seed that was cut before still has its rest
            pieces = [take(seed, window)]
            space = window - pieces[0][2]
            too_long = None
            for d in index.neighbours(seed, unused).tolist() if space else ():
                if left[d] <= space:
                    pieces.append(take(d, space))
                    space -= pieces[-1][2]
                    if not space:
                        break
                elif too_long is None:
                    too_long = d
            if space and too_long is not None:
                pieces.append(take(too_long, space))
                space = 0
            while space and spare < len(order):
                if unused[order[spare]]:
                    pieces.append(take(order[spare], space))
                    space -= pieces[-1][2]
                else:
                    spare += 1
            out.append(pieces)
    return [*out[:-1], *powers_of_two(out[-1])] if out else []


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One sequence cut into sequences whose lengths are falling powers of two."""
    out, total = [], sum(n for _, _, n in pieces)
    rest = list(reversed(pieces))
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        cut = []
        while room:
            d, at, n = rest.pop()
            cut.append((d, at, min(n, room)))
            if n > room:
                rest.append((d, at + room, n - room))
            room -= cut[-1][2]
        out.append(cut)
    return out


def _pack(corpus, kind: str, window: int, names: list[str]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        counts = corpus.value
        docs = [np.frombuffer(ids.as_buffer(), kind) for ids in table.column("ids")]
        shard = table.column("shard")[0].as_py()
        at = {name: [] for name in ("doc", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
        for number, pieces in enumerate(pack_shard(docs, counts, window)):
            offset = 0
            for d, start, n in pieces:
                for name, value in zip(at, (d, start, n, len(docs[d]), shard << 32 | number, offset, docs[d][start:start + n].astype("<u4").tobytes())):
                    at[name].append(value)
                offset += n
        key = table.column("key").combine_chunks().take(pa.array(at.pop("doc"), pa.int64()))
        kinds = [pa.int64()] * 5 + [pa.binary()]
        return pa.table([key, *[pa.array(v, k) for v, k in zip(at.values(), kinds)]], names=names)
    run.__annotations__ = {"table": pa.Table, "return": pa.Table}
    return run


def pack(docs: DataFrame, vocabulary: str, window: int = 2048, end: int | None = 1, text: str = "text", key: str = "doc_id",
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """All documents cut and packed into sequences of at most ``window`` tokens, one row per piece.

    Columns: the key, ``start`` (ids of the document before the piece), ``length``, ``doc_tokens`` (with the end
    mark), ``sequence_id``, ``offset`` (of the piece in its sequence, without gaps from 0) and ``ids`` (little-endian
    unsigned 32-bit numbers). ``vocabulary`` is a file of the `tokenizers` library that all executors have. A null or
    empty text has its end mark only (and no piece where ``end`` is None). Very long texts fill windows of their own.
    Rows with a null or repeated key are documents like any other, equal rows too; further columns are not used. An
    empty table gives no pieces. Each shard leaves one window less than full, which is cut at powers of two.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[key].dataType
    rows = docs.select(col(docs, key).alias("key"), col(docs, text).alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = StructType([StructField("key", kind)]).simpleString()[7:-1]
    made = materialise(rows.mapInArrow(
        _tokenise(vocabulary, end), f"{schema}, row long, ids binary, n long, sketch int, terms array<int>, counts array<long>"), "tokens")
    tokens = made.where(F.col("row").isNotNull() & (F.col("n") > 0))
    # one row per sketch and one per term: both are at most as many as the vocabulary has tokens
    groups = tokens.groupBy("sketch").agg(F.count("*").alias("docs"), F.sum("n").alias("n")).orderBy("sketch").collect()
    df = (made.where(F.col("terms").isNotNull()).select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
          .groupBy("t.terms").agg(F.sum("t.counts").alias("df")).collect())
    encoder = Encoder(vocabulary)
    n_docs, total = sum(g["docs"] for g in groups), sum(g["n"] for g in groups)
    found = np.zeros(max(encoder.size, (end or 0) + 1))
    for r in df:
        found[r["terms"]] = r["df"]
    # the end mark is in every document, so as a term it would only cost time
    idf = np.log1p((n_docs - found + 0.5) / (found + 0.5))
    if end is not None:
        idf[end] = np.log1p((n_docs - max(found[end], n_docs) + 0.5) / (n_docs + 0.5)) if n_docs else 0.0
    corpus = spark.sparkContext.broadcast(Corpus(idf, max(total / n_docs, 1.0) if n_docs else 1.0))
    places, before = [], 0
    for g in groups:
        places.append((g["sketch"], before, g["n"]))
        before += g["n"]
    table = F.broadcast(spark.createDataFrame(places, "sketch int, before long, share long"))
    # a sketch of any size is spread evenly over its share of the line of all tokens
    at = F.col("before") + F.floor(F.pmod(F.xxhash64("row"), F.lit(_SLOTS)) / F.lit(_SLOTS) * F.col("share"))
    dealt = tokens.join(table, "sketch").select("key", "row", "ids", F.floor(at / F.lit(shard_tokens)).alias("shard"))
    names = [key, *["start", "length", "doc_tokens", "sequence_id", "offset", "ids"]]
    out = StructType([StructField(key, kind)]).simpleString()[7:-1] if key.isidentifier() else f"`{key}` {kind.simpleString()}"
    return dealt.groupBy("shard").applyInArrow(
        _pack(corpus, encoder.kind.str, window, names),
        f"{out}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
