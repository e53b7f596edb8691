import math
import random
import re
from collections import Counter

import pytest
from cases import ODD, odd_documents, prose

from hourgrid.llm import ranked

ITEMS = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top):
    listed = [(k, Counter(words(t))) for k, t in docs]
    listed = [(k, c, sum(c.values())) for k, c in listed if c]
    n_docs, total = len(listed), sum(n for *_, n in listed)
    df = Counter(t for _, c, _ in listed for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, tf, n in listed:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
                        for t in set(words(text)) if t in tf)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scored, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus():
    draw = random.Random(5)
    common = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(draw.choices(common, [1 / (j + 1) for j in range(300)], k=draw.randint(1, 80)))) for i in range(700)]
    docs += [(1000 + i, docs[i % 3][1].upper()) for i in range(90)]  # ties beyond the top
    items = [(i, " ".join(draw.choices(common, k=draw.randint(1, 40)))) for i in range(25)] + [(90, docs[0][1]), (91, "W0 w1"), (92, "nowhere"), (93, None), (94, " -- ")]
    return docs, items


@pytest.mark.parametrize("top", [1, 10, 50, 2000])
def test_search_equals_brute_force(spark, top):
    docs, items = corpus()
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id"), spark.createDataFrame(items, ITEMS), top)
    assert found(got) == brute(docs, items, top)


def test_small_shards_and_item_blocks(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(ranked, "SHARD_DOCS", 130)
    monkeypatch.setattr(ranked, "BLOCK", 8)
    monkeypatch.setattr(ranked, "WAVE", 3)
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(2, "doc_id"), spark.createDataFrame(items, ITEMS), 7,
                        item_bytes=700)
    assert found(got) == brute(docs, items, 7)


def test_blocks_below_the_bar_are_skipped():
    """Long lists are not read where the bounds of a block cannot reach the bar."""
    import numpy as np

    n = ranked.BLOCK * 200
    docs = np.concatenate([np.arange(n), np.arange(0, n, ranked.BLOCK // 2), [5]]).astype(np.int32)
    tfs = np.concatenate([np.ones(n), np.ones(400), [9]]).astype(np.int64)
    shard = ranked.Shard(np.full(n, 10, np.int64), np.array([0, 1, 2]), np.array([n, 400, 1]), docs, tfs, ranked.Statistics(n, 10 * n, np.array([1, 5, 9000])))
    assert shard.is_long(0) and shard.is_long(1) and not shard.is_long(2)
    best = ranked.Best(1)
    shard.search([0, 1, 2], best, list(range(n)))
    assert best.keys == [5]
    begin, most = shard.bounds(0)
    assert len(begin) == 201 and (most[:-1] > 0).all()
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            read.append(at)
            return super().__getitem__(at)

    shard.value = shard.value.view(Watched)
    shard.search([0, 1, 2], best, list(range(n)))
    assert sum(s.stop - s.start for s in read if isinstance(s, slice) and s.stop - s.start > 1) < 3 * ranked.BLOCK


def test_odd_rows(spark):
    items = [(1, "one x"), (1, "one x"), (None, "straße"), (2, "日本語 no"), (3, ""), (4, None)]
    frame = spark.createDataFrame(items, ITEMS).selectExpr("*", "'kept' AS row", "1 AS score", "2 AS rank", "3 AS doc_id")
    got = ranked.search(odd_documents(spark), frame, 5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(ODD, items, 5)
    assert ranked.search(odd_documents(spark).limit(0), frame).collect() == []
    assert ranked.search(odd_documents(spark), frame.limit(0)).collect() == []
    strings = odd_documents(spark).selectExpr("cast(doc_id AS string) AS doc_id", "text")
    assert ranked.search(strings, frame, 5).schema["doc_id"].dataType.simpleString() == "string"


def test_very_long_text(spark):
    docs = [(1, "alpha " * 200_000), (2, "alpha beta"), (3, prose(1, 50))]
    items = [(1, "alpha beta")]
    assert found(ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))) == brute(docs, items, 50)
