import re

from cases import ODD, odd_documents, plain, prose
from pyspark.sql import functions as F

from hourgrid.llm import decontaminate as dec
from hourgrid.llm.common import prepare


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def similarity(a, b):
    keys = set(a) | set(b)
    low = sum(min(a.count(x), b.count(x)) for x in keys)
    return low / max(len(a) + len(b) - low, 1)


def brute(docs, items, least=0.8):
    found = set()
    for d, text in docs:
        words = words_of(text)
        for i, item in items:
            own = words_of(item)
            if own:
                k = min(5, len(own))
                mine, theirs = runs(words, k), runs(own, k)
                size = min(len(theirs), len(mine))
                scored = [(similarity(mine[s:s + size], theirs), -s) for s in range(len(mine) - size + 1)] if size else []
                if scored and max(scored)[0] >= least - 1e-9:
                    best = max(scored)
                    found.add((d, i, round(best[0], 6), -best[1]))
    return found


ITEMS = [(1, prose(501, 40)), (2, prose(502, 25)), (3, prose(503, 60)), (4, "Two words"), (5, "alone"), (6, None), (7, "?!"),
         (8, "again and again and again and again and again"), (2, prose(502, 25)), (9, prose(504, 40))]


def changed(text, at):
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


def documents():
    rows = [(i, prose(i, 120)) for i in range(20)]
    one, two, three = ITEMS[0][1], ITEMS[1][1], ITEMS[2][1]
    rows += [(100, one), (101, f"{prose(50, 30)} {one.upper()} {prose(51, 30)}"), (102, f"{prose(52, 30)}\n{two}\n{prose(53, 9)} {three}"),
             (103, f"a {one} b {one}"), (104, changed(one, 0)), (105, changed(one, 20)), (106, changed(three, 30)), (107, three + three),
             (108, " ".join(three.split()[:55])), (109, " ".join(three.split()[5:])), (110, "x two words y two, words"), (111, "two"), (112, "alone"),
             (113, "and " + "again and " * 30), (114, " ".join(one.split()[:18])), (115, ", ".join(one.split()))]
    return rows


def test_equals_brute_force(spark):
    prepare(spark)
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = dec.leaks(docs, items)
    got = {(r["key"], r["item"], round(r["similarity"], 6), r["start"]) for r in found.collect()}
    assert got == brute(documents(), ITEMS)
    kept = {r["doc_id"] for r in dec.accepted(docs, items).collect()}
    assert kept == {d for d, _ in documents()} - {g[0] for g in got} and set(range(20)) <= kept


def test_shuffled_paths_give_the_same(spark, monkeypatch):
    prepare(spark)
    docs, items = spark.createDataFrame(documents(), "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(dec, "SMALL", 0)
    got = {(r["key"], r["item"], round(r["similarity"], 6), r["start"]) for r in dec.leaks(docs, items).collect()}
    assert got == brute(documents(), ITEMS)


def test_fingerprint_is_simhash(spark):
    prepare(spark)
    rows = spark.createDataFrame([([1, -5, 1 << 62],), ([-1],), (list(range(0, 10**9, 10**7)),)], "h array<long>")
    for r in rows.select("h", dec._fingerprint(F.col("h")).alias("fp")).collect():
        votes = [sum((h & (1 << 64) - 1) >> b & 1 for h in r["h"]) for b in range(64)]
        assert r["fp"] & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * votes[b] > len(r["h"]))


def test_blocks_guarantee_the_radius(spark):
    """At distance 20 or less a listed block value is met."""
    prepare(spark)
    import random
    draw = random.Random(1)
    rows = []
    for n in (0, 1, 7, 20):
        for _ in range(40):
            a = draw.getrandbits(64)
            b = a ^ sum(1 << x for x in draw.sample(range(64), n))
            rows.append(tuple(v - (1 << 64) if v >> 63 else v for v in (a, b)))
    pairs = spark.createDataFrame(rows, "a long, b long")
    met = F.arrays_overlap(dec._block_values("a", dec.BLOCKS, dec.RADIUS // dec.BLOCKS), dec._block_values("b", dec.BLOCKS, 0))
    assert pairs.where(~met).count() == 0


def test_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark, ODD + [(9, prose(501, 40)), (9, prose(501, 40)), (None, prose(501, 40)), (9, "clean")])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dec.accepted(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 1
    assert plain(dec.accepted(docs.limit(0), items)) == []
    for none in (items.limit(0), items.where("item_id IN (6, 7)")):
        assert dec.accepted(docs, none).count() == docs.count() and dec.leaks(docs, none).count() == 0


def test_items_without_id_or_with_one_id(spark):
    prepare(spark)
    texts = [prose(700 + k, 40) for k in range(10)]
    items = spark.createDataFrame([(1, t) for t in texts] + [(None, prose(720, 30)), (None, prose(721, 30))], "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(texts), (20, f"{prose(50, 9)} {prose(720, 30)}"), (21, prose(721, 30)), (30, prose(800, 60))],
                                 "doc_id long, text string")
    found = {(r["key"], r["item"], r["similarity"]) for r in dec.leaks(docs, items).collect()}
    assert found == {(k, 1, 1.0) for k in range(10)} | {(20, None, 1.0), (21, None, 1.0)}
    assert [r["doc_id"] for r in dec.accepted(docs, items).collect()] == [30]
    changed_docs = spark.createDataFrame([(k, changed(t, 20)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert dec.accepted(changed_docs, items).count() == sum(not any(f[0] == k for f in brute([(k, changed(t, 20))], [(1, t)])) for k, t in enumerate(texts))


def test_no_python_in_the_plan(spark):
    prepare(spark)
    docs, items = spark.createDataFrame(documents(), "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = dec.leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "CartesianProduct", "NestedLoop"))


def test_items_of_little_variety(spark):
    """Items of few distinct shingles: their windows differ in many bits, none is lost."""
    prepare(spark)
    import random

    draw, items, docs = random.Random(9), [], []
    for i in range(12):
        words = [f"w{i}x{draw.randrange(3)}" for _ in range(22)]
        items.append((i, " ".join(words)))
        for j in range(25):
            other = list(words)
            for at in draw.sample(range(22), draw.choice((0, 1, 1, 2))):
                other[at] = f"w{i}x{draw.randrange(3)}"
            docs.append((i * 100 + j, " ".join(other)))
    for radius in (dec.RADIUS, 0):
        found = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), radius=radius)
        assert {(r["key"], r["item"], round(r["similarity"], 6), r["start"]) for r in found.collect()} == brute(docs, items)


def test_windows_meet_only_their_item(spark):
    """Many items of one length: a window is compared with the items it shares rare shingles with."""
    prepare(spark)
    items = [(i, prose(9000 + i, 40)) for i in range(800)] + [(5000 + i, prose(9000, 40)) for i in range(50)]
    docs = [(i, prose(9000 + i, 40)) for i in range(800)]
    found = dec.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string").repartition(4))
    assert {(r["key"], r["item"]) for r in found.collect()} == {(i, i) for i in range(800)} | {(0, 5000 + i) for i in range(50)}
