import math
import zlib
from collections import Counter

import pytest
import xxhash
from cases import ODD, odd_documents, plain, prose
from pyspark.sql import functions as F

from hourgrid.llm import queries
from hourgrid.llm import toxicity as tox
from hourgrid.llm.common import prepare, table


@pytest.mark.parametrize("text,word", [("IDIOT", "idiot"), ("1d10t", "idiot"), ("іdіоt", "idiot"), ("id!ot", "idiot"), ("ｉｄｉｏｔ", "idiot"),
                                       ("id​i­ot", "idiot"), ("$tup1d", None), ("stup|d", "stupid"), ("p@thetic", "pathetic")])
def test_fold(text, word):
    assert word is None or tox.fold(text).split() == [word]


def brute(model, folded):
    """Every stem at every word start, without an automaton."""
    found = {}
    for at in (i for i in range(len(folded) - 1) if folded[i] == " "):
        if any(folded.startswith(f" {p} ", i) and i <= at < i + len(p) + 1 for p in model.exceptions for i in range(max(0, at - len(p) - 1), at + 1)):
            continue
        for stem in sorted(model.weights, key=len):
            if folded.startswith(f" {stem}", at) and (stem.endswith(" ") or folded[at + len(stem) + 1] != " "):
                found[at] = model.weights[stem]
    return found


def test_hits_equal_brute_force():
    model = tox.Model({"idiot ": 2.0, "lam": 1.0, "lamp1": 3.0, "river ": 1.5}, ("river stone", "green idiot"))
    machine = model.automaton()
    for text in ["", "idiot", "an idiot idiot lamp lamp1x lam", "river stone river", "green idiot idiot", *[prose(i, 200) for i in range(20)]]:
        folded = tox.fold(text)
        assert tox.hits(machine, folded) == brute(model, folded), text


@pytest.mark.parametrize("text,n", [
    ("@sshole", 1), ("$tupid", 1), ("$tup1d!", 1), ("a$$hole", 1), ("a$$", 1), ("@idiot", 1), ("idiot!", 1), ("wow!idiot", 1), ("idiot!idiot", 2),
    ("\U0001d408\U0001d403\U0001d408\U0001d40e\U0001d413", 1), ("id\ufeffiot", 1), ("id\ufe0fi\U000e0101ot", 1), ("idiot\U0001f642", 1), ("$5 and 45$", 0),
    ("@home", 0), ("river stone!", 0), ("green idiot!", 0), ("lam!", 0), ("!" * 50000, 0)])
def test_signs_and_styles_are_met(text, n):
    model = tox.Model({**{f"{tox.fold(s).strip()} ": 2.0 for s in ("idiot", "asshole", "stupid", "ass", "river")}, "lam": 1.0},
                      ("river stone", "green idiot"))
    made = tox.forms(text)
    assert len(set(map(len, made))) == 1 and len(tox.hits(model.automaton(), *made)) == n


def labelled(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 6 == 0
        words = prose(i, 90).split()
        if bad:
            for k in range(0, 90, 15):
                words[k] = ("grumblor", "vexatis" + "abcdef"[i % 5])[k // 15 % 2]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_it_has_never_seen(spark):
    prepare(spark)
    docs, labels = labelled(spark)
    model = tox.learn(docs, labels, tox.held_out(labels["doc_id"]))
    scored, name = tox.score(docs, model)
    for r in scored.select("doc_id", f"{name}.score").collect():
        assert (r["score"] >= 0.5) == (r["doc_id"] % 6 == 0), r
    hard = spark.createDataFrame([(1, "Th3 GRUMBL0R " * 5), (2, prose(900, 50)), (3, "vexatisz was here, vexatisq too")], "doc_id long, text string")
    assert [r["doc_id"] for r in tox.accepted(hard, model).collect()] == [2]


def brute_learn(docs, labels):
    """``learn`` in plain Python, with its default parameters."""
    known = {}
    for i, toxic in labels:
        if i is not None and toxic in (0, 1) and zlib.crc32(str(i).encode()) % 5:
            known[i] = max(toxic, known.get(i, 0))
    groups = {}
    for i, text in docs:
        if i in known:
            words = tox.fold(text).split()
            shingles = [" ".join(words[k:k + 3]) for k in range(max(len(words) - 2, 1))]
            least = min(xxhash.xxh64_intdigest(s) for s in shingles) >> 1
            groups.setdefault((known[i], least), []).append((i, tox.fold(text), text))
    sample = [(label, *min(rows)[1:]) for (label, _), rows in groups.items()]
    texts, words, seen, held = Counter(), Counter(), Counter(), Counter()
    for label, folded, _ in sample:
        own = folded.split()
        texts[label] += 1
        words[label] += max(len(own), 1)
        stems = [w[:k] for w in own for k in range(3, min(len(w) - 1, 12) + 1)] + [w + " " for w in own if len(w) >= 3]
        for stem in stems:
            held[label, stem] += 1
        for stem in set(stems):
            seen[label, stem] += 1
    usual, scored = texts[1] / (texts[0] + texts[1]), {}
    for stem in {s for _, s in seen}:
        n, share = seen[0, stem] + seen[1, stem], (seen[1, stem] + 1e-9) / (seen[0, stem] + seen[1, stem] + 2e-9)
        g = 2 * n * (share * math.log(share / usual) + (1 - share) * math.log((1 - share) / (1 - usual)))
        scored[stem] = g, math.log((held[1, stem] + 0.5) / words[1] / ((held[0, stem] + 0.5) / words[0])), n
    kept = {}
    for stem in sorted(scored, key=lambda s: (-round(scored[s][0], 6), -len(s), s)):
        g, w, _ = scored[stem]
        if seen[1, stem] >= 4 and g >= 24 and w >= 2.5 and not any(k.startswith(stem) or stem.startswith(k) for k in kept):
            kept[stem] = w
    seeds = {f"{tox.fold(s).strip()} ": w for s, w in tox.SEEDS.items()}
    seeds = {s: w for s, w in seeds.items() if not (s in scored and scored[s][2] >= 8 and scored[s][1] < 2.5)}
    exceptions = {tox.fold(p).strip() for p in tox.EXCEPTIONS}
    model = tox.Model(seeds | kept, tuple(sorted(exceptions)))
    pairs = Counter()
    for label, folded, text in sample:
        found, at, places = tox.hits(model.automaton(), *tox.forms(text)), 0, []
        for word in folded.split():
            at = folded.index(f" {word} ", at)
            places.append((at, word))
            at += 1
        pairs.update({(f"{a} {b}", label) for (i, a), (j, b) in zip(places, places[1:]) if i in found or j in found})
    exceptions |= {p for p, _ in pairs if pairs[p, 0] >= 5 and pairs[p, 0] > 4 * pairs[p, 1]}
    model = tox.Model(model.weights, tuple(sorted(exceptions)))
    points = [(round(feature(model, text), 2), label) for label, _, text in sample]
    seen_x = sorted({x for x, _ in points})
    borders = [(sum((x > low) != (label == 1) for x, label in points), low - high, low, high)
               for low, high in zip(seen_x, [*seen_x[1:], seen_x[-1] + 1.0])]
    border = sum(min(borders)[2:]) / 2
    slope = min((0.25 * k for k in range(2, 21)), key=lambda s: sum(
        math.log1p(math.exp((-1 if label else 1) * s * (x - border))) for x, label in points))
    return tox.Model(model.weights, model.exceptions, -slope * border, slope)


def feature(model, text):
    total = sum(tox.hits(model.automaton(), *tox.forms(text)).values())
    return math.log1p(1000 * total / max(len(tox.fold(text).split()), 1))


def same(got, want):
    assert got.weights == pytest.approx(want.weights) and got.exceptions == want.exceptions
    assert (got.intercept, got.slope) == pytest.approx((want.intercept, want.slope))


def test_learning_equals_brute_force(spark):
    prepare(spark)
    docs, labels = labelled(spark)
    pairs = [tuple(r) for r in docs.collect()]
    # a harmless use of a toxic word, also where only another reading finds it, copies and documents labelled both ways
    pairs += [(1000 + i, f"the grumblor engine {i} runs " + prose(500 + i, 30) + (" @grumblor motor" if i % 2 else "")) for i in range(14)]
    pairs += [(2000 + i, pairs[6 * (i % 2)][1]) for i in range(9)]
    marks = [tuple(r) for r in labels.collect()] + [(1000 + i, 0) for i in range(14)] + [(2000 + i, 1) for i in range(9)] + [(0, 0), (None, 1)]
    docs, labels = spark.createDataFrame(pairs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = tox.learn(docs, labels, tox.held_out(labels["doc_id"]))
    assert any(tox.fold("grumblor").strip() in p for p in got.exceptions) and any(s.startswith("vexatis") for s in got.weights)
    same(got, brute_learn(pairs, marks))


def test_query_equals_brute_force(spark):
    prepare(spark)
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    labels = table(spark, folder, "labels")
    marks = [tuple(r) for r in labels.select("doc_id", "toxic").collect()]
    model = brute_learn(docs, marks)
    same(tox.learn(table(spark, folder, "documents"), labels, tox.held_out(labels["doc_id"])), model)
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_toxicity"](spark, folder).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        score = 1 / (1 + math.exp(-(model.intercept + model.slope * feature(model, text))))
        assert got[i]["score"] == pytest.approx(score) and got[i]["predicted"] == int(got[i]["score"] >= 0.5)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_learns_long_words(spark):
    prepare(spark)
    docs, labels = labelled(spark)
    long = "qwertyzuiopasdfghjkyxcvbnmqwertz"
    docs = docs.withColumn("text", F.regexp_replace("text", "grumblor|vexatis[a-f]", long))
    model = tox.learn(docs, labels, tox.held_out(labels["doc_id"]))
    assert len(long) > 24 and tox.hits(model.automaton(), tox.fold(f"a {long} here"))


def test_learns_nothing_from_held_out_rows(spark):
    prepare(spark)
    docs, labels = labelled(spark)
    out = tox.held_out(labels["doc_id"])
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tox.learn(docs, labels, out) == tox.learn(docs, flipped, tox.held_out(flipped["doc_id"]))
    assert {r["doc_id"]: r["h"] for r in labels.select("doc_id", out.alias("h")).collect()} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)}


def test_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = tox.learn(docs, none, tox.held_out(none["doc_id"]))
    assert model.weights  # the seeds
    scored, name = tox.score(docs, model)
    scores = scored.select(f"{name}.*").collect()
    assert len(scores) == len(ODD) and all(0 <= s["score"] < 0.5 for s in scores)
    kept = tox.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert plain(tox.accepted(docs.limit(0), model)) == []
    odd = spark.createDataFrame([(None, 1), (7, None), (7, 1), (7, 0), (4, 3)], "doc_id long, toxic int")
    assert tox.learn(docs, odd, tox.held_out(odd["doc_id"])).weights
