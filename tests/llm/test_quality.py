import re
from collections import Counter

import pytest
from cases import ODD, odd_documents, plain, prose
from pyspark.sql import functions as F

from hourgrid.llm import quality
from hourgrid.llm.common import prepare


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [t for _, t in ODD] + ["a b c a b c", "a a a a", "l\nl\n l\n\nl", "x y z \x0b \x1c q", "a b c d a b", "#|# <> $$ a%%", prose(1, 200)]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert quality.measure(text)[:5] == base_counts(text)


def junk(kind, seed):
    text = prose(seed, 120)
    return {"marks": re.sub(r"(\w+)", r"\1%%%", text), "capitals": re.sub(r"(\w+)", r"\1!!", text).upper(),
            "table": " | ".join(text.split()), "repeats": " ".join(w for w in text.split()[:8] for _ in range(20))}[kind]


KINDS = ("marks", "capitals", "table", "repeats")


def corpus():
    return [(i, prose(i, 60 + i)) for i in range(80)] + [(1000 + 10 * i + k, junk(kind, i)) for i in range(5) for k, kind in enumerate(KINDS)]


def test_keeps_clean_and_drops_each_kind_of_junk(spark):
    prepare(spark)
    kept = {r[0] for r in quality.accepted(spark.createDataFrame(corpus(), "doc_id long, text string")).select("doc_id").collect()}
    assert kept == set(range(80))


def test_equals_brute_force(spark):
    prepare(spark)
    docs = spark.createDataFrame(corpus() + ODD, "doc_id long, text string")
    judged, name = quality.judge(docs)
    rows = judged.select("text", f"{name}.*").collect()
    rules = [c[5:] for c in judged.select(f"{name}.*").columns if c.startswith("vote_")]
    patterns = Counter(tuple(r[f"vote_{c}"] for c in rules) for r in rows)
    model = quality.fit(sorted(patterns.items(), key=str), rules)
    for r in rows:
        counts = base_counts(r["text"])
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        p = model.posterior({c: r[f"vote_{c}"] for c in rules})
        assert tuple(r[c] for c in quality.COUNTS) == counts and r["base_failed"] == failed
        assert abs(r["p_good"] - p) < 1e-9 and r["kept"] == (not failed and p >= 0.5)


def test_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark)
    judged, name = quality.judge(docs)
    assert judged.count() == len(ODD) and set(docs.columns) < set(judged.columns)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    assert [r["row"] for r in kept.collect()] == ["kept"] * kept.count()
    empty = quality.accepted(docs.limit(0))
    assert empty.columns == docs.columns and plain(empty) == []


def test_without_documents_the_start_stays():
    model = quality.fit([], ["a", "b"])
    assert model.rounds == 0 and model.prior == 0.8
