import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import test_decontaminate
import test_simhash
import test_toxicity
from cases import ODD, odd_documents
from test_bpe import FILES, PAIRS

import corpus_pipeline
from hourgrid.llm import quality
from hourgrid.llm import toxicity as tox
from hourgrid.llm.common import prepare
from hourgrid.session import materialise

FOLDER = "/root/testdata/sf0.001"


def good(rows, rules):
    """Kept by the base rule and the posterior of rules fitted to all rows."""
    model = quality.fit(sorted(Counter(tuple(v) for v in rules.values()).items(), key=str), quality_names)
    kept = []
    for i, text in rows:
        counts = quality.measure(text)
        p = model.posterior(dict(zip(quality_names, rules[i])))
        if counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0] and p >= 0.5:
            kept.append((i, text))
    return kept


quality_names: list[str] = []


def test_equals_brute_force(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    judged, name = quality.judge(docs)
    voted = judged.select("doc_id", f"{name}.*")
    quality_names[:] = [c[5:] for c in voted.columns if c.startswith("vote_")]
    rows = good(rows, {r["doc_id"]: [r[f"vote_{c}"] for c in quality_names] for r in voted.collect()})

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    left = spark.createDataFrame(rows, "doc_id long, text string")
    model = tox.learn(left, labels, tox.held_out(labels["doc_id"]))

    def score(text):
        folded = tox.fold(text)
        total, n = sum(test_toxicity.brute(model, folded).values()), len(folded.split())
        x = math.log1p(1000 * total / n) if total else 0.0
        return 1 / (1 + math.exp(-model.intercept - model.slope * x))

    rows = [(i, t) for i, t in rows if score(t) < 0.5]
    prints = [test_simhash.brute_print(t) for _, t in rows]
    own = test_simhash.brute_classes(prints, 3)
    first = {c: min(rows[k][0] for k in range(len(rows)) if own[k] == c) for c in own}
    rows = [r for k, r in enumerate(rows) if r[0] == first[own[k]]]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    shingles = {s for _, t in items for s in test_decontaminate.runs(test_decontaminate.words_of(t), 5)}
    near = [r for r in rows if shingles & set(test_decontaminate.runs(test_decontaminate.words_of(r[1]), 5))]
    leaks = {d for d, *_ in test_decontaminate.brute(near, items)}
    want = []
    for i, text in rows:
        if i not in leaks:
            ids = PAIRS[FILES[0]][1].encode_ordinary(text)
            want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect())) == want and 50 < len(want) < 190


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, k):
    prepare(spark)
    name, stage = corpus_pipeline.STAGES[k]
    docs = odd_documents(spark)
    out = materialise(stage(spark, docs, FOLDER))
    last = k == len(corpus_pipeline.STAGES) - 1
    assert last or out.columns == docs.columns
    assert out.count() == len(ODD) if last else out.count() <= len(ODD)
    assert materialise(stage(spark, docs.limit(0), FOLDER)).count() == 0


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "near duplicates", "benchmark leaks", "byte-level tokens"]
