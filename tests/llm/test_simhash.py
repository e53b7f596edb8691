import random
import re

import xxhash
from cases import ODD, odd_documents, plain, prose

from hourgrid.llm import simhash
from hourgrid.llm.common import prepare


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits):
    own = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j]).bit_count() <= bits and own[i] != own[j]:
                    own[i] = own[j] = min(own[i], own[j])
                    changed = True
    return own


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    for text in [t for _, t in ODD] + [prose(i, i) for i in range(0, 60, 7)]:
        assert simhash.fingerprint(text) == signed(brute_print(text)), text


def test_links_equal_brute_force(spark):
    prepare(spark)
    draw = random.Random(3)
    some = {0, 1, (1 << 64) - 1, 1 << 63, *(draw.getrandbits(64) for _ in range(60))}
    for x in list(some):
        for n in (1, 2, 3, 4, 5):
            some.add(x ^ sum(1 << b for b in draw.sample(range(64), n)))
    for bits in (0, 1, 2, 3, 5):
        rows = spark.createDataFrame([(signed(x),) for x in some], "fp long")
        got = {tuple(r) for r in simhash.links(rows, "fp", bits).collect()}
        want = {tuple(sorted((signed(a), signed(b)))) for a in some for b in some if a != b and (a ^ b).bit_count() <= bits}
        assert got == want


def test_components(spark):
    prepare(spark)
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 140), (120, 140), (120, 130), (200, 201)] + [(300, x) for x in range(301, 340)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(chain, "low long, high long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 120: 100, 130: 100, 140: 100, 200: 200, 201: 200, **{x: 300 for x in range(300, 340)}}


def corpus():
    rows = [(i, prose(i, 150)) for i in range(40)]
    rows += [(100 + i, prose(i, 150)) for i in range(0, 40, 4)]  # copies
    rows += [(200 + i, prose(i, 150) + " " + "x" * (i + 1)) for i in range(20)]  # near copies
    return rows + [(i, t) for i, t in ODD if i is not None]


def test_labels_equal_brute_force(spark):
    prepare(spark)
    rows = corpus()
    prints = [brute_print(t) for _, t in rows]
    own = brute_classes(prints, 3)
    least = {c: min(rows[i][0] for i in range(len(rows)) if own[i] == c) for c in own}
    want = sorted(((rows[i][0], f"{prints[i]:016x}", least[own[i]]) for i in range(len(rows))), key=str)
    assert plain(simhash.label(spark.createDataFrame(rows, "doc_id long, text string"))) == want
    kept = simhash.accepted(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark)
    labels = simhash.label(docs).collect()
    assert len(labels) == len(ODD)
    assert {r["component_id"] for r in labels if r["fingerprint"] == "0" * 16} == {1}  # null, empty and blank texts
    kept = simhash.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 5, 6, None, 7, 8], key=str)
    assert plain(simhash.accepted(docs.limit(0))) == [] and plain(simhash.label(docs.limit(0))) == []
    nobody = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert simhash.accepted(nobody).count() == 1 and {r[2] for r in simhash.label(nobody).collect()} == {None}
