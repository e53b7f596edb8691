import hashlib

import numpy as np
import pytest

from hourgrid.llm import vector_codes as vc


def brute(rows, entries=64, parts=16, rounds=2):
    """Python whole numbers, one row and entry at a time; rows are (key, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [[int(np.floor(256 * np.float64(x))) for x in r[1]] for r in kept]
    w = len(whole[0]) // parts
    cut = [[v[p * w:p * w + w] for p in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        owner = [[near(v[p], books[p])[1] for v in cut] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, o in zip(cut, owner[p]) if o == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    digest = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return sorted((str(r[0]), str(r[2]), "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for r, f in zip(kept, final)), digest


SCHEMA = "vec_id long, embedding array<double>, label string, code string"


def made(n, length, scale=1.0, seed=1):
    draw = np.random.default_rng(seed)
    return [(int(i), draw.normal(0, scale, length).tolist(), [None, "a", "b"][i % 3], "kept") for i in draw.permutation(n)]


@pytest.mark.parametrize("scale", [1.0, 1e5])  # one limb, several limbs
def test_codes_equal_brute_force(spark, scale):
    rows = made(150, 48, scale)
    rows += [rows[0], (None, rows[1][1], "a", "x"), (7000, None, "a", "x"), (7001, [None] * 48, "b", "x"), (7002, [float("nan")] * 48, None, "x"),
             (7003, [float("-inf")] * 48, None, "x"), (7004, [], "b", "x")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5, "vec_id")
    books = vc.fit(frame)
    coded, code, error = vc.encode(frame, books)
    assert (code, error) == ("code_", "error") and coded.columns == [*frame.columns, "code_", "error"]
    got = coded.collect()
    odd = [r for r in got if r["vec_id"] == 7004]
    assert [(r["code_"], r["error"], r["code"]) for r in odd] == [(None, None, "x")]  # another length: no code
    want, digest = brute([r[:3] for r in rows if r[0] != 7004])
    assert sorted((str(r["vec_id"]), str(r["label"]), bytes(r["code_"]).hex(), r["error"]) for r in got if r["vec_id"] != 7004) == want
    assert books.sha256() == digest
    summed = {(r["label"], r["total"]) for r in vc.with_group_error(coded, "label", "error", "total").collect()}
    assert summed == {(k, sum(e for _, name, _, e in want if name == str(k))) for k in (None, "a", "b")}


def test_labels_beyond_the_broadcast(spark, monkeypatch):
    frame = spark.createDataFrame(made(200, 16), SCHEMA)
    coded, _, error = vc.encode(frame, vc.fit(frame))
    want = sorted(map(tuple, vc.with_group_error(coded, "label", error, "total").select("vec_id", "total").collect()))
    monkeypatch.setattr(vc, "SMALL", 0)
    assert sorted(map(tuple, vc.with_group_error(coded, "label", error, "total").select("vec_id", "total").collect())) == want


def test_ties_repeats_and_few_vectors(spark):
    rows = [(i, [float(i % 2)] * 16, None, "") for i in range(10)] + [(3, [1.0] * 16, None, "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    coded, code, error = vc.encode(frame, vc.fit(frame))
    assert {(r["vec_id"] % 2, bytes(r[code]).hex(), r[error]) for r in coded.collect()} == {(0, "00" * 16, 0), (1, "01" * 16, 0)}
    assert coded.count() == 11


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, None, "a", "")], SCHEMA)
    books = vc.fit(frame)
    coded, code, error = vc.encode(frame, books)
    assert books is None and vc.with_group_error(coded, "label", error, "total").collect() == []
    assert vc.fit(frame.limit(0)) is None
    with pytest.raises(ValueError, match="63 bits"):
        vc.fit(spark.createDataFrame([(1, [1e300] * 16, "", "")], SCHEMA))
    with pytest.raises(ValueError, match="equal parts"):
        vc.fit(spark.createDataFrame([(1, [1.0] * 17, "", "")], SCHEMA))


@pytest.mark.parametrize("bits", [3, 20, 27])
def test_dots_are_exact(bits):
    draw = np.random.default_rng(bits)
    a, b = (draw.integers(-(1 << bits), (1 << bits) + 1, (2, n, 40)) for n in (30, 7))
    a[0, 0] = -(1 << bits)
    b[0, 0] = 1 << bits
    got = vc.dots(a, b, 1 << bits)
    want = [[[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b[p]] for u in a[p]] for p in range(2)]
    assert got.tolist() == want
