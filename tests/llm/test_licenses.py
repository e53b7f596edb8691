import re

import pytest
from cases import ODD, odd_documents, plain, prose

from hourgrid.llm import licenses
from hourgrid.llm.common import prepare
from hourgrid.llm.license_rules import rules
from hourgrid.llm.queries import PHRASES


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    words = words_of(text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    layout, found = f" {'  '.join(words)} ", []
    for r in rules():
        for m in re.finditer(licenses.spread(licenses.spread_optional(r["regex"])), layout):
            start = len(layout[:m.start()].split())
            found.append((start, start + len(m[0].split()), r["label"], r["priority"], r["rank"]))
    kept = [d for d in found if not any(o[0] <= d[0] and o[1] >= d[1] and (
        o[3] < d[3] or o[3] == d[3] and (o[1] - o[0] > d[1] - d[0] or o[4] < d[4])) for o in found)]
    base = sorted({label for _, label in places})
    sure = max([licenses.SURE[d[3]] for d in kept] + [licenses.PHRASE if places else 0.0])
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(base),
            ",".join(sorted({*base, *(d[2] for d in kept)})), sure)


NOTICES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Released under the MIT license, under the MIT License and under the mit licence", "cc-by-nc CC BY NC 4.0 cc by nc-nd 4.0", "SPDX-License-Identifier: GPL-3.0-or-later",
    "GNU Lesser General Public License version 2.1 or GNU General Public License", "public domain, in the PUBLIC DOMAIN. unlicense", "écc by nc cc by ncé",
    "under the mit license under the mit license", "BSD 3-Clause License. New BSD license; BSD license", "Copyright (c) 2020-2021 All Rights Reserved", "İ MIT License K",
    "apache license version 2 apache license version 2 0 apache", "commit license emit licensed", "license mit license mit license"]


@pytest.fixture(scope="module")
def texts():
    long = " ".join(f"{prose(i, 20)} {NOTICES[i % len(NOTICES)]}" for i in range(300))
    return NOTICES + [t for _, t in ODD] + [prose(1, 100), f"{prose(2, 50)} {NOTICES[0]} {prose(3, 5)} {NOTICES[4]}", long, "mit license " * 3000]


def test_equals_brute_force(spark, texts):
    prepare(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:8] for r in licenses.scan(docs, PHRASES).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text and text[:80]


def test_rules():
    every = rules()
    assert len(every) >= 200 and len({r["rank"] for r in every}) == len(every)
    assert len({r["regex"] for r in every if r["priority"] < 4}) == sum(r["priority"] < 4 for r in every)
    for r in every:
        re.compile(r["regex"])
        assert r["keyword"] in r["regex"] or r["keyword"] == "rail", r


def test_odd_rows(spark):
    prepare(spark)
    docs = odd_documents(spark)
    assert licenses.scan(docs, PHRASES).count() == len(ODD)
    assert plain(licenses.scan(docs.limit(0), PHRASES)) == []
    again = spark.createDataFrame([(None, NOTICES[1]), (None, NOTICES[1]), (5, NOTICES[1])], "doc_id long, text string")
    assert {tuple(r)[1:8] for r in licenses.scan(again, PHRASES).collect()} == {brute(NOTICES[1])}


def test_no_python_in_the_plan(spark):
    prepare(spark)
    text = licenses.scan(odd_documents(spark), PHRASES)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "CartesianProduct", "NestedLoop"))
