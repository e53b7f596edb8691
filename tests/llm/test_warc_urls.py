import gzip
import hashlib
import random

import pytest
from cases import plain, prose
from pyspark.sql import functions as F

from hourgrid.llm import urls, warc
from hourgrid.llm.common import prepare
from hourgrid.session import scratch

BIG = prose(1, 400)
PAGES = [(1, "http://a.com/", BIG), (2, "http://b.com/", BIG), (3, None, BIG), (4, "http://c.com/x\r\nEvil: 1", "small"), (5, "http://d.com", "small"),
         (6, "u", None), (7, "", ""), (8, "é", "é" * 499), (9, "é", "é" * 500), (10, "é", "é" * 500), (None, "n", BIG), (11, "dup", BIG + "2"),
         (11, "dup", BIG + "2"), (12, "bin", "\x00\x1f\u008b\r\n\r\nWARC/1.1\r\n" * 100)]


def brute(pages):
    out = []
    for key, _, html in pages:
        data = (html or "").encode()
        same = [k for k, _, h in pages if (h or "") == (html or "") and k is not None]
        first = max(same, default=None) if len(data) >= 1000 else None
        visit = first is not None and first != key
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if visit else "response", first if visit else None))
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def table(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("key", F.lit(1)).withColumn("times", F.lit(1))


def test_round_trip_equals_brute_force(spark):
    prepare(spark)
    assert plain(warc.round_trip(table(spark)).select(*COLUMNS)) == brute(PAGES)
    assert plain(warc.round_trip(table(spark).limit(0))) == []


def test_many_groups_give_the_same(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(warc, "SMALL", 0)
    rows = PAGES + [(100 + i, "hot", BIG * 2) for i in range(300)]
    assert plain(warc.round_trip(table(spark, rows)).select(*COLUMNS)) == brute(rows)


def test_archives_are_gzip_and_payloads_come_back(spark):
    prepare(spark)
    path = scratch(spark, "warc")
    warc.write(table(spark), path)
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        data = gzip.decompress(r["content"])
        assert data.count(b"WARC/1.1\r\nWARC-Type") == len(list(warc.read_records(r["content"])))
    back = {r["page_id"]: r["payload"] for r in warc.read(spark, path).collect() if r["record_type"] == "response"}
    for key, _, html in PAGES:
        if key in back:
            assert bytes(back[key]) == (html or "").encode()


def test_large_records_and_damage():
    draw = random.Random(1)
    large = warc.write_record(1, "u", draw.randbytes(17 << 20))
    small = warc.write_record(2, "v", b"x" * 2000)
    assert large[-1] and not small[-1]
    archive = large + warc._member(b"") + small
    assert [r.headers["X-Page-ID"] for r in warc.read_records(archive)] == ["1", "2"]
    assert list(warc.read_records(b"")) == []
    for bad in (archive[:-5], archive[:100], small[:40] + bytes([small[40] ^ 255]) + small[41:], b"junk" * 10):
        with pytest.raises(Exception):  # noqa: B017
            list(warc.read_records(bad))
    broken = gzip.decompress(small).replace(b"x" * 2000, b"x" * 1999 + b"y")
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(gzip.compress(broken)))
    with pytest.raises(ValueError, match="content length"):
        list(warc.read_records(gzip.compress(gzip.decompress(small).replace(b"x" * 2000, b"x" * 1999))))


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
         ("block", "Deep.Example.com", "/en"), ("allow", "org", ""), ("block", "org", ""), ("block", "a.org", "/p?"), ("block", "", "/q"), ("allow", None, None), ("block", "x.net", "/es/")]
URLS = ["http://www.example.com/en/1", "https://EXAMPLE.com/en/", "http://example.com/en", "http://com/", "http://com", "http://acom/", "ftp://m.example.net/es/x?y#z",
        "http://example.net/fr", "no scheme", None, "", "://", "http://", "http:///q/1", "http://a.b.deep.example.com/english", "http://..com/", "x://h?/en/", "x://h#a/b",
        "http://a.org/p?q", "http://x.net/es/1", "a://b://c/d", "http://É.com/É/", "http://" + "a." * 3000 + "com/en/", "http://example.com:80/en/"]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = []
    for verdict, h, p in RULES:
        h, p = (h or "").lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p) and not (h == "" and host != ""):
            fits.append((len(h + p), len(h), h + p, verdict != "allow", verdict))
    best = max(fits, default=None)
    return host, path, best and best[2], best[4] if best else "allow"


def test_urls_equal_brute_force(spark):
    prepare(spark)
    pages = spark.createDataFrame([(i % 20 or None, u) for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string").withColumn("row", F.lit(1)).withColumn("host", F.lit(2))
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    want = sorted(((i % 20 or None, *judged(u)) for i, u in enumerate(URLS + URLS[:3])), key=str)
    assert plain(urls.judge(pages, rules)) == want
    assert plain(urls.judge(pages.limit(0), rules)) == []
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_urls_by_shuffle(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(urls, "SMALL", 0)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    assert plain(urls.judge(pages, rules)) == sorted(((i, *judged(u)) for i, u in enumerate(URLS)), key=str)


def test_archives_stay_below_their_bytes(spark, tmp_path):
    """Large payloads get archives with fewer records; all records come back."""
    sizes = [10] * 40 + [900, 1500, 5000, 5000, 40_000, 400_000]
    data = [(i, f"http://a/{i}", "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(n))) for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(2)
    path = str(tmp_path / "w")
    warc.write(pages, path, archive_bytes=100 * warc.RECORDS)
    got = {r["page_id"]: (r["payload_bytes"], r["payload"]) for r in warc.read(spark, path).collect()}
    assert got == {i: (len(t), t.encode()) for i, _, t in data}
    held = [[len(r.payload()) for r in warc.read_records(p.read_bytes())] for p in (tmp_path / "w").glob("part-*")]
    for own in held:
        assert max(own) <= 100 or len(own) <= warc.RECORDS // 16
        assert max(own) <= 25_600 or len(own) == 1


def test_small_payloads_are_not_joined(spark, monkeypatch):
    """Above the broadcast, rows without a digest stay out of the join."""
    monkeypatch.setattr(warc, "SMALL", 0)
    data = [(i, "u", "x" * (5 if i % 3 else 2000)) for i in range(60)] + [(60, None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    rows = warc.round_trip(pages).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {i: 57 if i % 3 == 0 and i < 57 else None for i in range(61)}


def test_plan_does_not_grow_with_the_rules(spark):
    many = [("block" if i % 2 else "allow", f"h{i % 40}.{'x.' * (i % 25)}com", "/" + "p" * (i % 40)) for i in range(2000)]
    pages = spark.createDataFrame([(i, f"http://www.h{i % 50}.{'x.' * (i % 25)}com/{'p' * (i % 60)}") for i in range(200)], "page_id long, url string")
    text = lambda rules: urls.judge(pages, spark.createDataFrame(rules, "verdict string, host string, path string"))
    few, all_ = text(many[:3]), text(many)
    length = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert length(all_) < length(few) + 500
    best = {}
    for _, host, path in sorted(set(many), key=lambda r: len(r[1] + r[2])):
        for page, url in pages.collect():
            name, _, rest = url.removeprefix("http://").partition("/")
            if (name == host or name.endswith("." + host)) and ("/" + rest).startswith(path):
                best[page] = host + path
    assert {r["page_id"]: r["rule"] for r in all_.collect() if r["rule"]} == best
