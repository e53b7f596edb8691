"""One query per operator over its whole table, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import bpe, chat, decontaminate, licenses, packing, quality, ranked, simhash, token_trees, toxicity, urls, vector_codes, warc
from hourgrid.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, name = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    q = F.col(name)
    return judged.select("doc_id", *[q[c].alias(c) for c in quality.COUNTS], q["base_failed"].alias("base_failed"),
                         q["kept"].alias("kept"), F.round(q["p_good"], 6).alias("p_good"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, toxicity.held_out(labels["doc_id"]))
    scored, name = toxicity.score(docs, model, carry=["doc_id"])
    t = F.col(name)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), t["score"].alias("score"),
                         (t["score"] >= 0.5).cast("int").alias("predicted"), t["n_hits"].alias("n_hits"))


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.label(table(spark, sf_dir, "documents"))


_LEAKS = r"""
WITH item AS (
  SELECT DISTINCT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
doc AS (SELECT doc_id, w, len(w) AS n FROM (
  SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents)),
item_run AS (SELECT item_id, n, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, n - k + 2)]) AS run FROM item),
item_count AS (SELECT item_id, n, k, run, count(*) AS c FROM item_run GROUP BY ALL),
doc_run AS (SELECT doc_id, k, i - 1 AS pos, n, array_to_string(w[i:i + k - 1], ' ') AS run FROM (
  SELECT doc_id, w, n, k, unnest(range(1, n - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM item))),
pair AS (
  SELECT doc_id, item_id, k, i.n AS item_n, d.n AS doc_n, i.n - k + 1 AS m, least(i.n - k + 1, d.n - k + 1) AS w
  FROM doc_run d JOIN item_count i USING (run, k) GROUP BY ALL HAVING count(*) >= 0.8 * (i.n - k + 1) - 1e-9),
win AS (SELECT *, unnest(range(0, doc_n - k + 1 - w + 1)) AS start FROM pair),
both_counts AS (
  SELECT doc_id, item_id, m, w, start, run, count(*) AS c
  FROM win JOIN doc_run d USING (doc_id, k) WHERE d.pos BETWEEN start AND start + w - 1 GROUP BY ALL),
scored AS (
  SELECT b.doc_id, b.item_id, b.start, sum(least(b.c, i.c)) / (b.m + b.w - sum(least(b.c, i.c))) AS similarity
  FROM both_counts b JOIN item_count i USING (item_id, run) GROUP BY b.doc_id, b.item_id, b.start, b.m, b.w)
SELECT doc_id, item_id, round(similarity, 6) AS similarity, start AS first_word FROM scored WHERE similarity >= 0.8 - 1e-9
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""


@query(_LEAKS)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), F.round("similarity", 6).alias("similarity"),
                        F.col("start").cast("long").alias("first_word"))


def byte_model() -> bytes:
    return bpe.serialise(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = bpe.digests(table(spark, sf_dir, "documents"), byte_model(), public_tokenizers.PATTERN, carry=["doc_id"])
    return out.select("doc_id", f"{name}.*")


_WARC = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
first AS (SELECT html, max(page_id) AS first FROM page WHERE n >= 1000 GROUP BY html HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM page LEFT JOIN first USING (html)
"""


@query(_WARC)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]

_URLS = r"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rule(verdict, rule_host, rule_path) AS (VALUES """ + ", ".join(str(r) for r in URL_RULES) + r"""),
fit AS (SELECT page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) AS won
        FROM part JOIN rule ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict FROM part LEFT JOIN fit USING (page_id)
"""


@query(_URLS)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, spark.createDataFrame(URL_RULES, "verdict string, host string, path string"))


MARKED = "</s>[INST] ok [/INST]"

_CHATS = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
chars AS (
  SELECT *, length(regexp_replace(regexp_replace(text, '<(\\*)(/?(?:s|turn|cont|end)>)', '<\\\1\2', 'g'),
                                  '\[(\\*)(/?INST\])', '[\\\1\2', 'g')) AS escaped,
         role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS joins FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (7 + sum(escaped + CASE WHEN joins THEN 6 ELSE 6 + length(role) + 1 + 5 END))::BIGINT AS formatted_chars
FROM chars GROUP BY conv_id
"""


@query(_CHATS)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(MARKED).alias("text"))
        for i, role in enumerate(("user", "assistant"))])).alias("row")).select("row.*")
    chats = chat.format_chats(rows.unionByName(extra))
    read = chats.select("conv_id", "segments", "formatted", F.explode(F.array(chat.read_turns(F.col("formatted")))).alias("turns"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.read_loss(F.col("segments"))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def _license_sql() -> str:
    """Brute force: every rule on every text, every pair of findings of a text."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ", ".join(f"({r['rank']}, {r['priority']}, {text(r['label'])}, {text(licenses.spread(licenses.spread_optional(r['regex'])))})"
                       for r in licenses.default_rules())
    phrases = ", ".join(f"({text(p)}, {text(label)})" for p, label in PHRASES.items())
    sure = " ".join(f"WHEN {p} THEN {s}" for p, s in licenses.SURE.items())
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
rule(rank, priority, label, regex) AS (VALUES {listed}),
phrase(phrase, label) AS (VALUES {phrases}),
layout AS (SELECT doc_id, w, ' ' || array_to_string(w, '  ') || ' ' AS t FROM words),
marked AS (SELECT doc_id, rank, priority, label, string_split_regex(trim(regexp_replace(t, regex, ' ' || chr(1) || ' \0 ' || chr(2) || ' ', 'g')), ' +') AS m
           FROM layout, rule WHERE regexp_matches(t, regex)),
token AS (SELECT doc_id, rank, priority, label, unnest(m) AS x, unnest(range(len(m))) AS i FROM marked),
mark AS (SELECT *, row_number() OVER (PARTITION BY doc_id, rank, x ORDER BY i) - 1 AS k FROM token WHERE x IN (chr(1), chr(2))),
span AS (SELECT a.doc_id, a.rank, a.priority, a.label, a.i - 2 * a.k AS start, b.i - 2 * b.k - 1 AS stop
         FROM mark a JOIN mark b USING (doc_id, rank, k) WHERE a.x = chr(1) AND b.x = chr(2)),
kept AS (
  SELECT * FROM span s WHERE NOT EXISTS (
    SELECT 1 FROM span o WHERE o.doc_id = s.doc_id AND o.start <= s.start AND o.stop >= s.stop AND (
      o.priority < s.priority OR o.priority = s.priority AND (o.stop - o.start > s.stop - s.start OR o.rank < s.rank)))),
place AS (
  SELECT doc_id, label, i - 1 AS start FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words), phrase
  WHERE array_to_string(w[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY doc_id),
found AS (SELECT doc_id, max(CASE priority {sure} END) AS sure FROM kept GROUP BY doc_id),
named AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM kept UNION ALL SELECT doc_id, label FROM place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, greatest(coalesce(sure, 0), CASE WHEN n_base > 0 THEN {licenses.PHRASE} ELSE 0 END)::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query(_license_sql())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), PHRASES).drop("found")


def edits_of(docs: DataFrame) -> Column:
    """Three edits of every document, one in each third, that follow from its id: a passage of up to 60
    characters goes and one of up to 80 characters of the same text comes."""
    text, third = F.coalesce(docs["text"], F.lit("")), F.floor(F.length(docs["text"]) / 3)

    def pick(k: int, most: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(docs["doc_id"], F.lit(0)), F.lit(k)), F.greatest(most, F.lit(1)))

    made = []
    for k in range(3):
        start = third * k + pick(k, third)
        made.append(F.struct(start.alias("start"), F.least(start + pick(k + 10, F.lit(61)), third * (k + 1)).alias("end"),
                             F.substring(text, (1 + pick(k + 20, F.length(text))).cast("int"), pick(k + 30, F.lit(81)).cast("int")).alias("new")))
    return F.array(*made)


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_trees.recount(docs, edits_of(docs), byte_model(), public_tokenizers.PATTERN)
    return counted.select("doc_id", token_trees.n_tokens(F.col("tree")).alias("n_tokens"),
                          token_trees.n_tokens(F.col("edited")).alias("n_tokens_edited"),
                          F.length("edited.text").cast("long").alias("n_chars_edited"), F.col("edited.encoded").alias("n_chars_encoded"),
                          F.sha2("edited.text", 256).alias("edited_sha256"))


@query()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _codes_sql() -> str:
    """Two rounds of assignment and means, each part against every entry of its codebook."""
    def assign(k: int) -> str:
        return f"""
near{k} AS (
  SELECT row, part, x, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
    SELECT row, p.part, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM part p JOIN book{k} b ON p.part = b.part) GROUP BY row, part, x)"""

    def move(k: int) -> str:
        return f"""
mean{k} AS (
  SELECT part, e, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT part, e, i, sum(v) AS s, count(*) AS n FROM (
      SELECT part, e, unnest(x) AS v, unnest(range(len(x))) AS i FROM near{k}) GROUP BY part, e, i) GROUP BY part, e),
book{k + 1} AS (SELECT part, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (part, e))"""

    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row, vec_id, label,
         list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
part AS (
  SELECT row, part, x[part * w + 1:part * w + w] AS x
  FROM (SELECT row, x, len(x) // 16 AS w, unnest(range(16)) AS part FROM kept)),
book0 AS (SELECT part, row AS e, x AS c FROM part WHERE row < 64),
{assign(0)},{move(0)},{assign(1)},{move(1)},{assign(2)},
code AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY row),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, e, i)) AS codebooks_sha256 FROM (
  SELECT part, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM book2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN code USING (row), books
"""


@query(_codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.fit(vectors)
    coded, code, error = vector_codes.encode(vectors, books, carry=["vec_id", "label"])
    summed = vector_codes.with_group_error(coded, "label", error, "label_error")
    return summed.select("vec_id", F.lower(F.hex(code)).alias("code"), F.col(error).alias("error"), "label_error",
                         F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


_RANKED = r"""
WITH doc AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
total AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM doc WHERE len(w) > 0),
asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
posting AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM doc)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * t.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posting, total t GROUP BY term, t.n),
scored AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * t.n) // t.l))))::BIGINT AS score
  FROM posting p JOIN weight USING (term) JOIN asked USING (term), total t GROUP BY i, item_id, d, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, d)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY rank <= 50
"""


@query(_RANKED)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
