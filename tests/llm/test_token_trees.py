import hashlib
import random

import public_tokenizers as P
import regex
from cases import ODD, odd_documents, plain, prose
from pyspark.sql import functions as F
from test_bpe import FILES, PAIRS

from hourgrid.llm import bpe, queries
from hourgrid.llm import token_trees as tt
from hourgrid.llm.common import prepare, table
from hourgrid.session import materialise

CODEC, OTHER = PAIRS[FILES[0]]


def count(text):
    return len(OTHER.encode_ordinary(text))


def consistent(tree):
    assert all(tree.chars[i] == tree.chars[2 * i] + tree.chars[2 * i + 1] and tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1]
               for i in range(1, tree.half))


def test_random_edits_equal_a_full_count():
    draw, letters, find = random.Random(9), "ab c\n\n  'sre1 2é.,!\t", regex.compile(P.PATTERN).finditer
    for case in range(600):
        text = "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 7, 90, 1500])))
        tree = next(tt.grow(CODEC, [text]))
        for _ in range(4):
            start = draw.randint(0, len(text))
            end = min(len(text), start + draw.choice([0, 1, 3, 40, 500]))
            new = "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 5, 30, 3000 if case % 20 == 0 else 2])))
            want = text[:start] + new + text[end:]
            text, tree, _ = tt.edit(CODEC, find, text, tree, start, end, new)
            assert text == want and tree.tokens[1] == count(text) and tree.chars[1] == len(text)
            consistent(tree)


def test_only_the_surroundings_are_encoded_again():
    find, text = regex.compile(P.PATTERN).finditer, prose(1, 20_000)
    _, _, encoded = tt.edit(CODEC, find, text, next(tt.grow(CODEC, [text])), 60_000, 60_010, "something else")
    assert encoded < 500


def test_patches():
    edits = [{"start": 5, "end": 7, "new": "x"}, None, {"start": None, "end": 1, "new": "y"}, {"start": 0, "end": None, "new": "z"},
             {"start": 7, "end": 99, "new": None}]
    assert tt.ordered(edits, 10) == [(7, 10, ""), (5, 7, "x"), (0, 0, "z")] and tt.ordered(None, 3) == []


def test_overlapping_edits_have_an_order():
    """Against a version that marks each character by the edit that takes it."""
    draw = random.Random(11)
    for _ in range(3000):
        text = "".join(draw.choice("ab \n1'") for _ in range(draw.randint(0, 14)))
        patch = [{"start": draw.randint(-2, 16), "end": draw.choice([None, draw.randint(-2, 18)]), "new": draw.choice(["", "X", "yz"])}
                 for _ in range(draw.randint(0, 5))]
        clip = [(s, max(s, min(e, len(text)))) for s, e in (
            (min(max(p["start"], 0), len(text)), p["start"] if p["end"] is None else p["end"]) for p in patch)]
        gone, after, reach = set(), {}, 0
        for k in sorted(range(len(patch)), key=lambda k: (*clip[k], k)):
            at = max(clip[k][0], reach)
            reach = max(clip[k][1], at)
            gone |= set(range(at, reach))
            after.setdefault(at, []).append(patch[k]["new"])
        want = "".join("".join(after.get(i, [])) + ("" if i in gone else text[i:i + 1]) for i in range(len(text) + 1))
        got = text
        for start, end, new in tt.ordered(patch, len(text)):
            got = got[:start] + new + got[end:]
        assert got == want, (text, patch)
    assert tt.ordered([{"start": 3, "end": 6, "new": "b"}, {"start": 0, "end": 5, "new": "a"}], 10) == [(5, 6, "b"), (0, 5, "a")]


def test_odd_rows_and_many_edits(spark):
    prepare(spark)
    model = bpe.serialise(bpe.read_ranks(P.path(FILES[0])))
    docs = odd_documents(spark, ODD + [(20, prose(20, 500))])
    n = F.length(F.coalesce("text", F.lit("")))
    edits = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct(
        F.floor(n * i / 10).alias("start"), F.floor(n * i / 10 + n / 30).alias("end"), F.concat(F.lit(" new "), i.cast("string")).alias("new")))
    rows = tt.recount(docs, edits, model, P.PATTERN).select(
        "doc_id", "edited.text", tt.n_tokens(F.col("tree")).alias("before"), tt.n_tokens(F.col("edited")).alias("after")).collect()
    assert len(rows) == len(ODD) + 1
    originals = {d: t for d, t in ODD + [(20, prose(20, 500))] if d is not None}
    for r in rows:
        assert r["after"] == count(r["text"])
        if r["doc_id"] is not None:
            old = originals[r["doc_id"]] or ""
            assert r["before"] == count(old)
            for i in reversed(range(10)):
                old = old[:len(originals[r["doc_id"]] or "") * i // 10] + f" new {i}" + old[int(len(originals[r["doc_id"]] or "") * i / 10 + len(originals[r["doc_id"]] or "") / 30):]
            assert r["text"] == old
    assert plain(tt.recount(docs.limit(0), edits, model, P.PATTERN)) == []
    kept = materialise(docs.select("text", edits.alias("edits"), tt.trees(F.col("text"), model, P.PATTERN).alias("tree")))
    again = kept.select("text", tt.edited(F.col("text"), F.col("tree"), F.col("edits"), model, P.PATTERN).alias("e")).select("e.text", tt.n_tokens(F.col("e")).alias("n"))
    assert plain(again) == sorted(((r["text"], r["after"]) for r in rows), key=str)


def test_query_equals_a_full_count(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    want = []
    for r in docs.select("doc_id", "text", queries.edits_of(docs).alias("edits")).collect():
        text = r["text"]
        for e in reversed(r["edits"]):
            text = text[:e["start"]] + e["new"] + text[e["end"]:]
        want.append((r["doc_id"], count(r["text"]), count(text), len(text), hashlib.sha256(text.encode()).hexdigest()))
    got = queries.QUERIES["op4_token_counts"](spark, folder)
    assert plain(got.drop("n_chars_encoded")) == sorted(want, key=str)
    assert got.where("n_tokens <> n_tokens_edited").count() > 100
