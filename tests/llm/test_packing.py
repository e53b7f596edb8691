import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ODD, odd_documents, prose
from tokenizers import Tokenizer

from hourgrid.llm import packing, pretokens
from hourgrid.llm.pretokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_equal_the_library(library):
    encoder = Encoder(PATH)
    texts = [t or "" for _, t in ODD] + [prose(i, 60) for i in range(30)] + [
        " ", "  a", "a  b", "a \n b", "a\n\nb c", "don't do  it 's", "日本 語  x", " a b ", "<|endoftext|> a <|endoftext|>b", "12 34a ½ b²",
        "a \x1c b", "﻿ a", "é a", "a\tb \t c", " 's 'll", "a 's' b", "x y  z w", "q " * 500 + "\n", "no" + "o" * 300, "a (b) c! d"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoder.encode_all(texts) == want
    assert [encoder.encode_all([t])[0] for t in texts] == want  # all remembered by now


def brute_shard(docs, df, n_docs, mean, window, queries=24, most=48):
    """The rule of the module with dictionaries and sorting, one document at a time."""
    tf = [Counter(d.tolist()) for d in docs]
    idf = lambda t: math.log1p((n_docs - df[t] + 0.5) / (df[t] + 0.5))
    value = [{t: round((1 << 20) * idf(t) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(d) / mean))) for t, c in own.items()} for d, own in zip(docs, tf)]
    start = [len(d) // window * window for d in docs]
    left = [len(d) % window for d in docs]
    out = [[(d, at, window)] for d in range(len(docs)) for at in range(0, start[d], window)]
    order = sorted(range(len(docs)), key=lambda d: (-left[d], d))

    def take(d, room):
        n = min(left[d], room)
        start[d] += n
        left[d] -= n
        return d, start[d] - n, n

    for seed in order:
        while left[seed]:
            made = [take(seed, window)]
            room = window - made[0][2]
            query = sorted(value[seed], key=lambda t: (-value[seed][t], t))[:queries]
            scores = {d: sum(value[d].get(t, 0) for t in query) for d in range(len(docs)) if left[d]}
            ranking = sorted((d for d in scores if scores[d] > 0), key=lambda d: (-scores[d], d))[:most] if room else []
            refused = []
            for d in ranking:
                if room and left[d] <= room:
                    made.append(take(d, room))
                    room -= made[-1][2]
                elif room:
                    refused.append(d)
            for d in refused[:1] + order:
                while room and left[d]:
                    made.append(take(d, room))
                    room -= made[-1][2]
            out.append(made)
    return out


@pytest.mark.parametrize("window", [16, 64])
def test_shard_equals_brute_force(window):
    draw = np.random.default_rng(window)
    docs = [draw.zipf(1.4, n).clip(0, 400).astype("<u2") for n in draw.integers(1, 3 * window, 150)]
    docs += [docs[3]] * 5
    df = Counter(t for d in docs for t in set(d.tolist()))
    idf = np.array([math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) for t in range(401)])
    mean = sum(map(len, docs)) / len(docs)
    want = brute_shard(docs, df, len(docs), mean, window)
    got = packing.pack_shard(docs, packing.Corpus(idf, mean), window)
    assert got[:len(want) - 1] == want[:-1]
    tail = got[len(want) - 1:]
    lengths = [sum(n for _, _, n in s) for s in tail]
    assert sum(lengths) == sum(n for _, _, n in want[-1]) and all(n & n - 1 == 0 for n in lengths) and lengths == sorted(lengths, reverse=True)


def check(pieces, docs, library, window):
    """Every id in one piece, sequences without gaps, full or a power of two long."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    for places in by_sequence.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end and n > 0
            end += n
        assert end == window or end < window and end & end - 1 == 0
    want = Counter()
    for key, text in docs:
        want[key] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    assert {k: sum(p["length"] for p in ps) for k, ps in by_doc.items()} == dict(want)
    texts = dict(docs)
    for key, ps in by_doc.items():
        if sum(k == key for k, _ in docs) > 1:
            continue
        ids = np.array([*library.encode(texts[key] or "", add_special_tokens=False).ids, 1], "<u4")
        end = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == end and p["doc_tokens"] == len(ids)
            end += p["length"]
            assert bytes(p["ids"]) == ids[p["start"]:end].tobytes() and zlib.crc32(bytes(p["ids"])) == zlib.crc32(ids[p["start"]:end].tobytes())
        assert end == len(ids)


@pytest.mark.parametrize("shard_tokens", [500, 1 << 22])
def test_pack(spark, library, shard_tokens):
    docs = [(i, prose(i % 40, 10 + 7 * (i % 23))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id")
    pieces = packing.pack(frame, PATH, window=128, shard_tokens=shard_tokens).collect()
    check(pieces, docs, library, 128)


def test_odd_rows(spark, library):
    pieces = packing.pack(odd_documents(spark), PATH, window=256).collect()
    check(pieces, ODD, library, 256)
    assert packing.pack(odd_documents(spark).limit(0), PATH).collect() == []
    bare = packing.pack(spark.createDataFrame([(1, None), (2, ""), (3, "a")], "doc_id long, text string"), PATH, end=None).collect()
    assert [(p["doc_id"], p["length"]) for p in bare] == [(3, 1)]


def test_neighbours_share_words(spark):
    """A window is filled with what shares its seed's rare words before anything else."""
    topics = [t.split() for t in ("guitar piano violin melody concert rhythm", "bread butter flour oven recipe sugar",
                                  "doctor hospital nurse patient surgery fever", "football goalkeeper stadium referee league penalty")]
    docs = [(t * 10 + i, " ".join(topics[t][(i + j) % 6] for j in range(12)) + " of the and it") for i in range(8) for t in range(4)]
    pieces = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, window=68).collect()
    together = {}
    for p in pieces:
        together.setdefault(p["sequence_id"], []).append(p["doc_id"] // 10)
    pairs = [(a, b) for ts in together.values() for a, b in zip(ts[:1] * len(ts), ts[1:])]
    assert sum(a == b for a, b in pairs) >= 0.6 * len(pairs)


def test_letters_alone_are_not_split(monkeypatch):
    """Pieces of letters go to the library as they are; only the others are cut into pre-tokens before."""
    split, seen = pretokens._SPLIT, []
    monkeypatch.setattr(pretokens, "_SPLIT", lambda text: seen.append(text) or split(text))
    encoder = pretokens.Encoder(PATH)
    texts = ["one two three, four's größe ñandú x9 ªº µ", "three four größe, two\nlines it's 'll", "", "two", f"a {'long' * 30} end."]
    want = [encoder.library.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        assert [np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.encode_all(texts)] == want
    pieces = " ".join(seen).split(" ")
    assert "three," in pieces and not {"größe", "ñandú", "ªº", "µ", "long" * 30} & set(pieces)


def test_terms_and_sketches_are_those_of_distinct_ids():
    texts = ["the cat the cat the", "", None, "a b c a " * 300, "cat"]
    batch = pa.RecordBatch.from_pydict({"key": list(range(5)), "row": list(range(5)), "text": texts})
    made, counts = list(packing._tokenise(PATH, 1)(iter([batch, batch.slice(1, 2), batch.slice(0, 0)])))[::3]
    kind = pretokens.Encoder(PATH).kind
    own = [sorted(set(np.frombuffer(ids, kind)[:-1].tolist())) for ids in made.column("ids").to_pylist()]
    mixed = [[i * 2654435761 % 2**32 for i in ids] for ids in own]
    assert made.column("sketch").to_pylist() == [ids[m.index(min(m))] if ids else -1 for ids, m in zip(own, mixed)]
    held = dict(zip(counts.column("terms")[0].as_py(), counts.column("counts")[0].as_py()))
    assert held == {i: sum(i in ids for ids in own) for i in {i for ids in own for i in ids}}


def test_words_are_numbered_by_arrow_and_pieces_met_last_stay(library, monkeypatch):
    """Texts of a call share one numbering; what is remembered stays bounded and never changes the ids."""
    monkeypatch.setattr(pretokens, "REMEMBERED", 50)
    monkeypatch.setattr(pretokens, "JOINED", 3)
    monkeypatch.setattr(pretokens, "BLOCK", 30, raising=False)
    encoder = Encoder(PATH)
    draw, bits = np.random.default_rng(5), [
        "a", "The", "größe", "it's", "x9", "9", "'ll", "don't", "(b)", "end.\n", "\nNew", "a\nb", "c\n\nd", "", "\t", " ", "e ", "​", "日本",
        "é", "é", "́", "ªº", "ǀƻ", "½", "ß­ß", "\x1c", "\x85", "᠎", "\U0001f600", "٣", "word" * 20, "<|endoftext|>", "﻿", "_", "$5,0"]
    for _ in range(6):
        texts = [" ".join(draw.choice(bits, n)) for n in draw.integers(0, 12, 150)] + [f"w{k} new{chr(97 + k)}" for k in range(20)]
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
        assert encoder.encode_all(texts) == want
        assert 0 < len(encoder.pieces) <= 50
        assert encoder.encode_all(pa.array(texts).cast(pa.large_string()).slice(7)) == want[7:]
        assert max(map(len, encoder.pieces.to_pylist())) <= pretokens.LONG
    assert encoder.encode_all([]) == [] and encoder.encode_all(["", " "]) == [b"", np.array(library.encode(" ").ids, "<u2").tobytes()]


@pytest.mark.parametrize("together", [1, 40, 1 << 23])
def test_batches_encoded_together_stay_apart(together, monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", together, raising=False)
    calls, encode_all = [], Encoder.encode_all
    monkeypatch.setattr(Encoder, "encode_all", lambda self, texts: calls.append(len(texts)) or encode_all(self, texts))
    texts = [prose(i, 5) if i % 4 else None for i in range(11)]
    whole = pa.RecordBatch.from_pydict({"key": list(range(11)), "row": list(range(11)), "text": texts})
    batches = [whole.slice(0, 4), whole.slice(4, 0), whole.slice(4, 1), whole.slice(5)]
    made = list(packing._tokenise(PATH, 1)(iter(batches)))
    alone = [packing._tokenise(PATH, 1)(iter([b])) for b in batches]
    assert [b.num_rows for b in made] == [4, 0, 1, 6, 1]
    assert [b.to_pylist() for b in made[:4]] == [next(m).to_pylist() for m in alone]
    assert calls[0] == (11 if together > 40 else 4)
    assert list(packing._tokenise(PATH, 1)(iter([]))) == []
