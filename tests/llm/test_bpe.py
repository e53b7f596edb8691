import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from cases import ODD, odd_documents, plain, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourgrid.llm import bpe
from hourgrid.llm.common import prepare


def reference(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
PAIRS = {f: (bpe.Codec(bpe.serialise(bpe.read_ranks(P.path(f))), P.PATTERN), reference(f)) for f in FILES}


@pytest.mark.parametrize("file", FILES)
@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_same_ids_and_round_trip(file, text):
    codec, other = PAIRS[file]
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_memory_of_a_worker_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec, other = bpe.Codec(bpe.serialise(bpe.read_ranks(P.path(FILES[0]))), P.PATTERN), PAIRS[FILES[0]][1]
    for i in range(30):
        assert np.frombuffer(codec.encode(prose(i, 60)), "<u4").tolist() == other.encode_ordinary(prose(i, 60))
        assert len(codec.known) <= 120


def test_rank_files_are_checked(tmp_path):
    (tmp_path / "gap").write_text("YQ== 0\nYg== 2\n")
    (tmp_path / "few").write_text("YQ== 0\nYg== 1\n")
    for name in ("gap", "few"):
        with pytest.raises(ValueError):
            bpe.read_ranks(str(tmp_path / name))


def test_columns(spark):
    prepare(spark)
    model = bpe.serialise(bpe.read_ranks(P.path(FILES[0])))
    docs = odd_documents(spark)
    out, name = bpe.digests(docs, model, P.PATTERN)
    rows = out.select("text", f"{name}.*").collect()
    assert len(rows) == len(ODD) and set(docs.columns) < set(out.columns)
    for r in rows:
        ids = PAIRS[FILES[0]][1].encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    ids = docs.select("text", bpe.encode(F.col("text"), model, P.PATTERN).alias("ids"))
    for r in ids.select("text", "ids", bpe.decode(F.col("ids"), model, P.PATTERN).alias("back")).collect():
        assert bytes(r["back"]) == (r["text"] or "").encode()
    assert plain(bpe.digests(docs.limit(0), model, P.PATTERN)[0]) == []
