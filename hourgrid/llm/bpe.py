"""Byte-level BPE through sentencepiece.

The rank file becomes a sentencepiece BPE model: one piece per token, its bytes mapped to printable characters,
its score the negative rank, no normalisation and no dummy prefix. A text is split by the pattern, each
pre-token is encoded on its own, and ids are decoded by the inverse mapping of their pieces.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hourgrid.llm.common import col, fresh

#: Encoded pre-tokens a worker remembers; beyond that it starts anew. Results do not depend on it.
REMEMBERED = 400_000
#: Pre-tokens longer than this are encoded but not remembered.
LONG = 64
#: A batch costs sentencepiece as much as so many calls for one pre-token each.
FEW = 24
GROUP = 1 << 20


def byte_letters() -> list[str]:
    """The printable character of each byte: itself where it prints, else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else spare))
        spare += b not in plain
    return letters


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which have to run from 0 without gaps."""
    ranks: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    tokens = [ranks.get(i) for i in range(len(ranks))]
    if None in tokens or len(set(tokens)) != len(tokens):
        raise ValueError(f"{path}: ranks with gaps or repeated tokens")
    if missing := [b for b in range(256) if bytes([b]) not in set(tokens)]:
        raise ValueError(f"{path}: no token for the bytes {missing[:5]}")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer: bytes, a 32-bit float or a whole number."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model of the tokens; ids are ranks, and the unknown piece it asks for comes last."""
    letters = byte_letters()
    model = b"".join(_field(1, _field(1, "".join(letters[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, 1))
                     for rank, token in enumerate(tokens))
    unknown = len(tokens)
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    no = (1 << 64) - 1  # -1: there is no such piece
    trainer = _field(3, 2) + _field(4, unknown + 1) + _field(40, unknown) + _field(41, no) + _field(42, no) + _field(43, no)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return model + _field(2, trainer) + _field(3, normaliser)


def grouped(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts (null: empty) in groups of about ``GROUP`` characters, whose pre-tokens are learnt together."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(text or "")
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encodes and decodes with one serialised model; a worker holds one."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        inverse = {c: b for b, c in self.letters.items()}
        self.tokens = [bytes(inverse[c] for c in self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size() - 1)]
        #: a pre-token that is itself a token stays whole, whatever the merges would make of it
        self.whole = {token: struct.pack("<I", i) for i, token in enumerate(self.tokens)}
        self.known: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Encoded forms of pre-tokens that are not remembered."""
        found, rest, raw = {}, [], []
        for part in parts:
            data = part.encode()
            if data in self.whole:
                found[part] = self.whole[data]
            else:
                rest.append(part)
                raw.append(data)
        mapped = b"".join(raw).decode("latin-1").translate(self.letters)
        ends = list(accumulate(map(len, raw), initial=0))
        pieces = [mapped[i:j] for i, j in zip(ends, ends[1:])]
        encode = self.pieces.encode
        all_ids = encode(pieces, num_threads=1) if len(pieces) >= FEW else map(encode, pieces)
        for part, ids in zip(rest, all_ids):
            found[part] = _pack(ids)
        return found

    def forms(self, texts: list[list[str]]) -> list[list[bytes]]:
        """The encoded form of each pre-token of each text."""
        known = self.known
        try:
            return [[known[part] for part in parts] for parts in texts]
        except KeyError:
            new = self._learn({part for parts in texts for part in parts if part not in known})
            if len(known) + len(new) > REMEMBERED:
                known = {part: known[part] for parts in texts for part in parts if part in known}
                self.known = {}
            self.known.update({part: ids for part, ids in new.items() if len(part) <= LONG})
            return [[new[part] if part in new else known[part] for part in parts] for parts in texts]

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit numbers; a null text has none."""
        return b"".join(self.forms([self.split(text or "")])[0])

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for group in grouped(texts):
            yield from map(b"".join, self.forms([self.split(text) for text in group]))

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_DIGESTS = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                       StructField("decoded_sha256", StringType())])


def _apply(model: bytes, pattern: str, kind, one):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(model, pattern)
        for values in batches:
            yield pd.Series([one(codec, v) for v in values], dtype=object)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)


def encode(text: Column, model: bytes, pattern: str) -> Column:
    """The ids of a text, an array of longs; null and empty texts have none."""
    return _apply(model, pattern, "array<bigint>", lambda c, t: np.frombuffer(c.encode(t), "<u4").astype("int64"))(text)


def decode(ids: Column, model: bytes, pattern: str) -> Column:
    """The bytes behind an array of ids; null ids decode to null."""
    return _apply(model, pattern, "binary",
                  lambda c, v: None if v is None else c.decode(np.asarray(v, "<u4").tobytes()))(ids)


def _digests(model: bytes, pattern: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(model, pattern)
        for texts in batches:
            rows = []
            for ids in codec.encode_all(texts):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=_DIGESTS.names)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, _DIGESTS)


def digests(docs: DataFrame, model: bytes, pattern: str, text: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (or the columns ``carry``) with a struct of token count and digests of ids and decoded bytes.

    Every row is encoded and decoded on its own, so repeated rows come out alike and an empty table stays
    empty; null and empty texts have no tokens, very long ones are encoded whole. Columns of ``docs`` keep their names; the struct's name, which is
    returned too, avoids them.
    """
    name = fresh(docs.columns, "tokens")[0]
    kept = [col(docs, c) for c in (docs.columns if carry is None else carry)]
    return docs.select(*kept, _digests(model, pattern)(col(docs, text)).alias(name)), name
