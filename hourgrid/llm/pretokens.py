"""Ids of the `tokenizers` library for whole texts, with what repeats encoded once.

A text is cut at single blanks between two visible characters. The byte-level pattern never matches across such a
cut, as the blank belongs to what follows, so the pieces are encoded apart and their ids are joined. Pieces seen
before are looked up; of new ones only the new words go to the library, many of them as lines of one text. Pieces stay
Arrow arrays: one call numbers those of many texts, and only the different new ones are looked at by themselves.
"""

from __future__ import annotations

import codecs
import itertools
import os
import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

#: Encoded pieces that a worker remembers, those met last. Results do not depend on it.
REMEMBERED = 500_000
#: Longer pieces are encoded but not remembered.
LONG = 40
#: New words that go to the library as one text.
JOINED = 250
#: Characters that go to the library in one call, about: what it returns takes much more memory than the ids.
BLOCK = 1 << 18
_STATE = "hourgrid_worker_state"
# Fixed value: the pattern of byte-level pre-tokens.
_SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""").findall
#: Visible characters that are the same in all versions of Unicode that libraries carry.
_LATIN = "!-~¡-¬®-ɏ"
_PLAIN = rf"^[{_LATIN}](?:[{_LATIN}\n]*[{_LATIN}])?$"
_LETTERS = f"^[{''.join(filter(str.isalpha, map(chr, range(0x250))))}]+$"
#: A blank at an end of the text or beside a character that may be invisible to some library.
_UNSAFE = r"(?:^|[^\pL\pM\pN\pP\pS]) | (?:$|[^\pL\pM\pN\pP\pS])"
#: Byte-level vocabularies write a byte as the character of its number if that is visible, the others as those from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [byte for byte in range(256) if byte not in _SHOWN]
_WRITTEN = "".join(chr(byte if byte in _SHOWN else 256 + _HIDDEN.index(byte)) for byte in range(256))
#: The same, with line ends kept.
_LINES = _WRITTEN.replace(_WRITTEN[10], "\n")


def once_per_worker(name: Any, make: Callable[[], Any]) -> Any:
    """``make()``, built once in a Python worker and kept for its later tasks."""
    state = sys.modules.setdefault(_STATE, ModuleType(_STATE)).__dict__
    if name not in state:
        state[name] = make()
    return state[name]


def _visible(char: str) -> bool:
    return char.isalnum() or (char != "" and char.isprintable() and not char.isspace())


def _units(pieces: list[str]) -> list[str]:
    """The pieces of a text, joined again where the cut between two of them is not safe."""
    units, safe = [pieces[0]], _visible(pieces[0][-1:])
    for piece in pieces[1:]:
        if safe and _visible(piece[:1]):
            units.append(piece)
        else:
            units[-1] += " " + piece
        safe = _visible(piece[-1:])
    return units


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Consecutive parts of ``data``, given where they end in bytes."""
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _parts(forms: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array that was just made, and where each value begins and the last one ends."""
    _, offsets, data = forms.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int32)[:len(forms) + 1]


def _where(mask: pa.BooleanArray) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


class Encoder:
    """Encodes texts with the vocabulary file at ``path``, special strings as ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core already
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        #: bytes behind each id: the vocabulary writes one character per byte
        self.bytes = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        # the same vocabulary for words that are cut already and written in its own characters, one a line
        self.by_line = Tokenizer.from_file(path)
        self.by_line.encode_special_tokens = True
        self.by_line.pre_tokenizer = Split("\n", "removed")
        #: pieces, their ids with a blank before them, and the call that met them last
        self.pieces = pa.array([], pa.string())
        self.forms = pa.array([], pa.binary())
        self.met = np.zeros(0, np.int64)
        self.calls = 0

    def _encode(self, texts: list[str]) -> pa.BinaryArray:
        kind, out = self.kind, []
        blocks = (np.cumsum([0, *map(len, texts)])[:-1] // BLOCK).tolist()
        for _, some in itertools.groupby(zip(blocks, texts), lambda pair: pair[0]):
            made = self.library.encode_batch_fast([text for _, text in some], add_special_tokens=False)
            out += [np.array(e.ids, kind).tobytes() for e in made]
        return pa.array(out, pa.binary())

    def _encode_words(self, words: pa.StringArray, before: str = "") -> pa.BinaryArray:
        """Ids of words that are one pre-token each, ``before`` included, and have no line end: many go as lines of one
        text, whose ids are cut again where the bytes of a word end."""
        if not len(words):
            return pa.array([], pa.binary())
        at = np.append(np.arange(0, len(words), JOINED), len(words))
        made, ends, past = [], [], 0
        for line, n in zip(pc.binary_join(pa.ListArray.from_arrays(at.astype(np.int32), words), "\n" + before).to_pylist(), np.diff(at).tolist()):
            written = (before + line).encode()
            lines = codecs.charmap_decode(written, "strict", _LINES)[0]
            ids = np.array(self.by_line.encode_batch_fast([lines], add_special_tokens=False)[0].ids, self.kind)
            end = np.append(np.flatnonzero(np.frombuffer(written, np.uint8) == 10), len(written)) - np.arange(n)
            ends.append(np.searchsorted(np.cumsum(self.bytes[ids]), end) + 1 + past)
            made.append(ids)
            past += len(ids)
        return _binary(np.concatenate(made), np.concatenate(ends) * self.kind.itemsize)

    def _encode_mixed(self, pieces: pa.StringArray, known: pa.StringArray, forms: pa.BinaryArray) -> pa.BinaryArray:
        """Ids of plain pieces that may be several pre-tokens, the first one with a blank before it."""
        if not len(pieces):
            return pa.array([], pa.binary())
        # plain pieces have no blank inside, so a pre-token that begins with one begins a piece
        tokens = pa.array(_SPLIT(" " + " ".join(pieces.to_pylist())), pa.string()).dictionary_encode()
        places, tokens = tokens.indices.to_numpy(), tokens.dictionary
        opens = _where(pc.starts_with(tokens, " "))
        heads, tails = pc.utf8_slice_codeunits(tokens.filter(opens), 1), tokens.filter(~opens)
        at = pc.index_in(heads, known)
        blank = _where(pc.utf8_is_space(tails))
        made = pa.concat_arrays([forms, self._encode_words(heads.filter(at.is_null()), " "), self._encode_words(tails.filter(~blank)),
                                 self._encode(tails.filter(blank).to_pylist())])
        # new words stand behind the known ones, in the order in which they were encoded
        numbers, new = np.empty(len(tokens), np.int64), _where(at.is_null())
        row = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row[new] = len(forms) + np.arange(new.sum())
        numbers[opens] = row
        order = np.empty(len(tails), np.int64)
        order[~blank] = np.arange((~blank).sum())
        order[blank] = (~blank).sum() + np.arange(blank.sum())
        numbers[~opens] = len(forms) + new.sum() + order
        data, begin = _parts(made.take(pa.array(numbers[places])))
        return _binary(data, np.append(begin[np.flatnonzero(opens[places])[1:]], begin[-1]))

    def _learn(self, pieces: pa.StringArray) -> pa.BinaryArray:
        """Ids of different new pieces, each with the blank before it."""
        letters, plain = _where(pc.match_substring_regex(pieces, _LETTERS)), _where(pc.match_substring_regex(pieces, _PLAIN))
        # letters alone are one pre-token with the blank before them
        words = pieces.filter(letters)
        forms = self._encode_words(words, " ")
        mixed = self._encode_mixed(pieces.filter(plain & ~letters), pa.concat_arrays([self.pieces, words]), pa.concat_arrays([self.forms, forms]))
        rest = self._encode([" " + piece for piece in pieces.filter(~plain).to_pylist()])
        back = np.empty(len(pieces), np.int64)
        back[np.concatenate([np.flatnonzero(x) for x in (letters, plain & ~letters, ~plain)])] = np.arange(len(pieces))
        return pa.concat_arrays([forms, mixed, rest]).take(pa.array(back))

    def encode_all(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        """The ids of each text as little-endian numbers of ``kind``; an empty text has none."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        self.calls += 1
        split, hard = pc.split_pattern(texts, " "), _where(pc.match_substring_regex(texts, _UNSAFE))
        if hard.any():
            units = [_units(text.split(" ")) for text in texts.filter(hard).to_pylist()]
            split = pa.concat_arrays([split.filter(~hard), pa.array(units, split.type)])
        bounds = split.offsets.to_numpy()
        numbered = pa.concat_arrays([self.pieces, split.values]).dictionary_encode()
        pieces, old = numbered.dictionary, len(self.pieces)
        rows = numbered.indices.to_numpy()[old:].copy()
        # the first piece of a text has no blank before it
        first, at = np.unique(rows[bounds[:-1]], return_inverse=True)
        rows[bounds[:-1]] = len(pieces) + at
        used = np.zeros(len(pieces) + len(first), np.bool_)
        used[rows] = True
        used = used[:len(pieces)]
        new = np.flatnonzero(used[old:]) + old
        number = np.arange(len(pieces) + len(first))
        number[new] = old + np.arange(len(new))
        number[len(pieces):] = old + len(new) + np.arange(len(first))
        learnt = pieces.take(pa.array(new))
        forms = pa.concat_arrays([self.forms, self._learn(learnt)])
        opening = self._encode(pieces.take(pa.array(first)).to_pylist())
        data, begin = _parts(pa.concat_arrays([forms, opening]).take(pa.array(number[rows])))
        self._remember(pa.concat_arrays([self.pieces, learnt]), forms, used[:old])
        begin, data = begin[bounds].tolist(), data.tobytes()
        out = [data[a:b] for a, b in zip(begin, begin[1:])]
        if not hard.any():
            return out
        order = np.argsort(np.append(np.flatnonzero(~hard), np.flatnonzero(hard))).tolist()
        return [out[i] for i in order]

    def _remember(self, pieces: pa.StringArray, forms: pa.BinaryArray, again: np.ndarray) -> None:
        """What the next call looks up: short pieces, and of too many the ones met last."""
        old = len(again)
        self.met[again] = self.calls
        met = np.append(self.met, np.full(len(pieces) - old, self.calls))
        keep = np.ones(len(pieces), np.bool_)
        keep[old:] = _where(pc.less_equal(pc.utf8_length(pieces[old:]), LONG))
        if keep.sum() > REMEMBERED:
            keep[np.argpartition(np.where(keep, -met, 1), REMEMBERED)[REMEMBERED:]] = False
        if not keep.all():
            pieces, forms, met = pieces.filter(keep), forms.filter(keep), met[keep]
        self.pieces, self.forms, self.met = pieces, forms, met
