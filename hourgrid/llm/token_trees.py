"""Token counts that follow edits.

A document keeps a segment tree over runs of its pre-tokens; each node holds the characters and tokens below
it. An edit finds its leaves by descending over characters, splits and encodes the text again from a little before
the edit to the first old leaf border that the new split meets, and updates the sums above those leaves.
The split only looks ahead, by at most one character behind a pre-token, so from such a border on it is the old one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.bpe import Codec, grouped
from hourgrid.llm.common import col

#: Pre-tokens of a fresh leaf; a leaf that grows beyond four times that is split.
LEAF = 16
TREE = "struct<chars:array<bigint>,tokens:array<bigint>>"
#: Characters that a pre-token's end may depend on.
AHEAD = 2


class Tree:
    """Sums in heap order: node 1 is the root, the leaves are the last half."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.half = len(chars) // 2

    @classmethod
    def of(cls, leaves: list[tuple[int, int]]) -> Tree:
        half = 1 << max(len(leaves) - 1, 0).bit_length()
        tree = cls([0] * (2 * half), [0] * (2 * half))
        for i, (chars, tokens) in enumerate(leaves):
            tree.chars[half + i], tree.tokens[half + i] = chars, tokens
        for i in range(half - 1, 0, -1):
            tree._sum(i)
        return tree

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf of a character and the leaf's start; the last leaf with text for the end of the text."""
        node, start = 1, 0
        position = min(position, self.chars[1] - 1) if self.chars[1] else 0
        while node < self.half:
            node *= 2
            if position - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.half, start

    def put(self, first: int, leaves: list[tuple[int, int]]) -> None:
        """Replace the leaves from ``first`` on and the sums above them."""
        for i, (chars, tokens) in enumerate(leaves, self.half + first):
            self.chars[i], self.tokens[i] = chars, tokens
        low, high = self.half + first, self.half + first + len(leaves) - 1
        while low > 1:
            low, high = low // 2, high // 2
            for i in range(low, high + 1):
                self._sum(i)

    def leaves(self) -> list[tuple[int, int]]:
        return list(zip(self.chars[self.half:], self.tokens[self.half:]))


def _measure(codec: Codec, texts: list[list[str]]) -> list[list[tuple[int, int]]]:
    """Characters and tokens of the pre-tokens of each text."""
    return [[(len(part), len(form) // 4) for part, form in zip(parts, forms)] for parts, forms in zip(texts, codec.forms(texts))]


def _group(sizes: list[tuple[int, int]], into: int) -> list[tuple[int, int]]:
    """``sizes`` summed to ``into`` leaves of about equal numbers of pre-tokens; some may be empty."""
    cuts = [len(sizes) * k // into for k in range(into + 1)]
    return [(sum(c for c, _ in sizes[a:b]), sum(t for _, t in sizes[a:b])) for a, b in zip(cuts, cuts[1:])]


def grow(codec: Codec, texts: Iterable[str | None]) -> Iterator[Tree]:
    """The tree of each text."""
    for group in grouped(texts):
        for sizes in _measure(codec, [codec.split(text) for text in group]):
            yield Tree.of(_group(sizes, -(-len(sizes) // LEAF) or 1))


def edit(codec: Codec, finditer, text: str, tree: Tree, start: int, end: int, new: str) -> tuple[str, Tree, int]:
    """Replace ``text[start:end]`` by ``new``: the text, its tree and how many characters were encoded again."""
    if start == end and not new:
        return text, tree, 0
    changed = text[:start] + new + text[end:]
    moved, settled = len(new) - (end - start), start + len(new)
    first, begin = tree.leaf_at(max(start - AHEAD, 0))
    last, border = tree.leaf_at(end)
    border += tree.chars[tree.half + last]  # where the last touched leaf ended before the edit
    parts, at = [], begin
    for match in finditer(changed, pos=begin):
        parts.append(match[0])
        at = match.end()
        if at >= settled:
            while border < at - moved and last + 1 < tree.half:
                last += 1
                border += tree.chars[tree.half + last]
            if border == at - moved:
                break
    else:
        while border < len(text):
            last += 1
            border += tree.chars[tree.half + last]
    sizes, old = _measure(codec, [parts])[0], last - first + 1
    if len(sizes) <= 4 * LEAF * old:
        tree.put(first, _group(sizes, old))
    else:
        leaves = tree.leaves()
        leaves[first:last + 1] = _group(sizes, -(-len(sizes) // LEAF))
        tree = Tree.of([leaf for leaf in leaves if leaf[0]])
    return changed, tree, at - begin


def _columns(trees: list[Tree]) -> dict[str, list[np.ndarray]]:
    return {"chars": [np.array(t.chars, np.int64) for t in trees], "tokens": [np.array(t.tokens, np.int64) for t in trees]}


def trees(text: Column, model: bytes, pattern: str) -> Column:
    """The segment tree of each text; null and empty texts have one empty leaf."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(model, pattern)
        for texts in batches:
            yield pd.DataFrame(_columns(list(grow(codec, texts))))
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, TREE)(text)


def n_tokens(tree: Column) -> Column:
    """The count is the root's sum."""
    return F.get(tree["tokens"], F.lit(1))


def _patched(codec: Codec, finditer, text: str, tree: Tree, patch) -> tuple[str, Tree, int]:
    encoded = 0
    for start, end, new in ordered(patch, len(text)):
        text, tree, again = edit(codec, finditer, text, tree, start, end, new)
        encoded += again
    return text, tree, encoded


def edited(text: Column, tree: Column, edits: Column, model: bytes, pattern: str) -> Column:
    """``text``, ``chars``, ``tokens`` (the new tree) and ``encoded`` (characters encoded again) after ``edits``.

    ``edits`` is an array of ``start, end, new`` in characters of the unedited text, as one patch: they may come in any order,
    and insertions at one place go in by their order. Of overlapping edits the one that begins first takes its characters, the
    other those behind them. Null arrays and null members change nothing; bounds are clipped to the text.
    ``pattern`` must look no further than ``AHEAD - 1`` characters behind a pre-token, as ``public_tokenizers.PATTERN`` does;
    one such as ``\\s*[\\r\\n]+``, which looks for a line end behind any number of blanks, gives counts that may be wrong.
    """
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        codec, finditer = Codec(model, pattern), regex.compile(pattern).finditer
        for texts, kept, patches in batches:
            done = [_patched(codec, finditer, text or "", Tree(chars.tolist(), tokens.tolist()), patch)
                    for text, chars, tokens, patch in zip(texts, kept["chars"], kept["tokens"], patches)]
            yield pd.DataFrame({"text": [d[0] for d in done], **_columns([d[1] for d in done]), "encoded": [d[2] for d in done]})
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "text string, chars array<bigint>, tokens array<bigint>, encoded long")(text, tree, edits)


def ordered(patch, length: int) -> list[tuple[int, int, str]]:
    """The edits of a patch from the last to the first, so that each leaves the places of the others alone.

    Where edits overlap, the one that begins first (then ends first, then stands first) takes its characters; the other takes
    what is left behind them, so its new text follows.
    """
    clipped = []
    for i, one in enumerate(patch if patch is not None else []):
        if one is not None and one["start"] is not None:
            start = min(max(int(one["start"]), 0), length)
            end = start if one["end"] is None else min(max(int(one["end"]), start), length)
            clipped.append((start, end, i, one["new"] or ""))
    apart, reached = [], 0
    for start, end, _, new in sorted(clipped):
        start = max(start, reached)
        reached = max(end, start)
        apart.append((start, reached, new))
    return apart[::-1]


def recount(docs: DataFrame, edits: Column, model: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``tree`` and ``edited``: the tree of each row of ``docs`` and the result of its ``edits``, a column over ``docs``.

    Rows stand for themselves, also where keys repeat or are null; an empty table stays empty, other columns are left out. Trees can be
    written and read like any column, and ``edited`` (the function) takes them up again; here both steps are done by
    one function, so that a text goes to Python once.
    """
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        codec, finditer = Codec(model, pattern), regex.compile(pattern).finditer
        for texts, patches in batches:
            grown, done = [], []
            for one, tree, patch in zip(texts, grow(codec, texts), patches):
                grown.append(Tree(list(tree.chars), list(tree.tokens)))
                done.append(_patched(codec, finditer, one or "", tree, patch))
            new = _columns([d[1] for d in done])
            yield pd.DataFrame({**_columns(grown), "text": [d[0] for d in done], "new_chars": new["chars"], "new_tokens": new["tokens"],
                                "encoded": [d[2] for d in done]})
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    made = F.pandas_udf(run, "chars array<bigint>, tokens array<bigint>, text string, new_chars array<bigint>, new_tokens array<bigint>, encoded long")
    out = docs.select(col(docs, key).alias(key), made(col(docs, text), edits).alias("made"))
    return out.select(key, F.struct("made.chars", "made.tokens").alias("tree"), F.struct(
        "made.text", F.col("made.new_chars").alias("chars"), F.col("made.new_tokens").alias("tokens"), "made.encoded").alias("edited"))
