"""Quality rules that vote, weighed by expectation-maximisation.

Each rule looks at a few counts of a document and votes good, bad or abstains. How far each rule can be
trusted is estimated without labels: the hidden class and the rules' accuracies are fitted to the counts
of vote patterns over all documents. A document is kept by its posterior probability of being good, not
by passing every rule.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hourgrid.llm.common import col, columns, fresh
from hourgrid.session import materialise

_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_SPACES = [9, 10, 11, 12, 13, 32]
_ENDS = re.compile(rb"[.?!](?=[\x20\x09-\x0d]|\Z)")
_DOUBLED = frozenset(bytes([c, c]) for c in b"#*$%&|<>!?~=+^@_")
#: Function words of the languages the rules know; a rule abstains where it finds none.
FUNCTION_WORDS = frozenset((
    "the and of to in that is was for it with as be on by are this an or from at "
    "der die und das ist von zu mit den im ein auf für nicht auch "
    "de la le et les des que en un une dans pour est au sur par "
    "el los las con se del una y al su").encode().split())

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_letters", "n_function", "n_twins", "n_ends", "n_marked", "n_distinct"]


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text; a null text has none of anything."""
    if not text:
        return (0,) * len(COUNTS + EXTRA)
    raw = text.encode()
    codes = np.frombuffer(raw, np.uint8)
    by_code = np.bincount(codes, minlength=256)
    words = raw.split()
    n = len(words)
    times = Counter(words)
    function = marked = 0
    for word, count in times.items():
        if word.lower() in FUNCTION_WORDS:
            function += count
        if word[-2:] in _DOUBLED or word == b"|":
            marked += count
    lines = [line for line in raw.split(b"\n") if line.strip()]
    upper = int(by_code[65:91].sum())
    if by_code[0xC3]:  # capitals with accents: U+00C0 to U+00DE
        upper += int(((codes[:-1] == 0xC3) & (codes[1:] < 0x9F)).sum())
    letters = int(by_code[65:91].sum() + by_code[97:123].sum() + by_code[0xC3:].sum())
    return (n, len(text) - int(by_code[_SPACES].sum()), int(by_code[_SYMBOLS].sum()), len(lines) - len(set(lines)),
            _repeated(words), len(lines), upper, letters, function, sum(map(bytes.__eq__, words, words[1:])),
            len(_ENDS.findall(raw)), marked, len(times))


def _repeated(words: list[bytes]) -> int:
    """How many words lie in a window of three that occurs more than once."""
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered = end = 0  # words before ``end`` are counted already
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


@F.pandas_udf(StructType([StructField(c, LongType()) for c in COUNTS + EXTRA]))
def measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=COUNTS + EXTRA, dtype="int64")


def votes(f: Column) -> dict[str, Column]:
    """Each rule's vote on the counts ``f``: 1 good, 0 bad, null abstains."""
    n = f["n_words"]

    def rule(good: Column, bad: Column) -> Column:
        return F.when(n < 1, 0).when(bad, 0).when(good, 1)

    return {
        "symbols": rule(f["n_symbols"] * 50 < n, f["n_symbols"] * 10 > n),
        "marked_words": rule(f["n_marked"] * 100 < n, f["n_marked"] * 10 > n),
        "repeated_windows": rule(f["n_repeat_words"] * 5 < n, f["n_repeat_words"] * 2 > n),
        "twin_words": rule(f["n_twins"] * 20 < n, f["n_twins"] * 10 > n),
        "repeated_lines": rule(f["n_dup_lines"] * 5 < f["n_lines"], f["n_dup_lines"] * 2 > f["n_lines"]),
        "capitals": rule(f["n_upper"] * 5 < f["n_letters"], f["n_upper"] * 3 > f["n_letters"]),
        "word_length": rule((f["word_chars"] >= 3 * n) & (f["word_chars"] <= 8 * n),
                            (f["word_chars"] < 2 * n) | (f["word_chars"] > 14 * n)),
        "function_words": rule(f["n_function"] * 12 > n, (f["n_function"] * 100 < n) & (n >= 100)),
        "letters": rule(f["n_letters"] * 10 > f["word_chars"] * 8, f["n_letters"] * 10 < f["word_chars"] * 6),
        "variety": rule(f["n_distinct"] * 4 > n, f["n_distinct"] * 10 < n),
    }


#: P(good, bad, no vote) of a rule before any document was seen, for good and for bad documents. Bad documents
#: are bad in one way or another, so most rules still pass them.
START = {True: (0.85, 0.01, 0.14), False: (0.65, 0.25, 0.10)}


@dataclass
class Votes:
    """What EM has learnt: the share of good documents, and per class and rule P(good, bad, no vote)."""

    prior: float
    chances: dict[bool, dict[str, tuple[float, float, float]]]
    rounds: int = 0

    def weights(self) -> dict[str, tuple[float, float, float]]:
        """Log odds that a good, a bad and no vote of each rule add."""
        return {r: tuple(math.log(g / b) for g, b in zip(self.chances[True][r], self.chances[False][r]))
                for r in self.chances[True]}

    def start(self) -> float:
        return math.log(self.prior / (1 - self.prior))

    def posterior(self, pattern: dict[str, int | None]) -> float:
        weights = self.weights()
        odds = self.start() + sum(weights[r][_PLACE[v]] for r, v in pattern.items())
        return 1 / (1 + math.exp(-max(min(odds, 700.0), -700.0)))


_PLACE = {1: 0, 0: 1, None: 2}


def fit(patterns: list[tuple[tuple, int]], names: list[str], rounds: int = 200, tolerance: float = 1e-9,
        strength: float = 20.0) -> Votes:
    """EM over the counts of vote patterns, starting from and drawn towards ``START``.

    There are at most 3 ** rules patterns however many documents there are. The start counts as ``strength``
    documents of each class. A rule's bad vote must stay likelier for bad documents than for good ones, so
    the classes cannot change places. Without documents the start values stay.
    """
    model = Votes(0.8, {c: dict.fromkeys(names, START[c]) for c in START})
    total = sum(count for _, count in patterns)
    for step in range(rounds if total else 0):
        sums = {c: {r: [strength * x for x in START[c]] for r in names} for c in START}
        mass = 0.0
        for pattern, count in patterns:
            p = model.posterior(dict(zip(names, pattern)))
            mass += p * count
            for r, vote in zip(names, pattern):
                sums[True][r][_PLACE[vote]] += p * count
                sums[False][r][_PLACE[vote]] += (1 - p) * count
        chances = {c: {r: tuple(x / sum(s) for x in s) for r, s in by_rule.items()} for c, by_rule in sums.items()}
        for r in names:
            good, bad = chances[True][r], chances[False][r]
            if good[1] * 2 > bad[1]:  # such a rule tells nothing
                chances[True][r] = chances[False][r] = tuple((x + y) / 2 for x, y in zip(good, bad))
        prior = min(max((mass + 0.8 * strength) / (total + strength), 0.05), 0.99)
        moved = abs(prior - model.prior) + sum(
            abs(x - y) for c in START for r in names for x, y in zip(chances[c][r], model.chances[c][r]))
        model = Votes(prior, chances, step + 1)
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5, carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct of counts, votes, ``base_failed``, ``p_good`` and ``kept``; and that struct's column name.

    ``carry`` names the columns to keep (all by default). The counts are written once to the shared folder, since
    the fit and the decision both need them. Null and empty texts have no words, fail the base rule and are
    not kept; very long ones are counted whole. Repeated rows each get their own verdict; an empty table stays empty; columns of ``docs`` keep
    their names and values, the struct's name avoids them.
    """
    name = fresh(docs.columns, "quality")[0]
    kept_columns = columns(docs) if carry is None else [col(docs, c) for c in carry]
    counted = materialise(docs.select(*kept_columns, measured(col(docs, text)).alias(name)), "quality")
    f = F.col(name)
    rules = votes(f)
    names = list(rules)
    seen = counted.select(*[v.alias(r) for r, v in rules.items()]).groupBy(*names).count().collect()
    model = fit(sorted(((tuple(r[:-1]), r[-1]) for r in seen), key=str), names)
    odds = F.lit(model.start())
    for r, (good, bad, none) in model.weights().items():
        odds = odds + F.when(rules[r] == 1, good).when(rules[r] == 0, bad).otherwise(none)
    failed = (f["n_words"] < 50) | (f["n_repeat_words"] * 100 > f["n_words"] * 50)
    p_good = 1 / (1 + F.exp(-odds))
    fields = [f[c].alias(c) for c in COUNTS + EXTRA]
    out = counted.withColumn(name, F.struct(
        *fields, *[v.alias(f"vote_{r}") for r, v in rules.items()], failed.alias("base_failed"),
        p_good.alias("p_good"), (~failed & (p_good >= threshold)).alias("kept")))
    return out, name


def accepted(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    judged, name = judge(docs, text, threshold)
    return judged.where(F.col(name)["kept"]).drop(name)
