"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits and signs that stand for letters), an Aho-Corasick
automaton finds lexicon stems at word starts, hits inside exception phrases do not count, and the summed
weights are normalised by the number of words. Weights, exceptions and the curve that turns the normalised
sum into a probability are learnt from labelled documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import ahocorasick
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from hourgrid.llm.common import col, fresh
from hourgrid.session import materialise

#: Stems and weights that hold until labelled documents say otherwise.
SEEDS = {stem: 4.0 for stem in (
    "idiot moron imbecile stupid dumbass loser scum worthless pathetic disgusting asshole bastard bitch "
    "retard cretin vermin filth scumbag dickhead shithead jackass").split()}
#: Phrases in which a stem is meant harmlessly.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "sore loser award")

# Letters of other scripts that look like Latin ones, then digits and signs used as letters. The letters i and l
# and all that looks like them become i, in texts and in the lexicon alike.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "i", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "γ": "y", "σ": "o", "ω": "w", "ı": "i", "ł": "i", "ø": "o", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "i", "ɴ": "n", "ʀ": "r",
    "l": "i", "1": "i", "!": "i", "|": "i", "0": "o", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b", "9": "g",
}
_SIGNS = {ord(c): _LOOKALIKES[c] for c in "@$!|"}
_RUN = re.compile(r"[@$!|]+")
_LETTER = re.compile(r"\d*[^\W\d_]")


class _Marks(dict):
    """Marks, joiners and soft hyphens vanish, of all of Unicode; other characters stay."""

    def __missing__(self, code: int) -> int | None:
        self[code] = None if unicodedata.category(chr(code)) in ("Mn", "Me", "Cf") else code
        return self[code]


class _Fold(dict):
    """Marks vanish, what is neither letter nor digit becomes a space, look-alikes become letters."""

    def __missing__(self, code: int) -> int | str | None:
        kind = unicodedata.category(chr(code))
        made: int | str | None = code
        if kind in ("Mn", "Me", "Cf"):
            made = None
        elif kind[0] not in "LN":
            made = " "
        elif code >= 0x100 and ord(plain := unicodedata.normalize("NFKD", chr(code))[0]) < 0x80:
            made = _LOOKALIKES.get(plain.lower(), plain.lower())
        self[code] = made
        return made


_MARKS = _Marks()
_FOLD = _Fold({ord(a): b for a, b in _LOOKALIKES.items() if a not in "@$!|"})


def forms(text: str | None) -> list[str]:
    """``fold(text)`` and the other readings of its signs, all of one length.

    Runs of signs inside a word, before one and behind one are letters in some forms and spaces in others, so that
    ``$tupid``, ``a$$`` and ``@sshole`` are met as well as ``@idiot`` and ``idiot!``. Signs at plain numbers are spaces.
    """
    text = (text or "").lower()
    if not text.isascii():  # full-width and styled letters; é stays é, it tells words apart
        text = unicodedata.normalize("NFKC", text).lower().translate(_MARKS)
    folded = text.translate(_FOLD)
    runs = []
    for run in _RUN.finditer(text):
        start, end = run.span()
        before, after = folded[start - 1:start].strip() != "", folded[end:end + 1].strip() != ""
        if before and after:
            runs.append((start, end, "inside"))
        elif after and _LETTER.match(text, end):
            runs.append((start, end, "ahead"))
        elif before:
            at = start - 1
            while at > 0 and text[at].isdigit():
                at -= 1
            if text[at].isalpha():
                runs.append((start, end, "behind"))

    def form(kinds: tuple[str, ...]) -> str:
        parts, at = [" "], 0
        for start, end, kind in runs:
            if kind in kinds:
                parts += [folded[at:start], text[start:end].translate(_SIGNS)]
                at = end
        return "".join([*parts, folded[at:], " "])

    there = sorted({kind for *_, kind in runs})
    usual = ("inside",) if "inside" in there else ()
    return [form(usual), *[form(some) for n in range(len(there) + 1) for some in combinations(there, n) if some != usual]]


def fold(text: str | None) -> str:
    """``text`` in folded letters, words apart by spaces, with a space at either end; null folds like empty.

    Signs are letters inside words and spaces elsewhere.
    """
    return forms(text)[0]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # folded stem, or whole word with a space behind -> weight
    exceptions: tuple[str, ...]  # folded phrases
    intercept: float = -3.0
    slope: float = 1.0

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for stem, weight in self.weights.items():
            machine.add_word(f" {stem}", (len(stem) + 1, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        machine.make_automaton()
        return machine


def _matches(machine: ahocorasick.Automaton, folded: str) -> tuple[dict[int, tuple[int, float]], list[tuple[int, int]]]:
    """Start -> end and weight of the stems, of one start the longest, and start and end of exception phrases."""
    found: dict[int, tuple[int, float]] = {}
    harmless: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(folded):
        if weight is None:
            harmless.append((end - length + 1, end))
        elif folded[end] == " " or folded[end + 1] != " ":  # a whole word, or a stem with more behind it
            found[end - length + 1] = end, weight  # longer stems end later
    return found, harmless


def hits(machine: ahocorasick.Automaton, folded: str, *others: str) -> dict[int, float]:
    """Start -> weight of the stems in ``folded`` outside exception phrases; of stems with one start the longest counts.

    A stem in one of the other forms counts if this form reads it otherwise and nothing is found in its word so far.
    """
    if not len(machine):
        return {}
    matches, harmless = _matches(machine, folded)
    found = {start: weight for start, (_, weight) in matches.items()}
    for other in others:
        more, phrases = _matches(machine, other)
        harmless += phrases
        found |= {start: weight for start, (end, weight) in more.items() if other[start:end + 1] != folded[start:end + 1]
                  and not any(at in found for at in range(start, other.index(" ", start + 1)))}
    if harmless and found:
        harmless.sort()
        at, reach = 0, -1
        for start in sorted(found):
            while at < len(harmless) and harmless[at][0] <= start:
                reach = max(reach, harmless[at][1])
                at += 1
            if start < reach:
                del found[start]
    return found


def _feature(total: float, words: int) -> float:
    return math.log1p(1000 * total / max(words, 1)) if total > 0 else 0.0


_SCORE = StructType([StructField("score", DoubleType()), StructField("n_hits", LongType()),
                     StructField("weight", DoubleType()), StructField("n_words", LongType()),
                     StructField("feature", DoubleType())])


def scorer(model: Model):
    """A column function: text -> score, hits, summed weight, words and the feature behind the score."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = model.automaton()
        for texts in batches:
            rows = []
            for text in texts:
                folded, *others = forms(text)
                found = hits(machine, folded, *others)
                total, words = sum(found.values()), len(folded.split())
                x = _feature(total, words)
                odds = max(min(model.intercept + model.slope * x, 700.0), -700.0)
                rows.append((1 / (1 + math.exp(-odds)), len(found), total, words, x))
            yield pd.DataFrame(rows, columns=_SCORE.names)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, _SCORE)


def training_rows(labels: DataFrame, held_out: Column, most: int) -> DataFrame:
    """About ``most`` labelled documents outside ``held_out``: id and label, by the hash of the id.

    A document labelled both ways counts as toxic; rows without id or label are left out.
    """
    known = labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isin(0, 1) & ~held_out)
    ids = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    share = min(1.0, most / max(ids.count(), 1))
    return ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else ids


def _least_shingle(words: list[str]) -> int:
    return min((xxhash.xxh64_intdigest(" ".join(words[i:i + 3])) for i in range(max(len(words) - 2, 1))), default=0) >> 1


def _sample(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """Texts, also folded, and labels; of texts that share their smallest shingle hash, so of most copies, one for each label."""
    def folded(texts: pd.Series) -> pd.DataFrame:
        made = [fold(t) for t in texts]
        least = [_least_shingle(t.split()) for t in made]
        return pd.DataFrame({"folded": made, "least": least})
    folded.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    make = F.pandas_udf(folded, "folded string, least long")
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, text).alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.select("doc_id", "label", "text", make("text").alias("t")).select("doc_id", "label", "text", "t.*")
    one = rows.groupBy("label", "least").agg(
        F.min_by(F.struct("folded", "text"), F.struct("doc_id", "folded", "text")).alias("t"))
    return materialise(one.select("label", "t.*"), "toxicity-sample")


def _stem_counts(batches: Iterator[pd.DataFrame], shortest: int, longest: int) -> Iterator[pd.DataFrame]:
    """Per stem and label the texts and the words that have it; a stem is a whole word or a proper beginning."""
    texts, words = (Counter(), Counter()), (Counter(), Counter())
    for batch in batches:
        for label, folded in zip(batch["label"], batch["folded"]):
            own: Counter = Counter()
            for word, times in Counter(folded.split()).items():
                if len(word) >= shortest:
                    own[f"{word} "] += times
                for k in range(shortest, min(len(word), longest + 1)):
                    own[word[:k]] += times
            texts[label].update(own.keys())
            words[label].update(own)
    stems = list(texts[0] | texts[1])
    yield pd.DataFrame({"stem": stems, "clean": [texts[0][s] for s in stems], "toxic": [texts[1][s] for s in stems],
                        "clean_words": [words[0][s] for s in stems], "toxic_words": [words[1][s] for s in stems]})


def _choose(stems: list[tuple[str, float, float]]) -> dict[str, float]:
    """Of (stem, weight, evidence) with one beginning keep the one with most evidence, of equals the longest."""
    kept: dict[str, float] = {}
    beginnings: set[str] = set()  # of those kept
    for stem, weight, _ in sorted(stems, key=lambda s: (-s[2], -len(s[0]), s[0])):
        if stem not in beginnings and not any(stem[:k] in kept for k in range(1, len(stem))):
            kept[stem] = weight
            beginnings |= {stem[:k] for k in range(1, len(stem) + 1)}
    return kept


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, text: str = "text", most: int = 20_000,
          shortest: int = 3, longest: int = 12, support: int = 4, evidence: float = 24.0, weight: float = 2.5) -> Model:
    """A model from about ``most`` labelled documents (its documented bound) outside ``held_out``.

    A stem weighs the log of its rate among the words of toxic texts against clean ones. It enters with a weight
    of ``weight``, ``support`` different toxic texts and a likelihood ratio (G) of ``evidence`` that it goes with
    the label; all that pass enter, and the sample's bound is theirs too. Seeds stay where the sample does not refute them. Word pairs around hits
    that are mainly in clean texts become exceptions. Without labelled documents the seeds and the default
    curve are used.
    """
    sample = _sample(docs, training_rows(labels, held_out, most), text)
    sizes = {r["label"]: (r["texts"], r["words"]) for r in sample.groupBy("label").agg(
        F.count("*").alias("texts"), F.sum(F.size(F.split(F.trim("folded"), " +"))).alias("words")).collect()}
    seeds = {f"{fold(s).strip()} ": w for s, w in SEEDS.items()}
    known = tuple(sorted(fold(p).strip() for p in EXCEPTIONS))
    if set(sizes) != {0, 1}:
        return Model(seeds, known)
    (clean, clean_words), (toxic, toxic_words) = sizes[0], sizes[1]
    counted = sample.mapInPandas(lambda batches: _stem_counts(batches, shortest, longest),
                                 "stem string, clean long, toxic long, clean_words long, toxic_words long")
    totals = counted.groupBy("stem").agg(*[F.sum(c).alias(c) for c in counted.columns[1:]])
    n, usual = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)
    share = (F.col("toxic") + 1e-9) / (n + 2e-9)
    likelihood = 2 * n * (share * F.log(share / usual) + (1 - share) * F.log((1 - share) / (1 - usual)))
    scored = totals.select(
        "stem", "toxic", n.alias("texts"), likelihood.alias("evidence"),
        F.log((F.col("toxic_words") + 0.5) / toxic_words / ((F.col("clean_words") + 0.5) / clean_words)).alias("weight"))
    strong = (F.col("toxic") >= support) & (F.col("evidence") >= evidence) & (F.col("weight") >= weight)
    rows = scored.where(strong | F.col("stem").isin(list(seeds))).orderBy(F.desc("evidence"), "stem").collect()
    found = [(r["stem"], r["weight"], round(r["evidence"], 6)) for r in rows
             if r["toxic"] >= support and r["evidence"] >= evidence and r["weight"] >= weight]
    refuted = {r["stem"] for r in rows if r["texts"] >= 2 * support and r["weight"] < weight}
    model = Model({s: w for s, w in seeds.items() if s not in refuted} | _choose(found), known)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = model.automaton()
        for batch in batches:
            pairs = []
            for label, text in zip(batch["label"], batch["text"]):
                folded, *others = forms(text)
                starts = hits(machine, folded, *others)
                if starts:
                    words = [(m.start() - 1, m[0]) for m in re.finditer(r"\S+", folded)]
                    pairs += {(f"{a} {b}", label) for (i, a), (j, b) in zip(words, words[1:]) if i in starts or j in starts}
            yield pd.DataFrame(pairs, columns=["pair", "label"])

    pairs = (sample.mapInPandas(around, "pair string, label int").groupBy("pair")
             .agg(F.sum(1 - F.col("label")).alias("clean"), F.sum("label").alias("toxic"))
             .where((F.col("clean") >= 5) & (F.col("clean") > 4 * F.col("toxic"))).orderBy(F.desc("clean"), "pair").collect())
    model = Model(model.weights, tuple(sorted({*known, *(r["pair"] for r in pairs)})))
    shape = (sample.select("label", F.round(scorer(model)("text")["feature"], 2).alias("x")).groupBy("label", "x").count().collect())
    return Model(model.weights, model.exceptions, *_curve(shape))


def _curve(rows: list) -> tuple[float, float]:
    """A logistic curve over one feature that passes one half where the labels part best.

    The border is the middle of the widest stretch with fewest errors; the slope is the likeliest one for it.
    """
    seen = sorted({r["x"] for r in rows})
    toxic = Counter({r["x"]: r["count"] for r in rows if r["label"] == 1})
    clean = Counter({r["x"]: r["count"] for r in rows if r["label"] == 0})
    wrong, best = sum(clean.values()), []  # all called toxic
    for low, high in zip(seen, [*seen[1:], seen[-1] + 1.0]):
        wrong += toxic[low] - clean[low]
        best.append((wrong, low - high, low, high))
    _, _, low, high = min(best)
    border = (low + high) / 2

    def loss(slope: float) -> float:
        return sum(count * math.log1p(math.exp(min(sign * slope * (x - border), 700.0)))
                   for sign, counts in ((1, clean), (-1, toxic)) for x, count in counts.items())

    slope = min((0.25 * k for k in range(2, 21)), key=loss)
    return -slope * border, slope


def score(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (or the columns ``carry``) with the struct of ``scorer``, and that struct's column name.

    Null and empty texts have no hits and get the score of a text without hits. Rows are scored one by one, so
    repeated rows score alike and texts of any length are scored whole; an empty table stays empty; columns of ``docs`` keep their names and values.
    """
    name = fresh(docs.columns, "toxicity")[0]
    kept = [col(docs, c) for c in (docs.columns if carry is None else carry)]
    return docs.select(*kept, scorer(model)(col(docs, text)).alias(name)), name


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns of ``docs``."""
    scored, name = score(docs, model, text)
    return scored.where(F.col(name)["score"] < threshold).drop(name)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that the model never learns from; false for null ids."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
