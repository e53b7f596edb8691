"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import functions as F

WORDS = "the of and lamp river stone paper window green walk over under seven bright north table from is was".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that follow from ``seed``; different seeds share no run of three words beyond chance."""
    words, state = [], seed * 2654435761 + 12345
    for _ in range(n):
        state = (state * 1103515245 + 12345) & 0x7FFFFFFF
        words.append(WORDS[(state >> 16) % len(WORDS)] + ("" if (state >> 8) % 3 else str((state >> 9) % 50)))
    return " ".join(words) + "."


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Straße   ÉÀ 日本語 🙂"), (6, "x " * 40000), (None, "no id"), (None, None),
       (7, prose(7, 80)), (7, prose(7, 80)), (8, "\\ <end> | $1 \\1 \u0000 ﻿")]


def odd_documents(spark, rows=ODD):
    """``documents`` with columns whose names the operators would like to use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "key", "fp", "quality", "toxicity", "tokens", "order", "first", "words", "`a.b`", "label", "Salt"):
        df = df.withColumn(name.strip("`"), F.lit("kept"))
    return df


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
