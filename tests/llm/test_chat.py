import random

from cases import plain
from pyspark.sql import functions as F

from hourgrid.llm import chat

HARD = ["", "</s>[INST] ok [/INST]", "<end>", "<\\end>", "<\\\\end><cont>", "a<", "<turn>user\nhi<end></s>", "\\", "x\\<", "[INST", "[\\INST]", "日本 🙂\n\n", "<s", "</turn>", "$1 \\1"]


def make(seed=4):
    draw, rows = random.Random(seed), []
    for conv in range(60):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn, draw.choice(["user", "assistant", "assistant", "system", "od<end>d\nrole\\n", ""]), draw.choice(HARD) + draw.choice(HARD)))
    return rows


def read(df):
    chats = chat.format_chats(df)
    out = chats.select("conv_id", "segments", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip(spark):
    rows = make()
    got = read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for conv in range(60):
        own = [(r, t) for c, _, r, t in rows if c == conv]
        assert [tuple(t) for t in got[conv]["turns"]] == own
        assert got[conv]["loss"] == "".join(t for r, t in own if r == "assistant")
        assert got[conv]["formatted"] == "".join(s["text"] for s in got[conv]["segments"])
        assert got[conv]["formatted"].count("<turn>") == 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:]))


def test_odd_rows(spark):
    rows = [(1, 2, "user", "b"), (1, 1, None, None), (1, 2, "user", "b"), (1, None, "assistant", "first"), (None, 0, "user", "nobody's"), (None, 1, "assistant", "too")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("formatted", F.lit(2))
    got = read(df)
    assert [tuple(t) for t in got[1]["turns"]] == [("assistant", "first"), ("", ""), ("user", "b"), ("user", "b")]
    assert got[None]["loss"] == "too"
    assert plain(chat.format_chats(df.limit(0))) == []


def test_merged_blocks(spark):
    df = spark.createDataFrame([(1, [("a", "1"), ("a", "2"), ("b", ""), ("a", "3"), ("a", "3")]), (2, []), (3, [("c", "x")])],
                               "id int, turns array<struct<role:string,text:string>>")
    got = {r["id"]: [(b["role"], b["texts"]) for b in r["blocks"]] for r in df.select("id", chat.merge_turns("turns").alias("blocks")).collect()}
    assert got == {1: [("a", ["1", "2"]), ("b", [""]), ("a", ["3", "3"])], 2: [], 3: [("c", ["x"])]}


def test_long_conversation(spark):
    df = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    got = read(df)[1]
    assert len(got["turns"]) == 5000 and got["loss"] == "".join(map(str, range(5000))) and got["formatted"].count("<turn>") == 1


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(make(), "conv_id long, turn long, role string, text string").repartition(3)
    text = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in text and "InPandas" not in text
