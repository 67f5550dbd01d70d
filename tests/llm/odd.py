"""Documents with everything that may be odd, and a few plain ones."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("node", T.StringType()), T.StructField("size", T.StringType()), T.StructField("score", T.StringType()),
    ]
)
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def words(r: random.Random, n: int) -> str:
    return " ".join(r.choice(["the", "of", "and", "plan", "river", "stone", "light", "garden", "winter", "paper", "letter", "market"]) + r.choice(["", "", "s", "ly", "er", ","]) for _ in range(n))


def rows(n: int = 60, seed: int = 1) -> list[tuple]:
    r = random.Random(seed)
    out = [(i, words(r, r.randint(20, 80)), ["en", "de"][i % 2], f"src{i % 4}", 0, "x", "y", "z") for i in range(n)]
    base = words(r, 100)
    out += [
        (1000, None, "en", "src0", 0, "x", "y", "z"), (1001, "", "en", "src0", 0, "x", "y", "z"), (1002, " \n\t ", None, None, 0, "x", "y", "z"),
        (1003, "one", None, "src1", 0, "x", "y", "z"), (1004, "one two", "xx", "src1", 0, "x", "y", "z"), (None, "a text without an id here", "en", "src1", 0, "x", "y", "z"),
        (None, None, None, None, None, None, None, None), (1005, base, "en", "src2", 0, "x", "y", "z"), (1006, base, "en", "src2", 0, "x", "y", "z"),
        (1007, base.replace("the", "thé", 1), "en", "src2", 0, "x", "y", "z"), (1008, words(r, 30_000), "en", "src3", 0, "x", "y", "z"), (1005, base, "en", "src2", 0, "x", "y", "z"),
        (1009, "漢字 <|endoftext|> ▁x  É\r\n'll \x00", "en", "src3", 0, "x", "y", "z"), (1010, "same id, first", "en", "src3", 0, "x", "y", "z"), (1010, "same id, second text", "en", "src3", 0, "x", "y", "z"),
    ]
    return out


def documents(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def labels(spark, n: int = 60):
    return spark.createDataFrame([(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(n)] + [(None, 1, 1), (3, None, None), (3, 1, 0)], LABELS)
