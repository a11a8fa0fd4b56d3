"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import types as T

# Extra columns have names that the operators use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("base", T.IntegerType()), T.StructField("score", T.DoubleType()),
    T.StructField("kept", T.StringType()), T.StructField("n", T.LongType())])


def words(seed: int, n: int, vocabulary: int = 3000) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randint(2, 8))) if rnd.random() < 0.9
            else f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def changed(text: list[str], seed: int, share: float) -> list[str]:
    rnd = random.Random(seed)
    return [f"x{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in text]


def texts() -> dict[int, str | None]:
    a, b, c = words(1, 200), words(2, 300), words(3, 120)
    passage = words(4, 70)
    out: dict[int, str | None] = {
        1: " ".join(a), 2: " ".join(a), 3: " ".join(changed(a, 5, 0.01)), 4: " ".join(changed(a, 6, 0.02)),
        5: " ".join(b), 6: " ".join(changed(b, 7, 0.3)), 7: " ".join(b[:250]), 8: " ".join(c + passage),
        9: " ".join(words(8, 80) + passage + words(9, 60)), 10: None, 11: "", 12: "  \n\t ", 13: "one", 14: "one", 15: "two words",
        16: " ".join(["spam"] * 400), 17: " ".join(["spam"] * 500), 18: "\n".join(["the same line again"] * 30),
        19: " ".join(words(10, 6000)), 20: " ".join(words(11, 100)).upper(), 21: " ".join(words(11, 100)),
        22: "Größe naïve 漢字 😀 " * 30, 23: "x" * 5000, 24: "a|b|c|d " * 50,
    }
    return out


def rows() -> list[tuple]:
    out = [(i, t, "en" if i % 3 else None, f"src{i % 2}", None if t is None else len(t), "id", i, 0.5, "kept", 7)
           for i, t in texts().items()]
    return [*out, out[0], (None, "no id at all", "en", None, 12, None, None, None, None, None)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
