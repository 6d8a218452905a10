"""Small tables with every odd case: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark, extra=()):
    rnd = random.Random(7)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    say = lambda n: " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) for _ in range(n))
    shared = say(60)
    rows = [
        (0, None, "en", "a", None), (1, "", None, "a", 0), (2, "   \n\t ", "en", None, 6), (3, "Same text", "en", "a", 9), (4, "Same text", "en", "b", 9), (4, "Same text", "en", "b", 9),
        (None, "no id here", "en", "a", 1), (6, "É" * 300, "fr", "a", 300), (7, "é" * 300, "fr", "a", 300), (8, say(30_000), "en", "a", 1), (9, shared + " " + say(80), "en", "a", 1),
        (10, say(50) + " " + shared, "en", "b", 1), (11, "word " * 400, "en", "a", 1), (12, "日本語テキスト🎉 " * 30, "ja", "a", 1), (13, "a\x00b\x1cc <|endoftext|> d", "en", "a", 1),
        *[(20 + i, f"copy {shared[:150]}", "en", "hot", 1) for i in range(15)], *extra,
    ]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def plain_docs(spark, n=200, seed=1):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(150, 900))) for _ in range(10)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 100)
            parts.append(rnd.choice([p[a : rnd.randint(a, len(p))], "xy" * rnd.randint(50, 200), "é" * rnd.randint(50, 300), "".join(rnd.choice("abcdefgh é") for _ in range(rnd.randint(1, 500)))]))
        rows.append((i, "".join(parts), "en", "s", 1))
    return spark.createDataFrame(rows, DOCS).repartition(3)


def clashing(docs):
    """The same rows with columns that have the operators' own names."""
    from pyspark.sql import functions as F

    names = ["keep_id", "group_size", "kept", "fp", "component_id", "row", "shard", "slot", "k", "rest", "removed", "size", "count", "__nth", "starts", "h", "p"]
    return docs.withColumns({n: F.lit(1) for n in names})
