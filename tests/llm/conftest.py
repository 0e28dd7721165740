import pytest

#: Columns that clash with names the operators use inside.
CLASHES = ("node", "raw", "size", "key", "shard", "score", "law", "tie", "n_tokens", "label_", "s", "l", "t",
           "mix_topic", "mix_tokens", "mix_kept", "leaks", "toxic_score", "_id", "_raw", "class_id", "parts", "seq")


def documents(spark, rows, extra=False):
    """rows of (doc_id, text); the other columns of the table follow, clashing ones on demand."""
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


ODD = [
    (1, None), (2, ""), (3, "..."), (4, "one"), (5, "one"), (6, "a b"), (7, "日本語 текст é " * 40),
    (8, "x" * 20_000), (9, "long words here " * 9_000), (9, "long words here " * 9_000), (10, "퟿\U0001f600 ok"),
    (None, None), (None, "no id at all"), (-5, "negative id"),
]


@pytest.fixture(scope="session")
def words():
    """A source of distinct invented words."""
    import random

    rng = random.Random(5)

    def some(n):
        return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
                        for _ in range(n))

    return some
