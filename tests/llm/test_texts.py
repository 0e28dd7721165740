"""Words, shingles and kept tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslog.llm.common import components, shared_folder, spans, stored
from opslog.llm.words import characters, grams_of, shingles, words


def test_words_are_folded_and_split_at_everything_else():
    a, ptr = words(["Hello, WORLD é9", None, "", "hello", "world-é9 x"])
    assert ptr.tolist() == [0, 3, 3, 3, 4, 7]
    assert a[0] == a[3] and a[1] == a[4] and a[2] == a[5] and a[6] not in a[:6]


def test_words_do_not_depend_on_their_batch():
    texts = ["abc def", "ghi", "abc ghi def", "x" * 5000 + " abc"]
    together, ptr = words(texts)
    for i, t in enumerate(texts):
        assert words([t])[0].tolist() == together[ptr[i]:ptr[i + 1]].tolist()


def test_shingles_of_short_and_long_texts():
    h, ptr = words(["a b c d e f", "a b c d e", "a b", "", "b a"])
    s, p = shingles(h, ptr, 5)
    assert np.diff(p).tolist() == [2, 1, 1, 0, 1]
    assert s[0] == s[2] and len(set(s.tolist())) == 4


def test_grams_stay_inside_words():
    h, ptr = grams_of(*characters(["abcd ef", "bcd", "xabc"]), 3)
    assert np.diff(ptr).tolist() == [2, 1, 2]
    assert h[1] == h[2] and h[0] == h[4]


def test_spans_cover_everything_once():
    assert list(spans([3, 3, 9, 1, 1], 6)) == [(0, 2), (2, 3), (3, 5)]
    assert list(spans([], 6)) == []


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 120)] + [(5, 5), (7, 8), (8, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert {got[i] for i in range(10, 41)} == {10} and {got[i] for i in range(100, 120)} == {100}
    assert got[7] == got[8] == 7 and 5 not in got


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stored_keeps_schema_and_reads_the_setting(spark):
    df = spark.range(3).withColumn("x", F.lit(None).cast("string"))
    assert stored(df, "t").dtypes == df.dtypes
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


@pytest.mark.parametrize("text", ["é", "ÀÉ", "ß", "İ"])
def test_folding_is_per_character(text):
    assert len(words([text, text.lower()])[0]) >= 2
