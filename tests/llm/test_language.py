import zlib

import numpy as np

from opslog.llm.language import Settings, fill, identify_languages, predict
from tests.llm.conftest import ODD, documents


def corpus(spark, n=400):
    import random

    rng = random.Random(3)
    parts = {"aa": "thi nger ous ion", "bb": "schl eit ung äch", "cc": "ción mos ella ñar"}
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3]
        text = " ".join("".join(rng.choice(parts[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(30))
        rows.append((i, text, lang, "s", len(text)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_held_out_accuracy_and_split(spark):
    got = identify_languages(corpus(spark)).collect()
    assert {r.doc_id for r in got if r.held_out} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == ["aa", "bb", "cc"][r.doc_id % 3] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_filters_hold_every_ngram_and_correct_for_chance():
    sample = [("aa", "abcdef ghijkl"), ("bb", "mnopqr stuvwx")]
    filters = fill(sample, {"aa": 1, "bb": 1}, Settings(bits=6))
    names, scores = predict(["abcdef", "stuvwx", "", None, "123 !", "zzzzzz yyyyyy"], filters)
    assert names[:2] == ["aa", "bb"] and names[2:5] == ["und"] * 3 and names[5] in ("aa", "bb")
    assert (scores[:2] > 0.5).all() and (filters.false_positive > 0).all()


def test_more_languages_than_one_plane():
    sample = [(f"l{i:03d}", f"{chr(0x4e00 + i) * 9} {chr(0x4e00 + i) * 5}") for i in range(130)]
    filters = fill(sample, {name: 1 for name, _ in sample})
    assert filters.planes.shape[0] == 3
    assert predict([t for _, t in sample], filters)[0] == [name for name, _ in sample]


def test_odd_rows(spark):
    got = {}
    for r in identify_languages(documents(spark, ODD, extra=True)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[1] == got[2] == got[3] == [("und", 0.0)] and got[4][0][0] == "en" and len(got[9]) == 2
    nothing = documents(spark, ODD).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in identify_languages(nothing).collect()} == {"und"}
    assert identify_languages(documents(spark, [])).count() == 0
