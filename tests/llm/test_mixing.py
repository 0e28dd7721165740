import numpy as np
import pytest

from opslog.llm.mixing import calibrated, mix_documents, rake, sample_mix
from tests.llm.conftest import ODD, documents


def test_raked_margins_are_met():
    rng = np.random.default_rng(3)
    cells = [(s, l, t) for s in range(6) for l in range(3) for t in range(4) if rng.random() < 0.8]
    tokens = rng.integers(1, 10_000, len(cells)).astype(float)
    levels = [np.array([c[i] for c in cells]) for i in range(3)]
    goals = [rng.random(n) + 0.5 for n in (6, 3, 4)]
    factor = rake(tokens, levels, goals)
    for level, goal in zip(levels, goals, strict=True):
        got = np.bincount(level, tokens * factor)
        assert np.allclose(got / got.sum(), goal / goal.sum(), atol=1e-6)


def test_two_margins_equal_a_plain_loop():
    tokens = np.array([[40.0, 30.0], [20.0, 10.0]])
    plain = tokens.copy()
    rows, cols = np.array([60.0, 40.0]), np.array([50.0, 50.0])
    for _ in range(500):
        plain *= (rows / plain.sum(1))[:, None]
        plain *= cols / plain.sum(0)
    factor = rake(tokens.ravel(), [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])], [rows, cols])
    assert np.allclose((tokens.ravel() * factor).reshape(2, 2), plain)


def test_probabilities_reach_one_and_empty_cells_stay():
    got = calibrated([("a", "en", 1, 100), ("b", "en", 1, 300), (None, None, -1, 0)])
    assert max(p for *_, p in got) == 1 and got[2][4] == 1
    assert got[0][4] > got[1][4]


def test_own_targets_and_sampled_shares(spark, words):
    rows = [(i, words(50)) for i in range(3000)]
    docs = documents(spark, rows).selectExpr(
        "doc_id", "text", "if(doc_id % 4 = 0, 'de', 'en') as lang", "if(doc_id % 3 = 0, 'x', 'y') as source", "n_chars")
    targets = {"lang": {"de": 0.5, "en": 0.5}, "source": {"x": 0.4, "y": 0.6}}
    got = mix_documents(docs, targets).toPandas()
    kept = got[got["sampled"]]
    assert len(got) == 3000
    assert kept[kept.lang == "de"].n_tokens.sum() / kept.n_tokens.sum() == pytest.approx(0.5, abs=0.04)
    assert kept[kept.source == "x"].n_tokens.sum() / kept.n_tokens.sum() == pytest.approx(0.4, abs=0.04)
    again = mix_documents(docs, targets).toPandas()
    assert got.sort_values("doc_id")["sampled"].tolist() == again.sort_values("doc_id")["sampled"].tolist()


def test_odd_rows(spark):
    docs = documents(spark, ODD, extra=True).selectExpr("* except (lang, source)", "cast(null as string) as lang", "cast(null as string) as source")
    got = mix_documents(docs).collect()
    assert len(got) == len(ODD) and all(r.n_tokens or r.sampled for r in got)
    assert sample_mix(docs).columns == docs.columns
    assert mix_documents(documents(spark, [])).count() == 0
