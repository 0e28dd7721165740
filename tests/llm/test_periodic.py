import hashlib
import random
import zlib

import numpy as np
import pytest

from opslog.llm.periodic import find_runs, periodic_runs, planted_text, split_words, surviving_segments
from tests.llm.conftest import ODD, documents


def brute(words):
    """Every lag over the whole text; a stretch inside one of a smaller period is dropped."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                stretch = words[i:i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    runs.append((i, length, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts):
    number = {}
    words = split_words(texts)
    ids = np.array([number.setdefault(w, len(number)) for t in words for w in t], np.int64)
    ptr = np.cumsum([0] + [len(w) for w in words])
    return find_runs(ids, ptr)


def made_text(rng):
    out = []
    for _ in range(rng.randint(1, 6)):
        letters = "abcdefghij"[:rng.choice([1, 2, 3, 10])]
        out += [rng.choice(letters) for _ in range(rng.randint(0, 15))]
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 17, 20, 33]))]
        times = rng.randint(1, 7)
        out += unit * times + unit[:rng.randint(0, len(unit))]
    return " ".join(out)


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [made_text(rng) for _ in range(60)]
    assert runs_of(texts) == [brute(split_words([t])[0]) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_long_periods_and_small_alphabets(seed):
    rng = random.Random(seed + 100)
    texts = []
    for period in (15, 16, 17, 31, 32, 63, 64, 65, 100):
        unit = [rng.choice("ab" if seed % 2 else "abcdefghijklmnopqrstuvwxyz") for _ in range(period)]
        texts.append(" ".join(["x"] * rng.randint(0, 9) + unit * 4 + unit[:rng.randint(0, 5)] + ["y"]))
        texts.append(" ".join((unit * 4)[:-1] + ["z"]))
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    texts += [" ".join(fib[-1]), "a " * 900, "a b " * 300 + "c " + "a b " * 5, " ".join(bin(i).count("1") % 2 and "a" or "b" for i in range(512))]
    assert runs_of(texts) == [brute(split_words([t])[0]) for t in texts]


def test_a_very_long_text_of_one_word_and_of_random_words():
    rng = np.random.default_rng(1)
    text = " ".join(rng.choice(["a", "b", "c"], 60_000).tolist())
    assert runs_of(["w " * 300_000]) == [[(0, 300_000, 1)]]
    unit = " ".join(map(str, rng.integers(0, 2000, 20_000)))
    assert runs_of([f"{unit} {unit} {unit} {unit} end"]) == [[(0, 80_000, 20_000)]]
    plain = text.split()
    for start, length, q in runs_of([text])[0]:
        assert plain[start:start + length - q] == plain[start + q:start + length] and length >= max(6, 4 * q)


def test_splitting_keeps_every_run_and_drops_rare_words():
    ids = np.array([0, 1, 2, 3] + [4, 5] * 4 + [6, 7, 4, 5, 8], np.int64)
    assert surviving_segments(ids, np.array([0, len(ids)])).tolist() == [[4, 12]]
    assert surviving_segments(np.zeros(0, np.int64), np.array([0, 0])).tolist() == []


def plain_row(doc_id, text):
    words = split_words([text])[0]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = [hashlib.sha256(x).hexdigest() for x in (
        "".join("%d,%d,%d\n" % r for r in runs).encode(), b" ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], *sha)


def test_query_equals_the_plain_definition(spark, words):
    rng = random.Random(9)
    odd = [(i, t and t[:400]) for i, t in ODD]
    rows = [(i, rng.choice([made_text(rng), words(rng.randint(0, 60)), "\x0b\x0c a b c\x1c\x85 d\r\n"])) for i in range(300)] + odd
    docs = documents(spark, rows, extra=True)
    got = periodic_runs(planted_text(docs)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r.n_runs for r in got) > 100


def test_whole_long_texts_and_the_empty_table(spark):
    got = {r.doc_id: r for r in periodic_runs(documents(spark, ODD)).collect()}
    assert (got[9].n_runs, got[9].length, got[9].period, got[9].collapsed) == (1, 27_000, 3, "long words here")
    assert got[1].collapsed == got[2].collapsed == "" and got[1].start is None
    assert periodic_runs(planted_text(documents(spark, []))).count() == 0
