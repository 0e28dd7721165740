import hashlib
import random

import numpy as np

from opslog.llm import substring_dedup
from opslog.llm.bwt import build, merge
from opslog.llm.substring_dedup import remove_repeats
from tests.llm.conftest import ODD, documents


def brute(rows):
    first: dict[bytes, int] = {}
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for i, b in bodies:
        if i is not None:
            for k in range(len(b) - 49):
                first[b[k:k + 50]] = min(first.get(b[k:k + 50], i), i)
    out = []
    for i, b in bodies:
        gone = [False] * len(b)
        reach = 0
        if i is not None:
            for k in range(len(b) - 49):
                if first[b[k:k + 50]] < i:
                    for x in range(max(k, reach), k + 50):
                        gone[x] = True
                    reach = k + 50
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in remove_repeats(df).drop("kept").collect()), key=repr)


def texts(words):
    rng = random.Random(9)
    base = [words(60) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [words(rng.randint(0, 30)), rng.choice(base)[rng.randint(0, 200):], words(5)]
        if i % 3 == 0:
            parts.append("A very common passage é that stands at the end of every third text, more than fifty bytes.")
        rows.append((rng.randint(0, 140), " ".join(parts)))
    return rows + [(500 + i, "ab" * rng.randint(20, 60)) for i in range(5)] + [(600, rows[3][1]), (601, rows[3][1])]


def test_equals_brute_force(spark, words):
    rows = texts(words)
    assert got(documents(spark, rows)) == brute(rows)


def test_crowded_anchors_give_the_same(spark, words, monkeypatch):
    rows = texts(words)
    monkeypatch.setattr(substring_dedup, "CROWD", 2)
    assert got(documents(spark, rows)) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    rows = [r for r in ODD if r[1] is None or len(r[1]) < 30_000] + [(10, "퟿\U0001f600 ok")]
    assert got(documents(spark, rows, extra=True)) == brute(rows)
    assert got(documents(spark, [])) == []


def test_long_texts_are_read_to_their_end(spark, words):
    tail = words(30)
    rows = [(1, words(20_000) + tail), (2, words(3) + tail)]
    out = {r[0]: r[2] for r in got(documents(spark, rows))}
    assert out == {1: 0, 2: len(tail)}


def test_merged_transforms_give_the_intervals_of_all_suffixes():
    rng = np.random.default_rng(2)
    for _ in range(20):
        shards, full, base = [], [], 0
        for _ in range(3):
            text, starts = [], []
            for _ in range(rng.integers(1, 5)):
                starts.append(len(text))
                text += [*rng.integers(1, 3, rng.integers(0, 20)).tolist(), 0]
            shards.append(build(np.array(text, np.uint16), np.array(starts), base, 8))
            full += text
            base += len(text)
        place, interval = merge(shards, 6)
        seen = {}
        order = []
        for p, i in zip(place.tolist(), interval.tolist(), strict=True):
            suffix = tuple(full[p:p + 6])
            if len(suffix) == 6 and 0 not in suffix:
                assert seen.setdefault(i, suffix) == suffix
                order.append(suffix)
        assert order == sorted(order) and len(seen) == len(set(order))


def test_merge_starts_from_the_heads_of_the_suffixes(monkeypatch):
    """A 50-byte interval takes 34 rounds after the first 16 bytes, and is the same as with none."""
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 90))) for _ in range(40)]
    strings += [s[3:] + b"z" for s in strings[:20]]
    docs = np.arange(len(strings))
    found = substring_dedup.repeated(strings, docs)
    first = {}
    for d, s in enumerate(strings):
        for i in range(len(s) - 49):
            first.setdefault(s[i:i + 50], d)
    assert [f.tolist() for f in found] == [
        [i for i in range(len(s) - 49) if first[s[i:i + 50]] < d] for d, s in enumerate(strings)]
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
    begins = np.cumsum([0] + [len(s) + 1 for s in strings[:-1]])
    cut = begins[30]
    shards = [build(text[:cut], begins[:30], 0, 64), build(text[cut:], begins[30:] - cut, int(cut), 64)]
    rounds, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: rounds.append(1) or argsort(*a, **k))
    merge(shards, 50)
    assert len(rounds) <= 36
