import random
import re
from collections import Counter

import numpy as np

from opslog.llm.decontaminate import (
    Settings,
    build_indexes,
    drop_leaks,
    fitted_edits,
    leaked_passages,
    search,
    side,
)
from opslog.llm.words import words as hashed
from tests.llm.conftest import ODD, documents


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def corpus(words):
    tests = [(i, words(8 + i % 40) + ". " + words(3 + i % 9) + ".") for i in range(60)]
    rows, truth = [], set()
    for d in range(120):
        text = words(50 + d * 7 % 400)
        for n, i in enumerate(([d % 60] if d % 4 == 0 else []) + ([(d + 7) % 60] if d % 12 == 0 else [])):
            # A second item goes to the end, not into the first one.
            at = len(text) if n else len(text) // 2 if d % 8 else 0
            shown = tests[i][1].upper().replace(" ", "  ") if d % 3 == 0 else tests[i][1]
            text = text[:at] + " . " + shown + " . " + text[at:]
            truth.add((d, i))
        rows.append((d, text))
    return tests, rows, truth


def test_all_planted_items_and_nothing_else(spark, words):
    tests, rows, truth = corpus(words)
    got = {(r.doc_id, r.item_id) for r in leaked_passages(documents(spark, rows), items(spark, tests)).collect()}
    assert got == truth


def test_skipping_blocks_loses_nothing(spark, words):
    """Block maxima against scoring every item of every passage."""
    tests, rows, _ = corpus(words)
    settings = Settings(threshold=0.3, question=0.0, answer=0.0, block=4)
    touched, all_postings = Counter(), 0
    index, = build_indexes(items(spark, tests), settings)
    dense = {}
    for t, (a, b) in enumerate(zip(index.item_ptr[:-1], index.item_ptr[1:], strict=True)):
        dense[int(index.terms[t])] = list(zip(index.item_of[a:b].tolist(), index.impact[a:b].tolist(), strict=True))
    for _, text in rows[:40]:
        h, ptr = hashed([text])
        best = {}
        for first in range(0, len(h), index.window):
            passage = set(h[first:first + 2 * index.window].tolist())
            score = {}
            for t in passage:
                all_postings += len(dense.get(t, ()))
                for i, w in dense.get(t, ()):
                    score[i] = score.get(i, 0) + w
            for i, s in score.items():
                if s >= 0.3 - 1e-9:
                    best[int(index.items[i])] = max(best.get(int(index.items[i]), 0), s)
        got = {r[1]: r[2] for r in search(index, h, ptr, settings, touched)}
        assert got.keys() == best.keys() and all(abs(got[i] - best[i]) < 1e-9 for i in got)
    assert touched["postings"] < all_postings


def test_random_impacts_are_searched_exactly_and_fewer_postings_are_read(spark):
    """Items of common words: every threshold, block size and step against the dense matrix."""
    rng = random.Random(3)
    common = ["".join(rng.choice("bdfgkl") + rng.choice("aeiou") for _ in range(3)) for _ in range(150)]
    pick = lambda n: " ".join(common[min(int(rng.expovariate(0.03)), 149)] for _ in range(n))
    tests = [(i, pick(rng.randint(4, 30)) + f" mark{i} sign{i}") for i in range(120)]
    texts = [pick(300) + " " + tests[rng.randrange(120)][1] + " " + pick(200) for _ in range(20)] + ["", "nothing"]
    for threshold, block in ((0.35, 1), (0.5, 8), (0.6, 8), (0.6, 64), (0.9, 500)):
        settings = Settings(threshold=threshold, question=0.0, answer=0.0, block=block)
        index, = build_indexes(items(spark, tests), settings)
        postings = {int(t): range(a, b) for t, a, b in
                    zip(index.terms, index.item_ptr[:-1], index.item_ptr[1:], strict=True)}
        touched, dense_reads, want = Counter(), 0, set()
        h, ptr = hashed(texts)
        for d in range(len(texts)):
            own = h[ptr[d]:ptr[d + 1]]
            for first in range(0, len(own), index.window):
                score = Counter()
                for t in set(own[first:first + 2 * index.window].tolist()):
                    for p in postings.get(t, ()):
                        score[int(index.item_of[p])] += float(index.impact[p])
                        dense_reads += 1
                want |= {(d, int(index.items[i])) for i, s in score.items() if s >= threshold - 1e-9}
        assert {r[:2] for r in search(index, h, ptr, settings, touched)} == want
        if threshold >= 0.6:
            assert touched["postings"] < dense_reads, (threshold, block)


def test_edits_of_a_stretch_are_the_fewest():
    rng = random.Random(8)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, old = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
        return row[-1]

    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, n))] for n in (6, 9))
        want = min(plain(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert fitted_edits(np.array(a, np.uint64), np.array(b, np.uint64)) == want


def test_items_with_one_changed_added_or_lost_word_are_found(spark, words):
    rng = random.Random(4)
    tests = [(i, words(6 + i % 30) + ". " + words(3 + i % 9) + ".") for i in range(60)]
    rows, clean = [], []
    for i, text in tests:
        for kind in range(3):
            for last in (False, True):
                q, a = (x.split() for x in text[:-1].split(". "))
                part = a if last else q
                at = rng.randrange(len(part))
                part[at:at + (kind != 1)] = [words(1)] * (kind != 2)
                rows.append((len(rows), f"{words(50)}. {' '.join(q)}. {' '.join(a)}. {words(60)}", i))
        # The same words in another order are no copy.
        q = re.findall(r"\w+", text)
        rng.shuffle(q)
        clean.append((10_000 + i, words(40) + " " + " ".join(q) + " " + words(40)))
    got = {(r.doc_id, r.item_id) for r in leaked_passages(
        documents(spark, [r[:2] for r in rows] + clean), items(spark, tests)).collect()}
    want = {(d, i) for d, _, i in rows}
    assert got <= want and len(got) >= 0.98 * len(want), (len(got), len(want), sorted(got - want))


def test_a_side_without_words_is_held_and_short_sides_are_aligned():
    none = np.zeros(0, np.uint64)
    assert side("_ _").overlap(none, none) == 1.0
    passage, _ = hashed(["a b c x e f"])
    assert side("a b c d e").overlap(passage, none) == 0.8 and side("a b c d").overlap(passage, none) == 0.75


def test_half_an_item_is_no_leak(spark, words):
    text = words(40)
    half = " ".join(re.findall(r"\w+", text)[:15])
    got = leaked_passages(documents(spark, [(1, half), (2, words(30) + " " + text)]), items(spark, [(9, text)]))
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(2, 9)]


def test_odd_rows_on_both_sides(spark):
    tests = items(spark, [(1, None), (2, ""), (3, "..."), (None, "no id at all"), (4, "one"), (4, "one")])
    got = {(r.doc_id, r.item_id) for r in leaked_passages(documents(spark, ODD, extra=True), tests).collect()}
    assert got == {(None, -1), (4, 4), (5, 4)}
    assert leaked_passages(documents(spark, ODD), items(spark, [])).count() == 0
    assert leaked_passages(documents(spark, []), tests).count() == 0


def test_stage_keeps_the_rest(spark, words):
    tests, rows, truth = corpus(words)
    kept = drop_leaks(documents(spark, rows, extra=True), items(spark, tests))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in truth}
    assert kept.columns == documents(spark, rows, extra=True).columns
