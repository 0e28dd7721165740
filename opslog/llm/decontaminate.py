"""Benchmark decontamination: BM25 with block-max WAND, then overlap checks (operator 2)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import set_aside, small, spans
from opslog.llm.words import BATCH_CHARS, shingles, words

SHINGLE = 5
FEW_RUNS = 25
#: Words of passages, once for each span of items they are in, that are searched together.
ROWS_AT_ONCE = 2_000_000
TOLERANCE = 1e-9
FOUND = ("array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double, "
         "item_overlap: double, passage: bigint>>")


@dataclass(frozen=True)
class Settings:
    """``threshold`` is the share of the BM25 score of the whole item that a passage must
    reach. A pair is a leak if the passage holds ``question`` and ``answer`` of the two sides,
    or ``whole`` of the item; see :class:`Side`. The index has the largest impact of each term
    in every ``span`` and in every ``block`` of items."""

    threshold: float = 0.6
    question: float = 0.8
    answer: float = 0.8
    whole: float = 0.8
    k1: float = 1.2
    b: float = 0.75
    block: int = 4
    span: int = 16
    items_per_index: int = 4_096


@dataclass(frozen=True)
class Side:
    """The words of an item, its question or its answer, and their distinct five-word runs."""

    words: np.ndarray
    runs: np.ndarray

    def overlap(self, passage: np.ndarray, runs: np.ndarray) -> float:
        """Share of the side that the passage holds: of its five-word runs, or, where one changed
        word breaks a fifth of these (fewer than 25), of its words in order if that is more. A side without a word is held by every passage."""
        if not len(self.runs):
            return 1.0
        share = float(np.isin(self.runs, runs).mean())
        if share < 1 and len(self.runs) < FEW_RUNS:
            share = max(share, 1 - fitted_edits(self.words, passage) / len(self.words))
        return share


@dataclass(frozen=True)
class Index:
    """Inverted index of a run of items: postings (term, item, impact) ordered by term and item,
    the largest impact of each term in each span and in each block of items that it is in."""

    items: np.ndarray
    window: int
    terms: np.ndarray
    member: np.ndarray
    item_ptr: np.ndarray
    item_of: np.ndarray
    impact: np.ndarray
    span_ptr: np.ndarray
    span_of: np.ndarray
    span_start: np.ndarray
    span_max: np.ndarray
    block_key: np.ndarray
    block_max: np.ndarray
    block_start: np.ndarray
    sides: list[tuple[Side, Side, Side]]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, the rest the question; a single sentence is both."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"\w", p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, text)


def side(text: str) -> Side:
    own, ptr = words([text])
    return Side(own, np.unique(shingles(own, ptr, SHINGLE)[0]))


def fitted_edits(short: np.ndarray, passage: np.ndarray) -> int:
    """Fewest word edits that turn ``short`` into some stretch of ``passage``."""
    place = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for i, word in enumerate(short.tolist()):
        after = row + 1
        np.minimum(after[1:], row[:-1] + (passage != np.uint64(word)), out=after[1:])
        after[0] = i + 1
        # A stretch may have extra words at one edit each.
        row = np.minimum.accumulate(after - place) + place
    return int(row.min())


def build_indexes(benchmark: DataFrame, settings: Settings = Settings()) -> list[Index]:
    """Indexes of all test items with a word, in runs of ``items_per_index`` items.

    Items come to the driver one after another; a test set is small by nature, and both
    passes hold only its distinct words and one run of items. Document frequencies are those
    of the whole test set, so the runs score alike. Repeated item ids stay apart.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    seen, total, length = Counter(), 0, 0
    kept = []
    for r in rows.toLocalIterator():
        own, _ = words([r.text])
        if len(own):
            seen.update(np.unique(own).tolist())
            total, length = total + 1, length + len(own)
            kept.append((len(own), r.item_id, r.text))
    kept.sort(key=lambda x: (x[0], str(x[1]), x[2]))
    mean = length / max(1, total)
    return [_index(kept[a:a + settings.items_per_index], seen, total, mean, settings)
            for a in range(0, len(kept), settings.items_per_index)]


def _index(kept: list, seen: Counter, total: int, mean: float, settings: Settings) -> Index:
    term, item, impact = [], [], []
    for i, (n, _, text) in enumerate(kept):
        own, tf = np.unique(words([text])[0], return_counts=True)
        df = np.array([seen[t] for t in own.tolist()])
        idf = np.log1p((total - df + 0.5) / (df + 0.5))
        w = idf * tf * (settings.k1 + 1) / (tf + settings.k1 * (1 - settings.b + settings.b * n / mean))
        term.append(own), item.append(np.full(len(own), i)), impact.append(w / w.sum())
    term, item, impact = np.concatenate(term), np.concatenate(item), np.concatenate(impact)
    terms, at = np.unique(term, return_inverse=True)
    order = np.lexsort((item, at))
    at, item, impact = at[order], item[order], impact[order]
    member = np.zeros(1 << 20, bool)
    member[(terms >> np.uint64(44)).astype(np.int64)] = True
    blocks = -(-len(kept) // settings.block)
    key, first = np.unique(at * blocks + item // settings.block, return_index=True)
    n_spans = -(-len(kept) // settings.span)
    span, span_first = np.unique(at * n_spans + item // settings.span, return_index=True)
    ids = np.arange(len(terms) + 1)
    longest = max(kept[-1][0], 2 * SHINGLE)
    return Index(
        np.array([-1 if i is None else i for _, i, _ in kept]), longest + longest // 4, terms, member,
        np.searchsorted(at, ids), item, impact,
        np.searchsorted(span // n_spans, ids), span % n_spans, span_first, np.maximum.reduceat(impact, span_first),
        key, np.maximum.reduceat(impact, first), first,
        [tuple(side(x) for x in (*question_and_answer(text), text)) for _, _, text in kept],
    )


def _expand(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of ``rows`` in a pointer table, and which row each is for."""
    sizes = ptr[rows + 1] - ptr[rows]
    of = np.repeat(np.arange(len(rows)), sizes)
    return np.arange(len(of)) + np.repeat(ptr[rows] - (np.cumsum(sizes) - sizes), sizes), of


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted ``x``."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))


def _distinct(x: np.ndarray) -> np.ndarray:
    return x[_firsts(x)]


def search(index: Index, hashes: np.ndarray, ptr: np.ndarray, settings: Settings,
           touched: Counter | None = None) -> list[tuple]:
    """(text, item, score, question, answer and item overlap, passage) of all accepted pairs.

    A text is cut into runs longer than the longest item by a quarter; a passage is two
    neighbouring runs, so an item lies whole in at least one passage, also with words added.
    ``touched`` counts the postings that were read.
    """
    maybe = np.flatnonzero(index.member[(hashes >> np.uint64(44)).astype(np.int64)])
    term = np.searchsorted(index.terms, hashes[maybe])
    term[term == len(index.terms)] = 0
    good = index.terms[term] == hashes[maybe]
    at, term = maybe[good], term[good]
    if not len(at):
        return []
    doc = np.searchsorted(ptr, at, side="right") - 1
    # A gap of one number keeps the runs of two texts from being neighbours.
    runs_before = np.concatenate([[0], np.cumsum(np.diff(ptr) // index.window + 2)])
    run = runs_before[doc] + (at - ptr[doc]) // index.window
    n = len(index.terms)
    own = _distinct(np.sort(run * n + term))
    runs = _distinct(own // n)
    # The words of a run also belong to the passage that the run before it begins.
    second = own - n
    before = np.searchsorted(runs, second // n)
    second = second[runs[np.minimum(before, len(runs) - 1)] == second // n]
    key = _distinct(np.sort(np.concatenate([own, second])))
    passage, term = key // n, key % n
    starts = np.append(_firsts(passage), len(passage))
    rows = np.add.reduceat(index.span_ptr[term + 1] - index.span_ptr[term], starts[:-1])
    found = []
    for a, b in spans(rows.tolist(), ROWS_AT_ONCE):
        some = slice(starts[a], starts[b])
        found += block_max_wand(index, passage[some], term[some], settings, touched)
    return _verify(index, found, runs_before, hashes, ptr, settings)


def block_max_wand(index: Index, passage: np.ndarray, term: np.ndarray, settings: Settings,
                   touched: Counter | None = None) -> list[tuple[int, int, float]]:
    """(passage, item, score) of all pairs that reach the threshold.

    ``passage`` and ``term`` are the distinct words of each passage, by passage. A search is a
    passage in a span of items in which the terms' largest impacts add up to the threshold;
    all searches take their steps together. Each term of a search has a cursor in its
    postings. The cursors are ordered by item; the pivot is the first item at which the largest
    impacts add up, so no item before it can be a result. If those of the pivot's block do not
    add up, these cursors jump behind the block, or to the next cursor's item; otherwise they
    jump to the pivot, which is scored.
    """
    least = settings.threshold - TOLERANCE
    n_items = len(index.items)
    blocks = -(-n_items // settings.block)
    posting = np.repeat(np.arange(len(index.terms)), np.diff(index.item_ptr)) * n_items + index.item_of
    posting = np.append(posting, len(index.terms) * n_items)
    block_of = np.repeat(np.arange(len(index.block_key)), np.diff(np.append(index.block_start, len(index.item_of))))
    block_start = np.append(index.block_start, len(index.item_of))
    n_spans = -(-n_items // settings.span)
    cursor, of = _expand(index.span_ptr, term)
    search_id, term = passage[of] * n_spans + index.span_of[cursor], term[of]
    new = np.diff(passage, prepend=passage[:1]) != 0
    cell = np.cumsum(new)[of] * n_spans + index.span_of[cursor]
    live = np.flatnonzero((np.bincount(cell, index.span_max[cursor]) >= least)[cell])
    search_id, term, cursor = search_id[live], term[live], cursor[live]
    largest, pos = index.span_max[cursor], index.span_start[cursor]
    last = np.append(index.span_start, len(index.item_of))[cursor + 1]
    out: list[tuple[int, int, float]] = []
    while len(pos):
        order = np.argsort(search_id * n_items + index.item_of[pos])
        search_id, term, pos, last, largest = (x[order] for x in (search_id, term, pos, last, largest))
        first = _firsts(search_id)
        sizes = np.diff(np.append(first, len(pos)))
        total = np.concatenate([[0.0], np.cumsum(largest)])
        pivot = np.searchsorted(total[1:], total[first] + least)
        alive = pivot < first + sizes
        if not alive.all():
            # Without a pivot the search is done, whatever its cursors have not read.
            keep = np.repeat(alive, sizes)
            search_id, term, pos, last, largest = (x[keep] for x in (search_id, term, pos, last, largest))
            if not len(pos):
                break
            pivot = (pivot - first)[alive]
            first = np.cumsum(sizes[alive]) - sizes[alive]
            sizes, pivot = sizes[alive], pivot + first
        item = index.item_of[pos]
        at = item[pivot]
        of = np.repeat(np.arange(len(first)), sizes)
        upto = item <= at[of]
        mine = np.flatnonzero(upto)
        whose = of[mine]
        reach = first + np.bincount(whose, minlength=len(first))
        own, mine_pos = term[mine], pos[mine]
        entry = block_of[mine_pos]
        wanted = own * blocks + at[whose] // settings.block
        behind = np.flatnonzero(index.block_key[entry] != wanted)
        entry[behind] = np.minimum(np.searchsorted(index.block_key, wanted[behind]), len(index.block_key) - 1)
        bound = np.bincount(whose, np.where(index.block_key[entry] == wanted, index.block_max[entry], 0.0), len(first))
        scored = bound >= least
        following = np.where(reach < first + sizes, item[np.minimum(reach, len(item) - 1)], n_items)
        target = np.where(scored, at, np.minimum((at // settings.block + 1) * settings.block, following))
        # A goal behind the last item of a term lands behind its postings.
        goal = own * n_items + np.minimum(target, n_items)[whose]
        landed = _seek(posting, mine_pos, block_start[entry + 1], goal)
        there = np.flatnonzero((posting[landed] == goal) & scored[whose] & (target[whose] < n_items))
        score = np.bincount(whose[there], index.impact[landed[there]], len(first))
        hit = np.flatnonzero(scored & (score >= least))
        out += zip((search_id[first[hit]] // n_spans).tolist(), at[hit].tolist(), score[hit].tolist(), strict=True)
        if touched is not None:
            touched["postings"] += int(((landed < last[mine]) & (landed > mine_pos)).sum()) + len(there)
        landed[there] += 1
        pos[mine] = landed
        keep = pos < last
        if not keep.all():
            search_id, term, pos, last, largest = (x[keep] for x in (search_id, term, pos, last, largest))
    return out


def _seek(posting: np.ndarray, start: np.ndarray, block_end: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """First place from ``start`` on whose posting is not before ``goal``: mostly ``start``, the
    next place or the end of the block, else by bisection."""
    out = start + (posting[start] < goal)
    far = np.flatnonzero(posting[out] < goal)
    end, aim = block_end[far], goal[far]
    fits = (posting[end] >= aim) & (posting[end - 1] < aim)
    out[far[fits]] = end[fits]
    rest = far[~fits]
    out[rest] = np.searchsorted(posting, goal[rest])
    return out


def _verify(index: Index, found: list, runs_before: np.ndarray, hashes: np.ndarray, ptr: np.ndarray,
            settings: Settings) -> list[tuple]:
    best: dict[tuple[int, int], tuple] = {}
    last, held = None, np.zeros(0, np.uint64)
    for run, item, score in sorted(found):
        doc = int(np.searchsorted(runs_before, run, side="right") - 1)
        first = ptr[doc] + (run - runs_before[doc]) * index.window
        passage = hashes[first:min(ptr[doc + 1], first + 2 * index.window)]
        if run != last:
            # A side of fewer than five words is one run of its own length.
            last, held = run, np.concatenate([
                shingles(passage, np.array([0, len(passage)]), SHINGLE)[0], _short_runs(passage)])
        question, answer, whole = (s.overlap(passage, held) for s in index.sides[item])
        if (question >= settings.question and answer >= settings.answer) or whole >= settings.whole:
            got = (score, question, answer, whole, -int(first - ptr[doc]))
            best[doc, item] = max(best.get((doc, item), got), got)
    return [(doc, int(index.items[item]), *row, -p) for (doc, item), (*row, p) in best.items()]


def _short_runs(passage: np.ndarray) -> np.ndarray:
    """Hashes of all runs of 1 to 4 words as :func:`shingles` makes them for short texts."""
    out = []
    for n in range(1, SHINGLE):
        if len(passage) >= n:
            rows = np.lib.stride_tricks.sliding_window_view(passage, n)
            out.append(shingles(np.ascontiguousarray(rows).ravel(), np.arange(0, rows.size + 1, n), SHINGLE)[0])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the column ``leaks``: the test items found in each whole text.

    Null and empty texts, and test items without a word, have no leaks. An item without an
    id is reported as -1. Repeated documents each get their own result. With an empty test
    set all lists are empty.
    """
    indexes = build_indexes(benchmark, settings)
    # As large as the test set, whatever the size of the corpus.
    shipped = docs.sparkSession.sparkContext.broadcast(indexes)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()),
                               ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
                               ("item_overlap", pa.float64()), ("passage", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch["text"].to_pylist()
            found: list[list[tuple]] = [[] for _ in texts]
            for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
                hashes, ptr = words(texts[a:b])
                for index in shipped.value:
                    for doc, *row in search(index, hashes, ptr, settings):
                        found[a + doc].append(tuple(row))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([sorted(x) for x in found], kind)],
                names=[*batch.schema.names, "leaks"])

    return docs.mapInArrow(scan, docs.withColumn("leaks", F.lit(None).cast(FOUND)).schema)


def leaked_passages(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, score, overlaps and start word of the passage, one row per found pair."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, settings)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    plain, back = set_aside(docs, "text")
    return find_leaks(plain, benchmark, settings).where(F.size("leaks") == 0).select(*back)
