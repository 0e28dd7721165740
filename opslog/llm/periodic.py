"""Runs of words that repeat with a period, found by recursive frequency splitting (operator 12).

Every word of a qualifying run occurs several times inside it. A word that is too rare within
its segment to be in such a run therefore splits the segment, and this goes on inside the
pieces until nothing splits. What survives is scanned at the lags that can be periods.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import small, spans
from opslog.llm.words import BASE, BASE_INVERSE, mix, powers

#: A run has at least this many words and repeats its period at least this often.
LEAST_WORDS = 6
LEAST_REPEATS = 4
#: Lags below this are scanned over the whole segment, longer ones where blocks repeat.
PLAIN_LAGS = 16
#: Characters handled at once; a longer text is handled alone and whole.
BATCH_CHARS = 1 << 20

Runs = np.ndarray  # rows of start, length, period


# --- recursive splitting --------------------------------------------------------------

def surviving_segments(ids: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """(start, end) of the stretches of texts ``ids[ptr[i]:ptr[i + 1]]`` left by splitting.

    A word of a run occurs at least four times in it, and at least six times where only a
    period of one word fits.
    """
    segment = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    place = np.arange(len(ids))
    n_words = int(ids.max()) + 1 if len(ids) else 1
    out = [np.zeros((0, 2), np.int64)]
    while len(place):
        sizes = np.bincount(segment)
        least = np.where(sizes < 2 * LEAST_REPEATS, LEAST_WORDS, LEAST_REPEATS)
        _, which, counts = np.unique(segment * n_words + ids[place], return_inverse=True, return_counts=True)
        common = counts[which] >= least[segment]
        split = np.zeros(len(sizes), bool)
        split[segment[~common]] = True
        stable = ~split[segment]
        if stable.any():
            firsts = np.flatnonzero(stable & np.r_[True, segment[1:] != segment[:-1]])
            out.append(np.stack([place[firsts], place[firsts] + sizes[segment[firsts]]], 1))
        left = common & ~stable
        place, before = place[left], segment[left]
        if not len(place):
            break
        new = np.r_[True, (np.diff(place) != 1) | (before[1:] != before[:-1])]
        segment = np.cumsum(new) - 1
        long = np.bincount(segment) >= LEAST_WORDS
        place, segment = place[long[segment]], (np.cumsum(long) - 1)[segment[long[segment]]]
    found = np.concatenate(out)
    found = found[found[:, 1] - found[:, 0] >= LEAST_WORDS]
    return found[np.argsort(found[:, 0])]


# --- lag scan -------------------------------------------------------------------------

def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.zeros(len(equal) + 2, np.int8)
    padded[1:-1] = equal
    edges = np.flatnonzero(np.diff(padded))
    return edges[::2], edges[1::2]


def _least_equal(lag: int) -> int:
    """Words in a row that equal the word ``lag`` later, in a run of that period."""
    return max(LEAST_WORDS, LEAST_REPEATS * lag) - lag


def _block_repeats(hashed: np.ndarray, block: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) where the block at a multiple of ``block`` comes again ``lag`` later, for
    ``block <= lag < 2 * block``. A run with such a period holds one of these pairs."""
    size = len(hashed) - block
    rows = size // block
    if rows < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    later = hashed[block:block + rows * block].reshape(rows, block)
    row, step = np.nonzero(later == hashed[:rows * block:block, None])
    lag, place = step + block, row * block
    fits = lag <= longest
    order = np.lexsort((place[fits], lag[fits]))
    return lag[fits][order], place[fits][order]


def _extend(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` whose words equal those ``lag`` later."""
    start, step = at, 4 * lag
    while start > 0:
        a = max(0, start - step)
        unequal = np.flatnonzero(words[a:start] != words[a + lag:start + lag])
        if len(unequal):
            start = a + int(unequal[-1]) + 1
            break
        start, step = a, 2 * step
    end, step, last = at, 4 * lag, len(words) - lag
    while end < last:
        b = min(last, end + step)
        unequal = np.flatnonzero(words[end:b] != words[end + lag:b + lag])
        if len(unequal):
            end += int(unequal[0])
            break
        end, step = b, 2 * step
    return start, end


def scan_segment(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one segment, every word compared exactly.

    Lags go upwards. Where a run of a shorter period covers a stretch, that period is the
    smallest one of the stretch, so it is not reported again.
    """
    n, found = len(words), []
    reach = np.zeros(n + 1, np.int64)  # furthest end of a run that starts at or before a place

    def add(starts: np.ndarray, ends: np.ndarray, lag: int) -> None:
        new = reach[starts] < ends
        found.extend((s, e - s, lag) for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True))
        np.maximum.at(reach, starts[new], ends[new])
        np.maximum.accumulate(reach, out=reach)

    longest = n // LEAST_REPEATS
    for lag in range(1, min(PLAIN_LAGS - 1, longest) + 1):
        starts, ends = _stretches(words[:-lag] == words[lag:])
        enough = ends - starts >= _least_equal(lag)
        if enough.any():
            add(starts[enough], ends[enough] + lag, lag)
    if longest < PLAIN_LAGS:
        return found
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + np.uint64(BASE)) * powers(BASE, n), out=sums[1:])
    inverse = powers(BASE_INVERSE, n + 1)
    block = PLAIN_LAGS
    while block <= longest:
        hashed = (sums[block:] - sums[:-block]) * inverse[:n + 1 - block]
        lags, places = _block_repeats(hashed, block, longest)
        open_ = reach[places] < places + lags + block
        seen, until, new = 0, 0, []
        for lag, place in zip(lags[open_].tolist(), places[open_].tolist(), strict=True):
            if lag == seen and place < until:
                continue
            start, end = _extend(words, place, lag)
            seen, until = lag, end
            if end - start >= _least_equal(lag):
                new.append((start, end + lag, lag))
        # Runs of one octave of lags never lie inside each other; shorter periods are in reach.
        for start, end, lag in new:
            add(np.array([start]), np.array([end]), lag)
        block *= 2
    return found


def find_runs(ids: np.ndarray, ptr: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, by start and then period; places count from the text's start."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ptr) - 1)]
    segments = surviving_segments(ids, ptr)
    owners = np.searchsorted(ptr, segments[:, 0], "right") - 1
    for (a, b), owner in zip(segments.tolist(), owners.tolist(), strict=True):
        shift = a - int(ptr[owner])
        out[owner].extend((s + shift, n, q) for s, n, q in scan_segment(ids[a:b]))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in out]


# --- jobs -----------------------------------------------------------------------------

def split_words(texts: list[str | None]) -> list[list[bytes]]:
    """Words between ASCII white space, as UTF-8."""
    return [(t or "").encode().split() for t in texts]


def _numbered(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ptr = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=ptr[1:])
    ids = np.fromiter((number[w] for text in words for w in text), np.int64, int(ptr[-1]))
    return ids, ptr


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.cumsum(edges)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Runs of every document: all of them, the longest one, and the text without repeats.

    A run is a maximal stretch of words with smallest period q, at least six words and four
    periods long. ``runs`` lists all; start, length, period and exponent_milli are those of
    the longest (ties: smallest start, then period), null without a run. ``collapsed`` is
    the text without the words that a run holds after its first period; it is null with
    ``keep_text`` false, its hash is not. Null and empty texts have no words. Repeated rows
    are answered each, null ids stay null, an empty table gives no rows, and extra columns are
    ignored. A text is handled whole in the task that read it; nothing is shuffled.
    """
    schema = (
        "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(RUN), pa.string()]
    names = [*(part.split()[0] for part in schema.split(", ")[:8]), "runs", "collapsed"]

    def answer(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> list:
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        text = _kept(words, runs)
        return [
            doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest(),
            [{"start": s, "length": n, "period": q} for s, n, q in runs] if keep_text else None,
            text.decode() if keep_text else None,
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
                words = split_words(texts[a:b])
                rows = list(map(answer, doc_ids[a:b], words, find_runs(*_numbered(words))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def planted_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the texts of a tenth of the ids repeat a stretch of their words.

    With h the CRC-32 of the decimal doc_id and g its tenth: where h ends in 0, the words from
    place g % n on repeat those of one period. Other texts, and those of null ids, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("words"),
    )
    n = F.size("words").cast("long")
    sized = chosen.withColumn("a", F.when(n > 0, F.col("g") % n))
    placed = sized.withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform("words", lambda _, i: F.get(F.col("words"), source(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(repeated, " ")).alias("text"))
