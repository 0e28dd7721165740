"""Near duplicates by Order MinHash with banded alignment (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import components, set_aside, small, spans, stored, tasks_for
from opslog.llm.words import BATCH_CHARS, STEP, mix, powers, shingles, words


@dataclass(frozen=True)
class Settings:
    """Shingles of ``k`` words; ``sketches`` samples of ``order`` shingles kept in text order.

    Two texts meet if one whole sample agrees. At similarity 0.8 a sample agrees with
    probability of about 0.8**4, so 24 samples miss a pair about three times in a million.
    ``worth`` and ``close`` are numbers of equal shingles, rank by rank, of the 96 in all
    samples; 57 are expected at similarity 0.8 and 84 at 0.95. From ``worth`` on a pair is
    verified, from ``close`` on one text stands for another under a key.
    """

    k: int = 5
    similarity: float = 0.8
    sketches: int = 24
    order: int = 4
    expected: int = 14
    close: int = 84
    worth: int = 33
    crowd: int = 8
    leaders: int = 1_024
    block: int = 1_024
    block_words: int = 1_000_000


ROWS_PER_TASK = 1_000_000
TEXTS_PER_TASK = 10_000
PAIRS_AT_ONCE = 50_000
EDGES_PER_BATCH = 10_000


def text_keys(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A hash of the whole word sequence of each text; 0 for a text without a word."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(int(STEP), n), out=sums[1:])
    inverse = powers(pow(int(STEP), -1, 2**64), n + 1)
    value = mix((sums[ptr[1:]] - sums[ptr[:-1]]) * inverse[ptr[:-1]] + np.diff(ptr).astype(np.uint64))
    return np.where(np.diff(ptr) > 0, value, np.uint64(0))


def occurrence_labelled(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Shingles that tell the second, third, ... occurrence in a text from the first."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    count = np.zeros(len(v), np.uint64)
    count[order] = (np.arange(len(v)) - start).astype(np.uint64)
    return mix(values + count * STEP)


def sketches(values: np.ndarray, ptr: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(sample keys, one byte of each shingle of a sample from the smallest hash on), by text.

    All are zero for an empty text.

    A sample takes the ``order`` labelled shingles with the smallest hashes and hashes them
    in the order in which they stand in the text. Only shingles below a value that about
    ``expected`` of a text reach are sorted; a text with too few of them is done in full.
    """
    docs = len(ptr) - 1
    sizes = np.diff(ptr)
    keys = np.zeros((docs, settings.sketches), np.uint64)
    small = np.zeros((docs, settings.sketches, settings.order), np.uint8)
    if not len(values):
        return keys, small.reshape(docs, -1)
    share = np.minimum(1.0, settings.expected / np.maximum(sizes, 1))
    limit = np.full(docs, 2**64 - 1, np.uint64)
    limit[share < 1] = (share[share < 1] * 2.0**64).astype(np.uint64)
    below = np.repeat(limit, sizes)
    doc_of = np.repeat(np.arange(docs, dtype=np.int64), sizes)
    base = np.random.default_rng(20).integers(1, 2**63, settings.sketches).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for j in range(settings.sketches):
        h = values * base[j]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        at = np.flatnonzero(h <= below)
        doc = doc_of[at]
        got = np.bincount(doc, minlength=docs)
        poor = np.flatnonzero(got < np.minimum(sizes, settings.order))
        if len(poor):
            extra = np.concatenate([np.arange(ptr[i], ptr[i + 1]) for i in poor])
            at = np.union1d(at, extra)
            doc = doc_of[at]
        by = np.lexsort((h[at], doc))
        at, doc = at[by], doc[by]
        first = np.searchsorted(doc, np.arange(docs))
        rank = np.arange(len(doc)) - first[doc]
        chosen = rank < settings.order
        at = at[chosen]
        small[doc[chosen], j, rank[chosen]] = (h[at] >> np.uint64(11)).astype(np.uint8)
        at = np.sort(at)
        doc = doc_of[at]
        first = np.searchsorted(doc, np.arange(docs))
        place = np.arange(len(doc)) - first[doc]
        key = np.full(docs, j + 1, np.uint64)
        for r in range(settings.order):
            mine = at[place == r]
            key[doc_of[mine]] = mix(key[doc_of[mine]] * STEP + values[mine])
        keys[:, j] = np.where(sizes > 0, key, 0)
    return keys, small.reshape(docs, -1)


class _Leaders:
    """Texts met so far under one sample key that no earlier one stands for."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.nodes: list[int] = []
        self.bytes = np.zeros((4, settings.sketches * settings.order), np.uint8)

    def meet(self, small: np.ndarray) -> tuple[int | None, bool]:
        """(the nearest leader if it is worth verifying, whether one stands for the text).

        This only finds most links at little cost; the texts of a key that are then still in
        different classes are all compared (:func:`_owned`).
        """
        n = len(self.nodes)
        if not n:
            return None, False
        agree = (self.bytes[:n] == small).sum(1)
        nearest = int(agree.argmax())
        if agree[nearest] < self.settings.worth:
            return None, False
        return self.nodes[nearest], bool(agree[nearest] >= self.settings.close or n >= self.settings.leaders)

    def add(self, node: int, small: np.ndarray) -> None:
        if len(self.nodes) == len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[len(self.nodes)] = small
        self.nodes.append(node)


SKETCHED = "doc_id bigint, raw bigint, node bigint, n_words bigint, key bigint, other bigint, small binary"


def _sketch(settings: Settings):
    """One row per text (doc_id, raw, node, n_words; small followed by all keys once per node
    of the task), per sample (key, node, small), and per pair found inside the task (node, other).

    Equal texts of one task are sketched once. Once ``crowd`` texts of the task share a key,
    a further text that one of them stands for sends the pair, and its key without a sketch,
    which the leaders of the key do not see: so a large group of near copies sends them a few
    rows per task. Such a text is compared under the key once its links are verified.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        crowds: dict[int, list[tuple[int, bytes]]] = {}
        for batch in small(batches):
            texts = batch["text"].to_pylist()
            keys_of, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            key_out, node_out, small_out, pair_out = [], [], [], set()
            small_of: list[bytes | None] = [None] * len(texts)
            for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
                hashes, word_ptr = words(texts[a:b])
                nodes = text_keys(hashes, word_ptr).view(np.int64)
                keys_of[a:b], counts[a:b] = nodes, np.diff(word_ptr)
                values, ptr = shingles(hashes, word_ptr, settings.k)
                keys, agreeing = sketches(occurrence_labelled(values, ptr), ptr, settings)
                rows = keys.view(np.int64).tolist()
                for i, node in enumerate(nodes.tolist()):
                    if ptr[i] == ptr[i + 1] or node in seen:
                        continue
                    seen.add(node)
                    mine = agreeing[i].tobytes()
                    small_of[a + i] = mine + keys[i].tobytes()
                    for key in rows[i]:
                        crowd = crowds.setdefault(key, [])
                        if len(crowd) < settings.crowd:
                            crowd.append((node, mine))
                        else:
                            every = np.frombuffer(b"".join(c[1] for c in crowd), np.uint8).reshape(len(crowd), -1)
                            agree = (every == agreeing[i]).sum(1)
                            if agree.max() >= settings.close:
                                pair_out.add((crowd[int(agree.argmax())][0], node))
                                key_out.append(key), node_out.append(node), small_out.append(None)
                                continue
                        key_out.append(key), node_out.append(node), small_out.append(mine)
            pairs = list(pair_out)
            none = [None] * len(texts)
            rest = [None] * (len(key_out) + len(pairs))
            yield pa.record_batch([
                pa.array(batch["doc_id"].to_pylist() + rest, pa.int64()),
                pa.array(batch["raw"].to_pylist() + rest, pa.int64()),
                pa.array(keys_of.tolist() + node_out + [p[1] for p in pairs], pa.int64()),
                pa.array(counts.tolist() + rest, pa.int64()),
                pa.array(none + key_out + [None] * len(pairs), pa.int64()),
                pa.array(none + [None] * len(key_out) + [p[0] for p in pairs], pa.int64()),
                pa.array(small_of + small_out + [None] * len(pairs), pa.binary()),
            ], names=["doc_id", "raw", "node", "n_words", "key", "other", "small"])
    return run


def _bucket_pairs(settings: Settings):
    """Rows come sorted by key. Each text is compared with the leaders of its key only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_now, leaders, waiting = None, None, None
        for batch in batches:
            keys, nodes, small = (batch[c].to_pylist() for c in ("key", "node", "small"))
            out: set[tuple[int, int]] = set()
            for key, node, raw in zip(keys, nodes, small, strict=True):
                if key != key_now:
                    key_now, leaders, waiting = key, None, (node, raw)
                    continue
                if leaders is None:
                    leaders = _Leaders(settings)
                    leaders.add(waiting[0], np.frombuffer(waiting[1], np.uint8))
                mine = np.frombuffer(raw, np.uint8)
                near, inside = leaders.meet(mine)
                if near is not None and near != node:
                    out.add((min(near, node), max(near, node)))
                if not inside:
                    leaders.add(node, mine)
            yield pa.record_batch([
                pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
    return run


def _grouped(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows that come sorted by their first three values, in lists of equal ones."""
    group: list[tuple] = []
    for row in rows:
        if group and row[:3] != group[0][:3]:
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _owned(rows: list[tuple], settings: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, other rows, agreement with them): the pairs of texts of one group to verify.

    A group is a key and two of its blocks, or one with itself. Its pairs are those in
    different classes and worth verifying whose first shared key it is, so each pair of texts
    belongs to one group only.
    """
    key, left, right = rows[0][:3]
    block, of = (np.array([r[c] for r in rows]) for c in (3, 5))
    looks = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1)
    _, inverse, sizes = np.unique(of, return_inverse=True, return_counts=True)
    # Small classes first: each text only meets the texts of the classes behind its own.
    order = np.lexsort((of, sizes[inverse]))
    block, of, looks = block[order], of[order], looks[order]
    every = looks[:, :settings.sketches * settings.order]
    keys = np.ascontiguousarray(looks[:, settings.sketches * settings.order:]).view(np.int64)
    ends = np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(of))
    for i, end in enumerate(np.repeat(ends, np.diff(ends, prepend=0)).tolist()):
        if end == len(of):
            break
        agree = (every[end:] == every[i]).sum(1)
        # Two texts of one block meet where it is compared with itself.
        met = np.flatnonzero((agree >= settings.worth) & ((left == right) | (block[end:] != block[i])))
        if len(met):
            met = met[keys[i][(keys[end + met] == keys[i]).argmax(1)] == key]
        if len(met):
            yield int(order[i]), order[end + met], agree[met]


def _needed(settings: Settings):
    """The rows of texts that belong to a pair to verify in their group, as they came."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def read() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple] = []
        for rows in _grouped(read()):
            met = np.zeros(len(rows), bool)
            for i, others, _ in _owned(rows, settings):
                met[i] = True
                met[others] = True
            out += [rows[i] for i in np.flatnonzero(met).tolist()]
            if len(out) >= EDGES_PER_BATCH:
                yield _as_batch(out, schema)
                out = []
        if out:
            yield _as_batch(out, schema)
    return run


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows whose last value is the word hashes of a text instead of the text."""
    for batch in small(batches, 200):
        *rest, texts = (c.to_pylist() for c in batch.columns)
        for a, b in spans([len(t) for t in texts], BATCH_CHARS):
            hashes, ptr = words(texts[a:b])
            for i in range(a, b):
                yield (*(c[i] for c in rest), hashes[ptr[i - a]:ptr[i - a + 1]].copy())


def _bridges(settings: Settings):
    """Rows come sorted by group, with their texts. Pairs of classes that verified pairs of a
    group join, as a spanning forest: pairs are verified in falling agreement, and those whose
    classes are joined by then are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out: list[int] = []
        b_out: list[int] = []
        for rows in _grouped(_hashed(batches)):
            found = list(_owned(rows, settings))
            if not found:
                continue
            one = np.repeat([i for i, _, _ in found], [len(o) for _, o, _ in found])
            two = np.concatenate([o for _, o, _ in found])
            order = np.argsort(-np.concatenate([g for _, _, g in found]), kind="stable")
            of = np.array([r[5] for r in rows])
            joined = of.copy()
            bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for at in range(0, len(order), PAIRS_AT_ONCE):
                part = order[at:at + PAIRS_AT_ONCE]
                part = part[joined[one[part]] != joined[two[part]]]
                for i, j in zip(one[part].tolist(), two[part].tolist(), strict=True):
                    if joined[i] == joined[j] or not _alike(rows[i][-1], rows[j][-1], i, j, bags, settings):
                        continue
                    joined[joined == joined[j]] = joined[i]
                    a_out.append(int(of[i])), b_out.append(int(of[j]))
            if len(a_out) >= EDGES_PER_BATCH:
                yield pa.record_batch([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
                a_out, b_out = [], []
        yield pa.record_batch([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
    return run


def _alike(a: np.ndarray, b: np.ndarray, i: int, j: int, bags: dict, settings: Settings) -> bool:
    for words_of, place in ((a, i), (b, j)):
        if place not in bags:
            grams, _ = shingles(words_of, np.array([0, len(words_of)]), settings.k)
            bags[place] = np.unique(grams, return_counts=True)
    return (_multiset_bound(bags[i], bags[j]) >= settings.similarity
            and aligned_similarity(a, b, settings.k, settings.similarity) >= settings.similarity)


def _prefix_hashes(a: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(mix(a) * powers(int(STEP), len(a)), out=sums[1:])
    return sums


def aligned_similarity(a: np.ndarray, b: np.ndarray, k: int = 5, least: float = 0.8) -> float:
    """Runs of k words that an alignment leaves whole, as a share of all runs of both texts.

    The alignment is one with the fewest inserted and deleted words, by furthest-reaching
    paths. Its band grows with each edit and ends where no alignment can reach ``least`` any
    more; then the result is 0. Texts of fewer than k words are one run each.
    """
    n, m = len(a), len(b)
    if n < k or m < k:
        return float(n == m and bool((a == b).all()))
    runs = n - k + 1 + m - k + 1
    # Each edit costs at least one run; matched / (runs - matched) has to reach least.
    most = int(np.ceil(runs * (1 - 2 * least / (1 + least)))) + 2
    if abs(n - m) > most:
        return 0.0
    power = powers(int(STEP), max(n, m) + 1)
    sums_a, sums_b = _prefix_hashes(a), _prefix_hashes(b)

    def extend(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from (x, y) on, by bisection over hashes of runs."""
        room = np.minimum(n - x, m - y)
        done = np.zeros(len(x), np.int64)
        step = 1 << int(room.max()).bit_length()
        while step:
            to = done + step
            fits = to <= room
            to = np.where(fits, to, 0)
            same = (sums_a[x + to] - sums_a[x]) * power[y] == (sums_b[y + to] - sums_b[y]) * power[x]
            done = np.where(fits & same, to, done)
            step >>= 1
        return done

    # far[i] is the furthest word of a reached on diagonal low + i (word of a - word of b).
    low, far = 0, extend(np.zeros(1, np.int64), np.zeros(1, np.int64))
    trail = []
    while True:
        goal = n - m - low
        if 0 <= goal < len(far) and far[goal] == n:
            break
        if len(trail) == most:
            return 0.0
        wide = np.full(len(far) + 4, -1, np.int64)
        wide[2:-2] = far
        low -= 1
        diagonal = low + np.arange(len(far) + 2)
        deleted = np.where(wide[:-2] >= 0, wide[:-2] + 1, -1)
        inserted = wide[2:]
        start = np.maximum(deleted, inserted)
        ok = (start >= 0) & (start <= n) & (start >= diagonal) & (start - diagonal <= m)
        x = np.where(ok, start, 0)
        far = np.where(ok, x + extend(x, np.where(ok, start - diagonal, 0)), -1)
        trail.append((low, deleted > inserted, x))
    matched, at, x = 0, n - m, n
    for low, by_deletion, start in reversed(trail):
        begin = int(start[at - low])
        matched += max(0, x - begin - k + 1)
        x, at = (begin - 1, at - 1) if by_deletion[at - low] else (begin, at + 1)
    matched += max(0, x - k + 1)
    return matched / (runs - matched)


def _multiset_bound(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two bags of shingles (values, counts); no alignment can exceed it."""
    (va, ca), (vb, cb) = a, b
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / max(1, int(ca.sum()) + int(cb.sum()) - both)


def _verify(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 200):
            left, right = batch["left"].to_pylist(), batch["right"].to_pylist()
            keep = np.zeros(len(left), bool)
            for s, e in spans([len(x) + len(y) for x, y in zip(left, right, strict=True)], BATCH_CHARS):
                pair_words, ptr = words([t for i in range(s, e) for t in (left[i], right[i])])
                grams, g_ptr = shingles(pair_words, ptr, settings.k)
                for i in range(s, e):
                    p = 2 * (i - s)
                    ga, gb = grams[g_ptr[p]:g_ptr[p + 1]], grams[g_ptr[p + 1]:g_ptr[p + 2]]
                    if _multiset_bound(np.unique(ga, return_counts=True), np.unique(gb, return_counts=True)) >= settings.similarity:
                        keep[i] = aligned_similarity(
                            pair_words[ptr[p]:ptr[p + 1]], pair_words[ptr[p + 1]:ptr[p + 2]],
                            settings.k, settings.similarity) >= settings.similarity
            at = pa.array(np.flatnonzero(keep))
            yield pa.record_batch([batch["a"].take(at), batch["b"].take(at)], names=["a", "b"])
    return run


def duplicate_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, raw (hash of the text as it is), class_id, one row per row of ``docs``.

    ``class_id`` is the smallest doc_id of the class. Texts with the same words in the same
    order are one text; different texts are linked when the five-word runs that a banded
    alignment leaves whole are at least ``similarity`` of all; classes are the connected
    components. Texts without a word (null, empty, only punctuation) are classes of their
    own, as are rows without a doc_id, whose class is null. A text of one to four words is
    one run and only joins equal texts.

    A group of copies shrinks to one text before anything is compared, and a group of near
    copies sends the leaders a few rows per task. Within a sample key a text first meets
    the leaders of the key, and the pair with the nearest is verified. Then all texts that
    share a key and are still in different classes are compared; those worth it are verified
    where they meet, and only the classes they join go on: no table holds the pairs.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").withColumn("raw", F.xxhash64("text"))
    found = stored(rows.mapInArrow(_sketch(settings), SKETCHED), "sketches")
    slim = found.where("n_words is not null").select("doc_id", "raw", "node", "n_words")
    heads = stored(
        slim.where("n_words > 0 and doc_id is not null").groupBy("node")
        .agg(F.min(F.struct("doc_id", "raw", "n_words")).alias("head")).select("node", "head.*"), "heads")
    keyed = found.where("key is not null and small is not null").select("key", "node", "small")
    width = tasks_for(spark, keyed.count(), ROWS_PER_TASK)
    # A different order under each key, so that not the same texts lead everywhere.
    buckets = keyed.repartition(width, "key").sortWithinPartitions("key", F.xxhash64("node", "key"))
    pairs = stored(
        buckets.mapInArrow(_bucket_pairs(settings), "a bigint, b bigint").union(
            found.where("other is not null").select(F.least("node", "other"), F.greatest("node", "other")))
        .where("a != b").distinct(), "pairs")
    again = not _repeated(slim).isEmpty()

    def bodies_of(wanted: DataFrame) -> DataFrame:
        bodies = heads.join(wanted.distinct(), "node").join(rows, ["doc_id", "raw"]).select("node", "text")
        return stored(bodies.dropDuplicates(["node"]) if again else bodies, "bodies")

    # The nearest leaders first.
    bodies = bodies_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    texts = (
        pairs.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        .join(bodies.select(F.col("node").alias("b"), F.col("text").alias("right")), "b"))
    links = stored(
        texts.select("a", "b", "left", "right").mapInArrow(_verify(settings), "a bigint, b bigint"), "links")
    classes = stored(
        heads.select("node", "n_words").join(components(links), "node", "left")
        .select("node", "n_words", F.coalesce("component", "node").alias("component")), "classes")
    # Then all texts that share a key and are still in different classes.
    tagged = stored(found.where("key is not null").select("key", "node").distinct().join(classes, "node"), "tagged")
    mixed = (
        tagged.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
             F.sum("n_words").alias("n_words"))
        .where("low < high")
        .select("key", F.greatest(F.ceil(F.col("n") / settings.block), F.ceil(F.col("n_words") / settings.block_words))
                .cast("int").alias("blocks")))
    looks = found.where("key is null and small is not null").select("node", "small")
    blocked = (
        tagged.select("key", "node", "component").join(stored(mixed, "mixed"), "key")
        .join(looks.dropDuplicates(["node"]), "node")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")))
    # A key with many texts is cut into blocks, and each pair of blocks is a group of its own.
    groups = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")).select(
        "key", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"),
        "block", "node", "component", "small")
    by = ["key", "left", "right"]
    needed = stored(
        groups.repartition(width, *by).sortWithinPartitions(*by).mapInArrow(_needed(settings), groups.schema), "needed")
    count = needed.count()
    if count:
        with_text = needed.join(bodies_of(needed.select("node")), "node").select(*needed.columns, "text")
        bridges = (
            with_text.repartition(tasks_for(spark, count, TEXTS_PER_TASK), *by).sortWithinPartitions(*by)
            .mapInArrow(_bridges(settings), "a bigint, b bigint"))
        # Only the classes that new links join are looked at again, not their members.
        merged = components(stored(bridges.distinct(), "bridges")).select(
            F.col("node").alias("before"), F.col("component").alias("after"))
        classes = stored(
            classes.select("node", F.col("component").alias("before")).join(merged, "before", "left")
            .select("node", F.coalesce("after", "before").alias("component")), "classes")
    named = heads.select("node", "doc_id").join(classes.select("node", "component"), "node")
    names = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    ids = named.join(names, "component").select("node", "class_id")
    whole = slim.where("n_words > 0 and doc_id is not null").join(ids, "node").select("doc_id", "raw", "class_id")
    alone = slim.where("n_words = 0 or doc_id is null").select("doc_id", "raw", F.col("doc_id").alias("class_id"))
    return whole.union(alone)


def _repeated(rows: DataFrame) -> DataFrame:
    """(doc_id, raw) of rows that are there more than once."""
    return rows.where("doc_id is not null").groupBy("doc_id", "raw").count().where("count > 1")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id and kept (the document stands for its class) for every row."""
    return duplicate_classes(docs, settings).select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id.

    Rows that repeat the same doc_id and text count as one; rows without a doc_id stay.
    """
    plain, back = set_aside(docs, "doc_id", "text")
    gone = (
        duplicate_classes(plain, settings).where("class_id != doc_id")
        .select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw")).distinct()
    )
    body = F.xxhash64(plain["text"])
    left = plain.join(gone, (plain["doc_id"] == F.col("_id")) & (body == F.col("_raw")), "left_anti")
    if not _repeated(plain.select("doc_id", F.xxhash64("text").alias("raw"))).isEmpty():
        whole = left.where("doc_id is not null").withColumn("_raw", F.xxhash64("text"))
        left = whole.dropDuplicates(["doc_id", "_raw"]).drop("_raw").union(left.where("doc_id is null"))
    return left.select(*back)
