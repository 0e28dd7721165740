"""Near-duplicate embeddings by E8 lattice hashing with exact cosine (operator 9)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from opslog.llm.common import components, stored, tasks_for
from opslog.llm.words import mix


@dataclass(frozen=True)
class Settings:
    """A key is the product of ``blocks`` E8 points of a table; see :meth:`for_rows`.

    There are as many tables as keep the chance that a pair exactly at the threshold meets in
    none of them below ``miss``, by a trial on random pairs.
    """

    cosine: float = 0.93
    miss: float = 5e-5
    blocks: int = 1
    scale: float = 1.6
    probes: int = 8
    block: int = 512
    seed: int = 8

    def for_rows(self, rows: int) -> Settings:
        """Finer cells for more vectors of one label, so that cells do not fill up with them.

        Up to ``ONE_BLOCK`` one E8 point is a key, then two, from ``TWO_BLOCKS`` on three. The
        lattice gets finer with the power 0.055 of the rows: a random pair of vectors shares a
        cell of b blocks with a chance that falls with about the 7 b-th power of the fineness,
        that is with the power 0.75 of the rows or more.
        """
        if rows <= ONE_BLOCK:
            return self
        three = rows > TWO_BLOCKS
        finer = (rows / (TWO_BLOCKS if three else ONE_BLOCK)) ** 0.055
        return replace(self, blocks=3 if three else 2, scale=(1.1 if three else 1.25) * finer, probes=16)


ONE_BLOCK = 4_000
TWO_BLOCKS = 4_000_000
TRIAL_PAIRS = 4_000
MOST_TABLES = 16
ROWS_PER_TASK = 100_000
#: Linked pairs of groups that are settled at once; a group is never cut.
SETTLED_PAIRS = 100_000
#: Rows of a group that is compared together with others of its kind.
FEW = 8


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, by their rule."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _minimal_vectors()


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest lattice point: the nearer of the nearest in D8 and in D8 + 1/2."""
    def nearest_d8(z: np.ndarray) -> np.ndarray:
        point = np.rint(z)
        off = z - point
        odd = np.flatnonzero(point.sum(1).astype(np.int64) & 1)
        worst = np.abs(off[odd]).argmax(1)
        point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
        return point

    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


@cache
def _bases(dim: int, tables: int, settings: Settings) -> np.ndarray:
    """Orthonormal directions: (tables, blocks, dim, 8). Vectors of fewer than 8 parts for each
    block have fewer blocks."""
    blocks = max(1, min(settings.blocks, dim // 8))
    rng = np.random.default_rng([settings.seed, dim])
    out = []
    for _ in range(tables):
        raw = rng.normal(size=(dim, 8 * blocks))
        basis = np.linalg.qr(raw)[0] if dim >= 8 else np.linalg.qr(raw.T)[0].T
        out.append(basis.reshape(dim, blocks, 8).transpose(1, 0, 2))
    return np.array(out)


def _keys(units: np.ndarray, bases: np.ndarray, table: int, settings: Settings) -> np.ndarray:
    """Hashes of the own cell and the ``probes`` nearest other ones: (vectors, 1 + probes).

    A neighbouring cell has a neighbouring lattice point in some of its blocks; the nearest ones
    have the least sum of what each point is farther away than the own one.
    """
    n, dim = units.shape
    salt = np.random.default_rng([settings.seed, 1]).integers(1, 2**63, (len(bases), 8))
    salt = salt.astype(np.uint64) * np.uint64(2) + np.uint64(1)
    keys, far = np.zeros((n, 1), np.uint64), np.zeros((n, 1))
    for basis, odd in zip(bases, salt, strict=True):
        y = units @ basis * (np.sqrt(max(dim, 8) / 8) * settings.scale)
        home = nearest_e8(y)
        gap = 2 - 2 * (y - home) @ NEIGHBOURS.T
        near = np.argpartition(gap, settings.probes, axis=1)[:, :settings.probes]
        points = np.concatenate([home[:, None], home[:, None] + NEIGHBOURS[near]], axis=1)
        hashed = ((2 * points).astype(np.int64).astype(np.uint64) * odd).sum(2, dtype=np.uint64)
        more = np.concatenate([np.zeros((n, 1)), np.take_along_axis(gap, near, 1)], axis=1)
        keys = mix(keys[:, :, None] + hashed[:, None]).reshape(n, -1)
        far = (far[:, :, None] + more[:, None]).reshape(n, -1)
        if keys.shape[1] > 1 + settings.probes:
            # The own cell is the first, at no distance, and stays first.
            best = np.argpartition(far[:, 1:], settings.probes, axis=1)[:, :settings.probes] + 1
            best = np.concatenate([np.zeros((n, 1), np.int64), best], axis=1)
            keys, far = np.take_along_axis(keys, best, 1), np.take_along_axis(far, best, 1)
    return mix(keys + np.uint64(table + 1))


@cache
def tables_for(dim: int, settings: Settings) -> int:
    """Number of tables that keeps a miss at the threshold below ``settings.miss``."""
    rng = np.random.default_rng([settings.seed, dim, 2])
    x, z = rng.normal(size=(2, TRIAL_PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(z, axis=1, keepdims=True)
    z = np.divide(z, size, out=np.zeros_like(z), where=size > 1e-9)
    y = settings.cosine * x + np.sqrt(1 - settings.cosine**2) * z
    trials, met = 4, 0
    each = TRIAL_PAIRS // trials
    for t, bases in enumerate(_bases(dim, trials, settings)):
        some = slice(t * each, (t + 1) * each)
        a, b = _keys(x[some], bases, t, settings), _keys(y[some], bases, t, settings)
        met += int((a[:, :, None] == b[:, None]).any((1, 2)).sum())
    missed = (TRIAL_PAIRS - met + 1) / (TRIAL_PAIRS + 1)
    needed = np.ceil(np.log(settings.miss) / np.log(missed)) if missed < 1 else MOST_TABLES
    return int(np.clip(needed, 2, MOST_TABLES))


def cells(units: np.ndarray, settings: Settings) -> np.ndarray:
    """Hashes of the cells of each vector: (vectors, tables, 1 + probes), the own cell first."""
    bases = _bases(units.shape[1], tables_for(units.shape[1], settings), settings)
    return np.stack([_keys(units, b, t, settings) for t, b in enumerate(bases)], axis=1)


def _units(raw: list[bytes], dtype: type) -> np.ndarray:
    x = np.array([np.frombuffer(r, dtype) for r in raw]).astype(np.float64)
    # By the largest component first: squares neither overflow nor vanish.
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _pack(dtype: type):
    """Vector as bytes, or null where it is null, zero or has a null or non-finite part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(len(batch), None, object)
            sizes = pc.fill_null(pc.list_value_length(batch["embedding"]), 0).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == size)
                parts = pc.list_flatten(batch["embedding"].take(pa.array(rows)))
                parts = pc.cast(parts, pa.from_numpy_dtype(dtype), safe=False)
                # A null part counts as not finite.
                x = pc.fill_null(parts, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, size)
                good = np.isfinite(x).all(1) & x.any(1)
                out[rows[good]] = [v.tobytes() for v in x[good]]
            yield pa.record_batch([batch["vec_id"], batch["label"], pa.array(out, pa.binary())],
                                  names=["vec_id", "label", "raw"])
    return run


def _deal(settings: Settings, dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["raw"].to_pylist()
            by_size: dict[int, list[int]] = {}
            for i, r in enumerate(raw):
                by_size.setdefault(len(r), []).append(i)
            for size, rows in by_size.items():
                for a in range(0, len(rows), 2048):
                    some = rows[a:a + 2048]
                    found = cells(_units([raw[i] for i in some], dtype), settings)
                    per = found.shape[1] * found.shape[2]
                    at = pa.array(np.repeat(some, per))
                    yield pa.record_batch([
                        batch["label"].take(at), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(found.reshape(-1).view(np.int64)), batch["node"].take(at),
                    ], names=["label", "size", "cell", "node"])
    return run


def _reach(units: np.ndarray, p: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    """Whether each pair of rows reaches the threshold, in double precision."""
    return np.einsum("ij,ij->i", units[p], units[q]) >= cosine


def _linked(units: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows ``i`` with the rows ``j`` that reach the threshold. The last bits of a
    matrix product vary with its shape, so :func:`_reach` decides the pairs next to the threshold
    and a pair has one answer in all groups."""
    found = units[i] @ units[j].T
    p, q = np.nonzero(found >= cosine - 1e-12)
    near = np.flatnonzero(found[p, q] < cosine + 1e-12)
    p, q = i[p], j[q]
    return (p, q) if not len(near) else tuple(
        np.delete(x, near[~_reach(units, p[near], q[near], cosine)]) for x in (p, q))


def _numbered(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct ones of ``rows``, all below ``n``, in order; the number of each row among them)."""
    seen = np.zeros(n, bool)
    seen[rows] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[rows]


def _first_meeting(units: np.ndarray, i: np.ndarray, j: np.ndarray, cell: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether its ``cell`` is where each pair of rows meets first: in the first table in which
    it meets, the smallest cell.

    A pair meets in every cell that both are dealt to. Every meeting sees both vectors whole,
    so all of them agree on the first. Nearly all pairs meet in the first table; the cells of
    the others are found only for the rest.
    """
    dim = units.shape[1]
    out, left = np.zeros(len(i), bool), np.arange(len(i))
    for table, bases in enumerate(_bases(dim, tables_for(dim, settings), settings)):
        used, pairs = _numbered(np.stack([i[left], j[left]], 1), len(units))
        own = np.sort(np.concatenate([
            _keys(units[used[a:a + 2048]], bases, table, settings) for a in range(0, len(used), 2048)]), axis=1)
        apart = []
        for a in range(0, len(left), 8_000):
            some = left[a:a + 8_000]
            both = own[pairs[a:a + 8_000]].reshape(len(some), -1)
            both.sort(axis=1)
            same = both[:, 1:] == both[:, :-1]
            at = same.argmax(1)
            row = np.arange(len(some))
            met = same[row, at]
            out[some] = met & (both[row, at] == cell[some])
            apart.append(some[~met])
        left = np.concatenate(apart)
        if not len(left):
            break
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that cut no group of equal ``key``, and where their groups begin."""
    rest: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        rows = pa.Table.from_batches([*rest, *([] if batch is None else [batch])]) if rest or batch is not None else None
        if rows is None or not len(rows):
            continue
        rows = rows.combine_chunks()
        new = np.zeros(len(rows), bool)
        new[0] = True
        for name in key:
            code = pc.dictionary_encode(rows[name]).combine_chunks().indices.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        begins = np.flatnonzero(new)
        if batch is not None:
            # The last group may go on in the next batch.
            rest = rows.slice(begins[-1]).to_batches()
            rows, begins = rows.slice(0, begins[-1]), begins[:-1]
        if len(begins):
            yield rows, begins


def _meet(settings: Settings, dtype: type):
    """One group per (label, size, cell, left block, right block), rows sorted by that key.

    Sends one row per vector with links in the group: the number of links first met here,
    and the smallest node its links reach here. Groups are small and many, so the cells of
    linked vectors are found for many groups at once, and once for each vector among them;
    groups of a few rows are compared together, at each distance between two rows.
    """
    def settle(rows: dict[str, np.ndarray], units: np.ndarray, p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        """``p`` and ``q`` are the rows of linked pairs; no pair lies in two groups."""
        cell = rows["cell"][p].view(np.uint64)
        used, pairs = _numbered(np.stack([p, q]), len(units))
        (p, q), nodes, copies = pairs, rows["node"][used], rows["copies"][used]
        _, at, vector = np.unique(nodes, return_index=True, return_inverse=True)
        mine = _first_meeting(units[used[at]], vector[p], vector[q], cell, settings)
        least = nodes.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, p, least[q])
            np.minimum.at(least, q, least[p])
            if (before == least).all():
                break
        count = (np.bincount(p[mine], copies[q[mine]], len(used))
                 + np.bincount(q[mine], copies[p[mine]], len(used))).astype(np.int64)
        return pa.record_batch([pa.array(nodes), pa.array(count), pa.array(least)], names=["node", "links", "least"])

    def of_one_size(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = {n: table[n].to_numpy() for n in ("cell", "left", "right", "block", "node", "copies")}
        units = _units(table["raw"].to_pylist(), dtype)
        sizes = np.diff(np.append(begins, len(table)))
        whole = rows["left"][begins] == rows["right"][begins]
        few = np.repeat(np.where(whole & (sizes <= FEW), np.arange(len(begins)), -1), sizes)
        ps, qs, pairs = [], [], 0
        for away in range(1, FEW):
            p = np.flatnonzero((few[:-away] == few[away:]) & (few[:-away] >= 0))
            for a in range(0, len(p), 4_096):
                some = p[a:a + 4_096]
                some = some[_reach(units, some, some + away, settings.cosine)]
                ps.append(some), qs.append(some + away)
                pairs += len(some)
        for g in np.flatnonzero(~whole | (sizes > FEW)).tolist():
            member = np.arange(begins[g], begins[g] + sizes[g])
            if whole[g]:
                p, q = _linked(units, member, member, settings.cosine)
                p, q = p[p < q], q[p < q]
            else:
                block = rows["block"][member]
                p, q = _linked(units, member[block == rows["left"][member[0]]],
                               member[block == rows["right"][member[0]]], settings.cosine)
            ps.append(p), qs.append(q)
            pairs += len(p)
            if pairs >= SETTLED_PAIRS:
                yield settle(rows, units, np.concatenate(ps), np.concatenate(qs))
                ps, qs, pairs = [], [], 0
        if pairs:
            yield settle(rows, units, np.concatenate(ps), np.concatenate(qs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_groups(batches, ["label", "size", "cell", "left", "right"]):
            # Vectors of one size follow each other; those of one label and size at least.
            size = table["size"].to_numpy()[begins]
            cut = np.flatnonzero(np.diff(size, prepend=-1))
            for x, y in zip(cut, np.append(cut[1:], len(begins)), strict=True):
                first, stop = begins[x], begins[y] if y < len(begins) else len(table)
                yield from of_one_size(table.slice(first, stop - first), begins[x:y] - first)
    return run


def similar_vectors(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``embeddings``.

    Only vectors of the same non-null label and the same length are compared. A vector that
    is null, empty, zero or has a null or non-finite part has no links and is its own
    component; so is a row without a vec_id, whose component is null and which is kept.
    Repeated rows are vectors of their own. Extra columns are ignored.

    Equal vectors are one node with a number of copies. A node goes to its own cell and its
    nearest neighbour cells in each table, as fine as the largest label asks for
    (:meth:`Settings.for_rows`); what meets in a cell is compared exactly. A cell
    with more than ``block`` vectors is cut into blocks, and each pair of blocks is a group
    of its own, so no group holds more than two blocks. Groups return one row per vector,
    not per pair: a link counts where the pair meets first.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["embedding"].dataType
    dtype = np.float32 if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else np.float64
    label = embeddings.schema["label"].dataType.simpleString()
    packed = embeddings.select("vec_id", "label", "embedding").mapInArrow(
        _pack(dtype), f"vec_id bigint, label {label}, raw binary")
    good = F.col("raw").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    packed = stored(
        packed.withColumn("node", F.when(good, F.xxhash64("label", "raw"))), "vectors")
    nodes = stored(
        packed.where("node is not null").groupBy("label", "node", "raw")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first")), "nodes")
    sizes = nodes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    settings = settings.for_rows(sizes[0] or 0)
    width = tasks_for(spark, (sizes[1] or 0) * 2 * (1 + settings.probes), ROWS_PER_TASK)
    dealt = stored(nodes.select("label", "node", "raw").mapInArrow(
        _deal(settings, dtype), f"label {label}, size int, cell bigint, node bigint"), "cells")
    key = ["label", "size", "cell"]
    shared = (
        dealt.groupBy(*key).count().where("count > 1")
        .select(*key, F.ceil(F.col("count") / settings.block).cast("int").alias("blocks")))
    # Only what meets somebody takes its vector along.
    met_by = dealt.join(shared, key).join(nodes.select("node", "copies", "raw"), "node")
    blocked = met_by.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    groups = blocked.select("*", other).select(
        *key, F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        "block", "node", "copies", "raw")
    by = [*key, "left", "right"]
    met = stored(
        groups.repartition(width, *by).sortWithinPartitions(*by)
        .mapInArrow(_meet(settings, dtype), "node bigint, links bigint, least bigint"), "met")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups_of = components(met.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = (
        nodes.select("node", "copies", "first").join(counts, "node", "left").join(groups_of, "node", "left")
        .withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    result = named.join(ids, "component").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return packed.select("vec_id", "node").join(result, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
