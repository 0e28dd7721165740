import numpy as np
import pyarrow as pa

from opslog.llm import lattice
from opslog.llm.lattice import NEIGHBOURS, Settings, cells, nearest_e8, similar_vectors, tables_for

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    links = {i: 0 for i, _, _ in rows}
    top = {i: i for i, _, _ in rows}
    found = []
    for a, (i, x, l) in enumerate(rows):
        for j, y, m in rows[:a]:
            if l is None or l != m or x is None or y is None or len(x) != len(y):
                continue
            x64, y64 = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
            if not (x64.any() and y64.any()):
                continue
            if x64 @ y64 / np.linalg.norm(x64) / np.linalg.norm(y64) >= cosine:
                links[i] += 1
                links[j] += 1
                found.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in found:
            low = min(top[i], top[j])
            changed |= top[i] != low or top[j] != low
            top[i] = top[j] = low
    return {i: (links[i], top[i], top[i] == i) for i in links}


def result(df, **settings):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in similar_vectors(df, Settings(**settings)).collect()}


def vectors(n=500, dim=24):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(0, 40)] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3)) if i % 50 else None))
    return rows


def test_equals_brute_force(spark):
    rows = vectors()
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_blocks_of_a_full_cell_change_nothing(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in base + rng.normal(size=16) * 0.15], 1) for i in range(200)]
    assert result(spark.createDataFrame(rows, SCHEMA), block=16) == brute(rows)


def test_odd_vectors_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    same = [1.0] * 10
    rows = [(1, same, 1), (2, same, 1), (2, same, 1), (3, [2.0] * 10, 1), (4, same, 2), (5, same, None), (6, None, 1),
            (7, [], 1), (8, [0.0] * 10, 1), (9, [1.0] * 9 + [nan], 1), (10, [1.0] * 9 + [inf], 1), (11, [1.0] * 9 + [None], 1),
            (12, [1.0] * 11, 1), (13, [1.0, 2.0], 1), (14, [2.0, 4.0], 1), (None, same, 1), (15, [1e30] * 10, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as raw", "1 as node", "2 as cell")
    got = {}
    for r in similar_vectors(df).collect():
        got.setdefault(r.vec_id, set()).add((r.n_links, r.component_id, r.kept))
    assert got[1] == {(4, 1, True)} and got[2] == {(4, 1, False)} and got[3] == {(4, 1, False)} and got[15] == {(4, 1, False)}
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert got[i] == {(0, i, True)}, i
    assert got[13] == {(1, 13, True)} and got[14] == {(1, 13, False)} and got[None] == {(0, None, True)}
    assert similar_vectors(df.limit(0)).count() == 0


def test_nearest_point_is_a_lattice_point_and_nearest():
    y = np.random.default_rng(1).normal(size=(500, 8)) * 2
    p = nearest_e8(y)
    assert ((p * 2 == np.rint(p * 2)).all() and (p.sum(1) % 2 == 0).all())
    off = ((y - p) ** 2).sum(1)
    for r in NEIGHBOURS:
        assert (off <= ((y - p - r) ** 2).sum(1) + 1e-9).all()
    assert len(NEIGHBOURS) == 240 and np.allclose((NEIGHBOURS ** 2).sum(1), 2)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    for dim, rows in ((64, 100), (24, 100), (64, 8_000), (24, 8_000), (64, 200_000), (128, 8_000_000)):
        settings = Settings().for_rows(rows)
        x = unit(rng.normal(size=(1500, dim)))
        z = rng.normal(size=x.shape)
        z = unit(z - (z * x).sum(1, keepdims=True) * x)
        a, b = cells(x, settings), cells(0.93 * x + np.sqrt(1 - 0.93**2) * z, settings)
        met = (a[:, :, :, None] == b[:, :, None]).any((1, 2, 3))
        assert met.mean() > 0.998, (dim, rows, met.mean(), tables_for(dim, settings))


def test_comparisons_of_a_vector_grow_slower_than_the_vectors():
    rng = np.random.default_rng(3)
    per = []
    for n in (8_000, 32_000):
        x = unit(rng.normal(size=(n, 64)))
        settings = Settings().for_rows(n)
        found = np.concatenate([cells(x[a:a + 4_000], settings) for a in range(0, n, 4_000)])
        _, members = np.unique(found, return_counts=True)
        per.append((members.astype(float) * (members - 1)).sum() / 2 / n)
    assert per[1] < 2 * per[0] and per[0] < 150, per


def test_finer_cells_find_the_same_links(spark):
    """Product keys of two points against brute force."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 32))
    rows = [(i, [float(np.float32(v)) for v in base[i % 30] + rng.normal(size=32) * 0.2], i % 2) for i in range(300)]
    fine = Settings().for_rows(10_000)
    assert fine.blocks == 2
    assert result(spark.createDataFrame(rows, SCHEMA), blocks=2, scale=fine.scale, probes=16) == brute(rows)


def test_meetings_hash_a_vector_once_for_many_groups(monkeypatch):
    """Six near vectors in every cell they share: 15 links, found in many groups, across batches."""
    rng = np.random.default_rng(7)
    settings = Settings().for_rows(10_000)
    x = unit(rng.normal(size=32) + rng.normal(size=(6, 32)) * 0.05).astype(np.float32)
    found = cells(lattice._units([v.tobytes() for v in x], np.float32), settings).reshape(6, -1)
    rows = sorted((int(c), i) for i in range(6) for c in set(found[i].view(np.int64).tolist()))
    batch = pa.record_batch([
        pa.array([1] * len(rows), pa.int32()), pa.array([128] * len(rows), pa.int32()), pa.array([c for c, _ in rows]),
        *(pa.array([0] * len(rows), pa.int32()) for _ in range(3)), pa.array([10 + i for _, i in rows]),
        pa.array([1] * len(rows)), pa.array([x[i].tobytes() for _, i in rows], pa.binary()),
    ], names=["label", "size", "cell", "left", "right", "block", "node", "copies", "raw"])
    hashed = []
    keys = lattice._keys
    monkeypatch.setattr(lattice, "_keys", lambda units, *rest: hashed.append(len(units)) or keys(units, *rest))

    def links(batches):
        got = {}
        for out in lattice._meet(settings, np.float32)(iter(batches)):
            for node, n, least in zip(*(c.to_pylist() for c in out.columns), strict=True):
                got[node] = got.get(node, 0) + n
                assert least >= 10
        return got

    assert links([batch]) == {10 + i: 5 for i in range(6)}
    groups = len({c for c, _ in rows})
    assert groups > 20 and sum(hashed) <= 6 * tables_for(32, settings), (groups, hashed)
    assert links([batch.slice(a, 7) for a in range(0, len(batch), 7)]) == {10 + i: 5 for i in range(6)}


def test_vectors_of_whole_numbers_and_odd_parts_are_packed(spark):
    rows = [(1, [1, 2, 3], 1), (2, [2, 4, 6], 1), (3, [0, 0, 0], 1), (4, [1, None, 3], 1), (5, None, 1), (6, [], 1), (7, [5], 1)]
    got = result(spark.createDataFrame(rows, "vec_id bigint, embedding array<int>, label int"))
    assert got == {1: (1, 1, True), 2: (1, 1, False)} | {i: (0, i, True) for i in range(3, 8)}
