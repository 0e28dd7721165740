import zlib

from opslog.llm.sharding import plan_shards
from tests.llm.conftest import ODD, documents


def brute(rows, shards):
    def size(t):
        return len((t or "").encode("utf-8", "surrogatepass")) + 1

    total, at, out = sum(size(t) for _, t in rows), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), size(r[1]))):
        at += size(t)
        out.append((i, size(t), zlib.crc32((t or "").encode()), (2 * at - size(t)) * shards // (2 * total)))
    seen: dict[int, int] = {}
    full = []
    for i, s, c, k in out:
        full.append((i, s, c, "bytes", k, seen.get(k, 0), None))
        seen[k] = seen.get(k, 0) + 1
    return full


def got(df, shards):
    cols = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return sorted((tuple(r) for r in plan_shards(df, shards).select(*cols).collect()), key=repr)


def test_equals_a_sequential_cut(spark, words):
    rows = [(i * 3 % 101, words(1 + i * i % 60)) for i in range(101)]
    assert got(documents(spark, rows), 8) == sorted(brute(rows, 8), key=repr)


def test_sizes_are_near_equal_with_one_hot_id(spark, words):
    rows = [(7 if i % 3 == 0 else i, words(20)) for i in range(300)]
    out = got(documents(spark, rows), 8)
    sizes = [sum(r[1] for r in out if r[4] == k) for k in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r[1] for r in out)


def test_odd_rows_and_extra_columns(spark):
    assert got(documents(spark, ODD, extra=True), 4) == sorted(brute(ODD, 4), key=repr)


def test_empty_table(spark):
    assert got(documents(spark, []), 8) == []


def test_fewer_documents_than_shards(spark):
    out = got(documents(spark, [(1, "a"), (2, "b")]), 8)
    assert [r[5] for r in out] == [0, 0] and len({r[4] for r in out}) == 2
