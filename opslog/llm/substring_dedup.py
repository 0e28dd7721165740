"""Removal of repeated 50-byte strings with merged Burrows-Wheeler transforms (operator 3).

Equal strings of 50 bytes pick the same anchor: the 20 bytes in them with the smallest hash.
A piece is a run of starts in one text with one anchor, together with the bytes up to the end
of its last string. Strings can only be equal in pieces with equal anchors, so pieces are dealt
out by anchor. Equal pieces shrink to the one in the smallest document; for anchors with more
than one kind of piece the bytes are fetched, each shard of them gets its Burrows-Wheeler
transform, and the merged transforms give the repeated intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm import bwt
from opslog.llm.common import small, spans, stored, tasks_for
from opslog.llm.words import BASE, BASE_INVERSE, mix, powers

LENGTH = 50
ANCHOR = 20
WINDOW = LENGTH - ANCHOR + 1
BATCH_BYTES = 1 << 19
PLACE_BITS = 31
BYTES_PER_BUCKET = 6_000_000
#: Symbols of pieces whose transforms are merged at once, in shards of half of that.
MERGE_SYMBOLS = 400_000
#: Kinds of pieces of one anchor that are still merged in one task.
CROWD = 4_096
PIECE = np.dtype([("anchor", "<u8"), ("kind", "<u8"), ("doc", "<i8"), ("raw", "<i8"), ("start", "<u4"), ("runs", "u1")])
INTERVALS = "doc_id bigint, raw bigint, cover binary"
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(piece records without doc and raw, index of the text of each) for whole texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n = len(raw)
    if n >= 1 << PLACE_BITS:
        raise ValueError("a text must be shorter than 2 GiB")
    if n < LENGTH:
        return np.zeros(0, PIECE), np.zeros(0, np.int64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[raw] * powers(BASE, n), out=sums[1:])
    inverse = powers(BASE_INVERSE, n + 1)
    short = n - ANCHOR + 1
    code = mix((sums[ANCHOR:] - sums[:short]) * inverse[:short])
    # Hash above, place below: the smallest is the leftmost anchor with the smallest hash.
    low = (code & np.uint64(2**64 - (1 << PLACE_BITS))) | np.arange(short, dtype=np.uint64)
    width = 1
    while width * 2 <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < WINDOW:
        low = np.minimum(low[:len(low) - (WINDOW - width)], low[WINDOW - width:])
    chosen = (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    start = np.arange(len(chosen))
    whole = text_of[:len(chosen)] == text_of[LENGTH - 1:LENGTH - 1 + len(chosen)]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | ~whole[:-1]
    first = start[new & whole]
    if not len(first):
        return np.zeros(0, PIECE), np.zeros(0, np.int64)
    border = np.append(np.flatnonzero(new | ~whole), len(chosen))
    last = border[np.searchsorted(border, first, side="right")]
    out = np.zeros(len(first), PIECE)
    at = chosen[first]
    out["anchor"] = code[at]
    out["runs"] = last - first
    stop = last - 1 + LENGTH
    out["kind"] = mix((sums[stop] - sums[first]) * inverse[first] + (at - first).astype(np.uint64) * np.uint64(7919)
                      + out["runs"].astype(np.uint64))
    which = text_of[first]
    out["start"] = first - (ends - sizes)[which]
    return out, which


def smallest_of_kind(got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of each kind in its smallest document, pieces that a smaller document has too)."""
    if not len(got):
        return got, got
    order = np.lexsort((got["doc"], got["kind"], got["anchor"]))
    got = got[order]
    new = np.ones(len(got), bool)
    new[1:] = (got["kind"][1:] != got["kind"][:-1]) | (got["anchor"][1:] != got["anchor"][:-1])
    least = got["doc"][new][np.cumsum(new) - 1]
    own = got["doc"] == least
    return got[own], got[~own]


def _covers(got: np.ndarray) -> pa.RecordBatch:
    """Rows (doc_id, raw, cover) for pieces that are removed whole: pairs of first and last byte."""
    return _cover_rows(got["doc"], got["raw"], got["start"].astype(np.int64),
                       got["start"].astype(np.int64) + got["runs"] + LENGTH - 1)


def _cover_rows(doc: np.ndarray, raw: np.ndarray, first: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((first, raw, doc))
    doc, raw = doc[order], raw[order]
    pairs = np.stack([first[order], stop[order]], 1).astype("<i4")
    change = np.ones(len(doc), bool)
    change[1:] = (doc[1:] != doc[:-1]) | (raw[1:] != raw[:-1])
    new = np.flatnonzero(change)
    ends = np.append(new, len(doc))[1:]
    return pa.record_batch([
        pa.array(doc[new], pa.int64()), pa.array(raw[new], pa.int64()),
        pa.array([pairs[a:b].tobytes() for a, b in zip(new, ends, strict=True)], pa.binary()),
    ], names=["doc_id", "raw", "cover"])


def _pack(got: np.ndarray) -> bytes:
    """Pieces column by column, documents as differences: what shuffles compress well.

    Of the anchor only the upper half goes along; with the bucket that is enough to tell
    groups apart, and groups may even collide, since kinds are compared in full.
    """
    parts = [(got["anchor"] >> np.uint64(32)).astype("<u4"), got["kind"], np.diff(got["doc"], prepend=np.int64(0)),
             np.diff(got["raw"], prepend=np.int64(0)), got["start"], got["runs"]]
    return np.int64(len(got)).tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack(raw: bytes, bucket: int) -> np.ndarray:
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    out, at = np.zeros(n, PIECE), 8
    for name, kind in (("anchor", "<u4"), ("kind", "<u8"), ("doc", "<i8"), ("raw", "<i8"), ("start", "<u4"), ("runs", "u1")):
        column = np.frombuffer(raw, kind, n, at)
        at += column.nbytes
        out[name] = np.cumsum(column) if name in ("doc", "raw") else column
    out["anchor"] |= np.uint64(bucket) << np.uint64(32)
    return out


def _scan(buckets: int):
    """Pieces of all texts, packed by bucket of their anchor, and covers settled at once.

    Within a batch a kind of piece is sent only for its smallest document, so a passage in
    very many documents comes to a bucket once per batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 4_000):
            texts = batch["body"].to_pylist()
            ids, raws = batch["doc_id"].to_numpy(), batch["raw"].to_numpy()
            for a, b in spans([len(t) for t in texts], BATCH_BYTES):
                got, which = pieces(texts[a:b])
                got["doc"], got["raw"] = ids[a:b][which], raws[a:b][which]
                sent, settled = smallest_of_kind(got)
                bucket = (sent["anchor"] % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((sent["start"], sent["raw"], sent["doc"], bucket))
                sent, bucket = sent[order], bucket[order]
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(first[1:], len(bucket))
                packed = [_pack(sent[x:y]) for x, y in zip(first, ends, strict=True)]
                cover = _covers(settled)
                none = pa.nulls(len(packed), pa.int64())
                anywhere = mix(cover["doc_id"].to_numpy().view(np.uint64)) % np.uint64(buckets)
                yield pa.record_batch([
                    pa.concat_arrays([pa.array(bucket[first], pa.int64()), pa.array(anywhere.astype(np.int64), pa.int64())]),
                    pa.concat_arrays([pa.array(packed, pa.binary()), pa.nulls(len(cover), pa.binary())]),
                    pa.concat_arrays([none, cover["doc_id"]]), pa.concat_arrays([none, cover["raw"]]),
                    pa.concat_arrays([pa.nulls(len(packed), pa.binary()), cover["cover"]]),
                ], names=["bucket", "packed", "doc_id", "raw", "cover"])
    return run


def _by_bucket(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Groups of rows that follow each other with the same bucket."""
    now, rows = None, []
    for batch in batches:
        for bucket, *row in zip(batch["bucket"].to_pylist(), *(batch[n].to_pylist() for n in names), strict=True):
            if rows and bucket != now:
                yield now, rows
                rows = []
            now = bucket
            rows.append(tuple(row))
    if rows:
        yield now, rows


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: covers of equal pieces, and the pieces whose anchor has several kinds."""
    for bucket, rows in _by_bucket(batches, ["packed", "doc_id", "raw", "cover"]):
        got = np.concatenate([np.zeros(0, PIECE), *(_unpack(r[0], bucket) for r in rows if r[0] is not None)])
        left, settled = smallest_of_kind(got)
        known = [r[1:] for r in rows if r[0] is None]
        cover = pa.Table.from_batches([_covers(settled), pa.record_batch(
            [pa.array([k[0] for k in known], pa.int64()), pa.array([k[1] for k in known], pa.int64()),
             pa.array([k[2] for k in known], pa.binary())], names=["doc_id", "raw", "cover"])]).combine_chunks()
        cover = cover.to_batches()[0] if len(cover) else _covers(settled)
        n = len(left)
        new = np.ones(n, bool)
        new[1:] = left["anchor"][1:] != left["anchor"][:-1]
        group = np.cumsum(new) - 1
        low = np.full(int(group[-1]) + 1 if n else 0, 2**63 - 1)
        high = np.full(len(low), -2**63)
        np.minimum.at(low, group, left["doc"])
        np.maximum.at(high, group, left["doc"])
        # An anchor of one document can hold nothing that a smaller one has.
        ask = left[(low < high)[group]]
        kinds = np.bincount(group, minlength=len(low))[group][(low < high)[group]]
        yield pa.record_batch([
            pa.concat_arrays([cover["doc_id"], pa.array(ask["doc"], pa.int64())]),
            pa.concat_arrays([cover["raw"], pa.array(ask["raw"], pa.int64())]),
            pa.concat_arrays([cover["cover"], pa.nulls(len(ask), pa.binary())]),
            pa.concat_arrays([pa.nulls(len(cover), pa.int64()), pa.array(ask["anchor"].view(np.int64), pa.int64())]),
            pa.concat_arrays([pa.nulls(len(cover), pa.int32()), pa.array(ask["start"].astype(np.int32))]),
            pa.concat_arrays([pa.nulls(len(cover), pa.int32()), pa.array(ask["runs"].astype(np.int32))]),
            pa.concat_arrays([pa.nulls(len(cover), pa.bool_()), pa.array(kinds > CROWD)]),
        ], names=["doc_id", "raw", "cover", "anchor", "start", "runs", "crowded"])


def repeated(strings: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each piece the starts of its strings that a smaller document of the pieces has."""
    sizes = np.array([len(s) + 1 for s in strings])
    begins = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    if int((text == 0xFF).sum()) == len(strings):
        # UTF-8 has no byte 255, so 0 is free for the ends.
        text = text + np.uint8(1)
    else:
        text = text.astype(np.uint16) + 1
        text[begins + sizes - 1] = 0
    half = max(1, len(strings) // 2)
    shards = []
    for a, b in ((0, half), (half, len(strings))):
        if b > a:
            x, y = begins[a], begins[b - 1] + sizes[b - 1]
            shards.append(bwt.build(text[x:y], begins[a:b] - x, int(x), 64))
    place, interval = bwt.merge(shards, LENGTH)
    piece = np.repeat(np.arange(len(strings)), sizes)[place]
    start = place - begins[piece]
    whole = start <= sizes[piece] - 1 - LENGTH
    piece, start, interval = piece[whole], start[whole], interval[whole]
    if not len(piece):
        return [np.zeros(0, np.int64) for _ in strings]
    new = np.flatnonzero(np.diff(interval, prepend=-1))
    least = np.minimum.reduceat(docs[piece], new)
    later = docs[piece] > np.repeat(least, np.diff(np.append(new, len(interval))))
    piece, start = piece[later], start[later]
    order = np.lexsort((start, piece))
    piece, start = piece[order], start[order]
    cut = np.searchsorted(piece, np.arange(len(strings) + 1))
    return [start[cut[i]:cut[i + 1]] for i in range(len(strings))]


def _merge_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; whole anchors are merged together up to MERGE_SYMBOLS."""
    def work(rows: list[tuple]) -> pa.RecordBatch:
        docs = np.array([r[0] for r in rows])
        raws = np.array([r[1] for r in rows])
        base = np.array([r[2] for r in rows])
        found = repeated([r[3] for r in rows], docs)
        sizes = [len(f) for f in found]
        starts = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(rows)), sizes)
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(of)) - 1
        if not len(at):
            return _cover_rows(docs[:0], raws[:0], base[:0], base[:0])
        i = of[at]
        return _cover_rows(docs[i], raws[i], base[i] + starts[at], base[i] + starts[ends] + LENGTH)

    rows, size = [], 0
    for _, group in _by_bucket((b.rename_columns(["bucket" if n == "anchor" else n for n in b.schema.names]) for b in batches),
                               ["doc_id", "raw", "start", "piece"]):
        rows += group
        size += sum(len(r[3]) + 1 for r in group)
        if size >= MERGE_SYMBOLS:
            yield work(rows)
            rows, size = [], 0
    if rows:
        yield work(rows)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked pieces of each text."""
    for batch in small(batches):
        out = []
        for doc, raw, body, asks in zip(*(batch[n].to_pylist() for n in ("doc_id", "raw", "body", "asks")), strict=True):
            for ask in asks:
                s = ask["start"]
                out.append((ask["anchor"], doc, raw, s, body[s:s + ask["runs"] + LENGTH - 1]))
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.record_batch([
            pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
            pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary()),
        ], names=["anchor", "doc_id", "raw", "start", "piece"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        ids, sizes, removed, runs, digest, kept = [], [], [], [], [], []
        for doc, body, covers in zip(*(batch[n].to_pylist() for n in ("doc_id", "body", "covers")), strict=True):
            left, n_runs = body, 0
            if covers:
                pairs = np.concatenate([np.frombuffer(c, "<i4").reshape(-1, 2) for c in covers])
                step = np.zeros(len(body) + 1, np.int64)
                np.add.at(step, pairs[:, 0], 1)
                np.add.at(step, pairs[:, 1], -1)
                gone = np.cumsum(step[:-1]) > 0
                n_runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                left = np.frombuffer(body, np.uint8)[~gone].tobytes()
            ids.append(doc), sizes.append(len(body)), removed.append(len(body) - len(left))
            runs.append(n_runs), digest.append(hashlib.sha256(left).hexdigest()), kept.append(left)
        yield pa.record_batch([
            pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(runs, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary()),
        ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) of every document.

    A byte goes when a 50-byte string that covers it also starts in a document with a smaller
    doc_id; strings are those of the input and do not cross documents. A null text is empty.
    Rows with the same doc_id do not remove from each other, and rows without one neither
    lose nor remove anything. Repeated rows each get their result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("body")
    ).withColumn("raw", F.xxhash64("body"))
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        # The id tells the rows apart; the hash of the text is only for ids that repeat.
        rows = rows.withColumn("raw", F.lit(0).cast("long"))
    known = rows.where(f"doc_id is not null and octet_length(body) >= {LENGTH}")
    total = known.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = tasks_for(spark, total, BYTES_PER_BUCKET)
    scanned = known.mapInArrow(
        _scan(buckets), "bucket bigint, packed binary, doc_id bigint, raw bigint, cover binary")
    settled = stored(
        scanned.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
            _settle, INTERVALS + ", anchor bigint, start int, runs int, crowded boolean"), "settled")
    asked = settled.where("anchor is not null")

    def fetched(some: DataFrame) -> DataFrame:
        asks = some.groupBy("doc_id", "raw").agg(F.collect_list(F.struct("anchor", "start", "runs")).alias("asks"))
        return known.join(asks, ["doc_id", "raw"]).select("doc_id", "raw", "body", "asks").mapInArrow(
            _fetch, "anchor bigint, doc_id bigint, raw bigint, start bigint, piece binary")

    merged = (
        fetched(asked.where("not crowded")).repartition(buckets, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(_merge_pieces, INTERVALS))
    covers = settled.where("cover is not null").select("doc_id", "raw", "cover").union(merged)
    if not asked.where("crowded").isEmpty():
        covers = covers.union(_crowded(fetched(asked.where("crowded"))))
    gathered = covers.groupBy("doc_id", "raw").agg(F.collect_list("cover").alias("covers"))
    return rows.join(gathered, ["doc_id", "raw"], "left").select("doc_id", "body", "covers").mapInArrow(
        _keep, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def _crowded(pieces_of: DataFrame) -> DataFrame:
    """Covers of anchors with more kinds than one task should hold.

    Their strings are grouped one by one; the minimum of the documents is formed before the
    shuffle, and a join brings it back, so no group is ever in one place.
    """
    strings = pieces_of.select(
        "doc_id", "raw", "start", "piece",
        F.explode(F.sequence(F.lit(0), F.length("piece") - LENGTH)).alias("offset"))
    strings = strings.select(
        "doc_id", "raw", (F.col("start") + F.col("offset")).cast("int").alias("first"),
        F.sha2(F.substring("piece", F.col("offset") + 1, F.lit(LENGTH)), 256).alias("string"))
    least = strings.groupBy("string").agg(F.min("doc_id").alias("least"))
    later = strings.join(least, "string").where(F.col("doc_id") > F.col("least"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = b["first"].to_numpy().astype(np.int64)
            yield _cover_rows(b["doc_id"].to_numpy(), b["raw"].to_numpy(), first, first + LENGTH)

    return later.select("doc_id", "raw", "first").mapInArrow(pack, INTERVALS)
