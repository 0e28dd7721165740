"""Token-id shards with a minimal perfect hash index for keyed access (operator 10).

A shard is one block of bytes: a header, the index, and the ids of its documents one after
another. Shards are rows of a Parquet table in the shared folder, so any executor reads them
through Spark from any store.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.alignment import byte_letters
from opslog.llm.common import stored, tasks_for
from opslog.llm.words import mix

MAGIC = b"OPSIDS1\0"
GAMMA = 2.0
NULL_KEY = np.uint64(0x6E756C6C)
#: A shard ends with the document that brings it to this many ids or documents.
SHARD_IDS = 1_000_000
SHARD_DOCS = 20_000
ROWS_PER_TASK = 8_000
END_ID = 1


# --- minimal perfect hash -------------------------------------------------------------

def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(keys + salt) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    """Levels of bits: a key owns the first level's bit that it alone asks for.

    Its number is the count of set bits before that bit, so n keys get the numbers 0 to n-1.
    """

    sizes: np.ndarray
    bits: np.ndarray
    before: np.ndarray

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """``keys`` must differ from each other; equal keys would never part."""
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) > 200:
                raise ValueError("keys of a perfect hash must be distinct")
            size = max(8, int(len(left) * GAMMA))
            at = _slots(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate([*levels, np.zeros(0, bool)])
        return PerfectHash.of(np.array(sizes, np.int64), np.packbits(bits), int(len(bits)))

    @staticmethod
    def of(sizes: np.ndarray, packed: np.ndarray, n_bits: int) -> PerfectHash:
        bits = np.unpackbits(packed, count=n_bits).astype(bool)
        before = np.zeros(n_bits + 1, np.int64)
        np.cumsum(bits, out=before[1:])
        return PerfectHash(sizes, bits, before)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that were never stored."""
        out = np.full(len(keys), -1, np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + _slots(keys[open_], level, size)
            hit = self.bits[at]
            out[open_[hit]] = self.before[at[hit]]
            open_ = open_[~hit]
            start += size
        return out


def document_keys(ids: list[int | None]) -> np.ndarray:
    """64-bit keys of sorted doc_ids; the k-th row with the same id has a key of its own."""
    missing = np.array([i is None for i in ids], bool)
    value = np.array([0 if i is None else i for i in ids], np.int64)
    new = np.ones(len(ids), bool)
    new[1:] = (value[1:] != value[:-1]) | (missing[1:] != missing[:-1])
    at = np.arange(len(ids))
    again = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    base = np.where(missing, NULL_KEY, mix(value.view(np.uint64)))
    return mix(base + again * np.uint64(0xD6E8FEB86659FD93))


# --- file format ----------------------------------------------------------------------

def write_shard(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """Documents in the given order, sorted by id, as one block of bytes."""
    keys = document_keys(doc_ids)
    index = PerfectHash.build(keys)
    number = index.numbers(keys)
    payload = np.concatenate([*ids, np.zeros(0, np.uint32)])
    wide = np.uint32 if len(payload) and payload.max() > 0xFFFF else np.uint16
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    slots = np.zeros((len(ids), 2), np.int64)
    slots[number, 0], slots[number, 1] = ends - [len(x) for x in ids], ends
    prints = np.zeros(len(ids), np.uint32)
    prints[number] = fingerprints(keys)
    missing = np.array([i is None for i in doc_ids], bool)
    value = np.array([0 if i is None else i for i in doc_ids], np.int64)
    parts = [index.sizes, np.packbits(index.bits), prints, slots, value, np.packbits(missing), payload.astype(wide)]
    head = np.array([len(ids), len(index.sizes), len(index.bits), len(payload), wide().itemsize], np.int64)
    return MAGIC + head.tobytes() + b"".join(p.astype(p.dtype.newbyteorder("<")).tobytes() for p in parts)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


class Shard:
    """A shard opened from its bytes; ``get`` finds a document in constant time."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not a token shard")
        n, n_levels, n_bits, n_ids, width = np.frombuffer(raw, "<i8", 5, 8).tolist()
        at = 48

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        sizes, packed = take("<i8", n_levels), take("<u1", -(-n_bits // 8))
        self.index = PerfectHash.of(sizes, packed, n_bits)
        self.prints, self.slots = take("<u4", n), take("<i8", 2 * n).reshape(n, 2)
        value, missing = take("<i8", n), np.unpackbits(take("<u1", -(-n // 8)), count=n)
        self.doc_ids = [None if m else v for v, m in zip(value.tolist(), missing.tolist(), strict=True)]
        self.payload = take("<u2" if width == 2 else "<u4", n_ids)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """(start, end) of each key's ids; -1 where the fingerprint says it is not stored."""
        number = self.index.numbers(keys)
        known = number >= 0
        known[known] = self.prints[number[known]] == fingerprints(keys[known])
        out = np.full((len(keys), 2), -1, np.int64)
        out[known] = self.slots[number[known]]
        return out

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """Ids of the first document with this id, or None."""
        start, end = self.find(document_keys([doc_id]))[0].tolist()
        return None if start < 0 else self.payload[start:end]


# --- encoding -------------------------------------------------------------------------

#: Characters whose handling by the vocabulary's rules is plain: ASCII and Latin letters,
#: without control characters; everything else goes through the tokenizer whole.
PLAIN = re.compile("[\t\n\x0b\x0c\r -~\xa0-įı-ſ]*")
#: The pieces that the vocabulary's own splitting rule makes of plain lower-case text.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffā-ſ"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\t\n\x0b\x0c\r \xa0{LETTERS}{DIGITS}]+")

#: The vocabulary's own rules, which the ones above stand for.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class Encoder:
    """Token ids of whole texts; pieces that were met before are not encoded again.

    The vocabulary first splits a text into pieces and then merges inside each piece, so the
    ids of a text are those of its pieces one after another. Only plain text without a
    special token's string is split here; any other text goes to the tokenizer as it is. A new
    piece is merged by the tokenizer's model alone, without a text built around it.
    """

    LIMIT = 1_000_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.known_rules = (rules["normalizer"], rules["pre_tokenizer"]) == (NORMALIZER, SPLITTER)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.start()

    def start(self) -> None:
        self.number: dict[str, int] = {}
        self.ptr = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text with the end id behind them; a null text is an empty one."""
        texts = [t or "" for t in texts]
        plain = [PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        hard = [i for i, p in enumerate(plain) if not p]
        for i in range(0, len(hard), 64):
            some = hard[i:i + 64]
            for j, enc in zip(some, self.tokenizer.encode_batch_fast(
                    [texts[j] for j in some], add_special_tokens=False), strict=True):
                out[j] = np.array([*enc.ids, END_ID], np.uint32)
        if len(self.number) > self.LIMIT:
            self.start()
        easy = [i for i, p in enumerate(plain) if p]
        pieces = [PIECES.findall(texts[i].lower()) for i in easy]
        fresh = list(set().union(*pieces).difference(self.number))
        if fresh:
            self.learn(fresh)
        edges = np.cumsum([0, *map(len, pieces)])
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(pieces)), np.int64, int(edges[-1]))
        sizes = self.ptr[at + 1] - self.ptr[at]
        ends = np.zeros(len(at) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.ptr[at] - ends[:-1], sizes)]
        edges = ends[edges].tolist()
        for i, first, stop in zip(easy, edges[:-1], edges[1:], strict=True):
            out[i] = np.append(ids[first:stop], np.uint32(END_ID))
        return out

    def learn(self, fresh: list[str]) -> None:
        merge, letters = self.tokenizer.model.tokenize, self.letters
        if self.known_rules:
            got = [[t.id for t in merge(p if p.isascii() else "".join([letters[b] for b in p.encode()]))] for p in fresh]
        else:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh)), strict=True))
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum([len(x) for x in got])])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32)])


@cache
def shared_encoder(path: str) -> Encoder:
    """One encoder per worker process, so that later tasks find the pieces of earlier ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- jobs -----------------------------------------------------------------------------

def write_token_shards(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode ``docs`` and keep the shards: a table (part, seq, n_ids, shard).

    Documents lie in ascending doc_id, nulls first; rows that share an id are ordered by the
    hash of their text. A shard is a contiguous run of them. The vocabulary file must lie at
    ``path`` on every executor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    width = tasks_for(spark, rows.count(), ROWS_PER_TASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path or vocabulary_path())
        seq, ids, got, size = 0, [], [], 0

        def block() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([seq]), pa.array([size]), pa.array([write_shard(ids, got)], pa.binary())],
                names=["seq", "n_ids", "shard"])

        for batch in batches:
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for a in range(0, len(texts), 256):
                for doc_id, one in zip(doc_ids[a:a + 256], encoder.encode(texts[a:a + 256]), strict=True):
                    # A run of equal ids stays in one shard only if it fits; keys count from
                    # the shard's start, so that does not matter.
                    ids.append(doc_id), got.append(one)
                    size += len(one)
                    if size >= SHARD_IDS or len(ids) >= SHARD_DOCS:
                        yield block()
                        seq, ids, got, size = seq + 1, [], [], 0
        if ids:
            yield block()

    ordered = rows.repartitionByRange(width, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shards = ordered.mapInArrow(run, "seq bigint, n_ids bigint, shard binary")
    return stored(shards.withColumn("part", F.spark_partition_id()), "token_shards")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, looked up in its shard.

    ``start`` counts the ids of all documents before it. Only the sizes of the shards are
    summed in one place.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "seq", "n_ids").select(
        F.col("part"), F.col("seq"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    placed = shards.select("part", "seq", "shard").join(F.broadcast(starts), ["part", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard = Shard(batch["shard"][i].as_py())
                first = batch["first"][i].as_py()
                found = shard.find(document_keys(shard.doc_ids))
                if (found < 0).any():
                    raise ValueError("a stored key is missing from its shard's index")
                crc = [zlib.crc32(shard.payload[s:e].astype("<u4").tobytes()) for s, e in found.tolist()]
                yield pa.record_batch([
                    pa.array(shard.doc_ids, pa.int64()), pa.array(found[:, 0] + first),
                    pa.array(found[:, 1] - found[:, 0]), pa.array(crc, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("first", "shard").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` and read every document back from them.

    A null or empty text is the end id alone. Repeated rows are stored and returned as often
    as they are there. An empty table gives no rows. Extra columns are ignored.
    """
    return read_token_shards(write_token_shards(docs, path))
