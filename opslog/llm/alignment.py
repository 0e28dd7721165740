"""Alignment of two tokenizers over the same texts (operator 13).

Tokens of both vocabularies are Arrow lists by document. Flattened, with the parent of every
token and the running sum of its bytes within the parent, each token has an end offset; a hash
join on (document, end) links the tokens that end together. Pairs are counted by Arrow inside
a block of documents, blocks are merged by Spark, and the counts come back to the blocks by
joins: nothing is broadcast and no task sees more than its block or share of pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import small, spans, stored

#: Characters of a block; a longer text is a block of its own.
BLOCK_CHARS = 1 << 22
#: Characters aligned at once inside a block.
BATCH_CHARS = 1 << 18
#: Pieces of text whose tokens a worker remembers.
REMEMBERED = 250_000

#: A cut before a space or newline that follows no white space: neither vocabulary has a token
#: across it. Checked against the pieces of the second vocabulary when it is opened.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
SPACE_MARK = "▁"
#: Letters with or without a space, then ASCII signs without the apostrophe: byte-level splitting
#: makes one part of each of the two groups.
LETTERS_SIGNS = re.compile("( ?[A-Za-zªµºÀ-ÖØ-öø-ſ]+)([!-&(-/:-@[-`{-~]*)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Tokens of space + text by a byte-level vocabulary, special strings as plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        rules = json.loads(self.tokenizer.to_str())
        split = rules["pre_tokenizer"] or {}
        #: Whether LETTERS_SIGNS tells how this vocabulary splits.
        self.known_rules = (
            rules["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") is True
            and split.get("add_prefix_space") is False and all(t["special"] for t in rules["added_tokens"]))
        self.letter_of = {b: c for c, b in letters.items()}
        by_id = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.token_bytes = [
            bytes(letters.get(c, 0) for c in by_id.get(i, "")) for i in range(max(by_id) + 1)]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece; the parts of a plain one go to the model alone."""
        merge, letter = self.tokenizer.model.tokenize, self.letter_of
        signs: dict[str, list[int]] = {"": []}
        out: list[list[int] | None] = [None] * len(pieces)
        hard = []
        for i, piece in enumerate(pieces):
            if not self.known_rules or (m := LETTERS_SIGNS.fullmatch(piece)) is None:
                hard.append(i)
                continue
            word, sign = m.groups()
            if sign not in signs:
                signs[sign] = [t.id for t in merge(sign)]
            out[i] = [t.id for t in merge("".join([letter[b] for b in word.encode()]))] + signs[sign]
        for i, e in zip(hard, self.tokenizer.encode_batch_fast(
                [pieces[i] for i in hard], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out


class Pieces:
    """Tokens of a text by a piece vocabulary that puts a space before it."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.space = self.model.piece_to_id(SPACE_MARK)
        self.token_bytes = [
            bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(n)) else n.replace(SPACE_MARK, " ").encode()
            for n in names]
        crossing = re.compile(rf"[^\s{SPACE_MARK}][ \n{SPACE_MARK}]|[ {SPACE_MARK}]\n")
        self.cuts_hold = not any(crossing.search(n) for n in names)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Tokens of pieces that begin with a space or a newline; the model adds a space."""
        told = [p[1:] if p[0] == " " else p for p in pieces]
        out = self.model.encode(told, num_threads=1)
        for i, piece in enumerate(pieces):
            if piece == " ":
                out[i] = [self.space]
            elif piece[0] != " ":
                if out[i][0] != self.space:
                    raise ValueError(f"the vocabulary joins the added space to {piece[:20]!r}")
                out[i] = out[i][1:]
        return out


class Remembered:
    """Ids of pieces of text under one vocabulary, kept one after another."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]) -> None:
        self.encode = encode
        self.ptr, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def learn(self, pieces: list[str]) -> None:
        got = self.encode(pieces)
        self.ptr = np.concatenate([self.ptr, self.ptr[-1] + np.cumsum([len(x) for x in got])])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.int32)])

    def lists(self, numbers: np.ndarray, ptr: np.ndarray) -> pa.LargeListArray:
        """The ids of texts ``numbers[ptr[i]:ptr[i + 1]]``."""
        sizes = self.ptr[numbers + 1] - self.ptr[numbers]
        ends = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        took = np.arange(ends[-1]) + np.repeat(self.ptr[numbers] - ends[:-1], sizes)
        return pa.LargeListArray.from_arrays(ends[ptr], self.ids[took])


class Tokenizers:
    """Both vocabularies. Texts are cut where no token can cross, and pieces met before are
    not encoded again; with a vocabulary that has tokens across the cuts, texts stay whole."""

    def __init__(self, a_path: str, b_path: str) -> None:
        a, b = ByteLevel(a_path), Pieces(b_path)
        self.cut = CUT.split if b.cuts_hold else lambda text: [text]
        self.encoders = (a.encode, b.encode)
        self.token_bytes = tuple(pa.array(t.token_bytes, pa.large_binary()) for t in (a, b))
        self.lengths = tuple(pc.cast(pc.binary_length(t), pa.int64()) for t in self.token_bytes)
        self.names = tuple(pa.array(map(str, range(len(t))), pa.large_string()) for t in self.token_bytes)
        self.start()

    def start(self) -> None:
        self.number: dict[str, int] = {}
        self.remembered = tuple(map(Remembered, self.encoders))
        self.exact = np.zeros(0, bool)

    def numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, pointers): the pieces of text i are ``numbers[ptr[i]:ptr[i + 1]]``."""
        if len(self.number) > REMEMBERED:
            self.start()
        pieces = [self.cut(f" {t}") if t else [] for t in texts]
        fresh = list(set().union(*pieces).difference(self.number))
        if fresh:
            self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh)), strict=True))
            many, each = np.arange(len(self.exact), len(self.number)), np.arange(len(fresh) + 1)
            for vocabulary in self.remembered:
                vocabulary.learn(fresh)
            want = pa.array([p.encode() for p in fresh], pa.large_binary())
            self.exact = np.append(self.exact, self.give(want, tuple(v.lists(many, each) for v in self.remembered)))
        ptr = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(p) for p in pieces], out=ptr[1:])
        return np.fromiter(map(self.number.__getitem__, chain.from_iterable(pieces)), np.int64, int(ptr[-1])), ptr

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Token ids of space + text under both vocabularies; an empty text has none."""
        return self.lists(*self.numbered(texts))

    def lists(self, numbers: np.ndarray, ptr: np.ndarray) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        return tuple(v.lists(numbers, ptr) for v in self.remembered)

    def checked(self, texts: list[str]) -> tuple[tuple[pa.LargeListArray, pa.LargeListArray], np.ndarray]:
        """(token ids, whether they give back the text). A text of exact pieces does; only the
        others are put together and compared."""
        numbers, ptr = self.numbered(texts)
        tokens = self.lists(numbers, ptr)
        inexact = np.concatenate([[0], np.cumsum(~self.exact[numbers])])[ptr]
        doubtful = np.flatnonzero(np.diff(inexact))
        faithful = np.ones(len(texts), bool)
        if len(doubtful):
            faithful[doubtful] = self.faithful(
                [texts[i] for i in doubtful], tuple(t.take(pa.array(doubtful)) for t in tokens))
        return tokens, faithful

    def faithful(self, texts: list[str], tokens: tuple[pa.LargeListArray, ...]) -> np.ndarray:
        """Whether the bytes of the tokens are those of space + text, under both vocabularies."""
        return self.give(pa.array([f" {t}".encode() if t else b"" for t in texts], pa.large_binary()), tokens)

    def give(self, want: pa.LargeBinaryArray, tokens: tuple[pa.LargeListArray, ...]) -> np.ndarray:
        """Whether the bytes of the tokens, joined, are the wanted ones under both vocabularies."""
        same = np.ones(len(want), bool)
        for ids, table in zip(tokens, self.token_bytes, strict=True):
            lists = pa.LargeListArray.from_arrays(ids.offsets, pc.take(table, ids.values))
            same &= pc.equal(pc.binary_join(lists, pa.scalar(b"", pa.large_binary())), want).to_numpy(zero_copy_only=False)
        return same


@cache
def shared_tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """One pair per worker process, so that later tasks find the pieces of earlier ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(a_path, b_path)


# --- alignment of a batch -------------------------------------------------------------

def _ends(ids: pa.LargeListArray, lengths: pa.Array) -> pa.Table:
    """One row per token: where it ends, its place and id. The end counts the bytes of all
    documents so far and one for each document before, so it stands for (document, end) where
    both vocabularies give the same bytes."""
    token, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.take(lengths, token)).to_numpy()
    return pa.table({"end": total + parent.to_numpy(), "place": np.arange(len(total)), "id": token})


def _group_texts(tokens: pa.LargeListArray, names: pa.Array, cuts: np.ndarray) -> pa.Array:
    """'id,id' for every group; ``cuts`` are the places of the last tokens of the groups."""
    edges = np.concatenate([[0], cuts + 1])
    lists = pa.LargeListArray.from_arrays(edges, pc.take(names, tokens.values))
    return pc.binary_join(lists, pa.scalar(",", pa.large_string()))


def align_batch(texts: list[str | None], tokenizers: Tokenizers) -> pa.Table:
    """n_a, n_b, groups (text) and links (a << 32 | b, in order) of every text."""
    texts = [t or "" for t in texts]
    tokens, faithful = tokenizers.checked(texts)
    if not faithful.all():
        texts = [t if ok else "" for t, ok in zip(texts, faithful.tolist(), strict=True)]
        tokens = tokenizers.encode(texts)
    a, b = (_ends(ids, lengths) for ids, lengths in zip(tokens, tokenizers.lengths, strict=True))
    linked = a.join(b, "end", join_type="inner", right_suffix="_b", use_threads=False)
    if (np.diff(linked["place"].to_numpy()) < 1).any():
        linked = linked.sort_by([("place", "ascending"), ("place_b", "ascending")])
    pairs = (linked["id"].to_numpy().astype(np.int64) << 32) | linked["id_b"].to_numpy().astype(np.int64)
    ptr = np.searchsorted(linked["place"].to_numpy(), tokens[0].offsets.to_numpy())
    sides = [
        _group_texts(ids, names, linked[place].to_numpy())
        for ids, names, place in zip(tokens, tokenizers.names, ("place", "place_b"), strict=True)]
    groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    by_text = pa.LargeListArray.from_arrays(ptr, groups)
    return pa.table({
        "n_a": pc.cast(pc.list_value_length(tokens[0]), pa.int64()),
        "n_b": pc.cast(pc.list_value_length(tokens[1]), pa.int64()),
        "groups": pc.binary_join(by_text, pa.scalar(";", pa.large_string())),
        "links": pa.LargeListArray.from_arrays(ptr, pa.array(pairs)),
    })


# --- jobs -----------------------------------------------------------------------------

def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def linked_documents(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = True) -> DataFrame:
    """(block, doc_id, n_a, n_b, n_groups, groups, groups_sha256, links), kept in the shared folder.

    A block is a run of documents of one task; its name is new in every attempt of a task, and
    only the attempt whose files are committed is read.
    """
    schema = (
        "block string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, "
        "groups_sha256 string, links array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = shared_tokenizers(a_path, b_path)
        block, room = "", 0
        for batch in small(batches):
            doc_ids, texts = batch["doc_id"], batch["text"].to_pylist()
            for i, j in spans([len(t or "") for t in texts], BATCH_CHARS):
                size = sum(len(t or "") for t in texts[i:j])
                if size > room:
                    block, room = uuid.uuid4().hex, BLOCK_CHARS
                room -= size
                got = align_batch(texts[i:j], tokenizers)
                shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"].to_pylist()]
                links = got["links"].combine_chunks()
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block] * (j - i)), "doc_id": doc_ids[i:j],
                    "n_a": got["n_a"].combine_chunks(), "n_b": got["n_b"].combine_chunks(),
                    "n_groups": pc.cast(pc.list_value_length(links), pa.int64()),
                    "groups": pc.cast(got["groups"].combine_chunks(), pa.string()) if keep_groups else pa.nulls(j - i, pa.string()),
                    "groups_sha256": pa.array(shas), "links": links.cast(pa.list_(pa.int64())),
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, schema), "links")


def pairs_by_block(linked: DataFrame) -> DataFrame:
    """(block, pair, n): partial counts of the links, one row per pair and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        size = 0

        def counted() -> pa.Table:
            return pa.concat_tables(waiting).group_by(["block", "pair"], use_threads=False).aggregate([("n", "sum")])

        for batch in small(batches, 256):
            links = batch["links"]
            pair = pc.list_flatten(links)
            table = pa.table({
                "block": pc.take(batch["block"], pc.list_parent_indices(links)), "pair": pair,
                "n": np.ones(len(pair), np.int64)})
            table = table.group_by(["block", "pair"], use_threads=False).aggregate([("n", "sum")])
            waiting.append(table.rename_columns(["block", "pair", "n"]))
            size += len(table)
            if size > 500_000:
                yield from counted().rename_columns(["block", "pair", "n"]).to_batches()
                waiting, size = [], 0
        if waiting:
            yield from counted().rename_columns(["block", "pair", "n"]).to_batches()

    return linked.select("block", "links").mapInArrow(run, "block string, pair bigint, n bigint")


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, count, best) over all documents; best: no other pair of its B id has more.

    A B id meets at most as many A ids as the vocabulary has, so its window is bounded.
    """
    counts = partial.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit(2**32 - 1).cast("long"))
    highest = F.max("count").over(Window.partitionBy(b))
    return counts.select("pair", "count", (F.col("count") == highest).alias("best"))


def align_tokens(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep_groups: bool = False
) -> DataFrame:
    """Token counts, groups and links of every document under two vocabularies.

    ``n_best`` counts the links whose pair has its B id's highest count over all documents
    (ties included), ``count_sum`` adds up the counts of the links. ``groups`` is kept with
    ``keep_groups``. A null or empty text, and one whose tokens do not give back its bytes,
    has no tokens: zeros and an empty ``groups_sha256``. Repeated rows are counted and
    answered each, ids may be null, an empty table gives no rows, extra columns are ignored.
    The vocabulary files must lie at their paths on every executor.
    """
    default = vocabulary_paths() if a_path is None or b_path is None else ("", "")
    linked = linked_documents(docs, a_path or default[0], b_path or default[1], keep_groups)
    partial = stored(pairs_by_block(linked), "pairs")
    counted = (
        partial.groupBy("block", "pair").agg(F.sum("n").alias("n"))
        .join(pair_counts(partial), "pair").select("block", "pair", "count", "best")
    )
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string, groups string"
    )

    def run(documents: pa.Table, known: pa.Table) -> pa.Table:
        links = documents["links"].combine_chunks()
        known = known.sort_by("pair")
        at = np.searchsorted(known["pair"].to_numpy(), pc.list_flatten(links).to_numpy())
        edges = links.offsets.to_numpy().astype(np.int64) - links.offsets[0].as_py()

        def total(name: str) -> np.ndarray:
            values = known[name].to_numpy().astype(np.int64)[at]
            return np.diff(np.concatenate([[0], np.cumsum(values)])[edges])

        return pa.table({
            "doc_id": documents["doc_id"], "n_a": documents["n_a"], "n_b": documents["n_b"],
            "n_groups": documents["n_groups"], "n_links": np.diff(edges).astype(np.int64), "n_best": total("best"),
            "count_sum": total("count"), "groups_sha256": documents["groups_sha256"], "groups": documents["groups"]})

    out = linked.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(run, schema)
    return out if keep_groups else out.drop("groups")
