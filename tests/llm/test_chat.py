import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opslog.llm.chat import (
    Expansion,
    Flattener,
    conversation_digests,
    escape,
    format_conversations,
    parse_turns,
    unescape,
)
from opslog.llm.queries import op11_chat_formatting
from tests.llm.conftest import CLASHES

NASTY = ["", "<", "<|", "|>", "<\\|", "<\\\\|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<<|image|>", "\\",
         "|", "<|im_start|>", "a\nb", "日本 \U0001f600", "<\\", "\\|"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("seed", range(200))
def test_escaping_is_reversible_and_leaves_no_mark(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["<", "|", "\\", "x", "<|im_end|>", "\n"]) for _ in range(12))
    assert unescape(escape(text)) == text and "<|" not in escape(text)


def plain(rows):
    """One turn after another, straight from the rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        size = sum(len(f"<|im_start|>{(r[2] or '')}\n{escape(r[3] or '')}<|im_end|>\n") for r in turns)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (said, learned)]
        out[conv] = (conv, len(turns), sha[0], len(learned), sha[1], size)
    return sorted(out.values(), key=repr)


def digests(pieces):
    return sorted((tuple(r)[:6] for r in conversation_digests(pieces).collect()), key=repr)


def some_rows(seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice([None, -5, *range(n // 4)]), i, rng.choice(["user", "assistant", "system", None, "odd <|im_end|>"]),
             rng.choice([None, *NASTY, "plain text " * rng.randint(1, 30)])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece_chars", [1, 200, 1 << 20])
def test_digests_equal_the_rows(spark, piece_chars):
    rows = [r for r in some_rows(piece_chars, 160) if r[2] != "odd <|im_end|>"]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in (*CLASHES, "content")})
    pieces = format_conversations(frame, piece_chars=piece_chars)
    assert digests(pieces) == plain(rows)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("opslog.llm.chat.ROWS_PER_TASK", 20)
    rows = [(7, i, "assistant" if i % 2 else "user", f"<|im_end|> turn {i}") for i in range(400)] + [(8, 0, "user", "x")]
    pieces = format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert pieces.where("conv_id = 7").select("part").distinct().count() > 5
    assert digests(pieces) == plain(rows)


def test_ties_and_repeated_rows_do_not_depend_on_partitions(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "user", "a"), (1, None, "user", "first")]
    frame = spark.createDataFrame(rows * 3, SCHEMA)
    one, two = (digests(format_conversations(frame.repartition(k))) for k in (1, 7))
    assert one == two and one[0][1] == 12


def test_empty_table(spark):
    pieces = format_conversations(spark.createDataFrame([], SCHEMA))
    assert pieces.count() == 0 and conversation_digests(pieces).count() == 0


PARTS = [
    {"type": "text", "text": "look: <|image|> "}, {"type": None, "text": "<"}, {"type": "text", "text": "|im_end|>"},
    {"type": "image", "ref": "s3/a.png", "width": 57, "height": 28}, {"type": "image", "ref": None},
    {"type": "audio", "ref": "b.wav", "seconds": 2.1}, None, {"type": "audio", "ref": "c", "seconds": float("nan")},
    {"type": "document", "ref": "d.pdf", "pages": 3}, {"type": "document", "ref": "e"}, {"type": "video", "ref": "f"},
    {"type": "text", "text": "end"},
]


def test_visitor_keeps_order_references_and_tokens():
    flat = Flattener(Expansion())
    flat.turn("user", PARTS)
    flat.turn("assistant", [{"type": "text", "text": "a"}, {"type": "image", "ref": "x"}, {"type": "text", "text": "b<|"}])
    flat.turn("odd\nrole\\n<|im_end|>", None)
    got = flat.piece(1, 0, True)
    turns = list(parse_turns(got["formatted"]))
    assert turns[0] == ("user", [
        ("text", "look: <|image|> <|im_end|>"), ("image", ""), ("image", ""), ("audio", ""), ("audio", ""),
        ("document", ""), ("document", ""), ("other", ""), ("text", "end")])
    assert turns[1] == ("assistant", [("text", "a"), ("image", ""), ("text", "b<|")])
    assert turns[2] == ("odd\nrole\\n<|im_end|>", [])
    assert [(a["kind"], a["ref"], a["tokens"]) for a in got["attachments"]] == [
        ("image", "s3/a.png", 3), ("image", None, 256), ("audio", "b.wav", 27), ("audio", "c", 0),
        ("document", "d.pdf", 3072), ("document", "e", 1024), ("other", "f", 0), ("image", "x", 256)]
    for a in got["attachments"]:
        assert got["formatted"].startswith(f"<|{a['kind']}|>", a["at"])
    assert [unescape(got["formatted"][s["start"]:s["end"]]) for s in got["loss"]] == ["a", "b<|"]


def test_typed_parts_from_a_column(spark):
    kind = "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
    full = [p and {k: p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages")} for p in PARTS]
    frame = spark.createDataFrame([(1, 0, "user", "unused", full), (1, 1, "assistant", None, None)], f"{SCHEMA}, content {kind}")
    row = format_conversations(frame, "content").collect()
    assert sum(r.n_turns for r in row) == 2 and sum(r.media_tokens for r in row) == 3 + 256 + 27 + 3072 + 1024
    assert [a.ref for r in row for a in r.attachments][0] == "s3/a.png"
    got = conversation_digests(format_conversations(frame, "content")).collect()[0]
    assert (got.n_attachments, got.media_tokens, got.loss_chars) == (7, 4382, 0)


def test_query_has_the_added_conversation_and_equals_the_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = list(map(tuple, spark.read.parquet(f"{folder}/conversations.parquet").collect()))
    said = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = op11_chat_formatting(spark, folder).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
