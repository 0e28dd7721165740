import random
import zlib

import numpy as np
import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from opslog.llm.token_store import Encoder, PerfectHash, Shard, document_keys, token_index, vocabulary_path, write_shard  # noqa: E402
from tests.llm.conftest import ODD, documents  # noqa: E402


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]


def test_pieces_give_the_ids_of_whole_texts(whole):
    rng = random.Random(1)
    texts = ["", None, "It's we'LL don't'd ''s 1²³¼ ½", "a\x85b\x1cc", "<|endoftext|> x", "naïve é ﬁ ΟΔΟΣ", "İstanbul ıI ſ ŉ"]
    texts += ["".join(rng.choice("aB'sSéÉ1² \n\xa0.,!-İŉſ×÷«tdrelmv") for _ in range(50)) for _ in range(1500)]
    encoder = Encoder(vocabulary_path())
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got.tolist() == whole(text), repr(text)


def test_a_full_cache_starts_again(whole, words):
    encoder = Encoder(vocabulary_path())
    encoder.LIMIT = 50
    for _ in range(5):
        text = words(80)
        assert encoder.encode([text])[0].tolist() == whole(text)


class Counted:
    """A tokenizer that notes how many texts it is given whole."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.texts = tokenizer, tokenizer.model, 0

    def encode_batch_fast(self, texts, **kind):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **kind)


def test_new_pieces_go_to_the_model_alone(whole, words):
    encoder = Encoder(vocabulary_path())
    encoder.tokenizer = Counted(encoder.tokenizer)
    texts = [words(50) for _ in range(20)] + ["NAÏVE été's 1²3 ¿qué? ½", "", None, "日本語"]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got.tolist() == whole(text), repr(text)
    assert encoder.tokenizer.texts == 1


def test_other_rules_of_a_vocabulary_go_through_its_tokenizer(whole, words):
    encoder = Encoder(vocabulary_path())
    encoder.known_rules = False
    encoder.tokenizer = Counted(encoder.tokenizer)
    text = words(30)
    assert encoder.encode([text])[0].tolist() == whole(text) and encoder.tokenizer.texts == len(set(text.split()))


def test_perfect_hash_numbers_every_key_once():
    for n in (0, 1, 2, 10, 5000):
        keys = document_keys(list(range(n)))
        assert sorted(PerfectHash.build(keys).numbers(keys).tolist()) == list(range(n))


def test_shard_round_trip_and_missing_keys():
    ids = [None, None, -3, 5, 5, 5, 90]
    docs = [np.arange(i + 1, dtype=np.uint32) * 100_000 for i in range(len(ids))]
    shard = Shard(write_shard(ids, docs))
    found = shard.find(document_keys(shard.doc_ids))
    assert shard.doc_ids == ids
    assert all((shard.payload[s:e] == d).all() for (s, e), d in zip(found.tolist(), docs, strict=True))
    assert shard.get(90).tolist() == docs[-1].tolist() and shard.get(None).tolist() == [0]
    assert sum(shard.get(i) is not None for i in range(1000, 3000)) == 0
    with pytest.raises(ValueError):
        Shard(b"something else" * 9)


def test_index_equals_a_plain_loop(spark, whole, words):
    rows = [(i * 7 % 50, words(1 + i)) for i in range(50)] + ODD
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(t)
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(token_index(documents(spark, rows, extra=True)).collect(), key=lambda r: r.start)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_empty_table(spark):
    assert token_index(documents(spark, [])).count() == 0
