import hashlib
import random
from collections import Counter

import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from opslog.llm import alignment  # noqa: E402
from opslog.llm.alignment import Tokenizers, align_tokens, byte_letters, vocabulary_paths  # noqa: E402
from tests.llm.conftest import ODD, documents  # noqa: E402


@pytest.fixture(scope="module")
def whole():
    """Ids and bytes of whole texts, straight from the libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_path, b_path = vocabulary_paths()
    a, b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    letters = byte_letters()

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def encode(text):
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ia], [(i, piece(i)) for i in ib]

    return encode


NASTY = [
    "", " ", "  ", "a ", "a  ", "\n", "\n\n a", "a\n  b", "a \n b\n", "\t x", "tab\tx \r\n y;\r z", "<|endoftext|> x </s><s><unk>", "▁ mark",
    "naïve é ﬁ 日本語 \U0001f600", "a\xa0b c　d \x85 e", "x.\x1c y", "0x0A <0x0A>", "é ​ z", "don't I'LL we're 123 4 56", "\x00 nul",
    "   leading and   inner   spaces ", "def f():\n    return 1\n\n\n", "-" * 300 + " " * 100 + "x",
]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(["a", "B", "the ", " ", "\n", ".", "'s", "é", "日", "\t", "\xa0", "\r", "1", "tion", "\x1c", " "])
                    for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pieces_give_the_tokens_of_whole_texts(whole):
    tokenizers = Tokenizers(*vocabulary_paths())
    texts = NASTY + random_texts(2000)
    got = [ids.to_pylist() for ids in tokenizers.encode(texts)]
    for i, text in enumerate(texts):
        if text and "▁" not in text:
            assert [got[0][i], got[1][i]] == [[t for t, _ in side] for side in whole(text)], repr(text)


def test_plain_new_pieces_go_to_the_model_alone(words, whole):
    tokenizers = Tokenizers(*vocabulary_paths())
    byte_level, given = tokenizers.encoders[0].__self__, []
    tokenizer = byte_level.tokenizer

    class Counted:
        model = tokenizer.model

        def encode_batch_fast(self, pieces, **kind):
            given.extend(pieces)
            return tokenizer.encode_batch_fast(pieces, **kind)

    byte_level.tokenizer = Counted()
    texts = [words(60) + ", Größe; (no) end. don't" for _ in range(5)]
    for text, *got in zip(texts, *(ids.to_pylist() for ids in tokenizers.encode(texts)), strict=True):
        assert got == [[t for t, _ in side] for side in whole(text)]
    assert set(given) == {" (no)", " don't"}


def test_only_texts_with_an_inexact_piece_are_compared_whole(monkeypatch):
    tokenizers, compared = Tokenizers(*vocabulary_paths()), []
    faithful = tokenizers.faithful
    monkeypatch.setattr(tokenizers, "faithful", lambda texts, tokens: compared.extend(texts) or faithful(texts, tokens))
    got = alignment.align_batch(["plain words", "a ▁ mark", None, "", "naïve"], tokenizers)
    assert compared == ["a ▁ mark"]
    assert [n > 0 for n in got["n_a"].to_pylist()] == [True, False, False, False, True]


def plain(rows, whole):
    links, out = [], []
    for doc_id, text in rows:
        a, b = whole(text) if text else ([], [])
        want = f" {text}".encode()
        if not text or b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            out.append([doc_id, 0, 0, 0, ""])
            links.append([])
            continue
        ends = []
        for side in (a, b):
            at, here = 0, {}
            for k, (_, t) in enumerate(side):
                at += len(t)
                here[at] = k
            ends.append(here)
        shared = sorted(set(ends[0]) & set(ends[1]))
        links.append([(a[ends[0][e]][0], b[ends[1][e]][0]) for e in shared])
        texts, pa_, pb = [], 0, 0
        for e in shared:
            i, j = ends[0][e] + 1, ends[1][e] + 1
            texts.append(",".join(str(t) for t, _ in a[pa_:i]) + "|" + ",".join(str(t) for t, _ in b[pb:j]))
            pa_, pb = i, j
        out.append([doc_id, len(a), len(b), len(shared), hashlib.sha256(";".join(texts).encode()).hexdigest()])
    count = Counter(link for some in links for link in some)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(((o[0], o[1], o[2], o[3], len(some), sum(count[k] == best[k[1]] for k in some),
                    sum(count[k] for k in some), o[4]) for o, some in zip(out, links, strict=True)), key=repr)


def answers(docs):
    got = align_tokens(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("block_chars", [200, 1 << 22])
def test_alignment_equals_a_plain_loop(spark, whole, words, monkeypatch, block_chars):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block_chars)
    monkeypatch.setattr(alignment, "BATCH_CHARS", min(block_chars, 1 << 18))
    rows = [(i, t) for i, t in enumerate(NASTY + random_texts(60) + [words(40) for _ in range(20)])] + ODD
    assert answers(documents(spark, rows, extra=True).repartition(3)) == plain(rows, whole)


def test_groups_are_kept_on_demand(spark, whole):
    row = align_tokens(documents(spark, [(1, "hello world")]), keep_groups=True).collect()[0]
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count("|") == row.n_groups


def test_empty_table_and_texts_without_tokens(spark):
    assert align_tokens(documents(spark, [])).count() == 0
    assert answers(documents(spark, [(1, None), (None, ""), (2, "▁")])) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
