"""Language identification with language-bitmask n-gram filters (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import small, spans
from opslog.llm.words import BATCH_CHARS, characters, grams_of, words_of

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample the filters are filled from; every document is predicted.

    An n-gram belongs to a language if at least ``least`` of its texts hold it and its share
    there is at least ``share`` of its largest share in any language.
    """

    texts_per_language: int = 1_500
    characters: int = 20_000_000
    least: int = 3
    share: float = 0.3
    bits: int = 22
    hashes: int = 3
    sizes: tuple[int, ...] = (3, 4)
    seed: int = 5


@dataclass(frozen=True)
class Filters:
    """Bit-sliced Bloom filters: bit l of a slot belongs to the filter of language l.

    One plane holds 64 languages; ``false_positive`` is the chance, per language, that a
    foreign n-gram is found.
    """

    languages: list[str]
    planes: np.ndarray
    false_positive: np.ndarray
    prior: np.ndarray
    settings: Settings

    def slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64((1 << self.settings.bits) - 1)
        return [((hashes >> np.uint64(j * 20)) & mask).astype(np.int64) for j in range(self.settings.hashes)]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The language bitmask of each n-gram, one row per plane."""
        found = None
        for at in self.slots(hashes):
            found = self.planes[:, at] if found is None else found & self.planes[:, at]
        return found


def grams(texts: list[str | None], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and pointers of the letter n-grams inside words and of whole words."""
    codes = characters(texts)
    return [grams_of(*codes, n) for n in settings.sizes] + [words_of(*codes)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def training_texts(docs: DataFrame, settings: Settings) -> tuple[list[tuple[str, str]], dict[str, int]]:
    """A sample of (lang, text), and the number of learnable documents per language.

    Learnable are documents with a language and crc32(doc_id) mod 3 != 1. Each language
    gets about ``texts_per_language`` of them, drawn by a hash of doc_id at a rate that
    follows from its count, all languages together at most ``characters`` characters (the
    sample rates are lowered alike for that).
    """
    learn = docs.where("text is not null and lang is not null").where(
        F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    stats = learn.groupBy("lang").agg(F.count("*").alias("n"), F.avg(F.length("text")).alias("length")).collect()
    want = {r.lang: min(r.n, settings.texts_per_language) for r in stats}
    size = sum(want[r.lang] * r.length for r in stats)
    shrink = min(1.0, settings.characters / max(1.0, size))
    # One row per language.
    rates = docs.sparkSession.createDataFrame(
        [(r.lang, want[r.lang] / r.n * shrink) for r in stats], "l string, rate double")
    turn = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / (1 << 30)
    sample = learn.join(F.broadcast(rates), F.col("lang") == F.col("l")).where(turn < F.col("rate"))
    return [(r.lang, r.text) for r in sample.select("lang", "text").collect()], {r.lang: r.n for r in stats}


def fill(sample: list[tuple[str, str]], counts: dict[str, int], settings: Settings = Settings()) -> Filters:
    languages = sorted(counts)
    hashes, langs = [], []
    for i, lang in enumerate(languages):
        texts = [t for name, t in sample if name == lang]
        held = []
        for a, b in spans([len(t) for t in texts], BATCH_CHARS):
            for h, ptr in grams(texts[a:b], settings):
                doc = np.repeat(np.arange(b - a), np.diff(ptr))
                order = np.lexsort((h, doc))
                once = np.ones(len(h), bool)
                once[1:] = (np.diff(h[order]) != 0) | (np.diff(doc[order]) != 0)
                held.append(h[order][once])
        gram, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
        enough = n >= min(settings.least, max(1, len(texts)))
        hashes.append((gram[enough], n[enough] / max(1, len(texts))))
        langs.append(np.full(int(enough.sum()), i))
    gram = np.concatenate([*(g for g, _ in hashes), np.zeros(0, np.uint64)])
    rate = np.concatenate([*(r for _, r in hashes), np.zeros(0)])
    lang = np.concatenate([*langs, np.zeros(0, np.int64)]).astype(np.int64)
    _, same = np.unique(gram, return_inverse=True)
    most = np.zeros(int(same.max()) + 1 if len(same) else 0)
    np.maximum.at(most, same, rate)
    own = rate >= settings.share * most[same]
    gram, lang = gram[own], lang[own]
    planes = np.zeros((max(1, -(-len(languages) // 64)), 1 << settings.bits), np.uint64)
    filters = Filters(languages, planes, np.zeros(len(languages)), np.array([counts[x] for x in languages], float), settings)
    for at in filters.slots(gram):
        np.bitwise_or.at(planes, (lang // 64, at), np.uint64(1) << (lang % 64).astype(np.uint64))
    for i in range(len(languages)):
        fullness = (planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()
        filters.false_positive[i] = fullness ** settings.hashes
    return filters


def predict(texts: list[str | None], filters: Filters) -> tuple[list[str], np.ndarray]:
    """(language, score) of whole texts.

    For each language the n-grams found in its filter are counted, and the count is
    corrected for those found by chance. The largest corrected count wins; its share of all
    corrected counts is the score. Where no filter holds an n-gram, the commonest language
    wins. Texts without a letter are ``und`` with score 0.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    n_lang = len(filters.languages)
    if not n_lang:
        return names, scores
    prior = filters.prior / filters.prior.sum()
    for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
        found, total = np.zeros((n_lang, b - a)), np.zeros(b - a)
        for hashes, ptr in grams(texts[a:b], filters.settings):
            masks = filters.lookup(hashes)
            total += np.diff(ptr)
            for i in range(n_lang):
                hits = np.zeros(len(hashes) + 1, np.int64)
                np.cumsum(masks[i // 64] >> np.uint64(i % 64) & np.uint64(1), out=hits[1:])
                found[i] += hits[ptr[1:]] - hits[ptr[:-1]]
        chance = filters.false_positive[:, None]
        clean = np.maximum(0, (found - total * chance) / (1 - np.minimum(chance, 0.999)))
        sums = clean.sum(0)
        share = np.where(sums > 0, clean / np.where(sums > 0, sums, 1), prior[:, None])
        best = share.argmax(0)
        for i in range(b - a):
            if has_letter(texts[a + i]):
                names[a + i], scores[a + i] = filters.languages[best[i]], share[best[i], i]
    return names, np.clip(scores, 0, 1)


def identify_languages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document, repeated rows included.

    Null texts and texts without a letter get ``und`` and 0; so does everything when no
    document can be learned from. A null doc_id is predicted, not held out and not learned
    from. Extra columns are ignored.
    """
    filters = fill(*training_texts(docs.select("doc_id", "text", "lang"), settings), settings)
    # 32 MB for every 64 languages.
    shipped = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            names, scores = predict(batch["text"].to_pylist(), shipped.value)
            yield pa.record_batch([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores)],
                                  names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
