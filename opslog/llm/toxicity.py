"""Toxicity by non-negative positive-unlabelled learning (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import set_aside, small, spans
from opslog.llm.words import BATCH_CHARS, characters, grams_of, words_of

BITS = 20


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample the classifier is fitted on; scoring covers every document."""

    max_positive: int = 4_000
    max_unlabelled: int = 12_000
    features: int = 1_024
    min_positive: int = 4
    steps: int = 300
    rate: float = 0.05
    shrink: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weight: np.ndarray
    bias: float


def features_of(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature ids and pointers, for whole words and for four-letter pieces of words."""
    codes = characters(texts)
    return [((hashes >> np.uint64(64 - BITS)).astype(np.int32), ptr)
            for hashes, ptr in (words_of(*codes), grams_of(*codes, 4))]


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        texts, kinds = batch["text"].to_pylist(), batch["positive"].to_pylist()
        rows = []
        for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
            sets = features_of(texts[a:b])
            rows += [np.unique(np.concatenate([ids[ptr[i]:ptr[i + 1]] for ids, ptr in sets])).tobytes()
                     for i in range(b - a)]
        yield pa.record_batch([pa.array(kinds, pa.bool_()), pa.array(rows, pa.binary())],
                              names=["positive", "ids"])


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list, list, float]:
    """Positive and unlabelled rows as arrays of feature ids, and the class prior.

    Only labels of documents with crc32(doc_id) mod 4 != 2 are looked at, and only texts of
    those documents. A document with several labels is toxic if one of them says so. The
    unlabelled sample is drawn from all these documents, whatever their label. Both samples
    are the smallest of a hash of doc_id, up to the bounds in ``settings``.
    """
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    marks = (
        labels.select("doc_id", "toxic").where(learn & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    counted = marks.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    prior = min(0.9, max(1e-3, counted.toxic / counted.n)) if counted.n else 1e-3
    rows = docs.select("doc_id", "text").where(learn)
    turn = F.xxhash64("doc_id", F.lit(settings.seed))
    positive_ids = marks.where("toxic = 1").orderBy(turn, "doc_id").limit(settings.max_positive)
    unlabelled_ids = rows.select("doc_id").orderBy(turn, "doc_id").limit(settings.max_unlabelled)
    chosen = positive_ids.select("doc_id", F.lit(True).alias("positive")).union(
        unlabelled_ids.select("doc_id", F.lit(False).alias("positive")))
    # Bounded by the two limits: at most 16,000 ids.
    sample = rows.join(F.broadcast(chosen), "doc_id").select("text", "positive")
    got = sample.mapInArrow(_collect_features, "positive boolean, ids binary").collect()
    ids = [(r.positive, np.frombuffer(r.ids, np.int32)) for r in got]
    return [x for p, x in ids if p], [x for p, x in ids if not p], prior


def mixture_share(score_p: np.ndarray, score_u: np.ndarray, most: float) -> float:
    """Share of positives among the unlabelled: the least ratio of the two tails above a score.

    No set of documents can be rarer among the unlabelled than this share of its rate among
    positives. Only scores that at least three tenths of the positives reach are tried.
    """
    cuts = np.quantile(score_p, np.linspace(0, 0.7, 29))
    tails = [((score_u >= c).mean() + 0.5 / len(score_u)) / (score_p >= c).mean() for c in cuts if c > 0]
    return float(np.clip(min([most, *tails]), 1e-3, 0.9))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        settings: Settings = Settings()) -> Model:
    """Minimise prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]), logistic loss.

    When the second part falls below zero its gradient is turned round, which
    keeps the classifier from fitting unlabelled positives as negatives. With no positive or
    no unlabelled row every score is the prior.
    """
    base = float(np.log(prior / (1 - prior)))
    weight = np.zeros(1 << BITS, np.float32)
    if not positive or not unlabelled:
        return Model(weight, base)
    n_p, n_u = len(positive), len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=1 << BITS)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=1 << BITS)
    p, u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    spread = (p - u) / np.sqrt(p * (1 - p) / n_p + u * (1 - u) / n_u)
    spread[in_p < settings.min_positive] = 0
    chosen = np.argsort(-np.abs(spread))[:settings.features]
    chosen = chosen[np.abs(spread[chosen]) > 2.5]
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        kept = [x[x >= 0] for x in (place[r] for r in rows)]
        ptr = np.zeros(len(kept) + 1, np.int64)
        np.cumsum([len(x) for x in kept], out=ptr[1:])
        return np.concatenate([*kept, np.zeros(0, np.int32)]), ptr

    (ids_p, ptr_p), (ids_u, ptr_u) = matrix(positive), matrix(unlabelled)
    row_p, row_u = np.repeat(np.arange(n_p), np.diff(ptr_p)), np.repeat(np.arange(n_u), np.diff(ptr_u))
    evidence = np.log(p[chosen] / u[chosen])
    prior = mixture_share(np.bincount(row_p, evidence[ids_p], n_p), np.bincount(row_u, evidence[ids_u], n_u), prior)
    w, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, settings.steps + 1):
        f_p = np.bincount(row_p, w[ids_p], n_p) + bias
        f_u = np.bincount(row_u, w[ids_u], n_u) + bias
        negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        d_u, d_p = sig(f_u) / n_u, -prior * sig(f_p) / n_p
        if negative < 0:
            d_u, d_p = -d_u, -d_p
        else:
            d_p = d_p - prior * sig(-f_p) / n_p
        grad = np.zeros(len(w) + 1)
        grad[:-1] = (np.bincount(ids_p, d_p[row_p], len(w)) + np.bincount(ids_u, d_u[row_u], len(w))
                     + settings.shrink * w)
        grad[-1] = d_p.sum() + d_u.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        move = settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weight[chosen] = w
    return Model(weight, float(bias))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    return fit(*training_sample(docs, labels, settings), settings)


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Probability of each whole text; each known feature counts once per text."""
    out = np.zeros(len(texts))
    for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
        found = []
        for ids, ptr in features_of(texts[a:b]):
            known = np.flatnonzero(model.weight[ids])
            doc = np.searchsorted(ptr, known, side="right") - 1
            found.append(doc << BITS | ids[known])
        once = np.unique(np.concatenate(found))
        out[a:b] = np.bincount(once >> BITS, model.weight[once & ((1 << BITS) - 1)], b - a)
    return 1 / (1 + np.exp(-np.clip(out + model.bias, -40, 40)))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the column ``toxic_score``; a null or empty text has the score of no words."""
    # The weights have a fixed size, 4 MB.
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            scores = score_texts(batch["text"].to_pylist(), shipped.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, "toxic_score"])

    return docs.mapInArrow(score, docs.withColumn("toxic_score", F.lit(0.0)).schema)


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
                    threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, repeated rows included.

    Extra columns of the inputs are ignored. A null doc_id is scored and not held out. With
    no labels every score is 0.001, and nothing is predicted toxic.
    """
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels, settings))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
               threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents that score at least ``threshold``, columns unchanged."""
    model = train(docs, labels, settings)
    plain, back = set_aside(docs, "doc_id", "text")
    return with_scores(plain, model).where(F.col("toxic_score") < threshold).select(*back)
