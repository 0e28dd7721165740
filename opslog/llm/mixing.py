"""Mixing sources to target weights by iterative proportional fitting (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import set_aside, small, spans
from opslog.llm.words import BATCH_CHARS, words

TOPICS = 8
MARGINS = ("source", "lang", "topic")
#: Without own targets each share of a margin is its share of the tokens to this power.
TEMPER = 0.95
ROUNDS = 200
TOLERANCE = 1e-9
HASH_STEPS = 1 << 30


def _topic_rows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    tokens, topics = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int32)
    for a, b in spans([len(t or "") for t in texts], BATCH_CHARS):
        hashes, ptr = words(texts[a:b])
        tokens[a:b] = np.diff(ptr)
        doc = np.repeat(np.arange(b - a), np.diff(ptr))
        group = (hashes >> np.uint64(61)).astype(np.int64)
        counts = np.bincount(doc * TOPICS + group, minlength=(b - a) * TOPICS).reshape(b - a, TOPICS)
        topics[a:b] = np.where(np.diff(ptr) > 0, counts.argmax(1), -1)
    return tokens, topics


def with_topics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_tokens`` (number of words) and ``mix_topic``.

    There is no topic in the data. The topic is the one of eight fixed groups of words, drawn
    by a hash of the word, that most words of the text belong to; the lower number wins a
    tie. A text without a word has topic -1.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            tokens, topics = _topic_rows(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens), pa.array(topics)],
                names=[*batch.schema.names, "mix_tokens", "mix_topic"])

    schema = docs.withColumns({"mix_tokens": F.lit(0).cast("long"), "mix_topic": F.lit(0)}).schema
    return docs.mapInArrow(add, schema)


def rake(tokens: np.ndarray, levels: Sequence[np.ndarray], targets: Sequence[np.ndarray]) -> np.ndarray:
    """Factors of the cells whose products with ``tokens`` have the target margins.

    Each round scales every margin in turn. Levels without tokens stay without; their target
    is spread over the others. Targets that contradict each other end at the last round with
    the last margin met.
    """
    weight = tokens.astype(float)
    total = weight.sum()
    if not total:
        return np.ones(len(tokens))
    goals = []
    for level, target in zip(levels, targets, strict=True):
        there = np.bincount(level, tokens, len(target)) > 0
        goal = np.where(there, target, 0.0)
        goals.append(goal / goal.sum() * total)
    for _ in range(ROUNDS):
        off = 0.0
        for level, goal in zip(levels, goals, strict=True):
            now = np.bincount(level, weight, len(goal))
            scale = np.divide(goal, now, out=np.ones_like(goal), where=now > 0)
            weight *= scale[level]
            off = max(off, float(np.abs(scale[now > 0] - 1).max()))
        if off < TOLERANCE:
            break
    return np.divide(weight, tokens, out=np.ones(len(tokens)), where=tokens > 0)


def calibrated(cells: list[tuple], targets: Mapping[str, Mapping] | None = None) -> list[tuple]:
    """(source, lang, topic, factor, probability) of cells (source, lang, topic, tokens).

    The largest factor of a cell with tokens gets probability 1, so nothing has to be
    repeated; cells without tokens keep their documents.
    """
    tokens = np.array([c[3] for c in cells], float)
    levels, goals = [], []
    for i, name in enumerate(MARGINS):
        values = sorted({c[i] for c in cells}, key=lambda v: (v is not None, v))
        place = {v: j for j, v in enumerate(values)}
        level = np.array([place[c[i]] for c in cells], np.int64)
        if targets and name in targets:
            goal = np.array([float(targets[name].get(v, 0.0)) for v in values])
        else:
            goal = np.bincount(level, tokens, len(values)) ** TEMPER
        levels.append(level)
        goals.append(goal if goal.sum() > 0 else np.ones(len(values)))
    factor = rake(tokens, levels, goals)
    top = factor[tokens > 0].max() if (tokens > 0).any() else 1.0
    chance = np.where(tokens > 0, factor / top, 1.0)
    return [(*c[:3], float(f), float(p)) for c, f, p in zip(cells, factor, chance, strict=True)]


def with_mix(docs: DataFrame, targets: Mapping[str, Mapping] | None = None, seed: int = 11) -> DataFrame:
    """``docs`` with mix_tokens, mix_topic, mix_weight, mix_probability and mix_kept.

    Tokens are summed by (source, lang, topic) over all documents, and the sums are raked to
    the margins. A document is kept when a hash of doc_id and text, as a number in [0, 1), is
    below the probability of its cell: the same document gets the same answer on every run.
    ``targets`` maps a margin to shares by value; missing margins are tempered shares. Nulls
    in source or lang are a level of their own. An empty table gives no rows.

    The table of cells (sources x languages x topics, not documents) goes through the driver;
    its size does not grow with the documents.
    """
    spark = docs.sparkSession
    counted = with_topics(docs)
    by_cell = counted.groupBy("source", "lang", F.col("mix_topic").alias("topic")).agg(
        F.sum("mix_tokens").alias("tokens"))
    fitted = calibrated([tuple(r) for r in by_cell.collect()], targets)
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    plan = spark.createDataFrame(
        fitted, f"s {types['source']}, l {types['lang']}, t int, mix_weight double, mix_probability double")
    turn = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(HASH_STEPS)) / HASH_STEPS
    return (
        counted.join(
            F.broadcast(plan),
            F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l"))
            & (F.col("mix_topic") == F.col("t")))
        .drop("s", "l", "t").withColumn("mix_kept", turn < F.col("mix_probability"))
    )


def mix_documents(docs: DataFrame, targets: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Weight, probability and decision for every document."""
    return with_mix(docs.select("doc_id", "text", "source", "lang"), targets).select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_weight").alias("weight"), F.col("mix_probability").alias("probability"),
        F.col("mix_kept").alias("sampled"))


def sample_mix(docs: DataFrame, targets: Mapping[str, Mapping] | None = None) -> DataFrame:
    """The sampled documents, columns unchanged."""
    plain, back = set_aside(docs, "doc_id", "text", "source", "lang")
    return with_mix(plain, targets).where("mix_kept").select(*back)
