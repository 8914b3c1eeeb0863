"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

Tokens are runs of word characters and runs of other visible characters, case
kept. Features of a text are its tokens, its token pairs and, for every window
of four tokens, which of them are equal (the four-gram in canonical form, so
that repetition counts whatever the repeated word is). Every feature is hashed
into ``2 ** DIM_BITS`` weights; its value is its share of the text's tokens
times ``SCALE``. A score is the sparse dot product of these values with the
weights, through the logistic function.

Training reads at most ``TRAIN_ROWS`` labelled rows (those with the smallest
hash of their identifier, so the choice does not depend on partitioning; one
row an identifier, that with the smallest hash of its text), never one of the
held-out fold. Their hashed features, not their texts, come to the driver, as
Arrow buffers. Scoring covers all rows, task by task, with the weights in a
broadcast of fixed size.

Defined cases: null and empty texts score by the intercept alone; labels
without an identifier or a quality, and labels of unknown documents, are
skipped; contradicting labels of a document count as the lowest; a null
identifier is held out; without any usable label every score is 0.5; repeated
rows are scored each; other columns never take part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import table

DIM_BITS, SCALE = 18, 20.0
TRAIN_ROWS, EPOCHS = 3000, 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.2
FOLDS, THRESHOLD = 5, 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SIZE = 1 << DIM_BITS


def features(text: str | None) -> np.ndarray:
    """Hashed feature numbers of one whole text, with repeats."""
    tokens = _TOKEN.findall(text or "")
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    crc = zlib.crc32
    t = np.fromiter([crc(w) for w in " ".join(tokens).encode("utf-8", "surrogatepass").split(b" ")], np.uint64, n)
    parts = [t * np.uint64(0x9E3779B97F4A7C15)]
    if n > 1:
        parts.append((t[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + t[1:]) * np.uint64(0x165667B19E3779F9))
    if n > 3:
        a, b, c, d = t[:-3], t[1:-2], t[2:-1], t[3:]
        same = (a == b) | (b == c) * np.uint64(2) | (c == d) * np.uint64(4) | (a == c) * np.uint64(8) \
            | (b == d) * np.uint64(16) | (a == d) * np.uint64(32)
        parts.append((same + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return (np.concatenate(parts) >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the intercept) from (feature numbers, values, label) rows."""
    z, n = np.zeros(_SIZE + 1), np.zeros(_SIZE + 1)

    def weights(i: np.ndarray | slice) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(17)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            ids, values, label = rows[k]
            w = weights(ids)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / ALPHA
            z[ids] += g - sigma * w
            n[ids] += g * g
    return weights(slice(None))


def fold(ident: str) -> Column:
    """crc32 of the identifier as text, modulo ``FOLDS``; 0 is held out."""
    return F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text",
          label: str = "quality", max_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from at most ``max_rows`` labelled rows outside the held-out fold."""
    known = (labels.filter(F.col(ident).isNotNull() & F.col(label).isNotNull() & (fold(ident) != 0))
             .groupBy(F.col(ident).alias("_id")).agg(F.min(label).cast("int").alias("_y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # at most max_rows narrow rows: a broadcast of bounded size
    picked = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
    # one row an identifier, however often it is repeated
    least = F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t")))
    picked = picked.groupBy("_id", "_y").agg(least.alias("_least")).select("_id", F.col("_least.t").alias("_text"), "_y")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, counts = [], []
            for t in b.column("_text"):
                i, c = np.unique(features(t.as_py()), return_counts=True)
                ids.append(i)
                counts.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_y"), pa.array(ids, pa.list_(pa.int64())),
                 pa.array(counts, pa.list_(pa.int64()))], ["_id", "_y", "ids", "counts"])

    kind = picked.schema["_id"].dataType.simpleString()
    got = picked.mapInArrow(scan, f"_id {kind}, _y int, ids array<long>, counts array<long>").toArrow()
    rows = []
    for i, y, ids, counts in zip(*[got.column(c) for c in ("_id", "_y", "ids", "counts")], strict=True):
        c = counts.values.to_numpy().astype(float)
        rows.append((str(i.as_py()), np.append(ids.values.to_numpy(), _SIZE),
                     np.append(c * (SCALE / max(c.sum() / 3, 1.0)), 1.0), int(y.as_py() > 0)))
    rows.sort(key=lambda r: r[0])
    return ftrl([r[1:] for r in rows])


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            out = np.empty(b.num_rows)
            for k, t in enumerate(b.column(at)):
                f = features(t.as_py())
                dot = w[f].sum() * (SCALE / max(len(f) / 3, 1.0))
                out[k] = 1 / (1 + np.exp(-np.clip(dot + w[_SIZE], -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())],
                                             schema=b.schema.append(pa.field(name, pa.float64())))

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    weights = train(docs, labels)
    got = score(docs.select("doc_id", "text"), weights)
    return got.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns."""
    weights = train(docs, labels)
    got = score(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), weights, "_text")
    return got.filter(F.col("score") >= THRESHOLD).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
