"""Conflict-constrained best-fit packing of documents into training sequences.

Texts longer than a bin are cut into full pieces and a remainder; nothing is
dropped. Pieces are placed in decreasing length into the bin with the smallest
sufficient residual that conflicts with neither their source nor their
duplicate cluster: no bin holds two documents of one source or of one cluster
(the pieces of a document form a cluster of their own too). Bins are ordered
by residual; each carries a bitmap of its sources and one of its clusters. The
search starts at the successor of the piece's length and goes on, a block of
bins at a time, until the first compatible bin, which is the tightest; only
when there is none a new bin opens.

Packing runs in shards of about ``BINS_PER_SHARD`` bins, or of about
``PIECES_PER_SHARD`` pieces where texts are so short that this gives more
shards, dealt by a hash of identifier, text, source, cluster and the number of the copy,
so a source, a cluster or a repeated row of any number spreads over all shards. Only lengths and keys are shuffled, never texts.

Defined cases: null and empty texts get one piece of length 0; a null source
conflicts with nothing; without a cluster column, texts that are equal but for
case and white space form a cluster; rows repeated with the same identifier
and text are packed each (and conflict with one another); an empty table gives
an empty result; other columns never take part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import repeated, table, text_of

#: Characters of a bin, about 2,048 tokens; bins that a shard is meant to fill; pieces that it is meant to hold.
CAPACITY, BINS_PER_SHARD, PIECES_PER_SHARD = 8192, 256, 4096
_BLOCK = 64
_OUT = "bin_id long, position int, doc_id {}, piece int, start long, length int, residual int"


def best_fit(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece; ``lengths`` must not increase. Keys below 0 never conflict."""
    n = len(lengths)

    def words(keys: np.ndarray) -> int:
        return (int(keys.max(initial=0)) >> 6) + 1

    src = np.zeros((max(n, 1), words(sources)), np.uint64)  # bitmaps by bin
    dup = np.zeros((max(n, 1), words(clusters)), np.uint64)
    residual = np.empty(n, np.int64)  # of the open bins, in increasing order
    order = np.empty(n, np.int64)     # their bins
    out, used = np.empty(n, np.int64), 0
    opened = 0
    for k in range(n):
        need, s, c = int(lengths[k]), int(sources[k]), int(clusters[k])
        s_word, s_bit = s >> 6, np.uint64(1 << (s & 63)) if s >= 0 else np.uint64(0)
        c_word, c_bit = c >> 6, np.uint64(1 << (c & 63)) if c >= 0 else np.uint64(0)
        at, found = int(np.searchsorted(residual[:used], need)), -1
        while at < used:
            bins = order[at:min(at + _BLOCK, used)]
            clash = (src[bins, s_word] & s_bit) | (dup[bins, c_word] & c_bit)
            free = np.flatnonzero(clash == 0)
            if len(free):
                found = at + int(free[0])
                break
            at += _BLOCK
        if found >= 0:
            b, left = int(order[found]), int(residual[found]) - need
            to = int(np.searchsorted(residual[:used], left))  # never right of where it was
            residual[to + 1:found + 1] = residual[to:found].copy()
            order[to + 1:found + 1] = order[to:found].copy()
        else:
            b, left = opened, capacity - need
            opened += 1
            to = int(np.searchsorted(residual[:used], left))
            residual[to + 1:used + 1] = residual[to:used].copy()
            order[to + 1:used + 1] = order[to:used].copy()
            used += 1
        residual[to], order[to] = left, b
        if s >= 0:
            src[b, s_word] |= s_bit
        if c >= 0:
            dup[b, c_word] |= c_bit
        out[k] = b
    return out


def _codes(keys: pd.Series, shared: bool) -> np.ndarray:
    """Dense numbers of keys that occur more than once (or of all, if ``shared`` is false); else -1."""
    codes = pd.factorize(keys)[0]
    if shared and len(codes):
        many = np.bincount(codes[codes >= 0], minlength=1) > 1
        codes = np.where((codes >= 0) & many[codes], codes, -1)
        codes = np.where(codes >= 0, np.unique(codes, return_inverse=True)[1] - int((codes < 0).any()), -1)
    return codes.astype(np.int64)


def pack(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source",
         cluster: Column | None = None, capacity: int = CAPACITY,
         bins_per_shard: int = BINS_PER_SHARD, pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """One row per piece: bin_id, position in the bin, identifier, piece number, start, length
    (characters) and the bin's residual."""
    t = text_of(text)
    if cluster is None:
        cluster = F.xxhash64(F.lower(F.regexp_replace(t, r"\s+", " ")))
    rows = docs.select(F.col(ident).alias("doc_id"), F.length(t).cast("long").alias("_n"),
                       F.col(source).alias("_source"), cluster.alias("_cluster"),
                       F.xxhash64(F.col(ident), t, F.col(source), cluster).alias("_h"))
    n = F.length(t).cast("long")
    total, pieces = docs.select(F.sum(n), F.sum(F.greatest(F.ceil(n / capacity), F.lit(1)))).first()
    shards = max(1, -(-int(total or 0) // (capacity * bins_per_shard)), -(-int(pieces or 0) // pieces_per_shard))
    # rows that agree in everything are numbered, so that they go to different shards
    rows = repeated(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies")), "_copies", "_copy").drop("_copies")
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_n") / capacity).cast("int") - 1, F.lit(0)))
    split = rows.withColumn("piece", F.explode(numbers)).withColumns({
        "start": F.col("piece").cast("long") * capacity,
        "_shard": F.pmod(F.xxhash64("_h", "piece", "_copy"), F.lit(shards)).cast("long")})
    split = split.withColumn("length", F.least(F.lit(capacity), F.col("_n") - F.col("start")).cast("int"))
    kind = docs.schema[ident].dataType.simpleString()

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_h", "piece", "_copy"], ascending=[False, True, True, True], kind="stable")
        where = best_fit(pdf["length"].to_numpy(np.int64), _codes(pdf["_source"], False),
                         _codes(pdf["_cluster"], True), capacity)
        pdf = pdf.assign(_bin=where)
        size = pdf.groupby("_bin")["length"].transform("sum")
        return pd.DataFrame({
            "bin_id": where + (int(key[0]) << 32), "position": pdf.groupby("_bin").cumcount().astype("int32"),
            "doc_id": pdf["doc_id"], "piece": pdf["piece"], "start": pdf["start"], "length": pdf["length"],
            "residual": (capacity - size).astype("int32")})

    return split.drop("_n").groupBy("_shard").applyInPandas(one, _OUT.format(kind))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
