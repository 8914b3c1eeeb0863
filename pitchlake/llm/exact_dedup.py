"""Exact dedup: tree-merge of sorted digest runs.

Every input partition is a run of (digest, identifier) rows. In each round
``fan_in`` neighbouring runs are merged into one: a task sorts its rows by run
and digest and keeps, of equal digests, the winning identifier and the number
of rows; the shuffle then brings equal digests of the merged runs together
(spread over tasks by run and digest, so that a merged run never sits in one
task), where they are merged in the same sorted order. A text that makes up a
third of all rows thus travels once per task and round. The last round leaves
one row per distinct text. (The winner is a struct, which Spark aggregates
over sorted input and not in a hash table.)

A digest alone decides nothing: at every level rows merge only if SHA-256,
byte length and a second hash (XXH64) all agree.

Defined cases: a null text counts as empty; null identifiers lose against all
others (a group of null identifiers only keeps null); a row repeated with the
same identifier and text is listed as often as it occurs, and exactly one of
the copies is kept; an empty table gives an empty result; other columns never
take part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import one_each, repeated, table, text_of

#: Runs that the input partitions are numbered into, and runs merged per round.
RUNS, FAN_IN = 4096, 16
_KEY = ("_sha", "_len", "_x64")


def _digest(t: Column) -> list[Column]:
    return [F.sha2(t.cast("binary"), 256), F.octet_length(t), F.xxhash64(t)]


def with_digest(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the three columns that identify a text."""
    return df.withColumns(dict(zip(_KEY, _digest(text_of(text)), strict=True)))


def _counted(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """Identifier, digest and number of rows of every (identifier, text)."""
    return (with_digest(docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")), "_text")
            .groupBy("_id", *_KEY).agg(F.count(F.lit(1)).alias("_copies")))


def _row_key(sha: Column, size: Column, x64: Column, ident: Column) -> Column:
    return F.struct(sha.alias("sha"), size.alias("len"), x64.alias("x64"), ident.alias("id"))


def merge_runs(rows: DataFrame, ident: str = "_id", keep: str = "largest",
               runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: digest columns, ``keep_id``, ``group_size``.

    ``rows`` has the digest columns, ``ident`` and ``_copies``. ``keep`` names
    which end of the identifiers wins (``smallest`` or ``largest``)."""
    known = F.col("keep_id").isNotNull()  # a null identifier loses either way
    best = F.max(F.struct(known, "keep_id")) if keep == "largest" else F.min(F.struct(~known, "keep_id"))
    run = F.pmod(F.spark_partition_id(), F.lit(runs))
    level = rows.select(run.alias("_run"), *_KEY, F.col(ident).alias("keep_id"),
                        F.col("_copies").alias("group_size"))
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (level.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int"))
                 .groupBy("_run", *_KEY)
                 .agg(best["keep_id"].alias("keep_id"), F.sum("group_size").alias("group_size")))
    return level.drop("_run")


def exact_groups(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                 keep: str = "largest") -> DataFrame:
    """One row per document: identifier, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows = _counted(docs, ident, text)
    won = merge_runs(rows, keep=keep)
    copy = repeated(rows.join(won, list(_KEY)), "_copies", "_n")
    return copy.select(F.col("_id").alias(ident), "keep_id", "group_size",
                       (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_n") == 0)).alias("kept"),
                       F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one per distinct text."""
    rows = _counted(docs, ident, text)
    won = merge_runs(rows, keep=keep).select(*[F.col(c).alias(f"w{c}") for c in _KEY], "keep_id")
    same = [F.col(c) == F.col(f"w{c}") for c in _KEY]
    named = rows.join(won, [*same, F.col("_id").eqNullSafe(F.col("keep_id"))])
    wanted = named.select(_row_key(*[F.col(c) for c in _KEY], F.col("_id")).alias("_key"), "_copies")
    t = text_of(text)
    return one_each(docs, _row_key(*_digest(t), F.col(ident)), wanted)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
