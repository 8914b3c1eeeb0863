"""Helpers shared by the training-data operators: table access and scratch tables.

Scratch tables cut lineage. They lie in the shared folder that the cluster
names in ``spark.checkpoint.dir`` and are removed when the driver ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import delete_at_exit, ensure_checkpoint_dir


#: Copies that one array lists; salts that repeated rows are dealt over.
CHUNK, SALTS = 4096, 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh folder in the shared checkpoint folder, removed when the driver ends."""
    return delete_at_exit(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{what}-{uuid.uuid4().hex}")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a recomputation
    after a lost executor starts from these files."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def repeated(df: DataFrame, copies: str, number: str) -> DataFrame:
    """Each row as often as ``copies`` says, with a ``number`` from 0, in arrays of bounded length."""
    whole = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / CHUNK)))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(CHUNK), F.col(copies) - F.col("_chunk") * CHUNK) - 1))
    return df.withColumn("_chunk", whole).withColumn("_in_chunk", part) \
        .withColumn(number, F.col("_chunk") * CHUNK + F.col("_in_chunk")).drop("_chunk", "_in_chunk")


def one_each(docs: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is wanted, with all their columns; of rows that share a key, one.

    ``wanted`` has ``_key`` (a struct, whose null fields are equal) and ``_copies``, the number of rows
    with that key. Rows that are alone with their key are joined as they are. Those that repeat an
    identifier and text are dealt over salts and reduced there before they meet."""
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))
    wanted = written(wanted.select("_key", "_copies"), "wanted")
    alone = rows.join(wanted.filter("_copies = 1").select("_key"), "_key", "left_semi").select("_row.*")
    several = wanted.filter("_copies > 1").select("_key")
    if several.isEmpty():
        return alone
    salted = several.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    one = dealt.join(salted, ["_key", "_salt"], "left_semi").groupBy("_key", "_salt").agg(F.first("_row").alias("_row")) \
        .groupBy("_key").agg(F.first("_row").alias("_row"))
    return alone.union(one.select("_row.*"))
