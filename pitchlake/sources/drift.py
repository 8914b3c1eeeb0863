"""Parquet files of one table whose columns or column types disagree.

One explicit schema can't read a column that is a float in one file and text in
another. The footers of all files are read in a Spark job; files with the same
columns and types form a group, and only one file per group is looked at from
the driver. Every group is one scan, cast to the target schema, and the groups
are unioned by name. File lists are metadata, as any scan's listing is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What Spark says of a file whose column has another type than the schema asks for.
MISMATCH = ("PARQUET_COLUMN_DATA_TYPE_MISMATCH", "SchemaColumnConvertNotSupported")


def is_mismatch(error: BaseException) -> bool:
    return any(m in str(error) for m in MISMATCH)


def or_by_groups(step: Callable[[bool], object]) -> object:
    """``step(False)``; if stored files disagree with the schema on a column's type, ``step(True)``.

    Tables written by the landing functions have one type per column, so the footers of all files are
    read only where a scan has found a file of another type."""
    try:
        return step(False)
    except Exception as e:  # noqa: BLE001 - Spark's job error carries the cause in its text
        if not is_mismatch(e):
            raise
        return step(True)


def files_of(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``path`` of every file below the folders, but for hidden ones (a listing; no content is read)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders)).select("path")


def _uri(path: str) -> str:
    scheme, _, rest = path.partition(":/")
    return path if rest.startswith("/") or not rest else f"{scheme}:///{rest}"


def footers(files: DataFrame) -> DataFrame:
    """``path``, ``n_rows`` and ``kind`` (a text of all columns and their types) of every file, from its footer.

    ``kind`` is NULL for a file in a store that only Spark reads."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet
        for b in batches:
            rows: list[int | None] = []
            kinds: list[str | None] = []
            for path in b.column("path").to_pylist():
                try:
                    store, inside = fs.FileSystem.from_uri(_uri(path))
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    rows.append(None)
                    kinds.append(None)
                    continue
                with store.open_input_file(inside) as source:
                    meta = parquet.read_metadata(source)
                kinds.append("\n".join(sorted(f"{f.name} {f.type}" for f in meta.schema.to_arrow_schema())))
                rows.append(meta.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(rows, pa.int64()), pa.array(kinds, pa.string())],
                                             ["path", "n_rows", "kind"])

    return files.mapInArrow(scan, "path string, n_rows long, kind string")


def _driver_kinds(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Groups of files whose store only Spark reads: their footers are read side by side from the driver."""
    from concurrent.futures import ThreadPoolExecutor
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for p, kind in zip(paths, pool.map(lambda p: spark.read.parquet(p).schema.json(), paths), strict=True):
            out.setdefault(kind, []).append(p)
    return out


def groups(spark: SparkSession, folders: Sequence[str]) -> list[list[str]]:
    """The files below the folders, those with the same columns and types together."""
    by: dict[str, list[str]] = {}
    found = footers(files_of(spark, folders)).groupBy("kind").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    for r in found.collect():
        if r["kind"] is None:
            by |= _driver_kinds(spark, r["paths"])
        else:
            by[r["kind"]] = r["paths"]
    return [by[k] for k in sorted(by)]


def column_names(spark: SparkSession, folder: str) -> list[str]:
    """All columns that the files below a folder have, whatever their types."""
    try:  # read and merged in a job
        return spark.read.option("mergeSchema", "true").parquet(folder).columns
    except Exception as e:  # noqa: BLE001 - types that can't be merged
        if "CANNOT_MERGE" not in str(e):
            raise
    return union(p.limit(0) for p in read_groups(spark, [folder], folder, as_text=True)).columns


def read_groups(spark: SparkSession, folders: Sequence[str], base: str | None = None,
                as_text: bool = False) -> list[DataFrame]:
    """One table per group of files, with the types that its files have (and the folders' partition columns)."""
    reader = spark.read if base is None else spark.read.option("basePath", base)
    parts = [reader.parquet(*paths) for paths in groups(spark, folders)]
    return [p.select(*[F.col(f"`{c}`").cast("string") for c in p.columns]) for p in parts] if as_text else parts


def union(parts: Iterable[DataFrame]) -> DataFrame:
    """The parts by name; a column that a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_drifted(spark: SparkSession, folders: Sequence[str], schema: T.StructType, base: str | None = None,
                 where: Column | None = None) -> DataFrame:
    """All files below the folders as one table of ``schema``; values that don't fit their type are NULL."""
    from pitchlake.sources.bronze import conform
    parts = [conform(p if where is None else p.where(where), schema) for p in read_groups(spark, folders, base)]
    return union(parts) if parts else spark.createDataFrame([], schema)
