"""Bronze landing, partitioned writes and typed scans.

Layout under one lake root (any Hadoop path; the cluster's shared folder):

  bronze/competitions/                         unpartitioned
  bronze/matches/competition_id=/season_id=/
  bronze/lineups/competition_id=/season_id=/
  bronze/events/competition_id=/season_id=/    sorted by type and match_id in each file
  silver/<table>/competition_id=/season_id=/   clustered by match_id
  gold/team_fingerprints/competition_id=/season_id=/

Match events are appended, but for matches that are stored already: their rows
are replaced, and only theirs. All other writes use dynamic partition
overwrite: re-running a season replaces only that season's partitions, other seasons stay (the reference overwrote one
object per table, so a multi-season warm-up kept only the last season).
Before writing, rows are rebalanced on the partition columns (AQE
``REBALANCE``): one file set per partition value, with skewed partitions
split and tiny ones coalesced, instead of tasks x partitions small files.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
import warnings
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schemas
from pitchlake.config import DEFAULT_SOURCE
from pitchlake.functions.parse import long_of
from pitchlake.session import delete_folder, join_path
from pitchlake.sources.drift import column_names, or_by_groups, scan_drifted

SEASON_PARTS = ("competition_id", "season_id")
MATCH = (*SEASON_PARTS, "match_id")
#: Held while the session's choice of file readers is changed for one read.
_READERS = threading.Lock()

# Fixed run stamp used when a run does not pass its own (keeps re-runs identical).
DEFAULT_INGESTED_AT = dt.datetime(2024, 2, 1, 0, 0, 0, tzinfo=dt.timezone.utc)


def paths(root: str) -> dict[str, str]:
    return {
        "competitions": join_path(root, "bronze/competitions"),
        "matches": join_path(root, "bronze/matches"),
        "lineups": join_path(root, "bronze/lineups"),
        "events": join_path(root, "bronze/events"),
        "corrupt": join_path(root, "bronze/_corrupt"),
        "silver": join_path(root, "silver"),
        "gold": join_path(root, "gold/team_fingerprints"),
    }


# ----------------------------------------------------------------- S5, S6

def add_audit_columns(df: DataFrame, ingested_at: dt.datetime = DEFAULT_INGESTED_AT,
                      source: str = DEFAULT_SOURCE) -> DataFrame:
    """``_ingested_at`` (one UTC instant per run, a parameter) and ``_source``."""
    return (df.withColumn("_ingested_at", F.lit(ingested_at).cast("timestamp"))
              .withColumn("_source", F.lit(source)))


def stringify_complex(df: DataFrame) -> DataFrame:
    """Nested columns -> text. Arrays print as ``[1.0, 2.5]``; structs and
    maps as JSON; a missing value stays NULL (never the text 'nan')."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to an explicit schema (missing columns become NULL), so every
    landed file of a table has the same physical types (no schema drift)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema.fields])


def landed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A feed table as Bronze keeps it: the known columns with their types, every other column as
    text, the fields of JSON lines that are no column in ``_extra`` (a VARIANT object), and the raw
    text of values that did not fit their type in ``_unparsed`` (else NULL)."""
    known = {f.name: f.dataType for f in schema.fields}
    lost = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(known[c]).isNull(), F.col(c).cast("string")).alias(c)
            for c in df.columns if c in known and df.schema[c].dataType != known[c]]
    extra = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns
             if c not in known and c not in (schemas.EXTRA, schemas.UNPARSED)]
    have = set(df.columns)
    out = [(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
           .alias(f.name) for f in schema.fields]
    if schemas.EXTRA in have:
        extra.append(F.col(schemas.EXTRA))
    unparsed = F.col(schemas.UNPARSED) if schemas.UNPARSED in have else F.lit(None).cast("string")
    if lost:
        unparsed = F.coalesce(unparsed, F.nullif(F.to_json(F.struct(*lost)), F.lit("{}")))
    return df.select(*out, *extra, unparsed.alias(schemas.UNPARSED))


def extra_columns(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """Names of the columns that landed files have beyond the schema (read from all footers, in a job)."""
    return [c for c in column_names(spark, path) if c not in schema.fieldNames()]


def with_columns(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """The schema with further columns of Bronze, which are text (``_extra`` is a VARIANT)."""
    return T.StructType([*schema.fields, *[T.StructField(
        n, T.VariantType() if n == schemas.EXTRA else T.StringType()) for n in names]])


def extra_fields(bronze: DataFrame) -> list[str]:
    """Names of the fields that the rows' ``_extra`` objects hold (distinct names, partial aggregation first)."""
    names = F.expr(f"explode(map_keys(try_variant_get({schemas.EXTRA}, '$', 'map<string,variant>'))) AS name")
    return [r["name"] for r in bronze.select(names).distinct().orderBy("name").collect()]


def scan_with(spark: SparkSession, path: str, schema: T.StructType, names: Sequence[str],
              seasons: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """A typed scan with further feed fields as text columns, wherever Bronze keeps them: as columns of
    their own (column feeds) or in ``_extra`` (JSON feeds)."""
    stored = extra_columns(spark, path, schema)
    wide = scan(spark, path, with_columns(schema, stored), seasons)
    out = []
    for n in names:
        kept = [F.col(f"`{n}`")] if n in stored else []
        if schemas.EXTRA in stored:
            kept.append(F.expr(f"""try_variant_get({schemas.EXTRA}, '$["{n}"]', 'string')"""))
        out.append((F.coalesce(*kept) if kept else F.lit(None).cast("string")).alias(n))
    return wide.select(*schema.fieldNames(), *out)


# ----------------------------------------------------------------- S7, S8, S13

def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
                      cluster_by: Sequence[str] = (), guard_empty: bool = True,
                      spread_by: Sequence[str] = (), mode: str = "overwrite",
                      selected_by: Sequence[str] = ()) -> int:
    """Parquet write with dynamic partition overwrite; returns rows written.

    S8 (empty input writes nothing, old data stays): with partition columns an
    empty input replaces no partition by construction of the dynamic
    overwrite, so no extra job is needed; an unpartitioned table is checked
    by taking one row first, since overwriting it with nothing would wipe it.
    The row count is observed during the write itself (no second job).
    ``spread_by`` names finer columns to rebalance on than the partition columns. Columns of
    ``selected_by`` get a bloom filter per row group, sized to their distinct values, so that a
    selection of one value reads the row groups that have it, whatever the order of rows.
    """
    if not partition_cols and guard_empty and not df.take(1):
        warnings.warn(f"empty input, nothing written to {path}", stacklevel=2)
        return 0
    obs = Observation(f"rows_{abs(hash(path)) % 10**9}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_cols:
        out = out.hint("rebalance", *(spread_by or partition_cols))
    if cluster_by:
        out = out.sortWithinPartitions(*partition_cols, *cluster_by)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    for c in selected_by:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(path)
    try:
        rows = int(obs.get.get("rows", 0))
    except Py4JJavaError:  # the optimizer saw that the input is empty, and nothing was observed
        rows = 0
    if rows == 0 and guard_empty:
        warnings.warn(f"empty input, no partition of {path} replaced", stacklevel=2)
    return rows


def land_events(events: DataFrame, root: str, ingested_at=DEFAULT_INGESTED_AT,
                source: str = DEFAULT_SOURCE, seasons: Sequence[tuple[int, int]] | None = None) -> int:
    """Match events -> bronze/events, one folder per (competition, season).

    ``seasons`` says which seasons the events are of, where that is known: one season is appended to
    its own folder, so that runs of several seasons side by side don't meet.

    Matches that are not stored yet are appended. If some are, the touched seasons are written
    anew: the stored rows of all other matches, and the delivered rows."""
    df = landed(add_audit_columns(stringify_complex(events), ingested_at, source),
                schemas.BRONZE_EVENTS)
    path, spark = paths(root)["events"], df.sparkSession
    if not table_exists(spark, path):
        return _write_events(df, path, "overwrite")
    delivered = df.select(*[F.col(c).alias(f"d_{c}") for c in MATCH]).distinct()
    touched = delivered.select(*[F.col(f"d_{c}").alias(c) for c in SEASON_PARTS]).distinct()

    def land(drifted: bool) -> int:
        def stored(schema: T.StructType) -> DataFrame:
            rows = scan_drifted(spark, [path], schema, path) if drifted else scan(spark, path, schema)
            # one row per delivered season: bounded by the catalogue; it prunes the stored folders
            return rows.join(F.broadcast(touched), list(SEASON_PARTS), "left_semi")

        def same(rows: DataFrame):
            return reduce(lambda x, y: x & y, [rows[c].eqNullSafe(delivered[f"d_{c}"]) for c in MATCH])

        keys = stored(schemas.BRONZE_EVENTS).select(*MATCH)
        if keys.join(delivered, same(keys), "left_semi").isEmpty():
            return _write_events(df, path, "append", seasons[0] if seasons and len(seasons) == 1 else None)
        rows = df.count()
        if rows:
            old = stored(with_columns(schemas.BRONZE_EVENTS, extra_columns(spark, path, schemas.BRONZE_EVENTS)))
            kept = old.join(delivered, same(old), "left_anti").unionByName(df, allowMissingColumns=True)
            # beside the stored files, which are about to go; its marker makes it what readers see
            staged = join_path(root, f"bronze/{_STAGED}{uuid.uuid4().hex}")
            kept.hint("rebalance", *MATCH).write.partitionBy(*SEASON_PARTS).parquet(staged)
            _replace(spark, root, staged, kept.schema)
        return rows

    return or_by_groups(land)


#: Front of the names of folders that hold seasons on their way into bronze/events.
_STAGED = "_staged-"


def _replace(spark: SparkSession, root: str, staged: str, schema: T.StructType | None = None) -> None:
    """Moves the seasons of a complete staged folder into bronze/events and removes it, its marker first."""
    rows = spark.read.schema(schema).parquet(staged) if schema is not None else spark.read.parquet(staged)
    _write_events(rows, paths(root)["events"], "overwrite")
    delete_folder(spark, join_path(staged, "_SUCCESS"))
    delete_folder(spark, staged)


def staged_folders(spark: SparkSession, root: str) -> list[str]:
    """Complete staged folders: a writer was stopped while it replaced their seasons (or is at it)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(join_path(root, "bronze"))
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    found = [st.getPath().toString() for st in fs.listStatus(hadoop_path) if st.getPath().getName().startswith(_STAGED)]
    return sorted(p for p in found if table_exists(spark, join_path(p, "_SUCCESS")))


def roll_forward(spark: SparkSession, root: str) -> int:
    """Finishes replacements of seasons that were stopped half-way; to be called while nobody else
    writes. Returns how many there were."""
    staged = staged_folders(spark, root)
    for folder in staged:
        _replace(spark, root, folder)
    return len(staged)


def _write_events(df: DataFrame, path: str, mode: str, season: tuple[int, int] | None = None) -> int:
    """Rows of a match go to few files, and those of one type lie together in a file, so that a
    filter on the type skips row groups and pages."""
    if season is not None:
        folder = join_path(path, *[f"{c}={v}" for c, v in zip(SEASON_PARTS, season, strict=True)])
        rows = df.where(season_filter([season])).drop(*SEASON_PARTS).hint("rebalance", "match_id")
        obs = Observation()
        rows.observe(obs, F.count(F.lit(1)).alias("rows")).sortWithinPartitions("type", "match_id") \
            .write.mode(mode).parquet(folder)
        return int(obs.get.get("rows", 0))
    return write_partitioned(df, path, SEASON_PARTS, cluster_by=("type", "match_id"), mode=mode,
                             spread_by=MATCH)


def land_competitions(competitions: DataFrame, root: str, ingested_at=DEFAULT_INGESTED_AT,
                      source: str = DEFAULT_SOURCE) -> int:
    """The competition catalogue, unpartitioned (small, whole overwrite)."""
    df = landed(add_audit_columns(stringify_complex(competitions), ingested_at, source),
                schemas.BRONZE_COMPETITIONS)
    return write_partitioned(df.coalesce(1), paths(root)["competitions"])


def land_matches(matches: DataFrame, root: str, ingested_at=DEFAULT_INGESTED_AT,
                 source: str = DEFAULT_SOURCE) -> int:
    """S3: matches of every season, partitioned by (competition, season)."""
    df = landed(add_audit_columns(stringify_complex(matches), ingested_at, source), schemas.BRONZE_MATCHES)
    return write_partitioned(df, paths(root)["matches"], SEASON_PARTS, cluster_by=("match_id",))


def land_lineups(lineups: DataFrame, root: str, ingested_at=DEFAULT_INGESTED_AT,
                 source: str = DEFAULT_SOURCE) -> int:
    """Per-team line-ups as one table with the team column kept, partitioned
    by (competition, season) so a season's line-ups are read alone."""
    df = landed(add_audit_columns(stringify_complex(lineups), ingested_at, source), schemas.BRONZE_LINEUPS)
    return write_partitioned(df, paths(root)["lineups"], SEASON_PARTS, cluster_by=("match_id",))


# ----------------------------------------------------------------- S9

def limit_matches(matches: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` matches of every season in (date, id) order; falsy n = all.

    The window is per season over that season's matches (one row per match).
    """
    if not n:
        return matches
    w = Window.partitionBy(*SEASON_PARTS).orderBy(F.col("match_date").asc_nulls_last(),
                                                  F.col("match_id"))
    return matches.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def events_of_matches(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Keep the events of the selected matches (semi-join on season and match id: an id may be in two seasons)."""
    return events.join(matches.select(*MATCH).distinct(), list(MATCH), "left_semi")


# ----------------------------------------------------------------- S10-S12

def season_filter(seasons: Iterable[tuple[int, int]] | None):
    """Partition predicate for a list of (competition_id, season_id) pairs."""
    if seasons is None:
        return None
    cond = F.lit(False)
    for c, s in seasons:
        cond = cond | ((F.col("competition_id") == c) & (F.col("season_id") == s))
    return cond


def _existing(spark: SparkSession, paths_: Sequence[str]) -> list[str]:
    """The given folders that exist (one metadata call each, on the driver)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for p in paths_:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder has been written (a source not landed yet is skipped)."""
    try:
        return bool(_existing(spark, [path]))
    except Exception:  # noqa: BLE001 - no JVM access: let the read decide
        return True


def scan(spark: SparkSession, path: str, schema: T.StructType,
         seasons: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """Typed scan of a partitioned table; seasons prune partitions.

    The explicit schema means no inference and no per-file schema merge: a
    column missing from some files reads as NULL, and partition values come
    from the folder names. With ``seasons`` only those season folders are
    listed, and the predicate is kept as a partition filter as well.
    """
    reader = spark.read.schema(schema).option("basePath", path)
    if seasons is None:
        return reader.parquet(path)
    seasons = list(seasons)
    names = [c for c in SEASON_PARTS if c in schema.fieldNames()]
    if len(names) == 2:
        wanted = [join_path(path, f"competition_id={c}/season_id={s}") for c, s in seasons]
        try:
            found = _existing(spark, wanted)
        except Exception:  # noqa: BLE001 - no JVM access (remote session): list all
            found = None
        if found is not None:
            if not found:
                return spark.createDataFrame([], schema)
            return reader.parquet(*found).where(season_filter(seasons))
    return reader.parquet(path).where(season_filter(seasons))


def stored_counts(spark: SparkSession, path: str, seasons: Iterable[tuple[int, int]] | None = None,
                  name: str = "n_rows") -> DataFrame:
    """Rows per season of a table partitioned by season, from its files' footers: the count is pushed
    into the scan (``PushedAggregation``), which reads no column and yields one row per file."""
    # Push-down is a feature of the newer reader; only this read uses it. The setting below has no effect on others.
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    schema = T.StructType([T.StructField("match_id", T.LongType()), *[T.StructField(c, T.LongType()) for c in SEASON_PARTS]])
    with _READERS:
        older = spark.conf.get("spark.sql.sources.useV1SourceList")
        spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in older.split(",") if x != "parquet"))
        try:
            rows = spark.read.schema(schema).parquet(path)
        finally:
            spark.conf.set("spark.sql.sources.useV1SourceList", older)
    wanted = season_filter(seasons)
    return (rows if wanted is None else rows.where(wanted)).groupBy(*SEASON_PARTS).agg(F.count(F.lit(1)).alias(name))


def scan_events(spark, root, seasons=None, drifted: bool = False) -> DataFrame:
    """Bronze events, typed. A season whose replacement is complete but was stopped on its way into
    bronze/events is read where it lies. ``drifted`` reads by groups of files with the same types."""
    def read(folder: str) -> DataFrame:
        if drifted:
            return scan_drifted(spark, [folder], schemas.BRONZE_EVENTS, folder, season_filter(seasons))
        return scan(spark, folder, schemas.BRONZE_EVENTS, seasons)

    seasons = None if seasons is None else list(seasons)
    rows = read(paths(root)["events"])
    for folder in staged_folders(spark, root):
        if seasons is not None and not _existing(spark, [
                join_path(folder, f"competition_id={c}/season_id={s}") for c, s in seasons]):
            continue  # other seasons, perhaps just being written
        there = spark.read.schema(schemas.BRONZE_EVENTS).parquet(folder).select(*SEASON_PARTS).distinct().collect()
        rows = rows.where(~season_filter([tuple(r) for r in there])).unionByName(read(folder))
    return rows


def scan_matches(spark, root, seasons=None) -> DataFrame:
    return scan(spark, paths(root)["matches"], schemas.BRONZE_MATCHES, seasons)


def scan_lineups(spark, root, seasons=None) -> DataFrame:
    return scan(spark, paths(root)["lineups"], schemas.BRONZE_LINEUPS, seasons)


def scan_competitions(spark, root) -> DataFrame:
    return spark.read.schema(schemas.BRONZE_COMPETITIONS).parquet(paths(root)["competitions"])


def normalize_match_id(df: DataFrame) -> DataFrame:
    """match_id as LONG whatever it was stored as (text '3.0', double, int)."""
    if "match_id" not in df.columns:
        return df
    return df.withColumn("match_id", long_of(df, "match_id"))


def point_read(spark: SparkSession, path: str) -> DataFrame:
    """Read one Parquet object or table folder as it is."""
    return spark.read.parquet(path)
