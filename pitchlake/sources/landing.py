"""Reading a landed feed (files as the feed delivers them) with explicit schemas.

A feed delivers events with nested values (``location`` as a list of numbers,
objects for kinds); the landing schema says so, and ``bronze.land_events``
stringifies and conforms them to the Bronze types. No schema inference: a
field missing from some files reads as NULL, and every file of a run is read
in one scan (no per-match loop). Nothing that a feed delivers is lost:

* a JSON line is read as one VARIANT; its known fields become typed columns, all
  others stay together in ``_extra``, and known ones that don't fit their type go
  to ``_unparsed`` as they are;
* a line that is no JSON object (nor an array of objects) is kept whole, in the
  feed's ``corrupt`` tables, instead of passing as a row of NULLs;
* Parquet files keep all their columns, also where files disagree on columns or
  types (see ``sources.drift``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schemas
from pitchlake.sources import drift

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
XY = T.ArrayType(D)

FEED_EVENTS = T.StructType([T.StructField(n, t, True) for n, t in [
    ("match_id", L), ("team_id", I), ("team", S), ("player_id", D), ("player", S),
    ("type", S), ("period", I), ("minute", I), ("second", I), ("location", XY),
    ("possession_team", S), ("play_pattern", S), ("carry_end_location", XY),
    ("shot_statsbomb_xg", D), ("shot_body_part", S), ("shot_outcome", S),
    ("under_pressure", T.BooleanType()), ("event_order", L),
    ("competition_id", L), ("season_id", L),
]])

FEED_MATCHES = T.StructType([T.StructField(n, t, True) for n, t in [
    ("match_id", L), ("competition_id", L), ("season_id", L), ("match_date", S),
    ("home_team", S), ("away_team", S), ("home_score", S), ("away_score", S),
]])


CORRUPT = "_corrupt_record"


def _sql_name(name: str) -> str:
    return "'" + name.replace("'", "\\'") + "'"


def _json_lines(spark: SparkSession, path: str, schema: T.StructType, corrupt: bool) -> DataFrame:
    known = schema.fieldNames()
    # the reader parses a line once; the elements of an array are rows of their own
    lines = (spark.read.schema(f"_line variant, {CORRUPT} string").option("singleVariantColumn", "_line").json(path)
             .select("*", F.col("_metadata.file_path").alias("_file"),
                     F.expr("explode(coalesce(try_variant_get(_line, '$', 'array<variant>'), array(_line))) AS _row"))
             .select("*", F.expr("try_variant_get(_row, '$', 'map<string,variant>') AS _fields")))
    if corrupt:
        return lines.where("_fields IS NULL").select(
            F.coalesce(F.col(CORRUPT), F.to_json("_row")).alias("line"), F.col("_file").alias("file"))
    lines = lines.where("_fields IS NOT NULL")

    def typed(f: T.StructField) -> str:
        return f"try_variant_get(_row, '$.{f.name}', '{f.dataType.simpleString()}')"

    def raw(f: T.StructField) -> str:
        return f"variant_get(_row, '$.{f.name}', 'variant')"

    # a JSON null is a missing value
    lost = ", ".join(f"CASE WHEN {typed(f)} IS NULL AND NOT coalesce(is_variant_null({raw(f)}), true) "
                     f"THEN {raw(f)} END AS `{f.name}`" for f in schema.fields)
    others = f"map_filter(_fields, (k, v) -> k NOT IN ({', '.join(map(_sql_name, known))}))"
    out = lines.select(*[F.expr(typed(f)).alias(f.name) for f in schema.fields],
                       F.expr(f"to_json(struct({lost}))").alias("_lost"), F.expr(others).alias("_others"))
    return out.select(*known, F.expr("CASE WHEN size(_others) > 0 THEN to_variant_object(_others) END").alias(schemas.EXTRA),
                      F.expr("nullif(_lost, '{}')").alias(schemas.UNPARSED))


def _fitted(part: DataFrame, schema: T.StructType) -> DataFrame:
    """A group of files with the feed's types; what does not fit is kept in ``_unparsed``."""
    have = {f.name: f.dataType for f in part.schema.fields}
    known = [f for f in schema.fields if f.name in have]
    wrong = [f for f in known if have[f.name] != f.dataType]

    def fitted(f: T.StructField):
        col, source = F.col(f.name), have[f.name]
        if isinstance(f.dataType, T.ArrayType) and isinstance(source, T.StringType):
            return F.from_json(col, f.dataType)  # '[61.0, 40.1]'
        if isinstance(source, (T.ArrayType, T.StructType, T.MapType)) and not isinstance(f.dataType, T.ArrayType):
            return F.to_json(col).try_cast(f.dataType)
        return col.try_cast(f.dataType)

    out = [fitted(f).alias(f.name) for f in known] + [F.lit(None).cast(f.dataType).alias(f.name)
                                                      for f in schema.fields if f.name not in have]
    names = set(schema.fieldNames())
    extra = [F.col(f"`{c}`") if isinstance(t, T.StringType) else
             (F.to_json(F.col(f"`{c}`")) if isinstance(t, (T.ArrayType, T.StructType, T.MapType))
              else F.col(f"`{c}`").cast("string")).alias(c) for c, t in have.items() if c not in names]
    unparsed = F.lit(None).cast("string")
    if wrong:
        lost = [F.when(F.col(f.name).isNotNull() & fitted(f).isNull(), F.col(f.name).cast("string")).alias(f.name)
                for f in wrong]
        unparsed = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}"))
    return part.select(*out, *extra, unparsed.alias(schemas.UNPARSED))


def read_landing(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "json", corrupt: bool = False) -> DataFrame:
    """All files under ``path`` (json lines or parquet) with the given schema, and what else they hold.

    Of JSON lines, those that parse; with ``corrupt``, the others, as text and with their file."""
    if fmt == "json":
        return _json_lines(spark, path, schema, corrupt)
    if fmt == "parquet":
        parts = [_fitted(p, schema) for p in drift.read_groups(spark, [path], path)]
        return drift.union(parts) if parts else spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


FEED_LINEUPS = T.StructType([T.StructField(n, t, True) for n, t in [
    ("match_id", L), ("competition_id", L), ("season_id", L), ("team_name", S),
    ("player_id", L), ("player_name", S), ("jersey_number", L),
]])

FEED_COMPETITIONS = T.StructType([T.StructField(n, t, True) for n, t in [
    ("competition_id", L), ("season_id", L), ("competition_name", S), ("season_name", S),
]])

FEED_SCHEMAS = {"events": FEED_EVENTS, "matches": FEED_MATCHES, "lineups": FEED_LINEUPS,
                "competitions": FEED_COMPETITIONS}


class LandedFeed:
    """A feed delivered as files: ``<root>/{events,matches,lineups,competitions}/``,
    each read with its explicit schema in one scan (same attributes as the
    adapter's ``Feed``, so ``plans.pipeline.ingest`` takes either)."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "json"):
        root = root.rstrip("/")
        self.corrupt: dict[str, DataFrame] = {}
        for name, schema in FEED_SCHEMAS.items():
            setattr(self, name, read_landing(spark, f"{root}/{name}", schema, fmt))
            if fmt == "json":
                self.corrupt[name] = read_landing(spark, f"{root}/{name}", schema, fmt, corrupt=True)
