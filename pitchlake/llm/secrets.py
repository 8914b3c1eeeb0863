"""Secret scans over an incremental blob ledger.

A blob is a distinct text, named by its SHA-256. The ledger holds one row per
(blob, rule, rule version) with the spans found, so a text is scanned by a
rule's version once, in whatever rows, paths or historical versions it occurs:
a run scans only the pairs that the ledger lacks, appends what it found, and
joins the findings of the current versions back to all rows.

Base rules (see ``RULES``) report leftmost matches that don't overlap within a
rule; matches that fail the rule's length are dropped after matching. Further
rules add spans of other kinds. Offsets are code points, ends exclusive.

Defined cases: a null text is the empty blob; texts without findings are in
the ledger with no spans; repeated rows get a row each; an empty table gives
an empty result; other columns never take part. A text that makes up a third
of all rows is reduced to one blob inside each task before any shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import scratch_path, table, text_of


class Rule(NamedTuple):
    kind: str
    pattern: str
    flags: int
    group: int     # its length decides
    least: int
    base: bool

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.pattern}|{self.flags}|{self.group}|{self.least}".encode()).hexdigest()[:16]


# The rules, base ones first, in the order that breaks ties.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.IGNORECASE | re.ASCII, 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 0, 24, True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0, 1, False),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, 1, False),
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}\b", 0, 0, 1, False),
)
_LEDGER = "blob string, rule string, version string, spans array<struct<start:int,end:int>>"
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def scan_text(rule: Rule, text: str) -> list[tuple[int, int]]:
    """The rule's spans in one whole text."""
    return [m.span() for m in re.compile(rule.pattern, rule.flags).finditer(text)
            if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of the (blob, rule) pairs named in ``todo`` (rule kinds)."""
    by_kind = {r.kind: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for blob, text, todo in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                t = text.as_py()
                for kind in todo:
                    rule = by_kind[kind]
                    spans = [{"start": s, "end": e} for s, e in scan_text(rule, t)]
                    for column, v in zip(out, (blob, kind, rule.version, spans), strict=True):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                 pa.array(out[3], _FOUND)], ["blob", "rule", "version", "spans"])

    return blobs.mapInArrow(scan, _LEDGER)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(_LEDGER).parquet(path)


def update(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans the unseen (blob, rule version) pairs of ``docs``, appends them to the ledger folder
    and returns the ledger's rows of the current versions."""
    spark = docs.sparkSession
    t = text_of(text)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    blobs = docs.select(F.sha2(t.cast("binary"), 256).alias("blob"), t.alias("_text")).dropDuplicates(["blob"])
    now = [(r.kind, r.version) for r in rules]
    old = _ledger(spark, ledger)
    if old is None:
        todo = blobs.select("blob", "_text", kinds.alias("todo"))
    else:
        seen = old.filter(F.struct("rule", "version").isin([F.struct(F.lit(k), F.lit(v)) for k, v in now])) \
            .groupBy("blob").agg(F.collect_set("rule").alias("done"))  # at most one entry per rule
        todo = blobs.join(seen, "blob", "left").select(
            "blob", "_text", F.array_except(kinds, F.coalesce("done", F.array().cast("array<string>"))).alias("todo")) \
            .filter(F.size("todo") > 0)
    _scan(todo, rules).write.mode("append").parquet(ledger)
    current = spark.createDataFrame(now, "rule string, version string")
    return spark.read.schema(_LEDGER).parquet(ledger).join(F.broadcast(current), ["rule", "version"])


def findings(docs: DataFrame, ledger: str | None = None, ident: str = "doc_id", text: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``spans_by_rule`` (rule -> spans) of its text, by way of the ledger."""
    spark = docs.sparkSession
    rows = update(docs, ledger or scratch_path(spark, "blob-ledger"), text, rules)
    # one list per rule and blob: a lost and repeated append would repeat, not change, it
    per_blob = rows.filter(F.size("spans") > 0).groupBy("blob") \
        .agg(F.map_from_entries(F.collect_set(F.struct("rule", "spans"))).alias("spans_by_rule"))
    own = docs.select(F.col(ident).alias("_id"), F.sha2(text_of(text).cast("binary"), 256).alias("blob"))
    return own.join(per_blob, "blob", "left")


def report(found: DataFrame, ident: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and joined spans of each document."""
    order = {r.kind: k for k, r in enumerate(rules)}

    def of_rule(r: Rule) -> Column:
        spans = F.coalesce(F.col("spans_by_rule")[r.kind], F.array().cast("array<struct<start:int,end:int>>"))
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order[r.kind]).alias("rank"), s["end"].alias("end"),
            F.lit(r.kind).alias("kind")))

    def joined(chosen: list[Rule]) -> Column:
        ordered = F.array_sort(F.concat(*[of_rule(r) for r in chosen]))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [r for r in rules if r.base]
    counts = [F.coalesce(F.size(F.col("spans_by_rule")[r.kind]), F.lit(0)) for r in base]
    counts = [F.greatest(c, F.lit(0)).cast("long").alias(f"n_{r.kind}") for c, r in zip(counts, base, strict=True)]
    return found.select(F.col("_id").alias(ident), *counts,
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(list(rules)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(findings(table(spark, sf_dir, "documents")))
