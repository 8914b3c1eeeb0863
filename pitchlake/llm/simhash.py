"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: 64 bits over word shingles (XXH64, seed 42); a bit is set if it
is set in more than half of the shingle hashes. Two fingerprints link if they
differ in at most ``distance`` bits; a document's class is its connected
component over those links.

Search. Bits that vary together are put into the same partition, so that the
partitions are as independent as possible. Each of the ``m`` partitions gets a
threshold of its own, at least -1 (never probed), and the thresholds add up to
``distance - m + 1``: then two linked fingerprints must agree within the
threshold in at least one partition (otherwise they would differ in at least
``distance + 1`` bits). Number of partitions and thresholds are chosen by
dynamic programming on the cost estimated from a sample of fingerprints: the
probes sent plus the candidates met. A probe is a partition's value with up to
``threshold`` bits flipped; it meets the fingerprints that have this value
there, and each candidate is verified on all 64 bits. The plan only affects
speed; any plan finds every link.

Only distinct fingerprints are probed, each with the smallest identifier that
has it, so copies never meet each other. Nothing about all documents reaches
the driver: the plan comes from at most ``PLAN_SAMPLE`` fingerprints.

Defined cases: null and blank texts have fingerprint zero and link like any
other; one or two words are one shingle; repeated rows come back as often as
they occur; a null identifier takes part with the others but never names a
component unless all identifiers of the component are null; an empty table
gives an empty result; other columns never take part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import one_each, table, written
from pitchlake.llm.components import components

SHINGLE, DISTANCE, SEED, BITS = 3, 3, 42, 64
#: Fingerprints that the probing plan is estimated from.
PLAN_SAMPLE = 4000
#: Rows of a block of the sample's distances, which the driver holds at a time.
PLAN_BLOCK = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[:1 - shingle or None].tolist(), ends[shingle - 1:].tolist(), strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, ident: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``_id``, ``_tx`` (hash of the text) and ``_fp`` (signed long) of every row."""
    src = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text"),
                      F.xxhash64(F.col(text)).alias("_tx"))
    kind = src.schema["_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps, pa.int64())],
                                             ["_id", "_tx", "_fp"])

    return src.mapInArrow(scan, f"_id {kind}, _tx long, _fp long")


@dataclass(frozen=True)
class Plan:
    """Partitions (lists of bit numbers) and their thresholds."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def _grouped(bits: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of nearly equal width; each grows by the bit most correlated with it."""
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.abs(np.nan_to_num(np.corrcoef(bits.T))) if len(bits) > 1 else np.zeros((BITS, BITS))
    left, out = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        rest = sorted(left)
        first = max(rest, key=lambda b: (corr[b, rest].sum(), -b))
        part = [first]
        left.discard(first)
        while len(part) < width:
            b = max(sorted(left), key=lambda c: (corr[c, part].sum(), -c))
            part.append(b)
            left.discard(b)
        out.append(sorted(part))
    return out


def make_plan(sample: np.ndarray, n: int, distance: int = DISTANCE) -> Plan:
    """Partitions and thresholds with the least estimated probes plus candidates for ``n`` fingerprints."""
    sample = np.unique(sample.astype(np.int64)).view(np.uint64)
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
    s = max(len(sample), 1)
    best: tuple[float, Plan] | None = None
    for m in range(2, distance + 3):
        parts, total = _grouped(bits, m), distance - m + 1
        top = total + m - 1  # all others at -1
        costs = []
        for part in parts:
            x = bits[:, part]
            # Hamming distance of all sample pairs inside the partition, by matrix products of blocks of rows
            pairs = np.zeros(BITS + 1, np.int64)
            for at in range(0, len(x), PLAN_BLOCK):
                y = x[at:at + PLAN_BLOCK]
                d = y.sum(1)[:, None] + x.sum(1)[None, :] - 2 * (y @ x.T)
                pairs += np.bincount(np.rint(d).astype(np.uint8).ravel(), minlength=BITS + 1)
            pairs[0] -= len(sample)
            cost = [0.0]  # threshold -1
            for t in range(top + 1):
                # at least a uniform share: a sample rarely shows the pairs of a wide partition
                near = max(pairs[:t + 1].sum() / s / s, sum(comb(len(part), j) for j in range(t + 1)) / 2.0 ** len(part))
                probes = float(sum(comb(len(part), j) for j in range(t + 1)))
                cost.append(n * probes + n * float(n) * near)
            costs.append(cost)
        # dynamic programme over partitions: least cost for each sum of thresholds so far
        state: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            nxt: dict[int, tuple[float, tuple[int, ...]]] = {}
            for used, (c, ts) in state.items():
                for t, extra in enumerate(cost, start=-1):
                    key, val = used + t, (c + extra, (*ts, t))
                    if key <= total + m and (key not in nxt or val < nxt[key]):
                        nxt[key] = val
            state = nxt
        if total in state and (best is None or state[total][0] < best[0]):
            best = state[total][0], Plan(tuple(map(tuple, parts)), state[total][1])
    assert best is not None
    return best[1]


def _mask(part: tuple[int, ...]) -> int:
    v = sum(1 << b for b in part)
    return v - (1 << BITS) if v >> (BITS - 1) else v


def _probes(fp: Column, part: tuple[int, ...], threshold: int) -> Column:
    """The partition's value with up to ``threshold`` of its bits flipped, as an array."""
    flips = [_mask(c) for t in range(threshold + 1) for c in itertools.combinations(part, t)]
    own = fp.bitwiseAND(F.lit(_mask(part)))
    if len(flips) == 1:
        return F.array(own)
    masks = F.array(*[F.lit(f).cast("long") for f in flips])
    return F.transform(masks, lambda f: own.bitwiseXOR(f))


def links(fps: DataFrame, plan: Plan, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``_fp``) within ``distance`` bits."""
    probe, index = [], []
    for k, (part, t) in enumerate(zip(plan.parts, plan.thresholds, strict=True)):
        if t >= 0:
            probe.append(fps.select(F.lit(k).alias("p"), F.explode(_probes(F.col("_fp"), part, t)).alias("v"),
                                    F.col("_fp").alias("a")))
            index.append(fps.select(F.lit(k).alias("p"), F.col("_fp").bitwiseAND(F.lit(_mask(part))).alias("v"),
                                    F.col("_fp").alias("b")))
    left, right = probe[0], index[0]
    for x, y in zip(probe[1:], index[1:], strict=True):
        left, right = left.union(x), right.union(y)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return left.join(right, (left.p == right.p) & (left.v == right.v) & near).select("a", "b").distinct()


def classes(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            distance: int = DISTANCE) -> DataFrame:
    """``_id``, ``_tx``, ``_fp``, ``_root`` (the class) and ``_component`` (its smallest identifier)
    of every row."""
    rows = written(with_fingerprint(docs, ident, text, shingle), "fingerprints")
    distinct = rows.groupBy("_fp").agg(F.min("_id").alias("low"))
    distinct = written(distinct, "distinct-fingerprints")
    n = distinct.count()
    # any bounded set will do for the estimate; the order by hash spreads it over the table
    sample = distinct.select("_fp").orderBy(F.xxhash64("_fp")).limit(PLAN_SAMPLE).collect()
    plan = make_plan(np.array([r[0] for r in sample], dtype=np.int64), max(n, 1), distance)
    roots = components(links(distinct, plan, distance))
    merged = distinct.join(roots.withColumnRenamed("node", "_fp"), "_fp", "left") \
        .select("_fp", "low", F.coalesce("root", "_fp").alias("root"))
    low = merged.groupBy("root").agg(F.min("low").alias("_component"))
    of_fp = merged.join(low, "root").select("_fp", F.col("root").alias("_root"), "_component")
    return rows.join(of_fp, "_fp").select("_id", "_tx", "_fp", "_root", "_component")


def keep_one(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one whose identifier names it.

    Of several rows with this identifier, one stays."""
    found = classes(docs, ident, text)
    named = found.filter(F.col("_id").eqNullSafe(F.col("_component")))
    texts = named.groupBy("_root", "_id", "_tx").agg(F.count(F.lit(1)).alias("_copies"))
    kept = texts.groupBy("_root", "_id").agg(F.min(F.struct("_tx", "_copies")).alias("_least"))
    wanted = kept.select(_row_key(F.col("_least._tx"), F.col("_id")).alias("_key"), "_least._copies")
    return one_each(docs, _row_key(F.xxhash64(F.col(text)), F.col(ident)), wanted)


def _row_key(tx: Column, ident: Column) -> Column:
    return F.struct(tx.alias("tx"), ident.alias("id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                        F.col("_component").alias("component_id"))
