"""Suffix-array dedup: removes every byte covered by a repeated ``SPAN``-byte string.

Sorting the suffixes of all positions would move the corpus many times over.
Here a suffix is sorted only where it can decide something:

1. Anchors. In every window of ``SPAN`` bytes the ``GRAM``-byte string with the
   smallest hash (the leftmost, if equal) is the window's anchor. The choice
   depends on the window's bytes alone, so equal windows have the same anchor
   at the same place. An anchor *owns* the run of windows that chose it, on
   average ``SPAN / 2`` of them.
2. A window repeats only if the string at its anchor does. Anchors whose
   string occurs once are dropped (hash counts, aggregated before the shuffle).
3. Anchors with the same owned stretch of bytes form a class. In a class of
   two or more every owned window repeats. Only one member of each class goes on, and only if
   its anchor string also occurs in another class.
4. These suffixes, from the anchor onwards, are range-partitioned by splitters
   sampled from their leading tokens, sorted in their bucket by multikey
   quicksort and compared with their neighbours (equal suffixes are ordered by
   what stands left of the anchor, so that a hot string spreads over buckets).
   A window that starts ``o`` bytes left of its anchor repeats exactly if
   another suffix of the same run of common prefixes of at least ``SPAN - o``
   has the same ``o`` bytes on its left.
5. Runs that reach past a bucket's splitters are compared across boundaries, in
   two steps. Each bucket first sends, for every ``BLOCK`` successive windows of
   such a run, a hash of the bytes that these windows have in common; only where
   two buckets sent the same one do the windows themselves meet. Of equal
   windows a bucket sends one, so a hot string spreads over many buckets and
   still meets, one row per bucket.

Strings are judged on the input. Hashes select; classes and windows that cross
buckets are 128-bit BLAKE2b digests; inside a bucket bytes are compared.

Defined cases: null and empty texts have no bytes; texts shorter than ``SPAN``
lose nothing unless a repeat covers them, which it can't; repeated rows repeat
each other's strings; rows are matched by text, so identifiers may be null or
repeated; an empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import rolling
from pitchlake.llm.common import table, text_of, written

SPAN, GRAM = 400, 96
#: Suffixes that a bucket is meant to hold, buckets up to which it is meant to; suffixes that it holds
#: at most beyond (their number then follows the suffixes); sampled suffixes per bucket.
BUCKET_ROWS, FEW_BUCKETS, MOST_ROWS, SAMPLED = 2000, 4096, 50_000, 8
#: Windows that are compared across boundaries together at first; at most 63 (they form a bit mask).
BLOCK = 32
#: Anchors and suffixes that leave a task together.
ANCHORS, BATCH = 8192, 4096
_CUTOFF = 24


def anchors(data: np.ndarray, span: int = SPAN, gram: int = GRAM) -> dict[str, np.ndarray] | None:
    """Anchors of one text: ``at``, first and last owned window ``lo`` and ``hi``, hash of the anchor
    string ``gram``. None if there is no window."""
    n = len(data)
    if n < span:
        return None
    p = np.arange(n - gram + 1)
    h = rolling.mixed(rolling.stretch(rolling.sums(rolling.BYTE[data]), p, p + gram))
    at, first, last = rolling.owners(h, span - gram + 1)
    return {"at": at, "lo": first, "hi": last, "gram": h[at].view(np.int64)}


def _anchor_rows(keyed: DataFrame) -> DataFrame:
    """All anchors of all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[dict[str, np.ndarray]] = []
            seg: list[bytes] = []
            of: list[int] = []

            def sent() -> pa.RecordBatch:
                take = pa.array(np.repeat(of, [len(f["at"]) for f in found]), pa.int32())
                each = {c: np.concatenate([f[c] for f in found]) for c in ("at", "lo", "hi", "gram")}
                return pa.RecordBatch.from_arrays(
                    [b.column("k1").take(take), b.column("k2").take(take),
                     *[pa.array(each[c].astype(np.int32)) for c in ("at", "lo", "hi")], pa.array(each["gram"]),
                     pa.array(seg, pa.binary())], ["k1", "k2", "at", "lo", "hi", "gram", "seg"])

            for k, t in enumerate(b.column("body")):
                body = t.as_py()
                own = anchors(np.frombuffer(body, np.uint8))
                if own is None:
                    continue
                found.append(own)
                of.append(k)
                # where the anchor lies in the stretch follows from the stretch
                seg += [blake2b(body[x:y + SPAN], digest_size=16).digest()
                        for x, y in zip(own["lo"].tolist(), own["hi"].tolist(), strict=True)]
                if len(seg) >= ANCHORS:
                    yield sent()
                    found.clear()
                    seg.clear()
                    of.clear()
            if found:
                yield sent()

    return keyed.select("k1", "k2", "body").mapInArrow(
        scan, "k1 long, k2 long, at int, lo int, hi int, gram long, seg binary")


def sort_key(right: bytes, left: bytes, span: int = SPAN) -> bytes:
    """A suffix's place in the order: its bytes, then those left of the anchor, nearest first."""
    return right.ljust(span, b"\0") + left[::-1].ljust(span, b"\0")


def multikey_quicksort(tokens: np.ndarray) -> np.ndarray:
    """Order of the rows of a token matrix: three-way partition by one token, equal rows go on with the next."""
    order = np.arange(len(tokens))
    todo = [(0, len(tokens), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2 or depth >= tokens.shape[1]:
            continue
        rows = order[a:b]
        keys = tokens[rows, depth]
        if b - a <= _CUTOFF and len(np.unique(keys)) == b - a:
            order[a:b] = rows[np.argsort(keys)]
            continue
        few = np.sort(keys[::max(1, (b - a) // 9)])
        pivot = few[len(few) // 2]
        less, same = keys < pivot, keys == pivot
        n1, n2 = int(less.sum()), int(same.sum())
        order[a:b] = np.concatenate((rows[less], rows[same], rows[~(less | same)]))
        todo += [(a, a + n1, depth), (a + n1, a + n1 + n2, depth + 1), (a + n1 + n2, b, depth)]
    return order


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def compare_bucket(right: list[bytes], left: list[bytes], below: bytes | None, above: bytes | None,
                   span: int = SPAN) -> tuple[np.ndarray, list[tuple[int, int, bool]]]:
    """Which windows repeat inside one bucket, and which may meet others beyond its splitters.

    ``right[i]`` runs from the anchor to the end of the last owned window, ``left[i]`` from the first
    owned window to the anchor. Returns a matrix (suffix, bytes left of the anchor), and one entry
    (suffix, bytes left, already known to repeat) for each distinct window to compare across boundaries."""
    n = len(right)
    keys = np.frombuffer(b"".join(sort_key(r, x, span) for r, x in zip(right, left, strict=True)), np.uint8)
    order = multikey_quicksort(keys.view(">u8").reshape(n, -1).astype(np.uint64))
    keys = keys.reshape(n, -1)[order]
    raw, rev = keys[:, :span], keys[:, span:]
    la = np.array([len(x) for x in right])[order]
    lb = np.array([len(x) for x in left])[order]
    lcp = np.full(n, -1, np.int64)  # of each suffix with the one before it
    lcp[1:] = _first_difference(raw[1:], raw[:-1])

    def edge(row: int, splitter: bytes | None) -> int:
        if splitter is None:
            return -1
        return int(_first_difference(raw[row:row + 1], np.frombuffer(splitter[:span], np.uint8)[None, :])[0])

    # common prefix of each suffix with the splitters below and above
    down = np.minimum.accumulate(np.concatenate(([edge(0, below)], lcp[1:])))
    up = np.minimum.accumulate(np.concatenate(([edge(n - 1, above)], lcp[:0:-1])))[::-1]
    deepest = int(lb.max(initial=0))
    repeats = np.zeros((n, deepest + 1), bool)
    across: list[tuple[int, int, bool]] = []
    # Suffixes with the same bytes left of the anchor, refined byte by byte. One that shares them with no
    # other drops out: further to the left it can't share more.
    alive, side = np.arange(n), np.zeros(n, np.int64)
    for o in range(deepest + 1):
        if o and len(alive):
            _, again, counts = np.unique(side[alive] * 256 + rev[alive, o - 1], return_inverse=True,
                                         return_counts=True)
            side[alive] = again
            alive = alive[counts[again] > 1]
        need = span - o
        fits = (lb >= o) & (la >= need)
        open_rows = fits & ((down >= need) | (up >= need))
        rows = np.flatnonzero(fits)
        here = alive[fits[alive]]
        if len(here):
            run = np.zeros(n, np.int64)
            run[rows[1:]] = np.cumsum(np.minimum.reduceat(lcp[:rows[-1] + 1], rows[:-1] + 1) < need) \
                if len(rows) > 1 else 0
            _, first, inverse, counts = np.unique(run[here] * (n + 1) + side[here], return_index=True,
                                                  return_inverse=True, return_counts=True)
            known = counts[inverse] > 1
            repeats[order[here], o] = known
            across += [(int(order[here[i]]), o, bool(known[i])) for i in first[open_rows[here[first]]]]
            open_rows[here] = False
        across += [(int(order[i]), o, False) for i in np.flatnonzero(open_rows)]
    return repeats, across


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _keyed(docs: DataFrame, ident: str, text: str) -> DataFrame:
    t = text_of(text)
    return docs.select(F.col(ident).alias("_id"), F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(7), t).alias("k2"),
                       t.cast("binary").alias("body"))


def _suffixes(texts: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """The suffixes at the wanted anchors (k1, k2, list of (at, lo, hi, n)), with their bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k1, k2, body, places in zip(*[b.column(c) for c in ("k1", "k2", "body", "places")], strict=True):
                t, every = body.as_py(), places.as_py()
                for start in range(0, len(every), BATCH):  # a long text has many anchors
                    rows = every[start:start + BATCH]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1.as_py()] * len(rows), pa.int64()), pa.array([k2.as_py()] * len(rows), pa.int64()),
                         pa.array([r["at"] for r in rows], pa.int32()), pa.array([r["n"] for r in rows], pa.int64()),
                         pa.array([t[r["at"]:r["hi"] + span] for r in rows], pa.binary()),
                         pa.array([t[r["lo"]:r["at"]] for r in rows], pa.binary())],
                        ["k1", "k2", "at", "n", "right", "left"])

    per_text = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "lo", "hi", "n")).alias("places"))
    return texts.select("k1", "k2", "body").join(per_text, ["k1", "k2"]).mapInArrow(
        scan, "k1 long, k2 long, at int, n long, right binary, left binary")


def _splitters(suffixes: DataFrame, span: int) -> list[bytes]:
    """Sampled splitters, one per bucket: a bucket's size is bounded whatever the number of suffixes."""
    m = suffixes.count()
    buckets = max(min(FEW_BUCKETS, -(-m // BUCKET_ROWS)), -(-m // MOST_ROWS))
    if buckets < 2:
        return []
    every = max(1, m // (buckets * SAMPLED))
    got = suffixes.filter(F.pmod(F.xxhash64("k1", "k2", "at"), F.lit(every)) == 0) \
        .select("right", "left").limit(2 * buckets * SAMPLED).collect()
    keys = sorted(sort_key(bytes(r[0]), bytes(r[1]), span) for r in got)
    return sorted({keys[k * len(keys) // buckets] for k in range(1, buckets)}) if keys else []


def _digest(data: bytes) -> tuple[int, int]:
    w = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(w[:8], "big", signed=True), int.from_bytes(w[8:], "big", signed=True)


def _compared(suffixes: DataFrame, span: int) -> DataFrame:
    """Per bucket: runs of repeated windows (first, last), and blocks of windows to compare across
    boundaries (at, block, hashes w1, w2, bit masks ``open`` and ``known`` of the block's windows)."""
    spark = suffixes.sparkSession
    shared = spark.sparkContext.broadcast(_splitters(suffixes, span))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right
        cuts = shared.value
        for b in batches:
            to = [bisect_right(cuts, sort_key(r, x, span))
                  for r, x in zip(b.column("right").to_pylist(), b.column("left").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to, pa.int32())], [*b.schema.names, "bucket"])

    def one(bucket: pa.Table) -> pa.Table:
        cuts, k = shared.value, bucket.column("bucket")[0].as_py()
        right, left = bucket.column("right").to_pylist(), bucket.column("left").to_pylist()
        k1, k2, at, n = (bucket.column(c).to_pylist() for c in ("k1", "k2", "at", "n"))
        repeats, across = compare_bucket(right, left, cuts[k - 1] if k else None, cuts[k] if k < len(cuts) else None,
                                         span)
        out: list[tuple] = []
        for i in range(len(right)):
            if n[i] == 1:  # of classes with more members every window repeats anyway
                out += [(k1[i], k2[i], at[i], at[i] - b, at[i] - a, None, None, None, None, None)
                        for a, b in _runs(repeats[i])]
        masks: dict[tuple[int, int], list[int]] = {}
        for i, o, known in across:
            m = masks.setdefault((i, o // BLOCK), [0, 0])
            m[0] |= 1 << o % BLOCK
            m[1] |= (known or n[i] > 1) << o % BLOCK
        for (i, j), (is_open, known) in masks.items():
            least, most = j * BLOCK, j * BLOCK + BLOCK - 1  # every window of the block has these bytes
            common = left[i][len(left[i]) - least:] + right[i][:max(span - most, 0)]
            out.append((k1[i], k2[i], at[i], None, None, j, *_digest(b"%d:" % j + common), is_open, known))
        columns = list(zip(*out, strict=True)) or [()] * 10
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, *[pa.int64()] * 4]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                    ["k1", "k2", "at", "first", "last", "block", "w1", "w2", "open", "known"])

    dealt = suffixes.mapInArrow(deal, "k1 long, k2 long, at int, n long, right binary, left binary, bucket int")
    return dealt.groupBy("bucket").applyInArrow(
        one, "k1 long, k2 long, at int, first int, last int, block int, w1 long, w2 long, open long, known long")


def _met(rows: DataFrame) -> DataFrame:
    """The hashes that several rows have. A bucket sends a window at most once, so a window's hash that
    several rows have is in several buckets; a block's hash may only seem so, which the windows settle."""
    return written(rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("w1", "w2"),
                   "met")


def _across(suffixes: DataFrame, blocks: DataFrame, span: int) -> DataFrame:
    """Windows (k1, k2, first, last) that repeat in another bucket, not known to repeat before."""
    shared = blocks.join(_met(blocks), ["w1", "w2"]).drop("w1", "w2", "first", "last")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                for bit in range(BLOCK):
                    if r["open"] >> bit & 1:
                        o = r["block"] * BLOCK + bit
                        left = r["left"]
                        out.append((r["k1"], r["k2"], r["at"] - o, bool(r["known"] >> bit & 1),
                                    *_digest((left[len(left) - o:] + r["right"])[:span])))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             ["k1", "k2", "first", "known", "w1", "w2"])

    held = suffixes.select("k1", "k2", "at", "right", "left").join(shared, ["k1", "k2", "at"])
    each = written(held.mapInArrow(windows, "k1 long, k2 long, first int, known boolean, w1 long, w2 long"),
                   "boundary-windows")
    return each.filter("NOT known").join(_met(each), ["w1", "w2"]).select(
        "k1", "k2", "first", F.col("first").alias("last"))


def repeated(docs: DataFrame, ident: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """k1, k2 (a text) and ``windows``: its runs of repeated windows as (first, last) starts."""
    keyed = _keyed(docs, ident, text)
    long_enough = keyed.filter(F.length("body") >= span)
    # these small tables are written, so that the joins with them can split a hot string
    every = written(_anchor_rows(long_enough), "anchors")
    often = written(every.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram"), "grams")
    found = written(every.join(often, "gram"), "repeated-anchors")
    key = ["gram", "seg"]
    classes = written(found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "at", "lo", "hi")).alias("one")), "anchor-classes")
    whole = found.join(classes.filter("n > 1").select(*key), key).select(
        "k1", "k2", F.col("lo").alias("first"), F.col("hi").alias("last"))
    several = written(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram"),
                      "shared-grams")
    wanted = classes.join(several, "gram").select("one.*", "n")
    texts = long_enough.dropDuplicates(["k1", "k2"])
    suffixes = written(_suffixes(texts, wanted, span), "suffixes")
    compared = written(_compared(suffixes, span), "compared")
    inside = compared.filter("block IS NULL").select("k1", "k2", "first", "last")
    beyond = _across(suffixes, compared.filter("block IS NOT NULL"), span)
    runs = whole.union(inside).union(beyond)
    return runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("windows"))


def kept_bytes(body: bytes, windows: list[tuple[int, int]], span: int = SPAN) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside all repeated windows, and the maximal removed runs."""
    spans: list[list[int]] = []
    for a, b in sorted(windows):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + span)
        else:
            spans.append([a, b + span])
    kept, at = [], 0
    for a, b in spans:
        kept.append(body[at:a])
        at = b
    kept.append(body[at:])
    return b"".join(kept), [(a, b) for a, b in spans]


def removed(docs: DataFrame, ident: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """One row per document: identifier, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans."""
    found = written(repeated(docs, ident, text, span), "repeated")
    keyed = _keyed(docs, ident, text)
    texts = keyed.select("k1", "k2", "body").dropDuplicates(["k1", "k2"]).join(found, ["k1", "k2"], "left")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for body, windows in zip(b.column("body"), b.column("windows"), strict=True):
                t = body.as_py()
                kept, spans = kept_bytes(t, [(w["first"], w["last"]) for w in windows.as_py() or []], span)
                rows.append((len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                             [{"start": x, "end": y} for x, y in spans]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    per_text = texts.select("k1", "k2", "body", "windows").mapInArrow(
        scan, "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<start:long,end:long>>")
    return keyed.select("_id", "k1", "k2").join(per_text, ["k1", "k2"]).select(
        F.col("_id").alias(ident), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).drop("spans")


#: One row per byte: is the window that starts there repeated, is the byte covered by such a window.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
                  strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT r, unnest(range(n)) AS p FROM d),
w AS (SELECT b.r, b.p, CASE WHEN b.p + {SPAN} <= d.n THEN hash(substr(d.h, 2 * b.p + 1, {2 * SPAN})) END AS s
      FROM b JOIN d USING (r)),
often AS (SELECT s FROM w WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
f AS (SELECT w.r, w.p, CASE WHEN often.s IS NOT NULL THEN 1 ELSE 0 END AS again
      FROM w LEFT JOIN often ON w.s = often.s),
c AS (SELECT r, p, max(again) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW) AS gone
      FROM f WHERE r IN (SELECT r FROM f WHERE again = 1)),
e AS (SELECT r, p, gone, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY p) AS before FROM c),
k AS (SELECT e.r, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans,
             string_agg(substr(d.h, 2 * p + 1, 2), '' ORDER BY p) FILTER (gone = 0) AS kept
      FROM e JOIN d USING (r) GROUP BY e.r)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN k.r IS NULL THEN d.h ELSE coalesce(k.kept, '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
