"""Substring dedup by prefix-partitioned suffix trees over words.

A word goes if a window of ``SPAN`` consecutive words covers it that also starts
in a document with a smaller identifier. Windows are judged on the input.

1. Anchors. In every window the ``GRAM``-word string with the smallest hash (the
   leftmost, if equal) is the window's anchor. The choice depends on the
   window's words alone. An anchor *owns* the run of windows that chose it;
   anchors whose string occurs once are dropped.
2. Anchors with the same owned stretch of words form a class. In a class all
   windows of all but the smallest document go. Only the smallest document's
   stretch goes on, and only if its anchor string also occurs in the class of
   another document: edges of shared passages, mostly.
3. The suffixes that start at the windows of these stretches are split by
   prefixes of variable length: a prefix shared by more than ``GROUP_ROWS``
   suffixes is extended to the next of ``LENGTHS``, one that stands in a single
   document only is dropped. A prefix of all ``SPAN`` words is a node of its
   own and needs no tree, so that a passage in a third of all documents is
   counted, not gathered.
4. Each other prefix gives a group that fits into memory. The nodes of its suffix
   tree are the runs of sorted suffixes with a longer common prefix than their
   neighbours; those of ``SPAN`` words or more are the repeats, and all their
   suffixes but those of the smallest document are windows that go.

Classes, and nodes of whole windows, are 128-bit BLAKE2b digests; prefixes are
64-bit hashes, since inside a group the words themselves are compared. Groups
stream through a task one after another.

Defined cases: null, empty and blank texts have no words; texts of fewer than
``SPAN`` words lose nothing; a null identifier counts as larger than all others
and as equal to itself; rows with the same identifier are one document, so
repeated rows lose nothing to each other; identifiers may be of any type with
an order; an empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import rolling
from pitchlake.llm.common import table, text_of, written

SPAN, GRAM = 50, 20
#: Prefix lengths in words, the last one a whole window; most suffixes of a group.
LENGTHS, GROUP_ROWS = (36, 43, SPAN), 20_000
#: Anchors and stretches that leave a task together, and stretches whose suffixes do.
ANCHORS, BATCH, STRETCHES = 8192, 1024, 256

Words = list[bytes]


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between them, and where each starts and ends."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return b" ".join(words), np.concatenate(([0], ends[:-1] + 1)), ends


def anchors(words: Words, span: int = SPAN, gram: int = GRAM) -> list[tuple[int, int, int, bytes]]:
    """(hash of the anchor's string, first and last owned window, digest of the owned stretch)."""
    if len(words) < span:
        return []
    text, start, end = _joined(words)
    letters = rolling.sums(rolling.BYTE[np.frombuffer(text, np.uint8)])
    of_words = rolling.sums(rolling.mixed(rolling.stretch(letters, start, end) + (end - start).astype(np.uint64)))
    p = np.arange(len(words) - gram + 1)
    h = rolling.mixed(rolling.stretch(of_words, p, p + gram))
    at, first, last = rolling.owners(h, span - gram + 1)
    return [(g, a, b, _digest(text[i:j])) for g, a, b, i, j in
            zip(h[at].view(np.int64).tolist(), first.tolist(), last.tolist(), start[first].tolist(),
                end[last + span - 1].tolist(), strict=True)]


def _keyed(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """Identifier, ``k1`` (hash of the text) and the text: rows that agree in the first two share a result."""
    t = text_of(text)
    return docs.select(F.col(ident).alias("_id"), F.xxhash64(t).alias("k1"), t.cast("binary").alias("body"))


def _doc(ident: str = "_id") -> Column:
    """The place of a document in the order: null identifiers come last."""
    return F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("id"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["k1"] == b["k1"]) & a["_id"].eqNullSafe(b["_id"])


def _anchor_rows(keyed: DataFrame, kind: str, span: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[int, int, int, bytes]] = []
            of: list[int] = []

            def sent() -> pa.RecordBatch:
                g, first, last, stretch = zip(*found, strict=True)
                take = pa.array(of, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [b.column("_id").take(take), b.column("k1").take(take), pa.array(g, pa.int64()),
                     pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(stretch, pa.binary())],
                    ["_id", "k1", "gram", "first", "last", "class"])

            for k, t in enumerate(b.column("body")):
                own = anchors(t.as_py().split(), span, gram)
                found += own
                of += [k] * len(own)
                if len(found) >= ANCHORS:
                    yield sent()
                    found.clear()
                    of.clear()
            if found:
                yield sent()

    return keyed.select("_id", "k1", "body").mapInArrow(
        scan, f"_id {kind}, k1 long, gram long, first int, last int, class binary")


def _stretches(keyed: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """The words of the wanted classes' stretches: class, _id (the smallest document), body."""
    kind, ident = _arrow(wanted.select("_id")), wanted.schema["_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, body, places in zip(*[b.column(c) for c in ("_id", "body", "places")], strict=True):
                words, every = body.as_py().split(), places.as_py()
                for x in range(0, len(every), BATCH):  # a long text has many stretches
                    rows = every[x:x + BATCH]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["class"] for r in rows], pa.binary()), pa.array([i.as_py()] * len(rows), kind),
                         pa.array([b" ".join(words[r["first"]:r["last"] + span]) for r in rows], pa.binary())],
                        ["class", "_id", "body"])

    per_row = wanted.groupBy("_id", "k1").agg(F.collect_list(F.struct("class", "first", "last")).alias("places"))
    texts = keyed.dropDuplicates(["_id", "k1"])
    joined = texts.join(per_row, _same(texts, per_row)).select(texts["_id"], "body", "places")
    return joined.mapInArrow(scan, f"class binary, _id {ident}, body binary")


def _arrow(df: DataFrame) -> pa.DataType:
    """The Arrow type of a table's only column."""
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema.fields[0].dataType)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few stretches at a time: each has many suffixes."""
    for b in batches:
        for at in range(0, b.num_rows, STRETCHES):
            yield b.slice(at, STRETCHES)


def _prefixes(stretches: DataFrame, length: int, span: int, only: DataFrame | None = None) -> DataFrame:
    """One row per suffix: class, ``at`` (its place in the stretch), _id, digest ``p`` of its first ``length`` words.

    ``only`` (class, places) names the suffixes that are wanted; all of them if there is none."""
    kind = stretches.schema["_id"].dataType.simpleString()
    size, whole = 16 if length == span else 8, only is None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            places: list[int] = []
            prefixes: list[bytes] = []
            of: list[int] = []
            for k, body in enumerate(b.column("body")):
                text, start, end = _joined(body.as_py().split())
                wanted = range(len(start) - span + 1) if whole else b.column("places")[k].as_py()
                places += wanted
                of += [k] * len(wanted)
                prefixes += [blake2b(text[start[at]:end[at + length - 1]], digest_size=size).digest() for at in wanted]
            take = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("class").take(take), pa.array(places, pa.int32()), b.column("_id").take(take),
                 pa.array(prefixes, pa.binary())], ["class", "at", "_id", "p"])

    src = stretches if whole else stretches.join(only, "class")
    return src.mapInArrow(scan, f"class binary, at int, _id {kind}, p binary")


def _shared(a: bytes, b: bytes) -> int:
    """Words in the common prefix."""
    if a == b:
        return a.count(b" ")
    return next(k for k, (u, v) in enumerate(zip(a.split(b" "), b.split(b" "), strict=False)) if u != v)


def suffix_tree(suffixes: list[bytes], least: int = 1) -> list[tuple[int, list[int]]]:
    """The tree's internal nodes of ``least`` words or more: string depth in words, and the suffixes below.

    The nodes are the runs of the sorted suffixes that share a longer prefix than their neighbours; words
    are followed by one space."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    nodes: list[tuple[int, list[int]]] = []
    stack = [(0, 0)]  # depth, first place in the order
    for x in range(1, len(order) + 1):
        shared = -1
        if x < len(order):
            a, b = suffixes[order[x - 1]], suffixes[order[x]]
            if a == b or max(a.count(b" "), b.count(b" ")) > least:
                shared = _shared(a, b)
            else:  # different suffixes of at most ``least`` words share fewer
                shared = 0
        first = x - 1
        while stack and stack[-1][0] > shared:
            depth, first = stack.pop()
            if depth >= least:
                nodes.append((depth, order[first:x]))
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))
    return nodes


def _trees(groups: DataFrame, stretches: DataFrame, span: int) -> DataFrame:
    """(class, at) of the windows that go, from the suffix tree of each group of suffixes (``p``)."""
    kind = groups.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            of: list[int] = []
            texts: list[bytes] = []
            every = b.column("places").to_pylist()
            for k, body in enumerate(b.column("body").to_pylist()):
                words = body.split()
                texts += [b" ".join(words[s["at"]:s["at"] + span]) + b" " for s in every[k]]
                of += [k] * len(every[k])
            take = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([s["p"] for e in every for s in e], pa.binary()), b.column("class").take(take),
                 pa.array([s["at"] for e in every for s in e], pa.int32()), b.column("_id").take(take),
                 pa.array(texts, pa.binary())], ["p", "class", "at", "_id", "body"])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p", "class", "at", "_id", "body"]
        now: bytes | None = None
        rows: list[tuple] = []
        out: list[tuple] = []

        def done() -> None:
            for _, below in suffix_tree([r[3] for r in rows], span):
                keys = [(rows[i][2] is None, rows[i][2]) for i in below]
                least = min(keys)
                out.extend(rows[i][:2] for i, key in zip(below, keys, strict=True) if key > least)

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()),
                                               pa.array([r[1] for r in out], pa.int32())], ["class", "at"])

        for b in batches:
            for p, *row in zip(*[b.column(c).to_pylist() for c in names], strict=True):
                if p != now:
                    done()
                    now = p
                    rows.clear()
                rows.append(tuple(row))
            yield sent()
            out.clear()
        done()
        yield sent()

    held = stretches.join(groups.groupBy("class").agg(F.collect_list(F.struct("p", "at")).alias("places")), "class")
    each = held.mapInArrow(cut, f"p binary, class binary, at int, _id {kind}, body binary")
    return each.repartition("p").sortWithinPartitions("p").mapInArrow(trees, "class binary, at int")


def _partly(stretches: DataFrame, span: int, lengths: tuple[int, ...], group_rows: int) -> DataFrame:
    """(class, at) of the windows of undecided stretches that start in a smaller document."""
    found: list[DataFrame] = []
    only = None
    for n in lengths:
        todo = written(_prefixes(stretches, n, span, only), "prefixes")
        shared = todo.groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.min(_doc()).alias("low"),
                                       F.max(_doc()).alias("high")).filter("low < high")
        if n == span:  # all suffixes of the prefix are the same window
            shared = written(shared.select("p", "low"), "whole-windows")
            found.append(todo.join(shared, "p").filter(_doc() > F.col("low")).select("class", "at"))
            break
        shared = written(shared.select("p", "c"), "shared-prefixes")
        small = todo.join(shared.filter(F.col("c") <= group_rows).select("p"), "p")
        found.append(_trees(small, stretches, span))
        large = shared.filter(F.col("c") > group_rows).select("p")
        if large.isEmpty():
            break
        only = written(todo.join(large, "p").groupBy("class").agg(F.collect_list("at").alias("places")), "large-prefixes")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def repeated(docs: DataFrame, ident: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM,
             lengths: tuple[int, ...] = LENGTHS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """_id, k1 (an identifier and a text) and ``windows``: runs of the windows that go as (first, last) starts."""
    keyed = _keyed(docs, ident, text)
    kind = keyed.schema["_id"].dataType.simpleString()
    every = written(_anchor_rows(keyed.filter(F.length("body") >= 2 * span - 1), kind, span, gram), "anchors")
    # small tables are written, so that the joins with them can split a hot string
    often = written(every.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram"), "grams")
    found = written(every.join(often, "gram"), "repeated-anchors")
    classes = written(found.groupBy("class").agg(
        F.min("gram").alias("gram"), F.max(_doc()).alias("high"),
        F.min(F.struct(_doc().alias("low"), "k1", "first", "last")).alias("one")), "classes")
    whole = found.join(classes.filter("high > one.low").select("class", "one.low"), "class") \
        .filter(_doc() > F.col("low")).select("_id", "k1", "first", "last")
    several = classes.groupBy("gram").agg(F.min("one.low").alias("a"), F.max("one.low").alias("b")) \
        .filter("a < b").select("gram")
    wanted = classes.join(written(several, "shared-grams"), "gram").select(
        "class", F.col("one.low.id").alias("_id"), "one.k1", "one.first", "one.last")
    stretches = written(_stretches(keyed, wanted, span), "stretches")
    gone = written(_partly(stretches, span, lengths, group_rows), "partly").distinct() \
        .groupBy("class").agg(F.collect_list("at").alias("places"))
    # a class's smallest document may hold its stretch several times
    low = classes.select("class", "one.low").join(gone, "class")
    partly = found.join(low, "class").filter(_doc() == F.col("low")) \
        .select("_id", "k1", "first", F.explode("places").alias("at")) \
        .select("_id", "k1", (F.col("first") + F.col("at")).alias("first"), (F.col("first") + F.col("at")).alias("last"))
    return whole.union(partly).groupBy("_id", "k1").agg(F.collect_set(F.struct("first", "last")).alias("windows"))


def kept(words: Words, windows: list[tuple[int, int]], span: int = SPAN) -> tuple[Words, list[tuple[int, int]]]:
    """The words outside all windows that go, and the maximal removed runs (start, end)."""
    spans: list[list[int]] = []
    for a, b in sorted(windows):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + span)
        else:
            spans.append([a, b + span])
    out, at = [], 0
    for a, b in spans:
        out += words[at:a]
        at = b
    return out + words[at:], [(a, b) for a, b in spans]


def removed(docs: DataFrame, ident: str = "doc_id", text: str = "text", span: int = SPAN, **how: object) -> DataFrame:
    """One row per document: identifier, n_words, n_removed, the removed spans (in words) and the ``kept`` text."""
    found = written(repeated(docs, ident, text, span, **how), "repeated")
    keyed = _keyed(docs, ident, text)
    joined = keyed.join(found, _same(keyed, found), "left").select(keyed["_id"], "body", "windows")
    kind = joined.schema["_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for body, windows in zip(b.column("body"), b.column("windows"), strict=True):
                words = body.as_py().split()
                left, spans = kept(words, [(w["first"], w["last"]) for w in windows.as_py() or []], span)
                rows.append((len(words), len(words) - len(left), [{"start": x, "end": y} for x, y in spans],
                             b" ".join(left)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["_id", "n_words", "n_removed", "spans", "kept"])

    got = joined.mapInArrow(scan, f"_id {kind}, n_words long, n_removed long, "
                                  "spans array<struct<start:long,end:long>>, kept binary")
    return got.select(F.col("_id").alias(ident), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Every window of every text, the smallest document that it starts in, and the words that it covers.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t
           FROM documents),
s AS (SELECT r, doc_id, unnest(range(len(t) - {SPAN} + 1)) AS i, t FROM d WHERE len(t) >= {SPAN}),
w AS (SELECT r, doc_id, i, md5(array_to_string(t[i + 1:i + {SPAN}], ' ')) AS s FROM s),
low AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
g AS (SELECT r, i FROM w JOIN low USING (s) WHERE low < coalesce(doc_id, 9223372036854775807)),
p AS (SELECT DISTINCT r, unnest(range(i, i + {SPAN})) AS i FROM g),
e AS (SELECT r, unnest(range(len(t))) AS i, t FROM d WHERE r IN (SELECT r FROM p)),
k AS (SELECT e.r, count(p.i) AS n_removed, string_agg(e.t[e.i + 1], ' ' ORDER BY e.i) FILTER (p.i IS NULL) AS kept
      FROM e LEFT JOIN p ON e.r = p.r AND e.i = p.i GROUP BY e.r)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN k.r IS NULL THEN array_to_string(t, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
