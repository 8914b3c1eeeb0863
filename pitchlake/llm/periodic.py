"""Periodic runs inside one text, found by seed-and-extend on diagonals, and collapsed to one period.

A run is a maximal stretch of words with smallest period ``q`` (words ``q``
apart are identical) and a length of at least ``max(LEAST, 2 * q)``. On the
diagonal of lag ``q`` it shows as a stretch of at least ``max(LEAST - q, q)``
places that hold the same word as the place ``q`` further on.

1. Lags are taken in bands ``[k, 2 * k)`` (the first one from 1). ``k`` words is
   the overlap that every run of the band guarantees, so the ``k``-grams are
   indexed. Numbers of ``2 * k``-grams come from pairs of numbers of ``k``-grams,
   for repeated grams only: exact, and next to no work for text without runs.
2. Occurrence pairs of equal grams whose distance is a lag of the band are
   enumerated. Occurrences at most ``k / 2`` apart form a chain (their gap is the
   gram's own period). Pairs inside a chain belong to a run of that smaller
   period; of all other pairs only those are needed where one of the two is the
   first of its chain, since at the start of a matching stretch one of them is
   (otherwise the stretch would start earlier). A text of one repeated word
   thus yields no pairs instead of all.
3. Each pair is extended in both directions on its diagonal. A table of the
   furthest place covered per lag suppresses pairs in a stretch already extended.
4. Stretches that are long enough are runs; of several with the same words the
   smallest period stays (all others are its multiples).

The number of runs of a text is below its number of words, and time and memory
of a task follow its longest text. Texts are independent, so nothing is
shuffled and a lost task is simply run again.

Defined cases: null, empty and blank texts have no words and no runs; repeated
rows are answered each; a null identifier is an identifier like any other;
an empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import table

#: Shortest run, and the overlap that any run with a lag below it guarantees.
LEAST, SEED = 12, 6

Words = list[bytes]


def _numbered(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal values, and which values occur more than once."""
    _, number, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    return number, counts[number] > 1


def _grams(ids: np.ndarray, at: np.ndarray, number: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the repeated grams that join a gram at ``at`` and the gram ``step`` further on."""
    full = np.full(len(ids) + 1, -1, np.int64)
    full[at] = number
    here = at[at + step < len(ids)]
    nxt = full[here + step]
    here, nxt = here[nxt >= 0], nxt[nxt >= 0]
    got, often = _numbered(full[here] * (len(ids) + 1) + nxt)
    return here[often], got[often]


def _extend(ids: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The matching stretch of the diagonal around place ``i``: places that equal the one ``lag`` further on."""
    end, size, n = i, 32, len(ids) - lag
    while end < n:
        stop = min(end + size, n)
        bad = ids[end:stop] != ids[end + lag:stop + lag]
        if bad.any():
            end += int(bad.argmax())
            break
        end, size = stop, 2 * size
    start, size = i, 32
    while start > 0:
        low = max(start - size, 0)
        bad = (ids[low:start] != ids[low + lag:start + lag])[::-1]
        if bad.any():
            start -= int(bad.argmax())
            break
        start, size = low, 2 * size
    return start, end


def _pairs(at: np.ndarray, number: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of the pairs of a band: lags from ``k`` (from 1 in the first band) below ``2 * k``."""
    order = np.lexsort((at, number))
    pos, gram = at[order], number[order]
    least = 1 if k == SEED else k
    got: list[tuple[np.ndarray, np.ndarray]] = []

    def paired(x: np.ndarray, y: np.ndarray, later: bool) -> None:
        """Pairs of sorted indexes x < y, then those with the next y (``later``) or the x before, and so on."""
        while len(x):
            ok = (x >= 0) & (y < len(pos))
            x, y = x[ok], y[ok]
            ok = (gram[x] == gram[y]) & (pos[y] - pos[x] < 2 * k)
            x, y = x[ok], y[ok]
            far = pos[y] - pos[x] >= least
            got.append(((pos[y] - pos[x])[far], pos[x][far]))
            x, y = (x, y + 1) if later else (x - 1, y)

    index = np.arange(len(pos))
    if k == SEED:  # lags below the seed's length: every occurrence counts as the first of its chain
        paired(index, index + 1, True)
    else:
        first = np.ones(len(pos), bool)
        first[1:] = (gram[1:] != gram[:-1]) | (pos[1:] - pos[:-1] > k // 2)
        starts = np.flatnonzero(first)
        after = np.append(starts[1:], len(pos))  # where the next chain starts
        paired(starts - 1, starts, False)
        paired(starts, after, True)
    if not got:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lag, place = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def runs(words: Words, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of a text as (start, length, period), by start, then period."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    n = len(ids)
    if n < least:
        return []
    one = _numbered(ids)
    at = np.flatnonzero(one[1])
    two = _grams(ids, at, one[0][at], 1)
    four = _grams(ids, *two, 2)
    full = np.full(n + 1, -1, np.int64)
    full[two[0]] = two[1]
    here = four[0][(four[0] + 4 < n)]
    numbers = four[1][(four[0] + 4 < n)]
    nxt = full[here + 4]
    got, often = _numbered(numbers[nxt >= 0] * (n + 1) + nxt[nxt >= 0])
    at, number = here[nxt >= 0][often], got[often]
    found: dict[tuple[int, int], int] = {}
    k = SEED
    while len(at) and 2 * k <= n:
        covered: dict[int, int] = {}
        lags, places = _pairs(at, number, k)
        x = 0
        while x < len(lags):
            lag, i = int(lags[x]), int(places[x])
            if i < covered.get(lag, 0):
                # on to the first place of this lag that isn't covered, or to the next lag
                stop = x + int(np.searchsorted(lags[x:], lag, "right"))
                x += int(np.searchsorted(places[x:stop], covered[lag]))
                continue
            start, end = _extend(ids, i, lag)
            covered[lag] = max(end, i + 1)
            if end - start >= max(least - lag, lag):
                key = start, end + lag
                found[key] = min(lag, found.get(key, lag))
            x += 1
        at, number = _grams(ids, at, number, k)
        k *= 2
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words: Words, found: list[tuple[int, int, int]]) -> Words:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def with_runs(docs: DataFrame, ident: str = "doc_id", text: str = "text",
              rewrite: Callable[[object, Words], Words] | None = None) -> DataFrame:
    """One row per document: identifier, ``n_words``, ``runs`` (start, length, period) and the ``collapsed`` text.

    ``rewrite`` may change the words of a document (given with its identifier) beforehand."""
    src = docs.select(F.col(ident).alias("_id"), F.col(text).cast("binary").alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    run_kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, every, kept = [], [], []
            for i, t in zip(b.column(0), b.column(1), strict=True):
                words = (t.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(i.as_py(), words)
                found = runs(words)
                counts.append(len(words))
                every.append([{"start": a, "length": n, "period": q} for a, n, q in found])
                kept.append(b" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(every, pa.list_(run_kind)),
                 pa.array(kept, pa.binary())], ["_id", "n_words", "runs", "collapsed"])

    got = src.mapInArrow(scan, f"_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                               "collapsed binary")
    return got.select(F.col("_id").alias(ident), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def repeat_tail(ident: object, words: Words) -> Words:
    """The query's rule: of a tenth of the identifiers, the words from some place on repeat a few of them."""
    if ident is None or not words:
        return words
    h, n = zlib.crc32(str(ident).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[:n - a]


def digests(found: DataFrame, ident: str = "doc_id") -> DataFrame:
    """The query's columns of ``with_runs``."""
    first = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("_first", first).select(
        ident, F.size("runs").cast("long").alias("n_runs"), F.col("_first.start").alias("start"),
        (-F.col("_first.less")).alias("length"), F.col("_first.period").alias("period"),
        F.expr("(1000 * -_first.less) DIV _first.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(with_runs(table(spark, sf_dir, "documents"), rewrite=repeat_tail))


_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform("
        "str_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")
#: Seeds of six equal words, their islands on a diagonal, the smallest lag of each stretch of words.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN doc_id IS NULL THEN 1 ELSE {_CRC} END AS h,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
g AS (SELECT *, len(t) AS n, CASE WHEN h % 10 = 0 AND len(t) > 0 THEN (h // 10) % len(t) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
w AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN t
             ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN t[i + 1] ELSE t[a + (i - a) % p + 1] END) END AS w
      FROM p),
s AS (SELECT r, unnest(range(n - {SEED} + 1)) AS i, w FROM w WHERE n >= {LEAST}),
k AS (SELECT r, i, w[i + 1:i + {SEED}] AS gram FROM s),
m AS (SELECT x.r, y.i - x.i AS q, x.i FROM k x JOIN k y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
e AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
f AS (SELECT r, q, min(i) AS start, count(*) + {SEED} - 1 AS same FROM e GROUP BY r, q, island),
u AS (SELECT r, start, same + q AS length, min(q) AS period FROM f WHERE same >= greatest({LEAST} - q, q)
      GROUP BY r, start, same + q),
b AS (SELECT r, count(*) AS n_runs, arg_min(start, (-length, start, period)) AS start,
             max(length) AS length, arg_min(period, (-length, start, period)) AS period,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
      FROM u GROUP BY r),
x AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
c AS (SELECT r, list_sort(list(i)) AS gone FROM x GROUP BY r),
o AS (SELECT w.r, array_to_string(list_transform(list_filter(range(n), lambda i: gone IS NULL OR NOT list_contains(gone, i)),
             lambda i: w[i + 1]), ' ') AS kept FROM w LEFT JOIN c USING (r))
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start,
       CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
       CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256,
       sha256(kept) AS collapsed_sha256
FROM w LEFT JOIN b USING (r) JOIN o USING (r)
"""
