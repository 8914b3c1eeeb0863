"""Vector code compression: product quantisation with Orchard's nearest-entry search.

Components become integers ``floor(SCALE * x)``; a vector is cut into ``PARTS``
equal parts, each with a codebook of its own. The codebooks start with the parts
of the ``ENTRIES`` smallest identifiers and are refined in ``ROUNDS`` rounds:
every part is assigned to its nearest entry, then each entry becomes the floor of
its parts' mean. At the end the parts are assigned once more.

Nearest entries are found by Orchard's search. Every entry has a list of all
entries sorted by their distance to it. A query walks along the list of its best
entry so far. A nearer entry becomes the best one and its list is walked next
(equally near ones only take over with a lower index). Visited entries are marked
and not computed again. Past entries beyond twice the query's current distance
the walk stops: by the triangle inequality none of them is as near. All
distances are exact integers. The queries of a batch walk together, ``STEP`` list
places at a time, from the nearest of ``GUESSES`` entries.

The kept vectors are written once, as integers. A round is one pass over them:
each task sums its parts per entry, Spark adds up as many sums of a task as the
codebooks have components, and the driver holds the codebooks alone, whose size
does not depend on the table. Label sums are a partial aggregate, joined back by label.

Defined cases: rows whose vector is null or holds a null, NaN or infinite
component are dropped; shorter vectors count as filled up with zeros to the
longest one's length, and that to a multiple of ``PARTS``; integers are cut
to the size at which errors still fit a long (2 ** 26 for 64 components); null identifiers come after all
others in the choice of entries; rows with the same identifier are ordered by
their vector; with fewer rows than ``ENTRIES`` the codebooks have as many entries
as rows; null labels belong together; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import table, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: List places that are walked at a time.
STEP = 16
#: Entries of which the nearest is where a walk starts; rows that a task searches at a time.
GUESSES, BATCH = 16, 4096
#: Below this size sums of products are exact in doubles, and matrix products may be used; larger than any distance.
_EXACT, _NEVER = 1 << 50, np.iinfo(np.int64).max


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact."""
    width = max(x.shape[1], 1)
    if max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0))) ** 2 * width < _EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return np.rint((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k, None] - entries[None, :, k]) ** 2
    return out


class Orchard:
    """Nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray) -> None:
        m = len(entries)
        gaps = _distances(entries, entries)
        order = np.argsort(gaps, axis=1, kind="stable")
        # the lists end with places that no walk reaches
        self.lists = np.concatenate([order, np.zeros((m, STEP), np.int64)], axis=1)
        self.gaps = np.concatenate([np.take_along_axis(gaps, order, axis=1), np.full((m, STEP), _NEVER)], axis=1)
        self.entries, self.largest = entries, int(np.abs(entries).max(initial=0))
        self.as_float, self.squares = entries.astype(np.float64), (entries * entries).sum(1)

    def _to(self, x: np.ndarray, some: np.ndarray, exact: bool) -> np.ndarray:
        """Squared distances of each row to its own candidates."""
        if not exact:
            return ((x[:, None, :] - self.entries[some]) ** 2).sum(axis=2)
        dots = np.matmul(self.as_float[some], x.astype(np.float64)[:, :, None])[:, :, 0]
        return (x * x).sum(1)[:, None] + self.squares[some] - 2 * np.rint(dots).astype(np.int64)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lowest one, if several are as near) and its squared distance."""
        n, m = len(x), len(self.entries)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        exact = max(int(np.abs(x).max(initial=0)), self.largest) ** 2 * max(x.shape[1], 1) < _EXACT
        guess = np.arange(0, m, -(-m // GUESSES))  # the walks start at the nearest of a few entries
        d = self._to(x, np.broadcast_to(guess, (n, len(guess))), exact)
        best, near = guess[d.argmin(axis=1)], d.min(axis=1)
        visited = np.zeros((n, m), bool)
        visited[:, guess] = True
        walk, place = best.copy(), np.zeros(n, np.int64)  # whose list is walked, and how far
        rows = np.arange(n)
        while len(rows):
            spots = place[rows, None] + np.arange(STEP)
            some, gaps = self.lists[walk[rows, None], spots], self.gaps[walk[rows, None], spots]
            wanted = (gaps <= 4 * near[rows, None]) & ~visited[rows[:, None], some]
            ask = wanted.any(axis=1)
            asked, some, wanted = rows[ask], some[ask], wanted[ask]
            place[rows] += STEP
            d = np.where(wanted, self._to(x[asked], some, exact), _NEVER)
            r, c = np.nonzero(wanted)
            visited[asked[r], some[r, c]] = True
            least = d.min(axis=1, initial=_NEVER)
            index = np.where(d == least[:, None], some, m).min(axis=1, initial=m)
            nearer = least < near[asked]
            better = nearer | ((least == near[asked]) & (index < best[asked]))
            best[asked[better]], near[asked[better]] = index[better], least[better]
            walk[asked[nearer]], place[asked[nearer]] = index[nearer], 0  # on to that entry's list
            rows = rows[self.gaps[walk[rows], place[rows]] <= 4 * near[rows]]
        return best, near


def _usable(col: str) -> F.Column:
    return F.col(col).isNotNull() & F.forall(
        col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def _integers(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with a usable vector, as integers in the column ``v``."""
    ints = F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-1e15), F.least(F.lit(1e15), x.cast("double"))) * SCALE).cast("long"))
    return rows.filter(_usable(vector)).withColumn("v", ints).drop(vector)


def _limit(width: int) -> int:
    """Components up to this size have squared distances that four times fit a long."""
    return 1 << (59 - width.bit_length()) // 2


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The integer vectors of a batch as rows of the same width, filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return np.clip(out, -_limit(width), _limit(width))


def _searched(column: pa.Array, searches: list[Orchard], width: int) -> Iterator[tuple[int, np.ndarray, list]]:
    """For blocks of a batch: where it starts, its vectors, (entry, squared distance) of each part."""
    step = width // len(searches)
    for at in range(0, len(column), BATCH):
        x = _matrix(column.slice(at, BATCH), width)
        yield at, x, [s.search(x[:, k * step:(k + 1) * step]) for k, s in enumerate(searches)]


def _refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floors of the means, unused entries as before."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    parts, entries, step = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in shared.value]
        total, count = np.zeros((parts, entries, step), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, x, got in _searched(b.column("v"), searches, parts * step):
                for k, (best, _) in enumerate(got):
                    np.add.at(total[k], best, x[:, k * step:(k + 1) * step])
                    count[k] += np.bincount(best, minlength=entries)
        cells, places = np.divmod(np.flatnonzero(np.repeat(count, max(step, 1))), max(step, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(places, pa.int32()), pa.array(count.ravel()[cells], pa.int64()),
             pa.array(total.reshape(parts * entries, step)[cells, places] if step else places, pa.int64())],
            ["cell", "place", "n", "total"])

    each = vectors.select("v").mapInArrow(sums, "cell int, place int, n long, total long")
    out = books.reshape(parts * entries, step).copy()
    if step:
        for r in each.groupBy("cell", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            out[r["cell"], r["place"]] = r["total"] // r["n"]
    shared.unpersist()
    return out.reshape(books.shape)


def codebooks(vectors: DataFrame, ident: str, parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS) -> np.ndarray:
    """The trained codebooks (part, entry, component) of the integer vectors ``v``."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    step = -(-longest // parts)
    first = vectors.select(ident, "v").orderBy(F.col(ident).asc_nulls_last(), "v").limit(entries).collect()
    books = np.zeros((parts, len(first), step), np.int64)
    for e, r in enumerate(first):
        v = np.zeros(parts * step, np.int64)
        v[:len(r["v"])] = r["v"]
        books[:, e] = np.clip(v, -_limit(len(v)), _limit(len(v))).reshape(parts, step)
    for _ in range(rounds if len(first) else 0):
        books = _refined(vectors, books)
    return books


def coded(rows: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label",
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The kept rows (``_id``, ``_label``) with ``codes`` and ``error``, and the codebooks."""
    vectors = written(_integers(rows.select(F.col(ident).alias("_id"), F.col(label).alias("_label"),
                                            F.col(vector).alias("_vector")), "_vector"), "vectors")
    books = codebooks(vectors, "_id", parts, entries, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in shared.value]
        for b in batches:
            for at, _, got in _searched(b.column("v"), searches, books_width):
                codes = np.stack([best for best, _ in got], axis=1)
                error = sum(near for _, near in got)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(at, BATCH), b.column("_label").slice(at, BATCH),
                     pa.array(list(codes), pa.list_(pa.int64())), pa.array(error, pa.int64())],
                    ["_id", "_label", "codes", "error"])

    books_width = books.shape[0] * books.shape[2]
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    got = vectors.mapInArrow(scan, f"_id {kinds['_id']}, _label {kinds['_label']}, codes array<long>, error long")
    return written(got, "codes"), books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, books = coded(table(spark, sf_dir, "embeddings"))
    sums = got.groupBy("_label").agg(F.sum("error").alias("label_error"))
    said = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return got.join(sums.withColumnRenamed("_label", "_of"), F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(said).alias("codebooks_sha256"))


def _oracle() -> str:
    """All distances in every round."""
    width = f"(SELECT max(len(v)) // {PARTS} FROM kept)"
    sql = f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS k,
                     list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT k, p, v[p * {width} + 1:(p + 1) * {width}] AS v FROM kept, range({PARTS}) AS t(p)),
b0 AS (SELECT p, k AS e, v FROM x WHERE k < {ENTRIES})"""
    near = """SELECT x.k, x.p, x.v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT x.k, x.p, x.v, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM x JOIN {b} b ON x.p = b.p) x GROUP BY x.k, x.p, x.v"""
    for r in range(ROUNDS):
        sql += f""",
a{r} AS ({near.format(b=f"b{r}")}),
m{r} AS (SELECT p, e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS c
         FROM a{r}, range(1, {width} + 1) AS t(i) GROUP BY p, e, i),
n{r} AS (SELECT p, e, list(c ORDER BY i) AS v FROM m{r} GROUP BY p, e),
b{r + 1} AS (SELECT p, e, coalesce(n.v, b.v) AS v FROM b{r} b LEFT JOIN n{r} n USING (p, e))"""
    return sql + f""",
f AS ({near.format(b=f"b{ROUNDS}")}),
s AS (SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY k),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS said FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, said AS codebooks_sha256
FROM s JOIN kept USING (k), h
"""


ORACLE = _oracle()
