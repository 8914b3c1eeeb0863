import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import vector_codes
from pitchlake.llm.vector_codes import Orchard

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("size", [1, 3, 100, 1 << 13, 1 << 26])
def test_orchard_matches_brute_force(size):
    rng = np.random.default_rng(size)
    for _ in range(30):
        m, width, n = (int(rng.integers(a, b)) for a, b in ((1, 300), (0, 20), (0, 300)))
        entries, x = rng.integers(-size, size + 1, (m, width)), rng.integers(-size, size + 1, (n, width))
        entries[m // 2] = entries[0]  # a tie goes to the lower index
        best, near = Orchard(entries).search(x)
        every = ((x[:, None, :] - entries[None]) ** 2).sum(2)
        assert (best == every.argmin(1)).all()
        assert (near == every.min(1)).all()


def brute(rows, entries, rounds, parts=4):
    """{(vec_id, label, code, error, label_error)} with all distances in every round."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in good), default=0) // parts) * parts
    ints = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] + [0] * (width - len(r[1])) for r in good]
    step = width // parts
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, good[k][1]))
    first = order[:entries]
    books = [[ints[k][p * step:(p + 1) * step] for k in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p * step:(p + 1) * step], e, strict=True)), i)
                      for i, e in enumerate(books[p])) for p in range(parts)] for v in ints]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for i in range(len(first)):
                own = [ints[k][p * step:(p + 1) * step] for k in range(len(good)) if got[k][p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    got = assign()
    error = [sum(d for d, _ in g) for g in got]
    of = {}
    for r, e in zip(good, error, strict=True):
        of[r[2]] = of.get(r[2], 0) + e
    return sorted(((r[0], r[2], [i for _, i in g], e) for r, g, e in zip(good, got, error, strict=True)), key=str), of, books


def vectors(seed, n=150, width=8):
    rng = random.Random(seed)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(width)], rng.choice([0, 1, 1, 1, None])) for k in range(n)]
    rows += [(1000 + k, list(rows[0][1]), 7) for k in range(60)]  # one common vector
    return [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]


@pytest.mark.parametrize(("entries", "rounds"), [(16, 3), (40, 4), (500, 2)])
def test_codes_match_brute_force(spark, entries, rounds):
    rows = vectors(entries)
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("_id", "v", "codes", "error")})
    got, books = vector_codes.coded(df.repartition(5), entries=entries, rounds=rounds)
    want, _, want_books = brute(rows, entries, rounds)
    assert sorted(((r["_id"], r["_label"], r["codes"], r["error"]) for r in got.collect()), key=str) == want
    assert books.tolist() == want_books


def test_awkward_vectors(spark):
    rows = vectors(3, 40) + [(5, [0.5] * 8, 1), (5, [0.5] * 8, 1), (6, None, 1), (7, [None] + [0.1] * 7, 1),
                             (8, [math.nan] * 8, 1), (9, [math.inf] * 8, 1), (None, [0.25] * 8, None), (10, [0.1] * 5, 1),
                             (11, [], 2), (12, [3e38] * 8, 9)]
    got, _ = vector_codes.coded(spark.createDataFrame(rows, VECTORS), entries=1000, rounds=2)
    found = got.collect()
    assert len(found) == len(rows) - 4
    assert all(r["error"] == 0 for r in found)  # every kept vector is an entry
    ragged = [(k, [0.1 * k] * (k % 7), k % 2) for k in range(30)]
    got, _ = vector_codes.coded(spark.createDataFrame(ragged, VECTORS), entries=5, rounds=2)
    want, _, _ = brute([(i, [float(np.float32(x)) for x in v], y) for i, v, y in ragged], 5, 2)
    assert sorted(((r["_id"], r["_label"], r["codes"], r["error"]) for r in got.collect()), key=str) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert vector_codes.coded(none)[0].count() == 0
    only_empty = spark.createDataFrame([(1, [], 1), (2, [], None)], VECTORS)
    assert [r["error"] for r in vector_codes.coded(only_empty)[0].collect()] == [0, 0]
