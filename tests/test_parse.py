"""Parsing helpers on random input: exact on well-formed lists, NULL (never an
ANSI error) on junk, missing forms and short lists."""

import random
import struct

from pyspark.sql import functions as F

from pitchlake.functions import parse as PZ


def _f32(x: float) -> float:
    return struct.unpack("f", struct.pack("f", x))[0]


def test_coordinates_random(spark):
    rnd = random.Random(11)
    rows, want = [], []
    for i in range(500):
        kind = rnd.random()
        if kind < 0.6:
            x, y = round(rnd.uniform(0, 120), 1), round(rnd.uniform(0, 80), 1)
            rows.append((i, f"[{x}, {y}]"))
            want.append((_f32(x), _f32(y)))
        elif kind < 0.7:
            x = round(rnd.uniform(0, 120), 1)
            rows.append((i, f"[{x}]"))                 # short list: y is NULL
            want.append((_f32(x), None))
        elif kind < 0.85:
            rows.append((i, rnd.choice(["nan", "None", "", None, "NaN", " nan "])))
            want.append((None, None))
        else:
            junk = "".join(rnd.choice("[],abc. -e+") for _ in range(rnd.randint(0, 8)))
            rows.append((i, junk))
            want.append(None)                           # anything but an error
    df = spark.createDataFrame(rows, "i int, loc string")
    got = {r.i: (r.x, r.y) for r in df.select(
        "i", PZ.coord("loc", 1).alias("x"), PZ.coord("loc", 2).alias("y")).collect()}
    for (i, _), w in zip(rows, want):
        if w is not None:
            assert got[i] == w, (rows[i], got[i], w)
        else:
            x, y = got[i]
            assert x is None or x == x               # parsed number or NULL, never NaN


def test_ints_and_bools_random(spark):
    rnd = random.Random(12)
    vals = [rnd.choice([str(rnd.randint(-5, 5000)), f"{rnd.randint(0, 99)}.0", "x", "", None,
                        "nan"]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(PZ.to_int("s")).collect()]
    for v, o in zip(vals, out):
        if v not in (None, "", "x", "nan"):
            assert o == int(float(v))
        else:
            assert o is None
    flags = spark.createDataFrame([(v,) for v in ["True", "False", "nan", None, "junk"]],
                                  "s string")
    assert [r[0] for r in flags.select(PZ.to_bool_default_false("s")).collect()] == \
        [True, False, False, False, False]
    assert flags.select(F.count("*")).first()[0] == 5
