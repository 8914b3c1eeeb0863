import hashlib
import random
import zlib

import pytest

from pitchlake.llm import periodic
from tests.llm.helpers import docs_of, edge_rows


def brute_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


@pytest.mark.parametrize("symbols", [1, 2, 3, 8, 50])
def test_runs_match_brute_force(symbols):
    rng = random.Random(symbols)
    for _ in range(300):
        w = [b"%d" % rng.randrange(symbols) for _ in range(rng.randrange(140))]
        for _ in range(rng.randrange(4)):
            block = [b"%d" % rng.randrange(symbols) for _ in range(rng.randrange(1, 30))]
            inner = rng.randrange(1, 8)
            if rng.random() < 0.5:  # a block that is periodic itself
                block = (block[:inner] * 30)[:len(block)]
            at = rng.randrange(len(w) + 1)
            w[at:at] = (block * rng.randrange(1, 8))[:rng.randrange(1, 80)]
        assert periodic.runs(w) == brute_runs(w)


def test_a_long_text_of_few_words_is_no_square():
    assert periodic.runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    assert periodic.runs([b"a", b"b"] * 150_000) == [(0, 300_000, 2)]
    once = [b"w%d" % k for k in range(50_000)]
    assert periodic.runs(once) == []
    assert periodic.runs(once * 3) == [(0, 150_000, 50_000)]


def test_collapsed_keeps_the_first_period():
    w = b"x y a b c a b c a b c a b c z".split()
    found = periodic.runs(w)
    assert found == [(2, 12, 3)]
    assert periodic.collapsed(w, found) == b"x y a b c z".split()


def test_query_matches_brute_force_on_awkward_rows(spark):
    rows = edge_rows()
    rows += [(200 + k, "one two three " * 9 + "four " * k, "en", "s", 1) for k in range(40)]
    got = sorted(map(tuple, periodic.digests(periodic.with_runs(
        docs_of(spark, rows, clash=True).repartition(5), rewrite=periodic.repeat_tail)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        n = len(w)
        if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
            g = zlib.crc32(str(doc_id).encode()) // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w) if n < 5000 else periodic.runs(w)
        gone = {i for a, m, q in found for i in range(a + q, a + m)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append((doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                     hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in found).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    assert got == sorted(want, key=str)
    assert sum(r[1] for r in got) > 40


def test_empty_table(spark):
    assert periodic.with_runs(docs_of(spark, [])).count() == 0
