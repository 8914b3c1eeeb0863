import hashlib
import random

import numpy as np
import pytest

from pitchlake.llm import suffix_dedup as S
from tests.llm.helpers import docs_of, edge_rows, words


def brute(texts: list[str], span: int) -> list[tuple]:
    bodies = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in bodies:
        for i in range(len(b) - span + 1):
            seen[b[i:i + span]] = seen.get(b[i:i + span], 0) + 1
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed: int) -> list[tuple]:
    """Shared passages of all lengths around the span, cut at every side, in texts of their own."""
    rng = random.Random(seed)
    common = words(rng, 400, 5000)
    rows = []
    for k in range(60):
        a = rng.randrange(1200)
        n = rng.randrange(300, 700)
        rows.append((2000 + k, words(rng, rng.randrange(80), 5000) + common[a:a + n] + words(rng, rng.randrange(80), 5000),
                     "en", "s", 1))
    same = common[100:560]  # many texts around one passage: a hot run
    rows += [(3000 + k, words(rng, 30, 5000) + same + words(rng, 30, 5000), "en", "s", 1) for k in range(40)]
    rows += [(4000, "x" * 1500, "en", "s", 1), (4001, "y" * 399, "en", "s", 1), (4002, "ab" * 300, "en", "s", 1)]
    return rows


@pytest.mark.parametrize("rows_per_bucket", [2000, 7])
def test_matches_brute_force(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(S, "BUCKET_ROWS", rows_per_bucket)
    rows = [r for r in edge_rows() if len(r[1] or "") < 20_000] + passages(11)
    got = S.removed(docs_of(spark, rows, clash=True)).collect()
    want = brute([r[1] for r in rows], S.SPAN)
    assert sorted(map(str, ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got))) \
        == sorted(map(str, ((r[0], *w) for r, w in zip(rows, want, strict=True))))
    assert sum(w[1] for w in want) > 10_000


def test_buckets_follow_the_suffixes_beyond_a_few(spark, monkeypatch):
    monkeypatch.setattr(S, "FEW_BUCKETS", 1)
    monkeypatch.setattr(S, "MOST_ROWS", 5)
    seen = []
    splitters = S._splitters
    monkeypatch.setattr(S, "_splitters", lambda *a: seen.append(splitters(*a)) or seen[-1])
    rows = passages(14)
    got = S.removed(docs_of(spark, rows)).collect()
    want = brute([r[1] for r in rows], S.SPAN)
    assert sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got) \
        == sorted((r[0], w[1], w[3]) for r, w in zip(rows, want, strict=True))
    assert len(seen[0]) > 10


def test_spans_are_what_was_removed(spark):
    rows = passages(12)
    texts = {r[0]: r[1].encode() for r in rows}
    for r in S.removed(docs_of(spark, rows)).collect():
        b, at, kept = texts[r["doc_id"]], 0, b""
        for s in r["spans"]:
            kept, at = kept + b[at:s["start"]], s["end"]
        assert hashlib.sha256(kept + b[at:]).hexdigest() == r["kept_sha256"]


def test_long_texts_and_empty_table(spark):
    rng = random.Random(3)
    long = words(rng, 30_000, 10**6)
    got = S.removed(docs_of(spark, [(1, long, "en", "s", 1), (2, long[5000:90_000], "en", "s", 1)])).collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in got} == {1: (85_000, 1), 2: (85_000, 1)}
    assert S.removed(docs_of(spark, [])).count() == 0


def test_multikey_quicksort_sorts():
    rng = np.random.default_rng(4)
    for n, values in ((0, 3), (1, 3), (500, 3), (500, 10**9)):
        m = rng.integers(0, values, (n, 6)).astype(np.uint64)
        assert [tuple(x) for x in m[S.multikey_quicksort(m)]] == sorted(tuple(x) for x in m)


def test_equal_windows_have_the_same_anchor():
    rng = random.Random(6)
    inner = words(rng, 200).encode()
    a, b = b"left part " + inner, b"another beginning of it " + inner + b" end"
    places = []
    for t in (a, b):
        found = S.anchors(np.frombuffer(t, np.uint8))
        at = np.empty(len(t) - S.SPAN + 1, np.int64)
        for x, lo, hi in zip(found["at"], found["lo"], found["hi"], strict=True):
            at[lo:hi + 1] = x
        places.append(at)
    da, db = len(b"left part "), len(b"another beginning of it ")
    n = len(inner) - S.SPAN + 1
    assert (places[0][da:da + n] - da == places[1][db:db + n] - db).all()
