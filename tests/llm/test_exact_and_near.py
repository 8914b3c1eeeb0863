import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from pitchlake.llm import exact_dedup, simhash
from pitchlake.llm.components import components
from tests.llm.helpers import docs_of, edge_rows, words


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups_match_brute_force(spark, keep):
    rows = edge_rows()
    got = exact_dedup.exact_groups(docs_of(spark, rows).repartition(7), keep=keep).collect()
    groups: dict[str, list] = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    best = max if keep == "largest" else min
    want, seen = Counter(), set()
    for r in rows:
        ids = groups[r[1] or ""]
        real = [i for i in ids if i is not None]
        win = best(real) if real else None
        first = r[0] == win and (r[1] or "") not in seen
        if first:
            seen.add(r[1] or "")
        want[(r[0], win, len(ids), first, hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(x) for x in got) == want


def test_tree_has_the_same_result_for_any_runs_and_fan_in(spark):
    rows = docs_of(spark, edge_rows()).repartition(13)
    digests = exact_dedup.with_digest(rows.selectExpr("doc_id AS _id", "text AS _text"), "_text").selectExpr(
        "_id", "_sha", "_len", "_x64", "1 AS _copies")
    one = sorted(map(str, exact_dedup.merge_runs(digests, runs=1, fan_in=2).collect()))
    assert one == [] or one  # a single run is its own result only after a round
    small = sorted(map(str, exact_dedup.merge_runs(digests, runs=16, fan_in=2).collect()))
    large = sorted(map(str, exact_dedup.merge_runs(digests).collect()))
    assert small == large


def test_drop_copies_keeps_whole_rows_once_per_text(spark):
    rows = edge_rows()
    docs = docs_of(spark, rows, clash=True)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(r["text"] or "" for r in got) == sorted({r[1] or "" for r in rows})
    assert {r["doc_id"] for r in got if r["text"] == rows[0][1]} == {2}
    assert all(r["_key"] == "x" for r in got)


def test_empty_tables(spark):
    empty = docs_of(spark, [])
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert simhash.classes(empty).count() == 0
    assert simhash.keep_one(empty).columns == empty.columns


def brute_fingerprint(text: str) -> int:
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    sh = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps: list[int], ids: list) -> list:
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low: dict[int, object] = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None and (low.get(r) is None or x < low[r]):
            low[r] = x
    return [low.get(find(i)) for i in range(len(ids))]


def near_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = edge_rows(seed)
    base = [words(rng, 400).split() for _ in range(6)]
    for k in range(90):  # chains of small edits, so that components are wider than one link
        ws = list(base[k % 6])
        for _ in range(rng.randrange(4)):
            ws[rng.randrange(len(ws))] = f"x{rng.randrange(99)}"
        base[k % 6] = ws if rng.random() < 0.4 else base[k % 6]
        rows.append((1000 + k, " ".join(ws), "en", "s", 1))
    return rows


def test_simhash_matches_brute_force(spark):
    rows = near_rows(3)
    got = simhash.classes(docs_of(spark, rows, clash=True)).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components(fps, [r[0] for r in rows])
    want = Counter((r[0], f, c) for r, f, c in zip(rows, fps, comp, strict=True))
    assert Counter((r["_id"], r["_fp"] & (1 << 64) - 1, r["_component"]) for r in got) == want
    assert len(set(comp)) < len(set(fps))  # some fingerprints were linked


def test_keep_one_keeps_one_row_of_each_class(spark):
    rows = near_rows(4)
    docs = docs_of(spark, rows, clash=True)
    kept = simhash.keep_one(docs).collect()
    comp = brute_components([brute_fingerprint(r[1]) for r in rows], [r[0] for r in rows])
    assert sorted(map(str, (r["doc_id"] for r in kept))) == sorted(map(str, set(comp)))


@pytest.mark.parametrize("plan", [
    simhash.Plan((tuple(range(32)), tuple(range(32, 64))), (1, 1)),
    simhash.Plan((tuple(range(32)), tuple(range(32, 64))), (-1, 3)),
    simhash.Plan((tuple(range(0, 22)), tuple(range(22, 43)), tuple(range(43, 64))), (-1, 1, 1)),
    simhash.Plan(tuple(tuple(range(k, 64, 4)) for k in range(4)), (0, 0, 0, 0)),
    simhash.Plan(tuple(tuple(range(k, 64, 4)) for k in range(4)), (-1, 1, 0, 0)),
    simhash.Plan(tuple(tuple(range(k, 64, 5)) for k in range(5)), (0, -1, 0, 0, 0)),
])
def test_any_plan_finds_every_link(spark, plan):
    if plan.thresholds == (-1, 3):
        plan = simhash.Plan((tuple(range(8, 64)), tuple(range(8))), (-1, 3))  # few probes
    assert sum(plan.thresholds) == 3 - len(plan.parts) + 1
    rng = np.random.default_rng(9)
    base = rng.integers(-2**63, 2**63 - 1, 30)
    fps = set(base.tolist()) | {0, -1}
    for b in base.tolist() + [0, -1]:
        for _ in range(6):
            m = 0
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                m ^= 1 << int(bit)
            fps.add(int(np.uint64(b % 2**64 ^ m).astype(np.int64)))
    fps = sorted(fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & 2**64 - 1).bit_count() <= 3}
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "_fp long"), plan).collect()
    assert {tuple(r) for r in got} == want and want


def test_plan_thresholds_add_up():
    rng = np.random.default_rng(2)
    for n in (10, 10**5, 10**10):
        for sample in (np.zeros(0, np.int64), rng.integers(-2**63, 2**63 - 1, 300), np.array([5])):
            p = simhash.make_plan(sample, n)
            assert sorted(b for part in p.parts for b in part) == list(range(64))
            assert sum(p.thresholds) == 3 - len(p.parts) + 1 and min(p.thresholds) >= -1


def test_components_on_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(5).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {k: 200 for k in (200, 201, 202)}
