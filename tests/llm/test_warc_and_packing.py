import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import packing, warc
from tests.llm.helpers import docs_of, edge_rows

REC = ("record_id long, url string, ts long, kind string, etag string, last_modified string, digest string, "
       "headers map<string,string>, bucket string")


@pytest.mark.parametrize("url,want", [
    ("HTTPS://User@Example.COM:443/a/b/?utm_source=x&b=2&a=1#top", "http://example.com/a/b?a=1&b=2"),
    ("http://example.com", "http://example.com"), ("http://example.com/", "http://example.com"),
    ("http://example.com/x/index.html", "http://example.com/x"), ("http://example.com:8080/x?", "http://example.com:8080/x"),
    ("https://example.com/A?reference=1&ref=2", "http://example.com/A?reference=1")])
def test_canonical_url(spark, url, want):
    got = spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0]
    assert got == want


def records(seed: int, n: int = 400) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        url = "http://hot.example/x" if rng.random() < 0.4 else f"http://h{rng.randrange(9)}.example/{rng.randrange(4)}"
        full = rng.random() < 0.5
        out.append((k, rng.choice([None, url, url.upper().replace("HTTP:", "https:").replace("/X", "/x"), url + "#f", url])
                    if rng.random() < 0.9 else url,
                    rng.choice([None] + [rng.randrange(60)] * 20), "response" if full else "revisit",
                    rng.choice([None, "e1", "e2", "W/e1"]), rng.choice([None, "m1", "m2"]),
                    rng.choice([None, "d1", "d2"]),
                    rng.choice([None, {"Date": str(k), "ETag": "e", "X-Own": "1", "Content-Length": "5"}]), "clash"))
    return out


def brute(rows: list[tuple], canon: dict) -> dict:
    out = {}
    weak = lambda e: e[2:] if e and e.startswith("W/") else e
    for r in rows:
        if r[3] != "revisit":
            continue
        best = None
        for f in rows:
            if (f[3] == "response" and r[1] is not None and f[1] is not None and canon[f[1]] == canon[r[1]]
                    and f[2] is not None and r[2] is not None and f[2] < r[2]
                    and (best is None or (f[2], f[0]) > (best[2], best[0]))):
                best = f
        status, headers = "no_response", None
        if best:
            status = "unverified"
            for a, b in ((weak(best[4]), weak(r[4])), (best[5], r[5]), (best[6], r[6])):
                if a is not None and b is not None:
                    status = "resolved" if a == b else "mismatch"
                    break
            if status == "resolved":
                new = {k: v for k, v in (r[7] or {}).items() if k.lower() in warc.PERMITTED}
                headers = {k: v for k, v in (best[7] or {}).items() if k.lower() not in {x.lower() for x in new}} | new
        out[r[0]] = (status, best[0] if best else None, headers)
    return out


@pytest.mark.parametrize("buckets", [1, 8, 256])
def test_revisits_match_brute_force(spark, buckets):
    rows = records(buckets)
    df = spark.createDataFrame(rows, REC)
    canon = {r[0]: r[1] for r in df.filter("url IS NOT NULL").select("url", warc.canonical_url(F.col("url"))).distinct().collect()}
    got = warc.resolve(df, buckets).collect()
    want = brute(rows, canon)
    assert {r["record_id"]: (r["status"], r["response_id"], r["headers"]) for r in got} == want
    assert len(got) == len(want) and {"resolved", "mismatch", "unverified", "no_response"} <= {w[0] for w in want.values()}
    assert all((r["digest"] is not None) <= (r["status"] == "resolved") for r in got)


def test_revisits_repeated_rows_and_empty(spark):
    rows = records(5, 60)
    df = spark.createDataFrame(rows + rows, REC)
    once = warc.resolve(spark.createDataFrame(rows, REC)).collect()
    twice = warc.resolve(df).collect()
    assert Counter(map(str, twice)) == Counter({str(r): 2 for r in once})
    assert warc.resolve(df.limit(0)).count() == 0


def brute_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fit = [(b["left"], k) for k, b in enumerate(bins)
               if b["left"] >= n and (s < 0 or s not in b["s"]) and (c < 0 or c not in b["c"])]
        if fit:
            left = min(fit)[0]
            out.append(left - n)
            k = min(fit)[1]
        else:
            bins.append({"left": capacity, "s": set(), "c": set()})
            k = len(bins) - 1
            out.append(capacity - n)
        bins[k]["left"] -= n
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
    return out, len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = np.random.default_rng(seed)
    n, cap = 500, 1000
    lengths = np.sort(rng.integers(0, cap + 1, n))[::-1]
    sources = np.where(rng.random(n) < 0.3, 0, rng.integers(-1, 150, n))
    clusters = rng.integers(-1, 90, n)
    got = packing.best_fit(lengths, sources, clusters, cap)
    left = defaultdict(lambda: cap)
    held: dict[int, tuple[set, set]] = defaultdict(lambda: (set(), set()))
    for k in range(n):
        b, s, c = int(got[k]), int(sources[k]), int(clusters[k])
        fit = [left[j] for j in held if left[j] >= lengths[k] and (s < 0 or s not in held[j][0])
               and (c < 0 or c not in held[j][1])]
        assert left[b] == (min(fit) if fit else cap) and (b in held) == bool(fit)
        assert left[b] >= lengths[k] and (s < 0 or s not in held[b][0]) and (c < 0 or c not in held[b][1])
        left[b] -= int(lengths[k])
        held[b][0].add(s)
        held[b][1].add(c)


@pytest.mark.parametrize("bins_per_shard", [256, 3])
def test_pack_round_trip_and_constraints(spark, bins_per_shard):
    rows = edge_rows()
    got = packing.pack(docs_of(spark, rows, clash=True), bins_per_shard=bins_per_shard).collect()
    source = {r[0]: r[3] for r in rows}
    cluster = {r[0]: " ".join((r[1] or "").lower().split()) for r in rows}
    text = {r[0]: r[1] or "" for r in rows}
    copies = Counter(r[0] for r in rows)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["bin_id"]].append(r)
    assert set(pieces) == set(copies)
    for d, ps in pieces.items():
        if d is None:
            continue
        for k in range(copies[d]):
            own = sorted(ps, key=lambda r: r["piece"])[k::copies[d]]
            assert "".join(text[d][r["start"]:r["start"] + r["length"]] for r in own) == text[d]
    for rs in bins.values():
        assert sum(r["length"] for r in rs) + rs[0]["residual"] == packing.CAPACITY and rs[0]["residual"] >= 0
        assert sorted(r["position"] for r in rs) == list(range(len(rs)))
        named = [source[r["doc_id"]] for r in rs if r["doc_id"] is not None and source[r["doc_id"]]]
        assert len(named) == len(set(named))
        groups = [cluster[r["doc_id"]] for r in rs if r["doc_id"] is not None]
        assert len(groups) == len(set(groups))
    assert packing.pack(docs_of(spark, [])).count() == 0


def test_short_texts_are_dealt_over_shards(spark):
    rows = [(k, ("", None, "a")[k % 3], "en", None, 0) for k in range(5000)]
    got = packing.pack(docs_of(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(5000))
    per_shard = Counter(r["bin_id"] >> 32 for r in got)
    assert set(per_shard) == {0, 1} and max(per_shard.values()) < 3000


@pytest.mark.parametrize("url,want", [
    ("example.com/a", "example.com/a"), (" //host/x?b&a ", "//host/x?b&a"), ("dns:host", "dns:host"),
    ("", None), ("  ", None), (None, None)])
def test_canonical_url_without_scheme(spark, url, want):
    got = spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0]
    assert got == want


def test_urls_without_scheme_match_only_themselves(spark):
    urls = ["example.com/a", "//host/x", "dns:host", "http://host/x"]
    rows = [(k, u, 10, "response", None, "m", f"d{k}", None, "x") for k, u in enumerate(urls)]
    rows.append((9, "", 10, "response", None, "m", "d9", None, "x"))
    asked = [*urls, "example.com/b", "//host/y", "dns:other", "", "  ", None]
    rows += [(20 + k, u, 20, "revisit", None, "m", None, None, "x") for k, u in enumerate(asked)]
    got = {r["record_id"]: (r["status"], r["response_id"], r["digest"]) for r in
           warc.resolve(spark.createDataFrame(rows, REC)).collect()}
    assert got == {20 + k: ("resolved", k, f"d{k}") if k < 4 else ("no_response", None, None) for k in range(len(asked))}
