import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pitchlake.llm import passage_dedup
from tests.llm.helpers import docs_of, edge_rows, words


def brute(rows, span):
    """(identifier, n_words, n_removed, kept text) of each row."""
    low, out = {}, []
    key = lambda i: (i is None, i)
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, w in split:
        for a in range(len(w) - span + 1):
            s = tuple(w[a:a + span])
            low[s] = min(low.get(s, key(i)), key(i))
    for i, w in split:
        gone = set()
        for a in range(len(w) - span + 1):
            if low[tuple(w[a:a + span])] < key(i):
                gone.update(range(a, a + span))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def shared_rows(seed, n=60):
    """Documents around shared passages (one in a third of them), nested repeats, copies and null identifiers."""
    rng = random.Random(seed)
    passages = [words(rng, rng.randrange(5, 25), 9) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = [words(rng, rng.randrange(0, 12), 9)]
        for _ in range(rng.randrange(4)):
            parts += [passages[0] if rng.random() < 0.4 else rng.choice(passages), words(rng, rng.randrange(0, 6), 9)]
        rows.append((rng.choice([k, k, k, None, 3]), rng.choice([" ", "  ", "\n"]).join(parts), "en", "s", k))
    return rows + rows[:5]


@pytest.mark.parametrize("how", [{"lengths": (4, 6), "group_rows": 10_000}, {"lengths": (3, 4, 5, 6), "group_rows": 3},
                                 {"lengths": (6,), "group_rows": 1}])
def test_small_windows_match_brute_force(spark, how):
    rows = shared_rows(len(how["lengths"]))
    docs = docs_of(spark, rows, clash=True).repartition(7)
    got = passage_dedup.removed(docs, span=6, gram=3, **how).select("doc_id", "n_words", "n_removed", "kept").collect()
    want = brute(rows, 6)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(w[2] for w in want) > 200


def test_awkward_rows_match_brute_force(spark):
    rng = random.Random(4)
    passage = words(rng, 70)
    rows = edge_rows() + [(300 + k, words(rng, rng.randrange(30)) + " " + passage + " " + words(rng, rng.randrange(30)),
                           "en", "s", 1) for k in range(25)]
    got = passage_dedup.removed(docs_of(spark, rows, clash=True)).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, passage_dedup.SPAN)


def test_text_identifiers_and_spans(spark):
    rows = shared_rows(9)
    docs = docs_of(spark, rows).withColumn("doc_id", F.format_string("d%03d", "doc_id")).filter("doc_id <> 'dnull'")
    got = passage_dedup.removed(docs, span=6, gram=3, lengths=(4, 6), group_rows=9).collect()
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 6)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == want
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_tree_nodes_are_all_repeated_prefixes():
    rng = random.Random(2)
    for _ in range(50):
        rows = [tuple(b"%d" % rng.randrange(3) for _ in range(6)) for _ in range(rng.randrange(1, 30))]
        texts = [b" ".join(r) + b" " for r in rows]
        want = {}
        for d in range(1, 7):
            for p in {r[:d] for r in rows}:
                below = tuple(i for i, r in enumerate(rows) if r[:d] == p)
                if len(below) > 1:
                    want[below] = d  # the deepest shared prefix names the node
        assert {(d, tuple(sorted(x))) for d, x in passage_dedup.suffix_tree(texts)} == {(d, b) for b, d in want.items()}
        deep = {(d, tuple(sorted(x))) for d, x in passage_dedup.suffix_tree(texts, 6)}
        assert deep == {(d, b) for b, d in want.items() if d == 6}


def test_empty_table(spark):
    assert passage_dedup.removed(docs_of(spark, [])).count() == 0


def test_digest_of_the_kept_words(spark):
    rows = [(1, words(random.Random(1), 60), "en", "s", 1), (2, words(random.Random(1), 60) + " more", "en", "s", 1)]
    got = {r["doc_id"]: r for r in passage_dedup.removed(docs_of(spark, rows)).collect()}
    assert (got[1]["n_removed"], got[2]["kept"]) == (0, "more")
    assert hashlib.sha256(got[1]["kept"].encode()).hexdigest() == hashlib.sha256(rows[0][1].encode()).hexdigest()
