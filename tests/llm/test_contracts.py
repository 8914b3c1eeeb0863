"""The parts of the contracts that SQL can say, and plain forms of training and scoring."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from pitchlake.llm import licenses, quality, secrets
from pitchlake.llm.common import table
from tests.conftest import SF01, SF001
from tests.llm.helpers import docs_of, edge_rows


def duck(sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    return con


def same(rows, want, names):
    return sorted(tuple(r[n] for n in names) for r in rows) == sorted(want)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_base_secrets_match_sql(spark, sf):
    want = duck(sf).sql(r"""SELECT doc_id,
      len(list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1),
                      lambda x: length(x) >= 6)) AS n_assign,
      len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS n_access,
      len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS n_hex
      FROM documents""").fetchall()
    got = secrets.query(spark, sf).collect()
    assert same(got, want, ["doc_id", "n_assign", "n_access", "n_hex"])
    assert sf == SF001 or sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got) > 0


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_base_licences_match_sql(spark, sf):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    places = " UNION ALL ".join(
        f"SELECT r, i, '{label}' AS label FROM w, unnest(range(len(w) - {len(p.split()) - 1})) AS t(i) "
        f"WHERE array_to_string(w[i + 1:i + {len(p.split())}], ' ') = '{p}'" for p, label in phrases.items())
    want = duck(sf).sql(rf"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
      p AS ({places}),
      b AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM p GROUP BY r)
      SELECT doc_id, len(w), coalesce(n, 0), a, z, coalesce(l, '') FROM w LEFT JOIN b USING (r)""").fetchall()
    got = licenses.query(spark, sf).collect()
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    key = lambda rows: sorted(rows, key=str)  # noqa: E731 - nulls
    assert key([tuple(r[n] for n in names) for r in got]) == key([tuple(w) for w in want])
    assert sf == SF001 or sum(r["n_base"] for r in got) > 0


def test_held_out_rows_match_sql(spark):
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(str_split("
           "CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")
    want = duck(SF01).sql(f"SELECT doc_id, {crc} % 5 = 0 FROM documents").fetchall()
    got = quality.query(spark, SF01).collect()
    assert same(got, want, ["doc_id", "held_out"])
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)


def plain_ftrl(rows, epochs):
    """FTRL-proximal by its definition, one coordinate after another."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / (
            (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    order = np.random.default_rng(17)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            x, y = rows[k]
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def values(text):
    """Feature number -> value, the intercept last."""
    counts = Counter(quality.features(text).tolist())
    scale = quality.SCALE / max(sum(counts.values()) / 3, 1.0)
    return {i: c * scale for i, c in counts.items()} | {1 << quality.DIM_BITS: 1.0}


def test_training_and_scores_match_plain_forms(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {r["doc_id"]: int(r["quality"] > 0) for r in labels.collect()
            if r["doc_id"] in text and r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    plain = plain_ftrl([(values(text[i]), rows[i]) for i in sorted(rows, key=str)], quality.EPOCHS)
    trained = quality.train(docs, labels)
    assert {int(i) for i in np.flatnonzero(trained)} == {i for i, w in plain.items() if w}
    assert all(abs(trained[i] - w) < 1e-9 for i, w in plain.items())
    for r in quality.scored(docs, labels).collect():
        dot = sum(plain.get(i, 0.0) * v for i, v in values(text[r["doc_id"]]).items())
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-35.0, min(35.0, dot))))) < 1e-9


def test_scores_of_awkward_rows_match_the_plain_form(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(100, 160)], "doc_id long, quality int")
    docs = docs_of(spark, edge_rows(), clash=True)
    weights = quality.train(docs, labels)
    for r in quality.score(docs.select("doc_id", "text"), weights).collect():
        dot = sum(weights[i] * v for i, v in values(r["text"]).items())
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-35.0, min(35.0, dot))))) < 1e-9
