import itertools
import random
import re
import zlib

import numpy as np

from pitchlake.llm import html_extract as H
from pitchlake.llm import quality
from pitchlake.llm.common import table
from tests.conftest import SF01
from tests.llm.helpers import docs_of, edge_rows


def test_quality_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    got = {r["doc_id"]: r for r in quality.scored(docs, labels).collect()}
    assert len(got) == docs.count()
    right = n = 0
    for r in labels.collect():
        held = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert got[r["doc_id"]]["held_out"] == held
        if held:
            n, right = n + 1, right + (got[r["doc_id"]]["predicted"] == r["quality"])
    assert n > 40 and right / n > 0.95


def test_quality_ignores_held_out_labels_and_is_repeatable(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    a = quality.train(docs.repartition(5), labels)
    assert np.array_equal(a, quality.train(docs, flipped))


def test_quality_edge_rows(spark):
    rows = edge_rows()
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0), (99999, 1, 0), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = quality.scored(docs_of(spark, rows, clash=True), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.scored(docs_of(spark, rows), labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.scored(docs_of(spark, []), labels).count() == 0
    docs = docs_of(spark, rows, clash=True)
    assert quality.keep_good(docs, labels.filter("false")).columns == docs.columns


def test_training_takes_one_row_an_identifier(spark, monkeypatch):
    rows = [(1, f"copy {k}", "en", "s", 1) for k in range(200)] + [(k, f"text {k}", "en", "s", 1) for k in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 40)], "doc_id long, quality int, toxic int")
    got = []
    monkeypatch.setattr(quality, "ftrl", lambda r, **_: got.append(r))
    quality.train(docs_of(spark, rows), labels)
    assert len(got[0]) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(1, 40))
    quality.train(docs_of(spark, rows[::-1]).repartition(7), labels)
    assert [[list(map(float, x)) for x in r[:2]] for r in got[0]] == [[list(map(float, x)) for x in r[:2]] for r in got[1]]
    pages = [(1, f"<article><p>copy {k}</p></article>") for k in range(50)] + [(1, "<p>no main</p>")]
    pages += [(k, f"<main><p>text {k}</p></main>") for k in range(2, 6)]
    monkeypatch.setattr(H, "fit", lambda data: got.append(data))
    H.train(spark.createDataFrame(pages, "page_id long, html string"))
    assert len(got[2]) == 3 * 5  # every page and two altered copies


def test_training_pages_are_read_whole(spark, monkeypatch):
    long = "<article>" + "<p>word</p>" * 5999 + "</article><footer>end</footer>"
    mark = "<article><p>" + "a " * 600 + "© " + "b " * 600 + "</p></article>"
    got = []
    monkeypatch.setattr(H, "fit", lambda data: got.append(data))
    H.train(spark.createDataFrame([(1, long), (2, mark)], "page_id long, html string"))
    pages = sorted((obs for obs, _ in got[0][::3]), key=len)
    assert [len(p) for p in pages] == [1, 6000] and "copyright" in pages[0][0]
    assert "last" not in pages[1][4999] and {"last", "in:footer"} <= set(pages[1][5999])
    # pages within the bound come first; a longer one only if there is room for the whole of it
    rows = [(k, "<main>" + f"<p>word {k}</p>" * (3 if k % 2 else 40) + "</main>") for k in range(10)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    for most, want in ((10, [3]), (20, [3, 40])):
        H.train(df, max_pages=10, max_blocks=most)
        assert sorted({len(obs) for obs, _ in got[-1][::3]}) == want
    H.train(df.filter("page_id % 2 = 0"), max_pages=2, max_blocks=5)
    assert [len(obs) for obs, _ in got[-1][::3]] == [40]


PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>'
        '<nav><ul><li><a href="/a">A</a></li></ul></nav><div class="{main}"><h1>Head &amp; line</h1>'
        '<p>Hello <b>wor</b>ld, a paragraph of the article.<br>Next line.<p>Another one with words in it.'
        '<aside>note in a box</aside><script>var t="</p>";</script></div><section class="comments"><p>Nice one.</p>'
        '</section><form><label>Name</label></form><div id="cookie-notice">We use cookies.</div><footer>&copy; x</footer>')
MAIN = "Head & line Hello world, a paragraph of the article. Next line. Another one with words in it."


def trained(spark):
    return H.train(table(spark, SF01, "pages"))


def truth(page: str) -> str:
    import html
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    t = re.sub(r"<[^>]*$", "", m.group(1)) if m else ""
    t = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", t))
    return " ".join(html.unescape(t).split())


def test_extraction_on_pages_not_trained_on(spark):
    pages = table(spark, SF01, "pages")
    crf = H.train(pages, max_pages=60)
    got = {r["page_id"]: r for r in H.extracted(pages, crf).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == truth(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(truth(r["html"]))


def test_extraction_of_other_layouts(spark):
    crf = trained(spark)
    for name in ("content", "article-body", "post", "plain"):
        assert H.main_text(PAGE.replace("{main}", name), crf, {}) == MAIN
    assert H.main_text(PAGE.replace('<div class="{main}">', "<main>").replace("</div><section", "</main><section"),
                       crf, {}) == MAIN


def test_extraction_edge_pages(spark):
    crf = trained(spark)
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (None, None, "<p", "x"), (3, "u", "text only & more", "x"),
            (3, "u", "text only & more", "x"), (4, "u", "<article>" + "<p>word " * 20_000, "x"),
            (5, "u", "<article><p>a < b &lt; c &#233; &bogus; d</p><script>x", "x"), (6, "u", "<" * 50, "x"),
            (7, "u", "<div>" * 3000 + "deep", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extracted(df, crf).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[None] == ""
    assert by[4] == " ".join(["word"] * 20_000) and by[5] == "a < b < c é &bogus; d"
    assert H.extracted(df.limit(0), crf).count() == 0
    assert H.extracted(df, H.train(df.limit(0))).count() == len(rows)


def test_extraction_reads_all_but_scripts_styles_and_templates(spark):
    crf = trained(spark)

    def read(body: str) -> str:
        return H.main_text(f"<body><nav>Home</nav><article>{body}</article><footer>end</footer>", crf, {})

    start, rest = "<p>A first paragraph of words.", "<p>The rest of it.</p><p>And more.</p>"
    plain = "A first paragraph of words. The rest of it. And more."
    assert read("<p>Let <math><mi>x</mi></math> be.</p>") == "Let x be."
    assert read("<p>Let <math><mi>x<mi></p><p>be.</p>") == "Let x be."
    for name in ("noscript", "object", "iframe", "noembed", "noframes", "svg"):
        assert read(f"{start}</p><{name}><p>A text in {name}.</p></{name}>{rest}") == plain.replace(
            "words.", f"words. A text in {name}.")
    for name in ("svg", "math", "object", "noscript", "iframe", "noembed", "noframes", "template"):
        assert read(f"{start}<{name} id=x>{rest}") == read(f"{start}</p><{name}>{rest}") == plain, name
    # scripts, styles and closed templates are hidden, with all inside them
    for name in ("script", "style", "template"):
        assert read(f"{start}<{name}><p>Hidden.</p></{name}>{rest}") == plain
    assert read(f"{start}<template><template>a</template><div>b</div></template>{rest}") == plain
    assert read(f"{start}</p><template><div>Open.<template>a</template>{rest}") == plain.replace("The", "Open. The")
    assert read(f'{start}<svg><title>Icon</title></svg> It goes on.</p>{rest}') == plain.replace("The", "It goes on. The")


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(1)
    for n in (1, 2, 6):
        for _ in range(20):
            u, step = rng.normal(size=(n, 2)), rng.normal(size=(3, 2))
            best = max(itertools.product((0, 1), repeat=n), key=lambda y: step[0][y[0]] + sum(
                u[k][y[k]] for k in range(n)) + sum(step[1 + y[k - 1]][y[k]] for k in range(1, n)))
            assert H.Crf({}, np.zeros((0, 2)), step).decode(u) == list(best)


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    u, step = rng.normal(size=(5, 2)), rng.normal(size=(3, 2))
    total, single, pair = 0.0, np.zeros((5, 2)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=5):
        w = np.exp(step[0][y[0]] + sum(u[k][y[k]] for k in range(5)) + sum(step[1 + y[k - 1]][y[k]] for k in range(1, 5)))
        total += w
        for k in range(5):
            single[k, y[k]] += w
        for k in range(1, 5):
            pair[y[k - 1], y[k]] += w
    got, got_pair = H._expected(u, step)
    assert np.allclose(got, single / total) and np.allclose(got_pair, pair / total)
    assert random.Random(0)
