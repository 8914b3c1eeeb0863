"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, each with the path of open elements (names
and the words of their class, id and role) and text features. The CRF labels
every block as main text or not; Viterbi finds the best labelling of the whole
page. The text is that of the main blocks, in page order.

Training pages are at most ``TRAIN_PAGES`` pages of the table (those with the
smallest hash of their identifier; of repeated identifiers the page with the
smallest hash). They are read whole: pages that can't have more than
``TRAIN_BLOCKS`` blocks (by their number of tags) are taken first, then longer
ones, shortest first, while ``TRAIN_PAGES`` times as many blocks are not
exceeded, and always one. Their blocks are labelled by the page's
own markup: a block is main text if it lies in ``article`` or ``main`` and in
nothing that serves another purpose. Each page also enters in altered copies:
with its article element renamed or dropped, and with sidebars, notices,
forms, adverts, headers and reader comments added, whose labels are known by
construction. Paths and features of blocks, not texts, come to the driver.

Read as text is all but tags, comments, ``script``, ``style`` and the contents of a
closed ``template``, which no browser shows. Formulas, drawings and the
fall-backs of ``noscript``, ``object``, ``iframe`` and the like are text that the CRF
judges; one of them (or a ``template``) left open hides nothing, while an
unclosed script or style reaches to the end of the page, as in browsers.

Defined cases: null and empty html give an empty text; markup that breaks off
is closed at the end of the page, an unfinished tag is dropped; pages without
any main block give an empty text; repeated rows are extracted each; no
trainable page leaves all weights zero and labels nothing main; other columns
never take part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import table

TRAIN_PAGES, TRAIN_BLOCKS, EPOCHS, RATE, L2 = 300, 5000, 12, 0.3, 1e-4

# Element names of HTML and words of class, id and role attributes.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
option p pre search section select summary table tbody td tfoot th thead title tr ul button textarea label""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style".split())
#: Elements whose text is a block of its own, but that leave an open paragraph open.
APART_TAGS = frozenset("iframe noembed noframes noscript object svg template".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = frozenset("li dd dt option tr td th thead tbody tfoot p".split())
NOT_MAIN_TAGS = frozenset("""nav aside footer form header menu button select option textarea label fieldset dialog
title head search""".split())
NOT_MAIN_WORDS = frozenset("""ad ads adsense adv advert advertisement advertising adverts alert announcement aside banner breadcrumb
breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion
disqus donate feedback footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice
notices optin pager pagination poll popup promo promoted rail recommended register related replies reply responses
search share sharing sidebar signin signup social sponsor sponsored sponsors subscribe survey teaser toolbar topbar
warning widget""".split())
MAIN_WORDS = frozenset("article content entry main post story text body".split())

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
                    r"|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|[^<]+|<", re.S)
_NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    """A leaf block: path of open elements as (name, attribute words), its text and the share of it in links."""

    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    linked: float


class Seen(NamedTuple):
    """What the CRF sees of a block: its path, the features and length of its whole text, the share in links."""

    path: tuple[tuple[str, tuple[str, ...]], ...]
    own: tuple[str, ...]
    n: int
    linked: float


def _attr_words(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    found = " ".join(a or b or c for a, b, c in _NAMED.findall(attrs))
    return tuple(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower()))


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a whole page that hold text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = [0, 0]  # characters in links, all characters
    hidden: dict[int, int] = {}  # place of an open template on the stack -> number of blocks before it

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(x for x in stack if x[0] in BLOCK_TAGS or x[0] in APART_TAGS or x[1])
                out.append(Block(path, text, links[0] / max(links[1], 1)))
            parts.clear()
        links[0] = links[1] = 0

    def close(name: str) -> None:
        while stack and stack.pop()[0] != name:
            pass

    page, skip_to = page or "", 0
    in_link = 0
    for m in _PIECE.finditer(page):
        if m.start() < skip_to:
            continue
        name = m.group(2)
        if name is None:
            s = m.group()
            if s[0] != "<" or s == "<":
                parts.append(s)
                n = len(s.strip())
                links[1] += n
                links[0] += n * (in_link > 0)
            continue
        if not m.group(4):  # the page ends inside this tag
            break
        name = name.lower()
        if m.group(1):
            apart = name in BLOCK_TAGS or name in APART_TAGS
            if apart:
                flush()
            if any(x[0] == name for x in stack):
                close(name)
                if name == "template":
                    del out[hidden[len(stack)]:]
            in_link = sum(x[0] == "a" for x in stack) if apart or name == "a" else in_link
            continue
        if name in RAW_TAGS:
            if not m.group(3).rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, m.end())
                skip_to = end.end() if end else len(page)
            continue
        if name in BLOCK_TAGS:
            flush()
            if stack and (stack[-1][0] == name and name in SAME_CLOSES):
                stack.pop()
            elif any(x[0] in CLOSED_BY_BLOCK for x in stack):
                # a block closes an open paragraph, with whatever is open inside it
                at = max(k for k, x in enumerate(stack) if x[0] in CLOSED_BY_BLOCK)
                if all(x[0] not in BLOCK_TAGS and x[0] not in APART_TAGS for x in stack[at + 1:]):
                    del stack[at:]
        elif name in APART_TAGS:
            flush()
        elif name == "br":
            parts.append(" ")
        if name not in VOID_TAGS and not m.group(3).rstrip().endswith("/"):
            if name == "template":
                hidden[len(stack)] = len(out)
            stack.append((name, _attr_words(m.group(3))))
            in_link += name == "a"
    flush()
    return out


def _path_features(path: tuple) -> list[str]:
    out = {"bias"}
    names = [x[0] for x in path]
    for name, words in path:
        out.add(f"in:{name}")
        for w in words:
            if w in NOT_MAIN_WORDS:
                out |= {"word:other", f"word:{w}"}
            if w in MAIN_WORDS:
                out |= {"word:main"}
    if names:
        out.add(f"own:{names[-1]}")
    if len(names) > 1:
        out.add(f"parent:{names[-2]}")
    if any(n in NOT_MAIN_TAGS for n in names):
        out.add("tag:other")
    return sorted(out)


def _text_features(t: str) -> tuple[str, ...]:
    out = [f"len:{min(len(t), 1000).bit_length()}"]
    if t[-1] in ".!?…":
        out.append("ends")
    if "©" in t:
        out.append("copyright")
    return tuple(out)


def seen(b: Block) -> Seen:
    return Seen(b.path, _text_features(b.text), len(b.text), b.linked)


def observed(page: list[Seen], cache: dict) -> list[list[str]]:
    """The features of each block of a page."""
    out = []
    for k, b in enumerate(page):
        if b.path not in cache:
            cache[b.path] = _path_features(b.path)
        out.append([*cache[b.path], *b.own, f"linked:{int(b.linked * 4)}", *(["first"] if k == 0 else []),
                    *(["last"] if k == len(page) - 1 else [])])
    return out


def marked(b: Block | Seen) -> int:
    """The label that a block's own markup gives it."""
    names = [x[0] for x in b.path]
    other = any(n in NOT_MAIN_TAGS and not (n == "header" and "article" in names[:k])
                for k, n in enumerate(names)) or any(w in NOT_MAIN_WORDS for x in b.path for w in x[1])
    return int(("article" in names or "main" in names) and not other)


def altered(page: list[tuple[Seen, int]], rng: np.random.Generator) -> list[tuple[Seen, int]]:
    """A copy of a labelled page with another main element and with added boilerplate of known label."""
    # the main element: kept, renamed, a named division, or a division without a name
    kind = rng.integers(4)
    main = [("article", ()), ("main", ()), ("div", ("content",)), ("div", ())][kind]

    def moved(b: Seen, y: int) -> Seen:
        return b._replace(path=tuple(main if y and x[0] in ("article", "main") else x for x in b.path))

    out = [(moved(b, y), y) for b, y in page]
    base = (("html", ()), ("body", ()))
    texts = [(b.own, b.n) for b, _ in page if b.n > 5] or [(_text_features("text"), 4)]
    words = sorted(NOT_MAIN_WORDS)
    places = [(("aside", ()),), (("header", ()),), (("form", ()), ("label", ())), (("nav", ()),), (("footer", ()),),
              (("form", ()), ("button", ())), (("form", ()), ("p", ()))]
    for _ in range(int(rng.integers(1, 6))):
        own = places[rng.integers(len(places))] if rng.random() < 0.4 else (
            (("div", "section", "aside", "p", "ul")[rng.integers(5)], (words[rng.integers(len(words))],)),)
        if rng.random() < 0.3:
            own = (*own, ("p", ()))
        inside = (main,) if rng.random() < 0.35 else ()
        at = int(rng.integers(len(out) + 1))
        for _ in range(int(rng.integers(1, 4))):
            text = texts[rng.integers(len(texts))]
            out.insert(at, (Seen((*base, *inside, *own), *text, float(rng.random() < 0.3)), 0))
    return out


class Crf:
    """Two labels; weights by feature and label, start and transition weights."""

    def __init__(self, index: dict[str, int], unary: np.ndarray, step: np.ndarray):
        self.index, self.unary, self.step = index, unary, step  # step[0] start, step[1:] from label to label

    def scores(self, obs: list[list[str]]) -> np.ndarray:
        get, w = self.index.get, self.unary
        out = np.empty((len(obs), 2))
        for k, fs in enumerate(obs):
            out[k] = w[[i for f in fs if (i := get(f)) is not None]].sum(axis=0)
        return out

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the best labelling of a page."""
        s = scores.tolist()
        (a0, a1), ((t00, t01), (t10, t11)) = self.step[0].tolist(), self.step[1:].tolist()
        back, v0, v1 = [], a0 + s[0][0], a1 + s[0][1]
        for u0, u1 in s[1:]:
            p0, p1 = v1 + t10 > v0 + t00, v1 + t11 > v0 + t01
            v0, v1 = u0 + (v1 + t10 if p0 else v0 + t00), u1 + (v1 + t11 if p1 else v0 + t01)
            back.append((p0, p1))
        y = [int(v1 > v0)]
        for p in reversed(back):
            y.append(int(p[y[-1]]))
        return y[::-1]


def _expected(u: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of labels and of neighbouring label pairs, by forward and backward sums of logarithms."""
    n = len(u)
    fwd, bwd = np.empty((n, 2)), np.zeros((n, 2))
    fwd[0] = step[0] + u[0]
    for k in range(1, n):
        fwd[k] = u[k] + np.logaddexp(fwd[k - 1, 0] + step[1], fwd[k - 1, 1] + step[2])
    for k in range(n - 2, -1, -1):
        x = step[1:] + u[k + 1] + bwd[k + 1]
        bwd[k] = np.logaddexp(x[:, 0], x[:, 1])
    z = np.logaddexp(*fwd[-1])
    pair = np.zeros((2, 2))
    for k in range(n - 1):
        pair += np.exp(fwd[k][:, None] + step[1:] + (u[k + 1] + bwd[k + 1])[None, :] - z)
    return np.exp(fwd + bwd - z), pair


def fit(pages: list[tuple[list[list[str]], list[int]]]) -> Crf:
    """Maximises the conditional likelihood by adaptive gradient steps, page by page."""
    index = {f: k for k, f in enumerate(sorted({f for obs, _ in pages for fs in obs for f in fs}))}
    unary, step = np.zeros((len(index), 2)), np.zeros((3, 2))
    unary[index["bias"], 0] = 1e-6 if "bias" in index else 0
    gu, gs = np.full_like(unary, 1e-6), np.full_like(step, 1e-6)
    rng = np.random.default_rng(5)
    numbered = [([np.array([index[f] for f in fs]) for fs in obs], np.array(y)) for obs, y in pages if obs]
    for _ in range(EPOCHS):
        for p in rng.permutation(len(numbered)):
            ids, y = numbered[p]
            u = np.array([unary[i].sum(axis=0) for i in ids])
            prob, pair = _expected(u, step)
            diff = np.eye(2)[y] - prob
            rows = np.concatenate(ids)
            grad = np.zeros_like(unary)
            np.add.at(grad, rows, np.repeat(diff, [len(i) for i in ids], axis=0))
            used = np.unique(rows)
            grad[used] -= L2 * unary[used]
            gstep = np.zeros_like(step)
            gstep[0] = diff[0]
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            gstep[1:] = seen - pair - L2 * step[1:]
            gu[used] += grad[used] ** 2
            gs += gstep ** 2
            unary[used] += RATE * grad[used] / np.sqrt(gu[used])
            step += RATE * gstep / np.sqrt(gs)
    return Crf(index, unary, step)


def train(pages: DataFrame, ident: str = "page_id", text: str = "html", max_pages: int = TRAIN_PAGES,
          max_blocks: int = TRAIN_BLOCKS) -> Crf:
    """A CRF from at most ``max_pages`` whole pages that their own markup labels, with at most
    ``max_pages * max_blocks`` blocks unless a single page has more."""
    has_main = F.lower(F.col(text)).rlike("<(article|main)[ >]")
    # a block ends at a tag or at the page's end, so a page has at most one more than "<"
    most = F.length(F.col(text)) - F.length(F.replace(F.col(text), F.lit("<"), F.lit(""))) + 1
    labelled = pages.filter(has_main).select(F.col(ident).alias("_id"), F.col(text).alias("_html"),
                                             F.greatest(most, F.lit(max_blocks)).alias("_most"))
    # identifiers first: only the chosen pages' texts travel
    first = labelled.groupBy("_id").agg(F.min("_most").alias("_most")) \
        .orderBy("_most", F.xxhash64("_id"), "_id").limit(max_pages)
    chosen, room = [], max_pages * max_blocks
    for r in first.collect():  # at most max_pages narrow rows
        if not chosen or r["_most"] <= room:
            chosen.append(r["_id"])
            room -= r["_most"]
    picked = labelled.filter(F.col("_id").isin(chosen))
    # one page an identifier, however often it is repeated
    least = F.min(F.struct("_most", F.xxhash64("_html").alias("h"), F.col("_html").alias("t")))
    picked = picked.groupBy("_id").agg(least.alias("_least")).select("_id", F.col("_least.t").alias("_html"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, words, own, sizes, linked = [], [], [], [], []
            for h in b.column("_html"):
                found = [seen(k) for k in blocks(h.as_py())]
                names.append([[x[0] for x in k.path] for k in found])
                words.append([[" ".join(x[1]) for x in k.path] for k in found])
                own.append([k.own for k in found])
                sizes.append([k.n for k in found])
                linked.append([k.linked for k in found])
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(names, pa.list_(pa.list_(pa.string()))),
                 pa.array(words, pa.list_(pa.list_(pa.string()))), pa.array(own, pa.list_(pa.list_(pa.string()))),
                 pa.array(sizes, pa.list_(pa.int64())), pa.array(linked, pa.list_(pa.float64()))],
                ["_id", "names", "words", "own", "sizes", "linked"])

    kind = picked.schema["_id"].dataType.simpleString()
    got = picked.mapInArrow(scan, f"_id {kind}, names array<array<string>>, words array<array<string>>, "
                                  "own array<array<string>>, sizes array<long>, linked array<double>").toArrow().to_pylist()
    got.sort(key=lambda r: str(r["_id"]))
    rng, data, cache = np.random.default_rng(23), [], {}
    for r in got:
        page = [Seen(tuple((a, tuple(w.split())) for a, w in zip(n, ws, strict=True)), tuple(f), k, x)
                for n, ws, f, k, x in zip(r["names"], r["words"], r["own"], r["sizes"], r["linked"], strict=True)]
        labelled = [(b, marked(b)) for b in page]
        for version in (labelled, altered(labelled, rng), altered(labelled, rng)):
            data.append((observed([b for b, _ in version], cache), [y for _, y in version]))
    return fit(data) if data else Crf({}, np.zeros((0, 2)), np.zeros((3, 2)))


def main_text(page: str | None, crf: Crf, cache: dict) -> str:
    """The main text of one page."""
    found = blocks(page)
    if not found:
        return ""
    labels = crf.decode(crf.scores(observed([seen(b) for b in found], cache)))
    return " ".join(b.text for b, y in zip(found, labels, strict=True) if y)


def extracted(pages: DataFrame, crf: Crf) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(crf)  # as large as the fixed feature names allow
    src = pages.select("page_id", "url", "html")
    kind = src.schema["page_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, {}
        for b in batches:
            if len(cache) > 50_000:
                cache.clear()
            texts = [main_text(h.as_py(), model, cache) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(scan, f"page_id {kind}, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, train(pages))
