"""Benchmark decontamination: pigeonhole edit matching.

A document is contaminated by a test item if some stretch of its whole text is
within the item's error budget (one edit per ``CHARS_PER_ERROR`` characters)
of the item; both are lower-cased words with one space between them and one at
either end. An item with a budget of ``k`` edits is split into ``k + 1``
pieces: whatever the edits, one piece survives untouched. All pieces are looked up
at once by an Aho-Corasick automaton; every hit fixes where the item would lie
in the document, and Myers' bit-parallel algorithm gives the least edit
distance of the item inside that window.

Items are taken in blocks of at most ``BLOCK_CHARS`` characters (one item at
least), each broadcast by itself. A task runs one Python stage, which takes a batch
of documents through one block after another, so that it holds one automaton at a
time whatever the test set. Documents are not shuffled.

Defined cases: null and blank texts, and null and blank items, never match;
a short item (budget 0) must occur word for word; repeated items are listed
once each by their identifier; repeated rows get a row each; an empty test set
or table gives no match or no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pitchlake.llm.common import table

CHARS_PER_ERROR = 16
BLOCK_CHARS = 4_000_000
_WORD = re.compile(r"\w+")


def normalised(text: str | None) -> str:
    words = _WORD.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def budget(item: str) -> int:
    return len(item) // CHARS_PER_ERROR


def pieces(item: str) -> list[tuple[int, str]]:
    """The item's budget-plus-one pieces with their offsets."""
    k, n = budget(item), len(item)
    cuts = [n * j // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(masks: dict[str, int], m: int, text: str) -> int:
    """Least edit distance of a pattern of ``m`` characters to any stretch of ``text``.

    ``masks`` has the pattern's positions of each character as bits."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    get = masks.get
    for c in text:
        eq = get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best = score
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | ~(xv | up) & full
        minus = up & xv
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items = [(i, s) for i, s in ((i, normalised(t)) for i, t in items) if s]
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (_, s) in enumerate(self.items):
            for at, piece in pieces(s):
                found.setdefault(piece, []).append((n, at))
        self.masks: dict[int, dict[str, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def _mask(self, n: int) -> dict[str, int]:
        if n not in self.masks:
            masks: dict[str, int] = {}
            for j, c in enumerate(self.items[n][1]):
                masks[c] = masks.get(c, 0) | 1 << j
            self.masks[n] = masks
        return self.masks[n]

    def matches(self, text: str | None) -> dict[object, int]:
        """Item identifier -> least edit distance, for items within their budget."""
        doc = normalised(text)
        if not doc or not self.items:
            return {}
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(doc):
            for n, at in where:
                starts.setdefault(n, set()).add(end + 1 - size - at)
        out: dict[object, int] = {}
        for n, all_starts in starts.items():
            ident, item = self.items[n]
            m, k = len(item), budget(item)
            best, low, high = k + 1, None, 0
            for s in [*sorted(all_starts), None]:  # windows that overlap are verified together
                if s is not None and low is not None and s - k <= high:
                    high = s + m + k
                    continue
                if low is not None and best:
                    window = doc[max(low, 0):high]
                    best = min(best, 0 if item in window else myers(self._mask(n), m, window) if k else 1)
                if s is not None:
                    low, high = s - k, s + m + k
            if best <= k:
                out[ident] = min(best, out.get(ident, best))
        return out


def _blocks(items: DataFrame, ident: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, streamed one partition at a time."""
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.select(F.col(ident), F.col(text)).filter(F.col(ident).isNotNull() & F.col(text).isNotNull())
    for r in rows.toLocalIterator():
        if block and size + len(r[1]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    if block:
        yield block


def with_matches(docs: DataFrame, items: DataFrame, text: str = "text", name: str = "matches",
                 item_ident: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with a map column of matching items to their edit distance."""
    kind = T.MapType(items.schema[item_ident].dataType, T.IntegerType())
    spark, at = docs.sparkSession, docs.columns.index(text)
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(items, item_ident, item_text)]
    found_kind = to_arrow_type(kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = Matcher(blocks[0].value) if len(blocks) == 1 else None
        for b in batches:
            found: list[dict] = [{} for _ in range(b.num_rows)]
            for shared in blocks:  # one block's automaton at a time
                matcher = only or Matcher(shared.value)
                for got, t in zip(found, b.column(at), strict=True):
                    got.update(matcher.matches(t.as_py()))
                if only is None:
                    vars(shared).pop("_value", None)  # the worker's copy of the block
            column = pa.array([sorted(x.items()) for x in found], found_kind)
            yield pa.RecordBatch.from_arrays([*b.columns, column], names=[*b.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def contaminated(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: matching items, their number and the least distance."""
    m = F.col("_m")
    got = with_matches(docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")), items, "_text", "_m")
    return got.select(F.col("_id").alias(ident), (F.size(m) > 0).alias("contaminated"),
                      F.size(m).cast("long").alias("n_items"), F.array_sort(F.map_keys(m)).alias("item_ids"),
                      F.array_min(F.map_values(m)).alias("least_distance"))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item matches, with all their columns."""
    got = with_matches(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), items, "_text", "_m")
    return got.filter(F.size("_m") == 0).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
