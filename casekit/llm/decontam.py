"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with every run of other characters than letters and
digits as one space.  A test item of ``m`` characters may differ from a passage of a
document by ``k = floor(rate * m)`` edits.  It is split into ``k + 1`` pieces: with at most
``k`` edits one piece must occur exactly.  All pieces of a block of items are found in one
pass over a document by an Aho-Corasick automaton, and each hit's neighbourhood is
verified with Myers' bit-parallel edit distance (the item anywhere in the window).

The pieces are the leaves of a tree: a node with budget ``k`` has two halves whose budgets
add up to ``k - 1``, so where a node matches, one of its halves does.  A hit climbs from its
leaf and is dropped at the first node that does not match; some leaf of a true passage
reaches the root.  Most chance hits end after a window of two pieces.

The items are a stated query set.  They are read in blocks of bounded size, hashed by item
id; a block's items are shipped to the tasks, and each block is one narrow map over the
documents.  Where one block holds the benchmark that is all.  Otherwise the compared forms
are written once, every block's hits are written before its items are given up and the
next block is read, so the driver and the tasks hold one block; documents to drop are then
found by an anti-join on text digests.  Documents are never gathered.

Defined results
    * one row per document and item that it holds, with its least distance and the first
      place of it (character offsets in the compared form);
    * null and empty texts hold nothing; an item without a letter or digit matches nothing;
    * an item too short for any edit must stand there exactly, as whole words;
    * rows that repeat a document give repeated rows; repeated items give one row each item id;
    * a null id stays null; other columns are ignored (``drop_contaminated`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, text_or_empty, unused

RESULT = ("doc_id long, item_id long, distance int, budget int, item_chars int, "
          "start long, end long")

_OTHER = re.compile(r"[\W_]+")


def compared(text: str | None) -> str:
    """The form in which texts are compared."""
    return _OTHER.sub(" ", text.lower()).strip() if text else ""


def pieces_of(item: str, budget: int) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """The ``budget + 1`` pieces (from, to) of an item, each with the nodes above it up to
    but without the whole item: (from, to, budget), smallest first."""
    out = []

    def split(a: int, b: int, k: int, above: list) -> None:
        if k == 0:
            out.append((a, b, above))
            return
        left = (k - 1) // 2
        middle = a + (b - a) * (left + 1) // (k + 1)
        here = [(a, b, k), *above]
        split(a, middle, left, here)
        split(middle, b, k - 1 - left, here)

    split(0, len(item), budget, [])
    return [(a, b, above[:-1]) for a, b, above in out]


def char_masks(pattern: str) -> dict[str, int]:
    """For each character, the bits of its places in the pattern."""
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | (1 << i)
    return at


def myers(pattern: str, text: str, limit: int,
          masks: dict[str, int] | None = None) -> tuple[int, int] | None:
    """Least edit distance of the pattern to any substring of the text, and the end of the
    first such substring; None if it exceeds the limit.  Bit i of the vectors says how the
    distance changes from row i to row i + 1."""
    m = len(pattern)
    at = char_masks(pattern) if masks is None else masks
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now = full, 0, m              # vertical +1, vertical -1, distance in the last row
    best, where = (m, 0) if m <= limit else (limit + 1, -1)
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        flat = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        rise = (down | ~(diag | up)) & full
        fall = up & diag
        if rise & top:
            now += 1
        elif fall & top:
            now -= 1
        rise = (rise << 1) & full           # a match may start anywhere: row 0 stays 0
        fall = (fall << 1) & full
        up = (fall | ~(flat | rise)) & full
        down = rise & flat
        if now < best:
            best, where = now, j + 1
            if best == 0:
                break
    return (best, where) if best <= limit else None


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick
        self.items, self.budgets = [], []
        self.masks: dict[str, dict[str, int]] = {}
        found: dict[str, list[tuple]] = {}
        for item_id, text in items:
            form = compared(text)
            if not form:
                continue
            k = int(rate * len(form))
            for a, b, above in pieces_of(form, k):
                nodes = [(form[x:y], a - x, n) for x, y, n in above]
                found.setdefault(form[a:b], []).append((len(self.items), b, b - a, nodes))
            self.items.append((item_id, form))
            self.budgets.append(k)
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, owners)
        if found:
            self.automaton.make_automaton()

    def _distance(self, pattern: str, window: str, limit: int) -> tuple[int, int] | None:
        masks = self.masks.get(pattern)
        if masks is None:
            masks = self.masks[pattern] = char_masks(pattern)
        return myers(pattern, window, limit, masks)

    def hits(self, form: str) -> list[tuple[int, int, int, int, int, int]]:
        """(item id, distance, budget, item length, start, end) for each item in a compared
        form."""
        if not form or not self.items:
            return []
        starts: dict[int, set[int]] = {}
        for last, owners in self.automaton.iter(form):
            end = last + 1
            for k, past, size, nodes in owners:
                if end - past in starts.get(k, ()):
                    continue
                for pattern, before, budget in nodes:
                    at = end - size - before
                    if self._distance(pattern, form[max(0, at - budget):
                                                    at + len(pattern) + budget], budget) is None:
                        break
                else:
                    starts.setdefault(k, set()).add(end - past)
        out = []
        for k, places in sorted(starts.items()):
            found = self._verify(form, k, sorted(places))
            if found is not None:
                item_id, item = self.items[k]
                out.append((item_id, found[0], self.budgets[k], len(item), found[1], found[2]))
        return out

    def _verify(self, form: str, k: int, starts: list[int]) -> tuple[int, int, int] | None:
        """The whole item near each place that its pieces point to: least distance, span."""
        item, budget = self.items[k][1], self.budgets[k]
        best = None
        for s in starts:
            if form.startswith(item, s) if s >= 0 else False:
                e = s + len(item)
                if budget or ((s == 0 or form[s - 1] == " ") and (e == len(form) or form[e] == " ")):
                    return 0, s, e
        if budget == 0:
            return None
        for s in starts:
            lo = max(0, s - budget)
            found = self._distance(item, form[lo:s + len(item) + budget],
                                   budget if best is None else best[0] - 1)
            if found:
                e = lo + found[1]
                # the reversed item against what ends there gives the start
                back = myers(item[::-1], form[max(0, e - len(item) - budget):e][::-1], found[0])
                best = (found[0], e - (back[1] if back else len(item)), e)
                if best[0] == 0:
                    break
        return best


def item_blocks(benchmark: DataFrame, block_chars: int, id_col: str = "item_id",
                text_col: str = "text") -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """The number of blocks of about ``block_chars`` characters each, and the blocks, read
    one at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                             F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // block_chars

    def blocks() -> Iterator[list[tuple[int, str]]]:
        for k in range(n):
            block = items if n == 1 else items.where(
                F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
            yield sorted((tuple(r) for r in block.distinct().collect()),
                         key=lambda r: (r[0] is not None, r[0], r[1]))

    return n, blocks()


def _hit_rows(forms: DataFrame, shared, form_of=lambda form: form) -> DataFrame:
    """``(key, text)`` to one row per text and item of a block; ``form_of`` gives the
    compared form of a text."""
    key_type = forms.schema[0].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = Matcher(*shared.value)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = ["doc_id", *(c.split()[0] for c in RESULT.split(", ")[1:])]
        for b in batches:
            out = [(row, *hit) for row, t in enumerate(b.column(1).to_pylist())
                   for hit in m.hits(form_of(t))]
            row, *columns = zip(*out) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return forms.mapInArrow(run, f"doc_id {key_type}, " + RESULT.split(", ", 1)[1])


def _written_forms(rows: DataFrame) -> DataFrame:
    """``(key, text)`` with the compared forms as texts, written."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([compared(t) for t in b.column(1).to_pylist()], pa.string())],
                ["key", "text"])

    key, text = (F.col(f"`{c}`") for c in rows.columns)
    rows = rows.select(key.alias("key"), text.alias("text"))
    return stored(rows.mapInArrow(run, rows.schema), "compared-forms")


def _hits_by_block(rows: DataFrame, blocks: Iterator, rate: float) -> DataFrame:
    """Hits of all blocks in ``(key, text)``: each block's are written, then its items go."""
    forms = _written_forms(rows)
    out = None
    for items in blocks:
        shared = rows.sparkSession.sparkContext.broadcast((items, rate))
        hits = stored(_hit_rows(forms, shared), "block-hits")
        shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1,
                       block_chars: int = 2_000_000, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n, blocks = item_blocks(benchmark, block_chars)
    if n > 1:
        return _hits_by_block(rows, blocks, rate)
    shared = docs.sparkSession.sparkContext.broadcast((next(blocks), rate))
    return _hit_rows(rows, shared, compared)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1,
                      block_chars: int = 2_000_000, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no benchmark item."""
    ship(docs.sparkSession)
    n, blocks = item_blocks(benchmark, block_chars)
    if n > 1:
        digest = unused(docs, "digest")
        keyed = docs.withColumn(digest, F.sha2(F.encode(text_or_empty(text_col), "UTF-8"), 256))
        gone = _hits_by_block(keyed.select(digest, text_col), blocks, rate)
        return keyed.join(gone.select(F.col("doc_id").alias(digest)).distinct(), digest,
                          "left_anti").select(*(f"`{c}`" for c in docs.columns))
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((next(blocks), rate))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m = Matcher(*shared.value)
        for b in batches:
            yield b.filter(pa.array([not m.hits(compared(t)) for t in b.column(at).to_pylist()],
                                    pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
