"""Hard-negative mining with Four-Russians scoring.

Vectors are cut to integers ``floor(scale * x)``.  An integer is a sum of bit planes (two's
complement), and in a plane eight neighbouring dimensions are one byte:

* the *index* holds, for every row, its planes as packed bytes;
* for every anchor and group of eight dimensions a *table* holds the sums of all 256 subsets
  of the anchor's eight components;
* a score is read from the tables: from the sign plane down, double what there is and add
  the table entries that the plane's bytes point to.  This gives the whole inner product,
  exactly.

Anchors are a stated query set.  They are taken in blocks of bounded size; a block is shipped
to the tasks, and each of its two passes is one narrow map over the index: the first gives
the anchors' best rows of their own label (their positives), the second the best rows of
another label in the window that each positive opens.  A task keeps only the few best rows
of each anchor and window; the tasks' lists meet in a ranking whose map side already cuts
them to the same length.  Rows are never paired in a join.

Defined results
    * rows with a null id, label or vector, or any null or non-finite component take no part;
      neither do rows with a component of 2^22 or more after scaling (a score must fit a long);
    * a vector shorter than the longest counts as having zeros at its end;
    * rows that repeat an id are candidates of their own, never for an anchor of the same id;
      of repeated anchors the one with the least label and vector is the anchor;
    * anchors without a positive, and positives without a negative, give no row;
    * an empty table, or one without anchors, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casekit.session import scratch_path

from .common import ship, stored

RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")
_HITS = "anchor_id long, slot int, id long, score long"
_NONE = -(1 << 62)


# ----------------------------------------------------------- bit planes, tables

def packed_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """Rows of integers to ``(rows, planes, groups of eight)`` bytes, sign plane first; bit k
    of a byte belongs to the k-th of its eight dimensions."""
    bits = x[:, None, :] >> np.arange(planes - 1, -1, -1, dtype=np.int64)[None, :, None] & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_tables(anchors: np.ndarray, dtype=np.int64) -> np.ndarray:
    """``(groups, 256, anchors)``: the sum of every subset of each group of eight components."""
    n, width = anchors.shape
    groups = -(-width // 8)
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :width] = anchors
    parts = padded.reshape(n, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, n), dtype)
    for k in range(8):                         # subsets with bit k: those without, plus one
        out[:, 1 << k:2 << k] = out[:, :1 << k] + parts[:, k:k + 1]
    return out


def table_scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """``(rows, anchors)`` inner products, by shifting and adding table entries."""
    rows, planes, groups = packed.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for p in range(planes):
        if p:
            np.left_shift(total, 1, out=total)
        for g in range(groups):
            np.take(tables[g], packed[:, p, g], axis=0, out=found, mode="clip")
            total += found
        if p == 0:
            np.negative(total, out=total)      # the sign plane counts negatively
    return total


def planes_for(least: int, most: int) -> int:
    """Planes that hold every integer from ``least`` to ``most``, sign included."""
    return 1 + max(int(most), -int(least) - 1, 0).bit_length()


class Best:
    """The ``k`` best (score, then least id) of each column, over blocks of rows."""

    def __init__(self, columns: int, k: int):
        self.scores = np.full((columns, k), _NONE, np.int64)
        self.ids = np.full((columns, k), np.iinfo(np.int64).max, np.int64)
        self.k = k

    def add(self, scores: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> None:
        last, last_id = self.scores[:, -1], self.ids[:, -1]
        ahead = valid & ((scores > last) | ((scores == last) & (ids[:, None] < last_id)))
        row, col = np.nonzero(ahead)
        if not len(row):
            return
        cols = np.concatenate([col, np.repeat(np.arange(len(last)), self.k)])
        s = np.concatenate([scores[row, col].astype(np.int64), self.scores.ravel()])
        i = np.concatenate([ids[row], self.ids.ravel()])
        order = np.lexsort((i, -s, cols))
        cols, s, i = cols[order], s[order], i[order]
        start = np.searchsorted(cols, np.arange(len(last)))
        pick = start[:, None] + np.arange(self.k)
        self.scores, self.ids = s[pick], i[pick]

    def rows(self, anchor_ids: np.ndarray, slot: int) -> list[np.ndarray]:
        """Columns anchor id, slot, id, score of what was found."""
        col, k = np.nonzero(self.scores != _NONE)
        return [anchor_ids[col], np.full(len(col), slot, np.int32), self.ids[col, k], self.scores[col, k]]


# ------------------------------------------------------------------- on Spark

def prepared(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id, label, ints`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    limit = F.lit(float((1 << 22) // scale))
    # NaN is greater than any number here
    inside = F.forall("v", lambda x: F.coalesce(F.abs(x) < limit, F.lit(False)))
    ints = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("int"))
    return (rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(inside)
            .select("id", "label", ints.alias("ints")))


def _matrix(column, width: int) -> np.ndarray:
    """An Arrow list column as a matrix, short rows filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def plane_index(rows: DataFrame, width: int, planes: int) -> DataFrame:
    """``id, label, packed`` of every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            packed = packed_planes(_matrix(b.column(2), width), planes)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([p.tobytes() for p in packed], pa.binary())],
                ["id", "label", "packed"])

    return rows.mapInArrow(run, "id long, label long, packed binary")


class Block:
    """Some anchors in a task: their tables, and the scores of index rows."""

    def __init__(self, anchors, width: int, planes: int):
        self.ids, self.labels, ints = anchors
        wide = np.abs(ints).sum(axis=1).max(initial=0) * (1 << planes) >= 1 << 31
        self.tables = subset_tables(ints, np.int64 if wide else np.int32)
        self.shape = (planes, self.tables.shape[0])

    def scored(self, batches: Iterator, rows: int = 256) -> Iterator:
        """``(scores, same label, ids)`` of slices of the index."""
        for b in batches:
            ids, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
            raw = b.column(2).to_pylist()
            order = np.argsort(ids, kind="stable")         # ties are then cut off early
            for at in range(0, len(ids), rows):
                pick = order[at:at + rows]
                packed = np.frombuffer(b"".join([raw[k] for k in pick]), np.uint8).reshape(len(pick), *self.shape)
                yield table_scores(self.tables, packed), labels[pick][:, None] == self.labels, ids[pick]


def _hits(found: list[Best], anchor_ids: np.ndarray):
    import pyarrow as pa
    columns = [np.concatenate(c) for c in zip(*(f.rows(anchor_ids, s) for s, f in enumerate(found)))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "slot", "id", "score"])


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and slot, with their rank."""
    w = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        label: Column | None = None, anchor: Column | None = None,
                        positives: int = 5, negatives: int = 3, low_pct: int = 50, high_pct: int = 95,
                        scale: int = 256, block_bytes: int = 32 << 20) -> DataFrame:
    """One row per anchor, positive and hard negative.

    ``anchor`` says which rows are anchors (over column ``id``).  A negative has another label
    and ``low_pct * positive_score <= 100 * negative_score <= high_pct * positive_score``.
    A block's tables take about ``block_bytes`` in a task.
    """
    spark = vectors.sparkSession
    ship(spark)
    anchor = F.expr("id % 50 = 0") if anchor is None else anchor
    rows = prepared(vectors, scale, id_col, vector_col, F.col("label") if label is None else label)
    size = rows.agg(F.max(F.size("ints")).alias("w"), F.min(F.array_min("ints")).alias("lo"),
                    F.max(F.array_max("ints")).alias("hi"), F.count_if(anchor).alias("n")).first()
    out_path = scratch_path(spark, "negatives")
    if not size.n:
        return spark.createDataFrame([], RESULT)
    width, planes = size.w or 0, planes_for(size.lo or 0, size.hi or 0)
    index = stored(plane_index(rows, width, planes), "planes")
    queries = stored(rows.where(anchor).groupBy("id").agg(F.min(F.struct("label", "ints")).alias("r"))
                     .select("id", "r.label", "r.ints"), "anchors")
    per_block = max(1, block_bytes // max(1, -(-width // 8) * 256 * 4))
    n_blocks = -(-size.n // per_block)
    for k in range(n_blocks):
        _mine_block(index, queries, k, n_blocks, width, planes, positives, negatives, low_pct,
                    high_pct, f"{out_path}/block={k}")
    return spark.read.schema(RESULT).parquet(*[f"{out_path}/block={k}" for k in range(n_blocks)])


def _mine_block(index: DataFrame, queries: DataFrame, k: int, n_blocks: int, width: int, planes: int,
                positives: int, negatives: int, low_pct: int, high_pct: int, path: str) -> None:
    """Both passes of one block of anchors; its result is written to ``path``."""
    spark = index.sparkSession
    block = queries.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == k).collect()
    block.sort(key=lambda r: r.id)
    ints = np.zeros((len(block), width), np.int64)
    for a, r in enumerate(block):
        ints[a, :len(r.ints)] = r.ints
    ids, labels = (np.array([r[c] for r in block], np.int64) for c in ("id", "label"))
    shared = spark.sparkContext.broadcast((ids, labels, ints))

    def own_label(batches: Iterator) -> Iterator:
        b = Block(shared.value, width, planes)
        best = Best(len(b.ids), positives)
        for scores, same, row_ids in b.scored(batches):
            best.add(scores, same & (row_ids[:, None] != b.ids), row_ids)
        yield _hits([best], b.ids)

    found = _first(index.mapInArrow(own_label, _HITS), positives).collect()
    # windows of the positives, at most `positives` an anchor; an empty window where there is none
    at = {a: n for n, a in enumerate(ids.tolist())}
    low, high = np.ones((2, len(ids), positives), np.int64) * np.array([1, 0])[:, None, None]
    for r in found:
        low[at[r.anchor_id], r["rank"] - 1] = -(-low_pct * r.score // 100)
        high[at[r.anchor_id], r["rank"] - 1] = high_pct * r.score // 100
    opened = spark.sparkContext.broadcast((low, high))

    def other_label(batches: Iterator) -> Iterator:
        b = Block(shared.value, width, planes)
        low, high = opened.value
        best = [Best(len(b.ids), negatives) for _ in range(positives)]
        for scores, same, row_ids in b.scored(batches):
            other = ~same & (row_ids[:, None] != b.ids)
            for s, slot in enumerate(best):
                slot.add(scores, other & (scores >= low[:, s]) & (scores <= high[:, s]), row_ids)
        yield _hits(best, b.ids)

    chosen = spark.createDataFrame(
        [(r.anchor_id, r["rank"] - 1, r.id, r.score) for r in found],
        "anchor_id long, slot int, positive_id long, positive_score long")
    (_first(index.mapInArrow(other_label, _HITS), negatives)
     .join(F.broadcast(chosen), ["anchor_id", "slot"])
     .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
             F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
     .write.parquet(path))
    shared.unpersist()
    opened.unpersist()
