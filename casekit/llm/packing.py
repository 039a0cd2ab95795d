"""Best-fit-decreasing packing of token sequences into fixed windows.

A document's ids (with its end id) are first cut into full windows; what is left over,
shorter than a window, is packed by best fit, longest first: a segment tree indexed by
remaining capacity gives the tightest open window that still has room in O(log window).

Packing happens in the task that encoded the documents, so ids are never shuffled.
Each task packs its scan split in blocks of at most ``block`` left-overs (bounded
memory); a window never spans two blocks, which costs at most a few open windows per
block.  Sequence ids are ``task << 40 | number in the task``; both come from the
split's content, so a retried task gives the same rows.

Defined results
    * a null or empty text is the end id alone: one piece of length 1;
    * a document longer than a window is cut into full windows and one left-over;
    * equal lengths are packed in order of arrival; repeated rows are packed each;
    * an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .chunks import ids_of, slices, tokenizer_path
from .common import give_back, ship

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, padded_to long")


class CapacityTree:
    """Open windows by remaining capacity, with the smallest sufficient one in O(log n)."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [0] * (2 * self.size)          # windows below each node
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window_no: int) -> None:
        self.open[capacity].append(window_no)
        i = self.size + capacity
        while i:
            self.any[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) with the least capacity >= need."""
        i, any_ = self.size + need, self.any
        if not any_[i]:
            while i > 1 and (i & 1 or not any_[i + 1]):
                i >>= 1                            # climb until a right sibling has one
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if any_[2 * i] else 2 * i + 1
        capacity = i - self.size
        while i:
            any_[i] -= 1
            i >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], list[int]]:
    """Window number and offset of each length, and the tokens in each window."""
    where, offset, filled = [0] * len(lengths), [0] * len(lengths), []
    tree = CapacityTree(window)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[k]
        found = tree.take(n)
        if found is None:
            where[k], room = len(filled), window
            filled.append(0)
        else:
            room, where[k] = found
        offset[k] = window - room
        filled[where[k]] += n
        if room > n:
            tree.add(room - n, where[k])
    return where, offset, filled


def padded_length(tokens: int, window: int) -> int:
    """A window is padded to its full length unless its tokens are a power of two."""
    return tokens if tokens & (tokens - 1) == 0 else window


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
                   window: int = 1024, block: int = 50_000, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit) and its place."""
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        give_back()
        enc = ids_of(tokenizer_path(tokenizer))
        schema = pa.schema([(c, pa.binary() if c == "ids" else pa.int64())
                            for c in (x.split()[0] for x in PIECES.split(", "))])
        base = TaskContext.get().partitionId() << 40
        end = end_id.to_bytes(4, "little")
        seq, rest = 0, []     # rest: (doc_id, start, ids, doc_tokens), shorter than a window

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*pieces), schema)], schema=schema)

        def pack(rest: list, seq: int) -> tuple[list, int]:
            where, offset, filled = best_fit_decreasing([len(r[2]) // 4 for r in rest], window)
            return [(d, start, len(ids) // 4, ids, total, base + seq + w, off, filled[w],
                     padded_length(filled[w], window))
                    for (d, start, ids, total), w, off in zip(rest, where, offset)], \
                seq + len(filled)

        def packed(pieces: list[tuple]) -> Iterator:
            # in slices, so that neither side holds a block's ids twice
            for at in range(0, len(pieces), 2048):
                yield rows(pieces[at:at + 2048])

        for b in batches:
            full, size = [], 0
            doc_ids = b.column(0).to_pylist()
            for at, to in slices(b.column(1), 2 << 20):
                flat, ends = enc(b.column(1)[at:to])
                raw, ends = flat.astype("<u4").tobytes(), (4 * ends).tolist()
                for doc, lo, hi in zip(doc_ids[at:to], ends, ends[1:]):
                    ids = raw[lo:hi] + end
                    total = len(ids) // 4
                    cut = total - total % window
                    for start in range(0, cut, window):
                        full.append((doc, start, window, ids[4 * start:4 * (start + window)],
                                     total, base + seq, 0, window, window))
                        seq += 1
                    size += 4 * cut
                    if cut < total:
                        rest.append((doc, cut, ids[4 * cut:], total))
                if size > 4 << 20:
                    yield rows(full)
                    full, size = [], 0
            if full:
                yield rows(full)
            if len(rest) >= block:
                pieces, seq = pack(rest, seq)
                rest = []
                yield from packed(pieces)
            pa.default_memory_pool().release_unused()
        if rest:
            yield from packed(pack(rest, seq)[0])

    return docs.select(id_col, text_col).mapInArrow(run, PIECES)


def ids_crc32(pieces: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``pieces`` with the ids replaced by their unsigned CRC-32."""
    from pyspark.sql import functions as F
    return pieces.withColumn("ids_crc32", F.crc32(F.col(ids_col))).drop(ids_col)


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
