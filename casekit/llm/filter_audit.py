"""Filter interaction audit with wide packed counters.

Five filters look at every document.  In which order should they run, and what does each
remove that the others would not?  All orders are answered from one pass:

1. A document's failures are a mask, one bit a filter.  Filters A to D read its words and
   characters; E (an earlier copy exists) compares its SHA-256 with the least id of all rows
   of the same digest, an aggregate that is combined map-side.
2. Mask, quality label and toxicity label decide every outcome: kept, removed, redundant,
   good and toxic documents lost, for each step of each order (600 steps for five
   filters).  They are packed into one big integer a combination, a field of ``WIDTH`` bits
   for each outcome, and the integers of a part's documents are added up: one addition
   counts all outcomes at once.
3. Every task emits one integer a part; they are added in two rounds (first dealt by part
   and a salt) and unpacked.  A field never exceeds the number of documents, which is the
   topmost field and is checked, so no field runs over into the next.

Defined results
    * a null text is the empty text; a null part is the part ``''``;
    * a null id has no smaller id and is smaller than none: such rows never fail E;
    * rows that repeat an id are documents of their own; they don't make each other fail E;
    * a document with several label rows is good (toxic) if any of them says so;
    * an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import slices
from .common import ship, stored

FILTERS = "ABCDE"
WIDTH = 48                                # bits of a field: 2.8e14 documents a part
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")
_GOOD, _TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)


# ------------------------------------------------------------------ failures

def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the marked bytes lie in each row."""
    before = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return before[offsets[1:]] - before[offsets[:-1]]


def text_failures(texts, words: int = 100, distinct_pct: int = 80, upper_pct: int = 10,
                  symbols: bytes = b"#$%&*|") -> np.ndarray:
    """Bits A to D of each text of an Arrow array: few words, few distinct words, many
    capitals, any of some symbols."""
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    parts = pc.ascii_split_whitespace(texts)
    coded = parts.values.dictionary_encode()
    codes = coded.indices.to_numpy()
    owner = np.repeat(np.arange(n), np.diff(parts.offsets.to_numpy()))
    blank = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    if blank.any():
        real = ~blank[codes]
        codes, owner = codes[real], owner[real]
    n_words = np.bincount(owner, minlength=n)
    kinds = max(1, len(coded.dictionary))
    n_distinct = np.bincount(np.unique(owner * kinds + codes) // kinds, minlength=n)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n_upper = _per_row((data >= ord("A")) & (data <= ord("Z")), offsets)
    n_symbols = _per_row(np.isin(data, np.frombuffer(symbols, np.uint8)), offsets)
    n_points = pc.utf8_length(texts).to_numpy()
    return ((n_words < words) | (100 * n_distinct < distinct_pct * n_words) << 1
            | (100 * n_upper > upper_pct * n_points) << 2 | (n_symbols > 0) << 3).astype(np.int32)


def document_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """One row per document: id, part, mask of the failed filters."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for at, to in slices(b.column(2)):
                texts = b.column(2)[at:to]
                digests = [hashlib.sha256(t or b"").digest() for t in texts.cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[at:to], b.column(1)[at:to], pa.array(text_failures(texts)),
                     pa.array(digests, pa.binary())], ["id", "part", "mask", "digest"])

    seen = stored(rows.mapInArrow(run, "id long, part string, mask int, digest binary"), "masks")
    # written, so that the join shuffles both sides and AQE can split a hot digest
    first = stored(seen.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                   .where("least < most").select("digest", "least"), "firsts")
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return seen.join(first, "digest", "left").select(
        "id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


# ------------------------------------------------------------ packed counters

def filter_orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


def outcome_fields(mask: int, filters: str = FILTERS) -> list[int]:
    """The 0/1 fields of one document: outcomes of every step of every order, which filter
    it fails alone, and a one that counts it."""
    good, toxic = bool(mask & _GOOD), bool(mask & _TOXIC)
    fails = {f: mask >> k & 1 for k, f in enumerate(filters)}
    out = []
    for order in filter_orders(filters):
        gone = 0
        for f in order:
            removed, redundant = fails[f] & ~gone & 1, fails[f] & gone
            gone |= fails[f]
            out += [1 - gone, removed, redundant, removed & good, removed & toxic]
    alone = sum(fails.values()) == 1
    return [*out, *(int(alone and fails[f]) for f in filters), 1]


def pack(fields: list[int], width: int = WIDTH) -> int:
    """Field k in bits ``k * width`` and up."""
    size = width // 8
    return int.from_bytes(b"".join(v.to_bytes(size, "little") for v in fields), "little")


def unpack(total: int, n: int, width: int = WIDTH) -> list[int]:
    """The ``n`` fields of a sum; the topmost is the number of summands, which no other
    field can exceed."""
    if total >> (n * width):
        raise OverflowError(f"more than 2^{width} documents in a part")
    size = width // 8
    raw = total.to_bytes(n * size, "little")
    return [int.from_bytes(raw[k:k + size], "little") for k in range(0, n * size, size)]


def audit_rows(part: str, fields: list[int], filters: str = FILTERS) -> list[tuple]:
    """The rows of one part from its unpacked sums."""
    orders, k, m = filter_orders(filters), len(filters), len(OUTCOMES)
    unique = dict(zip(filters, fields[len(orders) * k * m:]))
    steps = [(order, s + 1, order[s], fields[(o * k + s) * m:(o * k + s + 1) * m])
             for o, order in enumerate(orders) for s in range(k)]
    shapley = dict.fromkeys(filters, 0)
    for _, _, f, values in steps:
        shapley[f] += values[1]
    return [(part, order, step, kept, removed, redundant, unique[f], good, toxic, shapley[f])
            for order, step, f, (kept, removed, redundant, good, toxic) in steps]


def _partial_sums(batches: Iterator, flush_parts: int = 256) -> Iterator:
    """``(part, mask)`` to ``(part, total)``: the summed integers of this task."""
    import pyarrow as pa
    packed: dict[int, int] = {}
    counts: dict[str, np.ndarray] = {}

    def emit() -> pa.RecordBatch:
        totals = []
        for n in counts.values():
            total = 0
            for m in np.flatnonzero(n).tolist():
                if m not in packed:
                    packed[m] = pack(outcome_fields(m))
                total += packed[m] * int(n[m])          # equal integers are added at once
            totals.append(total.to_bytes((total.bit_length() + 7) // 8, "little"))
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                          pa.array(totals, pa.binary())], ["part", "total"])
        counts.clear()
        return out

    for b in batches:
        coded = b.column(0).dictionary_encode()
        names, codes, masks = coded.dictionary.to_pylist(), coded.indices.to_numpy(), b.column(1).to_numpy()
        both = np.bincount(codes * (2 * _TOXIC) + masks, minlength=len(names) * 2 * _TOXIC)
        for name, n in zip(names, both.reshape(len(names), 2 * _TOXIC)):
            if name in counts:
                counts[name] += n
            else:
                if len(counts) >= flush_parts:
                    yield emit()
                counts[name] = n.copy()
    if counts:
        yield emit()


def _added(rows: Iterator) -> Iterator[tuple[str, int]]:
    """Sums of ``(part, total)`` rows that come sorted by part."""
    part, total = None, 0
    for b in rows:
        for p, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if p != part and part is not None:
                yield part, total
                total = 0
            part = p
            total += int.from_bytes(raw, "little")
    if part is not None:
        yield part, total


def interaction_audit(marked: DataFrame, salts: int = 32) -> DataFrame:
    """``(part, mask)`` rows to one row per part, filter order and step.  Bits of the mask:
    the failed filters, then a good and a toxic label."""
    n = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_fields = len(outcome_fields(0))

    def first(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for part, total in _added(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.string()),
                 pa.array([total.to_bytes((total.bit_length() + 7) // 8, "little")], pa.binary())],
                ["part", "total"])

    def last(batches: Iterator) -> Iterator:
        import pyarrow as pa
        names = [c.split()[0] for c in RESULT.split(", ")]
        kinds = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]]
                 for c in RESULT.split(", ")]
        for part, total in _added(batches):
            columns = zip(*audit_rows(part, unpack(total, n_fields)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    sums = (marked.select("part", "mask").mapInArrow(_partial_sums, "part string, total binary")
            .withColumn("salt", F.spark_partition_id() % salts))
    sums = (sums.repartition(n, "part", "salt").sortWithinPartitions("part").select("part", "total")
            .mapInArrow(first, "part string, total binary"))
    return sums.repartition(n, "part").sortWithinPartitions("part").mapInArrow(last, RESULT)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """The audit of the five filters over all documents, part by part."""
    masks = document_masks(docs, id_col, text_col, part_col)
    # written, so that the join shuffles both sides and AQE can split a hot id
    lost = stored(labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, _GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, _TOXIC).otherwise(0)).alias("toxic"))
        .select("id", (F.col("good") + F.col("toxic")).alias("lost")).where("lost > 0"), "lost")
    return interaction_audit(masks.join(lost, "id", "left").select(
        "part", (F.col("mask") + F.coalesce("lost", F.lit(0))).cast("int").alias("mask")))
