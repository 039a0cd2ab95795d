"""N-gram Jaccard join with a MinHash LSH forest.

1. Each text is cut into words at ASCII white space, in lower case; its shingles are its
   distinct runs of five words, as 64-bit hashes.  Texts with the same shingle set are one
   node (told apart by a 64-bit digest of the set).
2. A node's signature is ``trees`` strings of ``depth`` minima under multiplicative
   permutations, 16 bits a letter.  The strings of each tree are sorted (one range shuffle
   for all trees): that order is the tree's prefix trie, and nodes that share a prefix stand
   side by side.
3. The matched prefix is the longest that lets every pair meet with at least the target recall:
   a pair at the threshold shares a prefix in some tree with a chance that follows from the
   threshold, the prefix and the number of trees, and a closer pair with a greater one.  No
   document is sampled for it.
4. Each trie node of the matched prefix gives a star of its members.  Trees are contracted one
   after the other: an edge counts only if its ends are still in different components, so a
   group of near copies costs about one edge a member, not one a member and tree.
5. Exact verification: a component is dealt into blocks of bounded size, every pair of
   blocks is one group, and the intersections of its sets come from products of 0/1
   matrices over the shingles they have in common.  A group returns, for each node, how
   many documents it is linked to, and a spanning forest of the links, never the pairs.
6. Components of the verified links are the classes.

Result: one row per document: ``rep_id`` (least document with the same shingle set),
``class_id`` (least document of the class), ``n_links`` (other documents at the threshold
or above, copies included).

Defined results
    * null texts and texts without a word have no shingles: a class of their own, no links;
    * a text of one to four words has one shingle, all its words;
    * rows that repeat a document are documents of their own that link to each other;
    * null ids are the least ids, and stay null; other columns are ignored;
    * an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import slices
from .common import one_of_each, ship, stored, unused
from .graph import connected_components

NO_ID = -(1 << 63)                     # stands for a null document id inside

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of an Arrow array."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash
    texts = pc.utf8_lower(texts.cast(pa.string()).fill_null(""))
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy().astype(np.int64)
    words = parts.values.dictionary_encode()
    if not len(words):
        return [np.empty(0, np.uint64)] * len(texts)
    known = words.dictionary.to_pylist()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for w in known), np.uint64, len(known))
    codes = words.indices.to_numpy()
    h = hashes[codes]
    real = (np.array([bool(w) for w in known])[codes] if "" in known
            else None)                                   # empty strings are not words
    if real is not None:
        before = np.concatenate([[0], np.cumsum(real)])
        h, ends = h[real], before[ends]
    rolled = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        rolled = rolled * _MIX[0] + h[k:k + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= n:
            s = np.sort(rolled[a:b - n + 1])
            if len(s) > 1:
                keep = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                s = s[keep]
            out.append(s)
        elif b > a:
            x = np.array([b - a], np.uint64)
            for v in h[a:b]:
                x = x * _MIX[0] + v
            out.append(mixed(x))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_digest(s: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def multipliers(n: int, seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(s: np.ndarray, by: np.ndarray, block: int = 1024) -> np.ndarray:
    """Least value of the set under each permutation."""
    best = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), block):
            np.minimum(best, np.multiply.outer(by, s[at:at + block]).min(axis=1), out=best)
    return best


def letters(s: np.ndarray, by: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """The signature as ``(trees, depth)`` letters."""
    return mixed(signature(s, by)).astype(np.uint16).reshape(trees, depth)


def recall(threshold: float, trees: int, prefix: int) -> float:
    """Chance that two sets at the threshold share a prefix of this length in some tree."""
    return 1.0 - (1.0 - threshold ** prefix) ** trees


def matched_prefix(links: list[int], threshold: float, trees: int, target: float,
                   floor_recall: float) -> int:
    """The prefix, shortened from the full depth until the target recall is reached.

    ``links[k]``: how many true links of the sample have a longest common prefix of ``k``
    letters (the best of all trees)."""
    total, found = sum(links), 0
    for prefix in range(len(links) - 1, 1, -1):
        found += links[prefix]
        if found >= target * total and recall(threshold, trees, prefix) >= floor_recall:
            return prefix
    return 1


def sure_prefix(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix by which a pair at the threshold meets with the target recall."""
    return max((p for p in range(1, depth + 1) if recall(threshold, trees, p) >= target), default=1)


class Sample:
    """Shingle sets of some documents, to find their true links among all rows.  A means to
    measure the recall; the join takes nothing from it."""

    def __init__(self, texts, by: np.ndarray, trees: int, depth: int, n: int, threshold: float):
        sets = [s for s in shingle_sets(texts, n) if len(s)]
        self.digests = [set_digest(s) for s in sets]
        first = {d: k for k, d in enumerate(self.digests)}          # a set counts once
        sets = [sets[k] for k in sorted(first.values())]
        self.digests = np.array([self.digests[k] for k in sorted(first.values())], np.int64)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.letters = np.array([letters(s, by, trees, depth) for s in sets],
                                np.uint16).reshape(-1, trees, depth)
        flat = np.concatenate([*sets, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.shingles, self.at = np.unique(flat[order], return_index=True)
        self.at = np.append(self.at, len(flat))
        self.threshold, self.depth = threshold, depth

    def links(self, s: np.ndarray, digest: int, own: np.ndarray) -> list[int] | None:
        """Number of the sample's sets linked to ``s``, by longest common prefix."""
        if not len(self.shingles):
            return None
        k = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        k = k[self.shingles[k] == s]
        if len(k) < self.threshold * len(s) - 1e-9:                 # too few for any set
            return None
        common = np.zeros(len(self.sizes), np.int64)
        for a, b in zip(self.at[k].tolist(), self.at[k + 1].tolist()):
            common[self.owner[a:b]] += 1
        linked = ((common >= self.threshold * (self.sizes + len(s) - common) - 1e-9)
                  & (self.digests != digest))
        if not linked.any():
            return None
        same = np.cumprod(self.letters[linked] == own, axis=2).sum(axis=2).max(axis=1)
        return np.bincount(same, minlength=self.depth + 1).tolist()


def sketch(docs: DataFrame, trees: int, depth: int, n: int) -> DataFrame:
    """Per row ``(id, text key)``: set digest, set size, signature letters (big-endian, tree
    by tree)."""
    by = multipliers(trees * depth)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for at, to in slices(b.column(2)):
                sets = shingle_sets(b.column(2)[at:to], n)
                sids = [set_digest(s) if len(s) else None for s in sets]
                own = [letters(s, by, trees, depth) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[at:to], b.column(1)[at:to], pa.array(sids, pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([None if x is None else x.astype(">u2").tobytes() for x in own], pa.binary())],
                    ["id", "key", "sid", "n", "letters"])

    return docs.select("id", "key", "text").mapInArrow(
        run, "id long, key long, sid long, n long, letters binary")


# ---------------------------------------------------------------- prefix tries

def trie_edges(nodes: DataFrame, trees: int, depth: int, prefix: int) -> DataFrame:
    """``(sid, letters)`` to ``(a, b, tree)``: the star of each trie node of the matched
    prefix; a pair that several trees give comes once, with the first of them."""
    spark, width, matched = nodes.sparkSession, 2 * depth, 2 * prefix

    def strings(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            raw = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8)
            raw = np.ascontiguousarray(raw.reshape(-1, trees, width)[:, :, :matched])
            count = raw.shape[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype=np.int32), count)),
                 pa.Array.from_buffers(pa.binary(matched), count * trees, [None, pa.py_buffer(raw)]).cast(pa.binary()),
                 pa.array(np.repeat(b.column(0).to_numpy(), trees))], ["tree", "string", "sid"])

    def stars(batches: Iterator) -> Iterator:
        """Sorted strings to edges from the head of each run of equal ones.  The first and
        last string of the partition also come out: a run may go on in the next one."""
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        first = last = None
        names = ["a", "b", "tree", "string", "part"]

        def edge(a, b, tree, strings=None, parts=None):
            k = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tree, pa.int32()),
                 pa.array(strings or [None] * k, pa.binary()), pa.array(parts or [None] * k, pa.int64())], names)

        for b in batches:
            if not b.num_rows:
                continue
            tree, sid = b.column(0).to_numpy(), b.column(2).to_numpy()
            text = np.array(b.column(1).to_pylist(), object)
            new = np.ones(len(sid), bool)
            new[1:] = (tree[1:] != tree[:-1]) | (text[1:] != text[:-1])
            head = sid.copy()
            new_at = np.maximum.accumulate(np.where(new, np.arange(len(sid)), 0))
            head = sid[new_at]
            if last is not None and (last[0], last[1]) == (tree[0], text[0]):
                head[new_at == 0] = last[2]                       # goes on from the batch before
            first = first or (int(tree[0]), text[0], int(sid[0]))
            last = (int(tree[-1]), text[-1], int(head[-1]))
            pick = head != sid
            yield edge(np.minimum(head, sid)[pick], np.maximum(head, sid)[pick], tree[pick])
        if first:
            yield edge([first[2], last[2]], [None, None], [first[0], last[0]], [first[1], last[1]],
                       [2 * part, 2 * part + 1])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("sid", "letters").mapInArrow(strings, "tree int, string binary, sid long")
    found = stored(rows.repartitionByRange(n, "tree", "string", "sid")
                   .sortWithinPartitions("tree", "string", "sid")
                   .mapInArrow(stars, "a long, b long, tree int, string binary, part long"), "stars")
    # two rows a partition: runs that go on from one partition to the next
    ends = sorted((r.part, r.tree, bytes(r.string), r.a)
                  for r in found.where("part IS NOT NULL").select("part", "tree", "string", "a").collect())
    across = [(min(x[3], y[3]), max(x[3], y[3]), x[1]) for x, y in zip(ends, ends[1:])
              if x[0] % 2 and x[1:3] == y[1:3] and x[3] != y[3]]
    edges = found.where("part IS NULL").select("a", "b", "tree").unionByName(
        spark.createDataFrame(across, "a long, b long, tree int"))
    return edges.groupBy("a", "b").agg(F.min("tree").alias("tree"))


def contracted(edges: DataFrame, trees: int) -> DataFrame:
    """Components ``(node, label)`` of ``(a, b, tree)`` edges, some trees after the others.

    The first tree's stars are components already.  For the next ones an edge is looked up in
    the components so far, and only edges between different ones are left.
    """
    edges, labels = stored(edges, "edges"), None
    for first, end in ((0, 1), (1, 4), (4, 12), (12, trees)):
        part = edges.where((F.col("tree") >= first) & (F.col("tree") < end)).select("a", "b")
        if labels is not None:
            for end_name in ("a", "b"):
                at = labels.select(F.col("node").alias(end_name), F.col("label").alias("to"))
                part = part.join(at, end_name, "left").withColumn(
                    end_name, F.coalesce("to", end_name)).drop("to")
            part = part.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        merged = connected_components(part)
        if labels is None:
            labels = merged
        else:
            moved = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
            own = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = stored(own.unionByName(merged.join(labels.select("node"), "node", "left_anti")), "labels")
    return labels


# ------------------------------------------------------------- exact verification

class Side:
    """Sets of one block, largest first, in slices that share a sorted shingle list."""

    def __init__(self, sets: list[np.ndarray], weights: np.ndarray, sids: np.ndarray, rows: int = 256):
        order = sorted(range(len(sets)), key=lambda k: -len(sets[k]))
        self.sets = [sets[k] for k in order]
        self.weights, self.sids = weights[order], sids[order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.slices = []
        for at in range(0, len(order), rows):
            part = self.sets[at:at + rows]
            flat = np.concatenate(part)
            owner = np.repeat(np.arange(len(part)), self.sizes[at:at + rows])
            by = np.argsort(flat, kind="stable")
            flat, owner = flat[by], owner[by]
            self.slices.append((at, at + len(part), flat, owner))


def _incidence(flat, owner, rows: int, columns: np.ndarray) -> np.ndarray:
    """0/1 matrix of a slice over some shingles (sorted)."""
    x = np.zeros((rows, len(columns)), np.float32)
    lo = np.searchsorted(flat, columns, side="left")
    hi = np.searchsorted(flat, columns, side="right")
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    x[owner[at], np.repeat(np.arange(len(columns)), n)] = 1.0
    return x


def linked(left: Side, right: Side, threshold: float, width: int = 4096) -> np.ndarray:
    """Boolean matrix: which sets of the two sides reach the threshold."""
    out = np.zeros((len(left.sets), len(right.sets)), bool)
    for a, b, flat, owner in left.slices:
        for c, d, flat2, owner2 in right.slices:
            n1, n2 = left.sizes[a:b], right.sizes[c:d]
            if n1[0] < threshold * n2[-1] or n2[0] < threshold * n1[-1]:
                continue                              # no sizes here are close enough
            common = np.intersect1d(flat, flat2)
            if not len(common):
                continue
            both = np.zeros((b - a, d - c), np.float64)
            for at in range(0, len(common), width):
                columns = common[at:at + width]
                x = _incidence(flat, owner, b - a, columns)
                y = x if flat is flat2 else _incidence(flat2, owner2, d - c, columns)
                both += x @ y.T
            out[a:b, c:d] = both >= threshold * (n1[:, None] + n2[None, :] - both) - 1e-9
    return out


def forest(match: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, root) of a spanning forest of the links between two lists of nodes."""
    big = np.iinfo(np.int64).max
    la, lb = left.copy(), right.copy()
    while True:
        na = np.minimum(la, np.where(match, lb[None, :], big).min(axis=1, initial=big))
        nb = np.minimum(lb, np.where(match, na[:, None], big).min(axis=0, initial=big))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return [(int(x), int(r)) for x, r in zip(np.concatenate([left, right]),
                                             np.concatenate([la, lb])) if x != r]


def verify_group(rows: list[tuple], diagonal: bool, threshold: float) -> Iterator[tuple]:
    """Rows ``(sid, side, weight, set)`` of one pair of blocks to
    ``(sid, linked documents, None)`` and ``(sid, None, root)``."""
    sides = []
    for side in (0, 1):
        own = {r[0]: r for r in rows if r[1] == side}.values()      # a set stands once
        sides.append(Side([r[3] for r in own], np.array([r[2] for r in own], np.int64),
                          np.array([r[0] for r in own], np.int64)))
    left, right = sides[0], sides[0] if diagonal else sides[1]
    if not left.sets or not right.sets:
        return
    match = linked(left, right, threshold)
    if diagonal:
        np.fill_diagonal(match, False)
    for side, m, other in ((left, match, right),) if diagonal else (
            (left, match, right), (right, match.T, left)):
        for sid, n in zip(side.sids.tolist(), (m @ other.weights).tolist()):
            if n:
                yield sid, int(n), None
    for sid, root in forest(match, left.sids, right.sids):
        yield sid, None, root


def verified_links(payload: DataFrame, threshold: float) -> DataFrame:
    """``(cid, i, j, sid, side, weight, shingles)`` to link counts and forest edges."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
        key, rows = None, []

        def done():
            out = list(verify_group(rows, key[1] == key[2], threshold)) if rows else []
            columns = list(zip(*out)) if out else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        for b in batches:
            for cid, i, j, sid, side, weight, raw in zip(*(c.to_pylist() for c in b.columns)):
                if key != (cid, i, j):
                    if rows:
                        yield done()
                    key, rows = (cid, i, j), []
                rows.append((sid, side, weight, np.frombuffer(raw, np.uint64)))
        if rows:
            yield done()

    n = int(payload.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (payload.repartition(n, "cid", "i", "j").sortWithinPartitions("cid", "i", "j", "sid")
            .mapInArrow(run, "sid long, n long, root long"))


def _payload(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Shingle sets of the wanted nodes, once for each pair of blocks that they are in.
    ``wanted``: sid, rep, rep_key, copies, weight, cid, blocks."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for at, to in slices(b.column(0)):
                part = b.slice(at, to - at)
                sets = shingle_sets(part.column(0), n)
                ok = [len(s) > 0 and set_digest(s) == sid
                      for s, sid in zip(sets, part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(1, 5)),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["sid", "weight", "cid", "blocks", "shingles"]).filter(pa.array(ok, pa.bool_()))

    wanted = stored(wanted, "wanted")
    # shuffled at every size, so that AQE can split a hot id and cost grows with the input
    texts = docs.join(wanted.hint("merge"), (docs.id == wanted.rep) & (docs.key == wanted.rep_key))
    if not wanted.where("copies > 1").isEmpty():           # rows that repeat id and text
        texts = texts.where("copies = 1").unionByName(
            one_of_each(texts.where("copies > 1"), [F.col("sid")]))
    sets = texts.select("text", "sid", "weight", "cid", "blocks").mapInArrow(run, "sid long, weight long, cid long, blocks long, shingles binary")
    own = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    return (sets.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("cid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    "sid", (F.col("own") > F.col("other")).cast("int").alias("side"), "weight",
                    "shingles"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))


def classified(rows: DataFrame, threshold: float = 0.8, shingle: int = 5, trees: int = 32,
               depth: int = 8, target_recall: float = 0.999, block_sets: int = 1024,
               block_shingles: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """``(id, key, text)`` rows to their sketch ``(id, key, sid, ...)`` and the sets
    ``(sid, rep, weight, label, n_links)``; sets with one label are a class."""
    ship(rows.sparkSession)
    sketched = stored(sketch(rows, trees, depth, shingle), "sketch")
    prefix = sure_prefix(threshold, trees, depth, target_recall)
    # one node per set; the letters follow from the set, so any row's will do
    sets = sketched.where("sid IS NOT NULL")
    nodes = stored(sets.groupBy("sid", "id", "key").agg(
        F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")).groupBy("sid").agg(
        F.min(F.struct("id", "key", "copies")).alias("r"), F.sum("copies").alias("weight"),
        F.max("n").alias("n")).select("sid", F.col("r.id").alias("rep"), F.col("r.key").alias("rep_key"),
                                      F.col("r.copies").alias("copies"), "weight", "n"), "nodes")
    lettered = sets.select("sid", "id", "key", "letters").join(
        nodes.select("sid", F.col("rep").alias("id"), F.col("rep_key").alias("key")),
        ["sid", "id", "key"], "left_semi")
    found = contracted(trie_edges(lettered, trees, depth, prefix), trees)
    sized = nodes.join(found.withColumnRenamed("node", "sid"), "sid")
    blocks = stored(sized.groupBy("label").agg(F.greatest(
        F.ceil(F.sum("n") / block_shingles), F.ceil(F.count(F.lit(1)) / block_sets))
        .alias("blocks")), "blocks")
    wanted = sized.join(blocks, "label").select("sid", "rep", "rep_key", "copies", "weight",
                                                F.col("label").alias("cid"), "blocks")
    links = stored(verified_links(_payload(rows, wanted, shingle), threshold), "links")
    classes = connected_components(links.where("root IS NOT NULL").select(
        F.col("sid").alias("a"), F.col("root").alias("b")))
    counts = links.where("n IS NOT NULL").groupBy("sid").agg(F.sum("n").alias("n_links"))
    placed = (nodes.join(classes.withColumnRenamed("node", "sid"), "sid", "left")
              .join(counts, "sid", "left")
              .withColumn("label", F.coalesce("label", "sid")))
    return sketched, placed


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, rep_id, class_id, n_links (options: ``classified``)."""
    sketched, placed = classified(_rows(docs, id_col, text_col), **options)
    least = stored(placed.groupBy("label").agg(F.min("rep").alias("class_id")), "classes")
    by_set = placed.join(least, "label").select(
        "sid", "rep", "class_id",
        (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = sketched.select("id", "sid").join(by_set, "sid", "left")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(
        real("id").alias("doc_id"),
        F.when(F.col("rep").isNull(), real("id")).otherwise(real("rep")).alias("rep_id"),
        F.when(F.col("class_id").isNull(), real("id")).otherwise(real("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """The rows of ``docs``, with all columns, one of each class: the one with the least id
    (null is the least), then the least hash of its text.  Of rows that repeat both, one
    stays.  Rows without a word are in no class and stay."""
    sketched, placed = classified(_rows(docs, id_col, text_col), **options)
    # the id and the text's hash name a row up to repetition, and the set follows from them
    members = stored(sketched.where("sid IS NOT NULL").select("sid", "id", "key").join(
        placed.select("sid", "label"), "sid").groupBy("label", "id", "key").agg(
        F.count(F.lit(1)).alias("n")), "members")
    keepers = stored(members.groupBy("label").agg(F.min(F.struct("id", "key")).alias("k")), "keepers")
    stays = (F.col("id") == F.col("k.id")) & (F.col("key") == F.col("k.key"))
    marked = stored(members.join(keepers, "label").where(~stays | (F.col("n") > 1))
                    .select("id", "key", stays.alias("repeats")).distinct(), "marked")
    i, k = unused(docs, "id"), unused(docs, "key")
    own = (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col(i)) & (F.xxhash64(text_col) == F.col(k))
    named = lambda which: marked.where(which).select(F.col("id").alias(i), F.col("key").alias(k))
    out = docs.join(named("true"), own, "left_anti")
    if not marked.where("repeats").isEmpty():
        out = out.unionByName(one_of_each(docs.join(named("repeats"), own, "left_semi"),
                                          [F.col(id_col), F.xxhash64(text_col)]))
    return out
