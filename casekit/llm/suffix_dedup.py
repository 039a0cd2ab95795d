"""Removal of repeated passages with suffix arrays.

A byte is removed if some ``width``-byte string that covers it also starts earlier: in a
document with a smaller id, or earlier in the same one.  Strings are judged on the input.

1. *Anchors.*  Of the 32-byte hashes in a window of ``width`` bytes the least one (leftmost
   of ties) is its anchor.  Equal windows have equal anchors at the same offset, so windows
   that share an anchor occurrence form a segment, and a repeated string lies in segments
   of the same anchor hash.  An anchor that occurs once in the corpus is dropped; what is
   left is a small part of the text.
2. *Shards.*  The segments of the shared anchors are dealt by anchor hash.  Segments with
   the same bytes are collapsed first, in the map task and again in the shard; all their
   occurrences but the first are repeats as a whole.
3. *Suffix arrays.*  Where an anchor has different segments, a shard builds the suffix
   array of their bytes (Larsson-Sadakane), Kasai's common prefixes, and so the runs of
   equal windows; of each run the earliest start stays.  An anchor with more bytes than a
   shard holds is cut into several, and a shard's sorted distinct windows are looked up in
   those of the shards before it by binary search.
4. *Spans.*  Repeated spans return to their documents, which are read once more.

No step depends on chance: hashes only choose what meets where, bytes decide.

Hot anchors.  A map task sends one row for all its occurrences of an anchor, and one for
all its equal segments, so a passage in a third of all documents costs one row a task.
What remains distinct around a hot anchor is the edge of the passage with its different
surroundings; an anchor with more than ``hot`` occurrences is therefore cut into its
windows, which are dealt by their hash, one row a task for equal ones.  Shards of whole
hashes are resolved by suffix arrays and binary search like any other.

Defined results
    * null and empty texts have nothing to remove; a text shorter than ``width`` neither;
    * rows with the same id and text are one document and get the same result each; rows
      with the same id and different texts are ordered by a digest of the text;
    * a null id is less than any other; other columns are ignored;
    * an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ragged, slices
from .common import ship, stored, text_or_empty
from .ngram_join import NO_ID, mixed
from .suffix_array import common_prefixes, packed8, suffix_array

GRAM = 32
BLOCK = 1 << 15                 # positions hashed at a time
WINDOWS = 1 << 16               # of hot anchors, held at a time
RESULT = ("id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "removed array<struct<start:long,end:long>>, kept binary")
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0xD6E8FEB86659FD93)]


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position; the last 31 positions are meaningless."""
    n = len(buf)
    out = np.zeros(n, np.uint64)
    m = n - GRAM + 1
    for a in range(0, m, BLOCK):                 # blocks whose columns stay in the cache
        b = min(a + BLOCK, m)
        out[a:b] = _block_hashes(buf[a:b + GRAM - 1])
    return out


def _block_hashes(buf: np.ndarray) -> np.ndarray:
    """Hashes of the 32-byte strings of a short buffer."""
    eight = packed8(buf)
    m = len(buf) - GRAM + 1
    x = eight[:m] * _M[0]
    high = np.empty_like(x)
    for k in (1, 2, 3):
        np.right_shift(x, np.uint64(29), out=high)
        x ^= high
        x += eight[8 * k:8 * k + m]
        x *= _M[k]
    return mixed(x)


def window_hashes(grams: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place, from the hashes of 32-byte strings."""
    steps = [*range(0, width - GRAM, GRAM), width - GRAM]
    out = np.zeros(len(at), np.uint64)
    for k in steps:
        out = mixed(out * _M[1] + grams[at + k])
    return out


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each window of ``w``, by windows of doubling width: len(x) - w + 1 values."""
    k = 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:len(x) - (w - k)], x[w - k:]) if k < w else x


def anchor_runs(buf: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one buffer that have the same anchor occurrence, texts aside: first
    window, the anchor's place and its hash.  Goes in blocks whose columns stay in the cache."""
    # the position in the block below the hash breaks ties to the left
    low = np.uint64((1 << 26) - 1)
    w = width - GRAM + 1
    windows = len(buf) - width + 1
    starts, anchors, hashes, last = [], [], [], -1
    for a in range(0, windows, BLOCK):
        b = min(a + BLOCK, windows)
        h = _block_hashes(buf[a:b + width - 1])
        keyed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        least = sliding_least(keyed, w)
        new = np.ones(b - a, bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        lo = np.flatnonzero(new)
        at = (least[lo] & low).astype(np.int64)
        if at[0] + a == last:                    # the run goes on from the block before
            lo, at = lo[1:], at[1:]
        if len(at):
            last = at[-1] + a
        starts.append(lo + a)
        anchors.append(at + a)
        hashes.append(h[at])
    return tuple(np.concatenate(c) for c in (starts, anchors, hashes))


def segments(buf: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts that lie one after the other in ``buf``: text number, start in
    the text, end in the text (of the last window), anchor hash.  ``ends``: text offsets."""
    if len(buf) < width:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    start, _, anchor = anchor_runs(buf, width)
    stop = np.append(start[1:], len(buf) - width + 1)
    # the windows of each text are cut out of the runs
    first, over = ends[:-1], ends[1:] - width + 1
    text = np.flatnonzero(over > first)
    lo = np.searchsorted(start, first[text], side="right") - 1
    n = np.searchsorted(start, over[text], side="left") - lo
    run = ragged(lo, n)
    text = np.repeat(text, n)
    begin = np.maximum(start[run], first[text])
    end = np.minimum(stop[run], over[text])
    return text, begin - first[text], end - 1 - first[text] + width, anchor[run]


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string array without nulls, and the offsets of its texts."""
    import pyarrow as pa
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts_of(texts, width: int, max_bytes: int = 4 << 20) -> Iterator[tuple]:
    """Slices of texts for ``segments``; a very long text is cut into overlapping pieces.
    Yields (rows of the slice, offset in the text, bytes, ends)."""
    for at, to in slices(texts, max_bytes):
        buf, ends = joined(texts[at:to])
        if len(buf) < 1 << 25:
            yield np.arange(at, to), 0, buf, ends
            continue
        for row in range(at, to):
            own = buf[ends[row - at]:ends[row - at + 1]]
            for lo in range(0, max(1, len(own) - width + 1), 1 << 24):
                piece = own[lo:lo + (1 << 24) + width - 1]
                yield np.array([row]), lo, piece, np.array([0, len(piece)])


# ---------------------------------------------------------------- shared anchors

def anchor_rows(texts: DataFrame, width: int) -> DataFrame:
    """Per map slice: for each anchor hash one row to be compared (``key`` the hash, ``n``
    its occurrences in the slice), and for every other occurrence a row that is known to be
    shared and only travels (``key`` its document's, ``hash`` set)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            ids = b.column(0).to_numpy()
            for rows, _, buf, ends in parts_of(b.column(1), width):
                text, _, _, h = segments(buf, ends, width)
                if not len(h):
                    continue
                own = ids[rows[text]]
                order = np.argsort(h, kind="stable")
                h, own = h[order], own[order]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                n = np.diff(np.concatenate([np.flatnonzero(new), [len(h)]]))
                # once a document is enough for the others
                more = ~new
                more[1:] &= (own[1:] != own[:-1])
                key = np.where(new, h, mixed(own.view(np.uint64)))
                count = np.zeros(len(h), np.int64)
                count[new] = n
                take = new | more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[take].view(np.int64)), pa.array(own[take]),
                     pa.array(h[take].view(np.int64), mask=new[take]), pa.array(count[take])],
                    ["key", "id", "hash", "n"])

    return texts.select("id", "text").mapInArrow(run, "key long, id long, hash long, n long")


def shared_anchors(rows: DataFrame, hot: int) -> DataFrame:
    """``(id, hash, hot)`` of anchors that occur more than once; ``id`` null marks a hash
    with more than ``hot`` occurrences.  Streams over rows sorted by key."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kept = [np.empty(0, np.int64)] * 3                 # the last run of the batch before

        def settle(key, own, n, last: bool):
            """Shared rows and hot hashes of all runs, but the last one if more may come."""
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            if not last and len(starts):
                cut = starts[-1]
                rest = [key[cut:], own[cut:], n[cut:]]
                key, own, n, starts = key[:cut], own[:cut], n[:cut], starts[:-1]
            else:
                rest = [key[:0], own[:0], n[:0]]
            if not len(key):
                return rest, None
            total = np.add.reduceat(n, starts)
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            ok = np.repeat(total > 1, sizes)
            heavy = key[starts][total > hot]
            return rest, (own[ok], key[ok], heavy)

        def batch(own, key, heavy):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own, np.zeros(len(heavy), np.int64)]),
                          mask=np.concatenate([np.zeros(len(own), bool), np.ones(len(heavy), bool)])),
                 pa.array(np.concatenate([key, heavy]))], ["id", "hash"])

        for b in batches:
            hashes = b.column(2)
            known = hashes.is_valid().to_numpy(zero_copy_only=False)
            key, own, n = (b.column(k).to_numpy() for k in (0, 1, 3))
            if known.any():
                yield batch(own[known], hashes.drop_null().to_numpy(), np.empty(0, np.int64))
                key, own, n = key[~known], own[~known], n[~known]
            kept, done = settle(*(np.concatenate([x, y]) for x, y in zip(kept, (key, own, n))), False)
            if done:
                yield batch(*done)
        _, done = settle(*kept, True)
        if done:
            yield batch(*done)

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(width, "key").sortWithinPartitions("key")
            .mapInArrow(run, "id long, hash long"))


# ------------------------------------------------------------- segments to spans

_SEGMENT = "key long, window boolean, bytes binary, id long, h long, start long, end long"
_SPAN = "id long, h long, start long, end long"


def _doc_key(ids: np.ndarray) -> np.ndarray:
    """Where rows go that only travel: by document."""
    return mixed(ids.view(np.uint64)).view(np.int64)


def _binary(raw: np.ndarray, lo: np.ndarray, sizes: np.ndarray):
    """Arrow array of the byte strings raw[lo:lo + size]."""
    import pyarrow as pa
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = raw[ragged(lo, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _firsts(group: tuple, place: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the earliest place of each group, and of the others whose place is later;
    rows are given by parallel key columns, a group by equal ``group`` columns."""
    order = np.lexsort((*place[::-1], *group[::-1]))
    n = len(order)
    new = np.ones(n, bool)
    again = np.zeros(n, bool)
    if n > 1:
        same = np.ones(n - 1, bool)
        for c in group:
            c = c[order]
            same &= c[1:] == c[:-1]
        new[1:] = ~same
        for c in place:
            c = c[order]
            same &= c[1:] == c[:-1]
        again[1:] = same                        # the same place twice is one occurrence
    return order[new], order[~new & ~again]


def _segment_batches(data, key, window: bool, i, h, start, end) -> Iterator:
    """Rows for the shards: of equal byte strings the first place with its bytes, by key;
    the others only travel, by document."""
    import pyarrow as pa
    code = data.dictionary_encode().indices.to_numpy()
    first, later = _firsts((code,), (i, h, start))
    for r, whole in ((first, True), (later, False)):
        if len(r):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[r].view(np.int64) if whole else _doc_key(i[r])),
                 pa.array(np.full(len(r), window)),
                 data.take(r) if whole else pa.nulls(len(r), pa.binary()),
                 *(pa.array(x[r]) for x in (i, h, start, end))],
                ["key", "window", "bytes", "id", "h", "start", "end"])


def segment_rows(texts: DataFrame, width: int) -> DataFrame:
    """``(id, h, text, hashes, heavy)`` to rows for the shards: distinct segments of shared
    anchors with their first place in the slice; windows of heavy anchors likewise, by
    digest; and spans that are known to repeat something in the slice."""
    def run(batches: Iterator) -> Iterator:
        for b in batches:
            ids, hs = b.column(0).to_numpy(), b.column(1).to_numpy()
            for rows, shift, buf, ends in parts_of(b.column(2), width):
                text, lo, hi, anchor = segments(buf, ends, width)
                # whether an anchor is shared (or heavy) is the same in every text
                own = slice(int(rows[0]), int(rows[-1]) + 1)
                shared, heavy = (np.unique(b.column(c)[own].flatten().to_numpy()).view(np.uint64)
                                 for c in (3, 4))
                keep = np.isin(anchor, shared)
                text, lo, hi, anchor = text[keep], lo[keep], hi[keep], anchor[keep]
                i, h, at = ids[rows[text]], hs[rows[text]], ends[text] + lo
                start, size = lo + shift, hi - lo
                hot = np.isin(anchor, heavy)
                some = np.flatnonzero(~hot)
                if len(some):
                    yield from _segment_batches(
                        _binary(buf, at[some], size[some]), anchor[some], False, i[some],
                        h[some], start[some], start[some] + size[some])
                some = np.flatnonzero(hot)
                if not len(some):
                    continue
                grams = gram_hashes(buf)
                windows = np.cumsum(size[some] - width + 1)
                # windows hold their bytes: a bounded number at a time
                for lo in np.flatnonzero(np.diff(windows // WINDOWS, prepend=-1)):
                    part = some[lo:][:np.searchsorted(windows, (windows[lo] // WINDOWS + 1) * WINDOWS) - lo]
                    n = size[part] - width + 1
                    of = np.repeat(part, n)
                    x = ragged(np.zeros(len(part), np.int64), n).astype(np.int64)
                    p, ws = at[of] + x, start[of] + x
                    yield from _segment_batches(
                        _binary(buf, p, np.full(len(p), width)), window_hashes(grams, p, width),
                        True, i[of], h[of], ws, ws + width)

    return texts.select("id", "h", "text", "hashes", "heavy").mapInArrow(run, _SEGMENT)


class Shard:
    """Repeated windows among distinct segments.  ``segs``: (bytes, (id, h, start))."""

    def __init__(self, segs: list[tuple[bytes, tuple]], width: int):
        self.width = width
        self.buf = np.frombuffer(b"".join(s for s, _ in segs), np.uint8)
        sizes = np.array([len(s) for s, _ in segs], np.int64)
        begin = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(segs)), sizes)
        self.within = np.arange(len(self.buf)) - begin[self.owner]
        place = np.array([p for _, p in segs], np.int64).reshape(len(segs), 3)
        self.place = place
        # documents in order, so that (document, start) is one number
        docs = np.lexsort((place[:, 1], place[:, 0]))
        new = np.ones(len(docs), bool)
        new[1:] = (place[docs[1:], :2] != place[docs[:-1], :2]).any(axis=1)
        self.doc_rank = np.empty(len(docs), np.int64)
        self.doc_rank[docs] = np.cumsum(new)
        window = sizes[self.owner] - self.within >= width
        sa = suffix_array(self.buf)
        lcp = common_prefixes(self.buf, sa, width)
        # runs of equal windows; a suffix between two equal windows equals them too
        run = np.cumsum(lcp < width)
        ok = window[sa]
        self.at, self.run = sa[ok], run[ok]

    def earliest(self) -> tuple[np.ndarray, np.ndarray]:
        """Which windows start first in their run, and the places of all windows."""
        owner = self.owner[self.at]
        start = self.place[owner, 2] + self.within[self.at]
        key = (self.doc_rank[owner] << 33) + start          # texts are shorter than 8 GB
        if not len(key):
            return np.empty(0, bool), np.empty((0, 3), np.int64)
        new = np.ones(len(key), bool)
        new[1:] = self.run[1:] != self.run[:-1]
        least = np.minimum.reduceat(key, np.flatnonzero(new))
        return key == least[np.cumsum(new) - 1], np.column_stack(
            [self.place[owner, 0], self.place[owner, 1], start])

    def strings(self, at: np.ndarray) -> np.ndarray:
        """The windows as fixed-length byte strings (in suffix order they are sorted)."""
        rows = np.lib.stride_tricks.sliding_window_view(self.buf, self.width)[at]
        return np.ascontiguousarray(rows).view(f"V{self.width}").ravel()


def _words(strings: np.ndarray, width: int) -> np.ndarray:
    """Byte strings as rows of big-endian words, whose order is the byte order."""
    pad = -width % 8
    raw = strings.view(np.uint8).reshape(len(strings), width)
    if pad:
        raw = np.concatenate([raw, np.zeros((len(raw), pad), np.uint8)], axis=1)
    return np.ascontiguousarray(raw).view(">u8")


def binary_search(sorted_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Index of each row in the sorted rows, or -1; one bisection for all rows at once."""
    lo, hi = np.zeros(len(words), np.int64), np.full(len(words), len(sorted_words), np.int64)
    while (lo < hi).any():
        mid = np.minimum((lo + hi) // 2, max(0, len(sorted_words) - 1))
        other = sorted_words[mid]
        differ = other != words
        k = differ.argmax(axis=1)
        rows = np.arange(len(words))
        less = differ.any(axis=1) & (other[rows, k] < words[rows, k])
        go = lo < hi
        lo = np.where(go & less, mid + 1, lo)
        hi = np.where(go & ~less, mid, hi)
    found = np.minimum(lo, max(0, len(sorted_words) - 1))
    same = (lo < len(sorted_words)) & (sorted_words[found] == words).all(axis=1) if len(sorted_words) \
        else np.zeros(len(words), bool)
    return np.where(same, found, -1)


def repeated_windows(segs: list[tuple[bytes, tuple]], width: int, shard_bytes: int) -> Iterator[np.ndarray]:
    """Places (id, h, start) of the windows that also start earlier, by shards."""
    shards, part, size = [], [], 0
    for s in segs:
        if part and size + len(s[0]) > shard_bytes:
            shards.append(part)
            part, size = [], 0
        part.append(s)
        size += len(s[0])
    if part:
        shards.append(part)
    before: list[list] = []       # of earlier shards: sorted distinct windows, their first places
    for segs in shards:
        shard = Shard(segs, width)
        first, place = shard.earliest()
        yield place[~first]
        if len(shards) == 1:
            return
        words, own = _words(shard.strings(shard.at[first]), width), place[first]
        for at, (known, places) in enumerate(before):
            hit = binary_search(known, words)
            here, there = np.flatnonzero(hit >= 0), hit[hit >= 0]
            mine, theirs = own[here], places[there]
            later = _after(mine, theirs)
            yield mine[later]
            yield theirs[~later]
            # the earlier place stands for both, in one shard only
            keep = np.ones(len(known), bool)
            keep[there[~later]] = False
            before[at] = [known[keep], places[keep]]
            keep = np.ones(len(own), bool)
            keep[here[later]] = False
            words, own = words[keep], own[keep]
        before.append([words, own])


def _after(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise a > b."""
    out = np.zeros(len(a), bool)
    tie = np.ones(len(a), bool)
    for k in range(a.shape[1]):
        out |= tie & (a[:, k] > b[:, k])
        tie &= a[:, k] == b[:, k]
    return out


def spans_of_windows(places: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Columns (id, h, start, end) of spans that cover the windows at these places."""
    p = places[np.lexsort(places.T[::-1])]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:, 0] != p[:-1, 0]) | (p[1:, 1] != p[:-1, 1]) | (p[1:, 2] > p[:-1, 2] + width)
    lo = np.flatnonzero(new)
    hi = np.concatenate([lo[1:], [len(p)]]) - 1
    return p[lo, 0], p[lo, 1], p[lo, 2], p[hi, 2] + width


def resolve(rows: DataFrame, width: int, shard_bytes: int) -> DataFrame:
    """Rows for the shards to repeated spans.  Rows come sorted: segments by anchor, then
    hot windows by hash and rows that only travel; a group that a batch cuts is held over
    to the next one."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        shard, size = [], 0

        def spans(i, h, start, end):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (i, h, start, end)],
                                              ["id", "h", "start", "end"])

        def columns(t, *names):
            return tuple(t.column(n).to_numpy() for n in names)

        def flush_shard():
            nonlocal shard, size
            for places in repeated_windows(shard, width, shard_bytes) if shard else ():
                if len(places):
                    yield spans(*spans_of_windows(places, width))
            shard, size = [], 0

        def to_shard(segs, more):
            nonlocal size
            if size and size + more > shard_bytes:
                yield from flush_shard()
            shard.extend(segs)
            size += more
            if size >= shard_bytes:
                yield from flush_shard()

        def groups_to_shard(data, rows, counts, i, h, start, sizes):
            """Groups of ``counts`` rows each, one after the other in ``rows``."""
            texts = data.take(pa.array(rows)).to_pylist()
            places = list(zip(i[rows].tolist(), h[rows].tolist(), start[rows].tolist()))
            ends = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(sizes[rows])])
            for a, b in zip((ends - counts).tolist(), ends.tolist()):
                yield from to_shard(zip(texts[a:b], places[a:b]), int(total[b] - total[a]))

        def group_bounds(key):
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return starts, np.concatenate([starts[1:], [len(key)]])

        def settle(t):
            """Whole anchors: whole copies are settled, different segments go to a shard."""
            key, i, h, start, end = columns(t, "key", "id", "h", "start", "end")
            data = t.column("bytes").combine_chunks()
            code = data.dictionary_encode().indices.to_numpy()
            first, later = _firsts((key, code), (i, h, start))
            if len(later):
                yield spans(i[later], h[later], start[later], end[later])
            # (one segment alone cannot repeat itself: equal windows have equal anchors)
            lo, hi = group_bounds(key[first])
            several = hi - lo > 1
            yield from groups_to_shard(data, first[np.repeat(several, hi - lo)], (hi - lo)[several],
                                       i, h, start, end - start)

        def settle_windows(t):
            """Whole hashes of hot windows: those that met another go to a shard."""
            key, i, h, start = columns(t, "key", "id", "h", "start")
            data = t.column("bytes").combine_chunks()
            rows = np.lexsort((start, h, i, key))
            new = np.ones(len(rows), bool)          # the same place twice is one occurrence
            new[1:] = np.logical_or.reduce([c[rows[1:]] != c[rows[:-1]] for c in (key, i, h, start)])
            rows = rows[new]
            lo, hi = group_bounds(key[rows])
            several = hi - lo > 1
            yield from groups_to_shard(data, rows[np.repeat(several, hi - lo)], (hi - lo)[several],
                                       i, h, start, np.full(len(i), width))

        def whole_groups(held, t):
            """Rows of finished groups, and the rows of the group that may go on."""
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                return t, None
            key = t.column("key").to_numpy()
            same = key == key[-1]
            cut = t.num_rows - int(same[::-1].argmin() if not same.all() else t.num_rows)
            return t.slice(0, cut), t.slice(cut)

        held: dict = {"segment": None, "window": None}
        kinds = (("segment", settle), ("window", settle_windows))
        for b in batches:
            t = pa.Table.from_batches([b])
            whole, window = t.column("bytes").is_valid(), t.column("window")
            travel = t.filter(pc.invert(whole))
            if travel.num_rows:
                yield spans(*columns(travel, "id", "h", "start", "end"))
            masks = (pc.and_(whole, pc.invert(window)), pc.and_(whole, window))
            for (kind, finish), mask in zip(kinds, masks):
                done, held[kind] = whole_groups(held[kind], t.filter(mask))
                if done.num_rows:
                    yield from finish(done)
        for kind, finish in kinds:
            if held[kind] is not None and held[kind].num_rows:
                yield from finish(held[kind])
        yield from flush_shard()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "key")
            .sortWithinPartitions(F.col("bytes").isNull(), "window", "key")
            .mapInArrow(run, _SPAN))


def merged_spans(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of several texts, those that overlap or touch made one: text, start, end,
    in order."""
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    if not len(text):
        return text, start, end
    # texts are set apart, so that the furthest end so far is one running maximum
    apart = text * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(text), bool)
    new[1:] = start[1:] + apart[1:] > reach[:-1]
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(text)) - 1
    return text[lo], start[lo], reach[hi] - apart[lo]


def cut_texts(texts: DataFrame) -> DataFrame:
    """``(id, h, text, spans)`` to what is removed and kept."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for at, to in slices(b.column(2)):
                yield cut(pa, *(b.column(k)[at:to] for k in range(4)))

    def cut(pa, ids, h, texts, spans):
        buf, ends = joined(texts)
        sizes, n = np.diff(ends), len(ids)
        each = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(n), each)
        own, start, end = (c.to_numpy() for c in spans.flatten().flatten())
        mine = own == h.to_numpy()[of]                   # not of another text with this id
        of, start, end = merged_spans(of[mine], start[mine], end[mine])
        keep = np.ones(len(buf), bool)
        for x, y in zip((ends[of] + start).tolist(), (ends[of] + end).tolist()):
            keep[x:y] = False
        data = buf[keep]
        count = np.bincount(of, minlength=n)
        gone = np.bincount(of, end - start, minlength=n).astype(np.int64)
        left = np.concatenate([[0], np.cumsum(sizes - gone)])
        raw = memoryview(data)
        digests = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(left[:-1].tolist(), left[1:].tolist())]
        removed = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()),
            pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"]))
        kept = pa.Array.from_buffers(pa.binary(), n, [
            None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.array(gone), pa.array(count), pa.array(digests, pa.string()),
             removed, kept], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    return texts.select("id", "h", "text", "spans").mapInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, width: int = 100, hot: int = 50_000,
                   shard_bytes: int = 4 << 20, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the removed
    spans, and the remaining bytes."""
    if width < GRAM + 1:
        raise ValueError(f"width must exceed {GRAM}")
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                        text_or_empty(text_col).alias("text"))
    found = stored(shared_anchors(anchor_rows(texts, width), hot), "anchors")
    heavy = found.where("id IS NULL").select("hash", F.lit(True).alias("heavy"))
    by_doc = (found.where("id IS NOT NULL").join(heavy, "hash", "left").groupBy("id").agg(
        F.collect_set("hash").alias("hashes"),
        F.collect_set(F.when(F.col("heavy"), F.col("hash"))).alias("heavy")))
    # one shuffle of the texts serves both joins
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.withColumn("h", F.xxhash64("text")).repartition(n, "id")
    segs = segment_rows(dealt.join(by_doc, "id"), width)
    spans = resolve(segs, width, shard_bytes).groupBy("id").agg(
        F.collect_list(F.struct("h", "start", "end")).alias("spans"))
    cut = cut_texts(dealt.join(spans, "id", "left"))
    return cut.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes",
                      "n_removed", "n_spans", "kept_sha256", "removed", "kept")
