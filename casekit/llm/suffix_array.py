"""Suffix arrays of byte buffers in numpy: Larsson-Sadakane refinement and Kasai's
common prefixes, both vectorised."""

from __future__ import annotations

import numpy as np


def packed8(buf: np.ndarray) -> np.ndarray:
    """Big-endian 64-bit value of the eight bytes from each position (zeros past the end)."""
    n = len(buf)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = buf
    out = np.empty(n, np.uint64)
    for r in range(8):
        part = padded[r:r + (n + 7 - r) // 8 * 8].view(">u8")
        out[r::8] = part[:len(out[r::8])]
    return out


CHUNK = 1 << 17                 # positions refined at a time, unless one group has more


def _first_keys(buf: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """The first ``h`` bytes from each position in ``bits`` bits, and ``h``.  Bytes stand as
    their number among those that occur, from 1; 0 is the end, so the shorter suffix is less."""
    n = len(buf)
    present = np.bincount(buf, minlength=256) > 0
    each = int(present.sum()).bit_length()
    h = bits // each
    code = np.zeros(n + h, np.uint64)
    code[:n] = np.cumsum(present).astype(np.uint64)[buf]
    key = code[:n].copy()
    for k in range(1, h):
        key <<= np.uint64(each)
        key |= code[k:k + n]
    return key, h


def suffix_array(buf: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes.

    Positions are first sorted by a few bytes.  Then only groups that are not single yet
    are sorted by the rank of the position ``h`` further on, with ``h`` doubling: a rank is
    the last place of its group, so a group's members are told apart by what follows.
    Every sort is of plain numbers that hold what is sorted below what it is sorted by.
    """
    n = len(buf)
    if n == 0:
        return np.empty(0, np.int64)
    bits = n.bit_length()
    low = np.uint64((1 << bits) - 1)
    key, h = _first_keys(buf, 64 - bits)
    key <<= np.uint64(bits)
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & low).astype(np.int64)
    key >>= np.uint64(bits)
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    del key
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=n)
    rank[sa] = np.repeat(starts + sizes - 1, sizes)
    todo = np.flatnonzero(np.repeat(sizes > 1, sizes))     # places in sa that are not settled
    while len(todo):
        # chunks of whole groups; finer ranks of chunks before only tell more apart
        group = rank[sa[todo]]
        bounds = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(todo)]])
        cuts = [0]
        while cuts[-1] < len(todo):
            k = np.searchsorted(bounds, cuts[-1] + CHUNK, side="right") - 1
            cuts.append(int(bounds[k] if bounds[k] > cuts[-1] else bounds[k + 1]))
        todo = np.concatenate([_refine(sa, rank, todo[a:b], h) for a, b in zip(cuts, cuts[1:])])
        h *= 2
    return sa


def _refine(sa: np.ndarray, rank: np.ndarray, todo: np.ndarray, h: int) -> np.ndarray:
    """Sort whole groups by what follows ``h`` further on; places that stay unsettled."""
    n = len(sa)
    members = sa[todo]
    group = rank[members]
    new = np.ones(len(todo), bool)
    np.not_equal(group[1:], group[:-1], out=new[1:])
    after = rank[np.minimum(members + h, n)] + 1
    bits, own = int(n).bit_length(), int(len(todo)).bit_length()
    both = ((np.cumsum(new) - 1) << bits) | after          # (group, what follows) as one number
    if int(new.sum()).bit_length() + bits + own <= 63:
        both = (both << own) | np.arange(len(todo))
        both.sort()
        order = both & ((1 << own) - 1)
        both >>= own
    else:
        order = np.argsort(both)
        both = both[order]
    members = members[order]
    sa[todo] = members                                     # groups stay in their own places
    np.not_equal(both[1:], both[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=len(todo))
    rank[members] = np.repeat(todo[starts + sizes - 1], sizes)
    return todo[np.repeat(sizes > 1, sizes)]


def common_prefixes(buf: np.ndarray, sa: np.ndarray, cap: int, lanes: int = 64) -> np.ndarray:
    """Common prefix, up to ``cap``, of each suffix with the one before it in ``sa``.

    Kasai's order: going through the text, a suffix shares one byte less with its
    predecessor than the suffix before it did, where both predecessors are one text apart.
    So only the first suffix of each such stretch is compared, as far as the stretch needs.
    """
    n = len(buf)
    if n < 2:
        return np.zeros(n, np.int64)
    before = np.empty(n, np.int64)               # the suffix that precedes each one
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    head = np.ones(n, bool)
    q = before[1:]
    head[1:] = (q != before[:-1] + 1) | (q < 1) | (buf[:-1] != buf[np.maximum(q, 1) - 1])
    p = np.flatnonzero(head)
    length = np.diff(p, append=n)
    q = before[p]
    room = np.minimum(n - np.maximum(p, q), cap + length)
    room[q < 0] = 0
    shared = _shared(buf, p, q, room, lanes)
    plcp = np.repeat(shared + p, length) - np.arange(n)
    out = np.minimum(plcp, cap)[sa]
    out[0] = 0
    return out


def _shared(buf: np.ndarray, p: np.ndarray, q: np.ndarray, room: np.ndarray, lanes: int) -> np.ndarray:
    """Equal bytes from ``p`` and ``q`` on, up to ``room``: eight at a time for all pairs,
    by long stretches once ``lanes`` pairs or fewer are left."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    eight = packed8(padded)
    shared = np.zeros(len(p), np.int64)
    act = np.flatnonzero(room > 0)
    a, b = p[act], q[act]
    done = 0
    while len(act) > lanes:
        differ = eight[a + done] ^ eight[b + done]
        more = differ == 0
        end = np.flatnonzero(~more)
        differ = differ[end]
        same = np.full(len(end), done)                     # leading equal bytes
        for k in range(8):
            same += differ < np.uint64(1 << (56 - 8 * k))
        shared[act[end]] = same
        done += 8
        shared[act[more]] = done
        more &= done < room[act]
        act, a, b = act[more], a[more], b[more]
    for k, x, y in zip(act.tolist(), a.tolist(), b.tolist()):
        size, at = 256, done
        while at < room[k]:
            differ = buf[x + at:x + min(at + size, room[k])] != buf[y + at:y + min(at + size, room[k])]
            if differ.any():
                at += int(differ.argmax())
                break
            at, size = at + len(differ), 2 * size
        shared[k] = at
    return np.minimum(shared, room)
