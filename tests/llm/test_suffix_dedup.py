"""Operator 1 against brute force."""

import hashlib
import random

import numpy as np
import pytest

from casekit.llm import suffix_array as sa_module
from casekit.llm import suffix_dedup as sd
from casekit.llm.suffix_array import common_prefixes, suffix_array

DOCS = "doc_id long, text string, id string, h string, spans string"


def brute(rows, width):
    """Spans to remove of each distinct (id, text)."""
    docs = sorted({(-1 if i is None else i, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in docs:
        raw = t.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            w = raw[s:s + width]
            if w in seen:
                gone[s:s + width] = b"\1" * width
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i, t] = (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, width=100, **options):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS).repartition(5)
    out = sd.remove_repeats(docs, width=width, **options).collect()
    want = brute(rows, width)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    assert got == sorted((-1 if i is None else i, *want[-1 if i is None else i, t or ""]) for i, t in rows)
    for r in out:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.removed) == r.n_spans


def passages(rng, n=60):
    pieces = ["".join(rng.choices("abcdefg hij", k=rng.randint(60, 400))) for _ in range(12)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice([rng.choice(pieces), "".join(rng.choices("klmnop qrs", k=rng.randint(0, 150))),
                                rng.choice(pieces)[rng.randint(0, 50):]]) for _ in range(rng.randint(0, 5)))
        rows.append((i * 7 % 61, t))
    return rows


EDGE = [(500, None), (501, ""), (502, "a" * 99), (503, "a" * 100), (504, "a" * 1000), (505, "ab" * 400),
        (506, "é🙂" * 200), (507, "é🙂" * 201), (None, "é🙂" * 100), (508, "\0" * 300), (509, "x\0" * 150),
        (504, "a" * 1000), (510, ("long text " + "y" * 7) * 20_000)]


def test_equals_brute_force_with_edges(spark):
    check(spark, passages(random.Random(1)) + EDGE)


@pytest.mark.parametrize("options", [{"hot": 3}, {"shard_bytes": 300}, {"hot": 6, "shard_bytes": 200}])
def test_hot_anchors_and_shards(spark, options):
    check(spark, passages(random.Random(2), 50) + EDGE[:8], **options)


def test_hot_passage_in_every_document(spark):
    """Anchors in all documents: windows at the passage's edges, repeated rows, small shards."""
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=260))
    rows = [(i, "".join(rng.choices("xyz", k=rng.randint(0, 40))) + passage[rng.choice([0, 0, 90]):]
             + "".join(rng.choices("xyz", k=rng.randint(0, 40)))) for i in range(80)]
    check(spark, rows + rows[:20], hot=5, shard_bytes=2_000)


def test_small_width(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 120)))) for i in range(40)]
    check(spark, rows, width=33)


def test_empty_table_and_given_rows(spark):
    check(spark, [])
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, rows)


def test_same_id_different_texts(spark):
    docs = spark.createDataFrame([(1, "q" * 50 + "w" * 100, "", "", ""), (1, "w" * 100 + "e", "", "", "")], DOCS)
    out = sd.remove_repeats(docs).collect()
    assert sorted(r.n_removed for r in out)[0] in (0, 99) and sum(r.n_removed for r in out) >= 100


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        alphabet = rng.choice([b"\0", b"ab", b"\0a", b"abc\xff", bytes(range(256))])
        s = bytes(rng.choices(alphabet, k=rng.randint(0, 120))) * rng.choice([1, 1, 2])
        buf = np.frombuffer(s, np.uint8)
        sa = suffix_array(buf)
        want = sorted(range(len(s)), key=lambda i: s[i:])  # noqa: B023
        assert sa.tolist() == want
        for cap in (5, 1000):
            lcp = common_prefixes(buf, sa, cap, lanes=rng.choice([1, 3, 50]))
            for k in range(1, len(s)):
                a, c, m = s[want[k - 1]:], s[want[k]:], 0
                while m < min(len(a), len(c), cap) and a[m] == c[m]:
                    m += 1
                assert lcp[k] == m


def test_binary_search():
    rng = np.random.default_rng(0)
    rows = np.unique(rng.integers(0, 3, (200, 12), dtype=np.uint8), axis=0)
    words = sd._words(np.ascontiguousarray(rows).view("V12").ravel(), 12)
    probe = rng.integers(0, 3, (500, 12), dtype=np.uint8)
    hit = sd.binary_search(words, sd._words(np.ascontiguousarray(probe).view("V12").ravel(), 12))
    at = {r.tobytes(): k for k, r in enumerate(rows)}
    assert hit.tolist() == [at.get(p.tobytes(), -1) for p in probe]


@pytest.mark.parametrize("block", [3, 40, 1 << 15])
def test_segments_in_blocks(monkeypatch, block):
    """Hashed in short blocks, the segments are those of one pass over each text."""
    monkeypatch.setattr(sd, "BLOCK", block)
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=k)) for k in (0, 120, 99, 100, 36, 0, 400, 3, 101)]
    texts += [b"a" * 150, texts[1] * 2]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    hashes = sd.gram_hashes(buf)
    for width in (33, 100):
        want = []
        for k, t in enumerate(texts):
            last = None
            for p in range(len(t) - width + 1):
                places = range(ends[k] + p, ends[k] + p + width - sd.GRAM + 1)
                at = min(places, key=lambda q: (hashes[q] >> np.uint64(26), q))
                if at == last:
                    want[-1] = (k, want[-1][1], p + width, int(hashes[at]))
                else:
                    want.append((k, p, p + width, int(hashes[at])))
                last = at
        assert list(zip(*(c.tolist() for c in sd.segments(buf, ends, width)))) == want


def test_suffix_array_in_chunks(monkeypatch):
    """Groups larger and smaller than a chunk; numbers that fill 64 bits or do not."""
    monkeypatch.setattr(sa_module, "CHUNK", 5)
    rng = random.Random(6)
    for alphabet in (b"a", b"ab", bytes(range(256))):
        s = bytes(rng.choices(alphabet, k=300)) * 2
        assert suffix_array(np.frombuffer(s, np.uint8)).tolist() == sorted(range(600), key=lambda i: s[i:])  # noqa: B023


def test_prefixes_compare_only_where_a_stretch_begins(monkeypatch):
    """A text that stands twice is compared once, not at each of its positions."""
    pairs = []
    shared = sa_module._shared
    monkeypatch.setattr(sa_module, "_shared", lambda buf, p, *a: (pairs.append(len(p)), shared(buf, p, *a))[1])
    text = np.random.default_rng(0).integers(0, 256, 5000).astype(np.uint8)
    buf = np.concatenate([text, text])
    lcp = common_prefixes(buf, suffix_array(buf), 100)
    assert (lcp >= 100).sum() == 4901 and pairs[0] < 5100


def test_merged_spans():
    rng = random.Random(7)
    spans = [(rng.randrange(5), a := rng.randrange(60), a + rng.randint(1, 12)) for _ in range(40)]
    covered = {(t, p) for t, a, b in spans for p in range(a, b)}
    got = list(zip(*(c.tolist() for c in sd.merged_spans(*(np.array(c) for c in zip(*spans))))))
    assert got == sorted(got) and {(t, p) for t, a, b in got for p in range(a, b)} == covered
    assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(got, got[1:]))
