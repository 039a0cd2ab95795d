"""Operators 11 to 13 against brute force, on hand-made rows and given tables."""

import math
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casekit.llm import filter_audit as fa
from casekit.llm import hard_negatives as hn
from casekit.llm import license_scan as ls

SF = "/root/testdata/sf0.001"


# ----------------------------------------------------------------- operator 11

DOCS = "doc_id long, text string, lang string, mask int, part string, digest string, id string"
LABELS = "doc_id long, quality int, toxic int, lost string"


def failures(text):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    return "".join(f for f, fails in (
        ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
        ("D", bool(re.search("[#$%&*|]", text)))) if fails)


def audit(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic)."""
    fails = [set(failures(t or "") + ("E" if i is not None and any(
        j is not None and j < i and (u or "") == (t or "") for j, u, _ in docs) else ""))
        for i, t, _ in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for part in sorted({p or "" for _, _, p in docs}):
        own = [(i, f) for (i, _, p), f in zip(docs, fails) if (p or "") == part]
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                left = [(i, x) for i, x in own if not x & set(order[:s])]
                gone = [i for i, x in left if f in x]
                shapley[f] += len(gone)
                rows.append((part, "".join(order), s + 1, len(left) - len(gone), len(gone),
                             sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own),
                             sum(i in good for i in gone), sum(i in toxic for i in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def test_audit_against_brute_force(spark):
    rng = random.Random(2)
    words = ["w%d" % k for k in range(150)] + ["BIG", "a|b", "é", "x\x1cy", "Ünï", "$5"]
    docs = [(i, rng.choice([" ", "\n\x0b", "  "]).join(rng.choices(words, k=rng.choice([3, 99, 100, 130, 300]))),
             rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(100, " ".join(f"u{k}" for k in range(120)), "en"), (101, None, "en"), (102, "", "de"),
             (103, " \t", None), (104, "LONG " * 40_000, "en"), (105, "ABC", "xx")]
    docs += [(200 + i, docs[i][1], "en") for i in range(0, 20)] + [(None, docs[0][1], "en"), (7, docs[7][1], "en"),
                                                                   (7, docs[7][1], "en"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 230, 3)]
    labels += [(3, 1, None), (3, 0, 0), (None, 1, 1)]
    got = fa.audit_filters(
        spark.createDataFrame([(*d, 1, "x", "y", "z") for d in docs], DOCS).select(
            "doc_id", "text", "lang", "mask", "digest", "id"),
        spark.createDataFrame([(*r, "n") for r in labels], LABELS)).collect()
    assert sorted(map(tuple, got)) == audit(docs, labels)


def test_audit_given_table_and_empty(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = fa.audit_filters(docs, labels).collect()
    assert sorted(map(tuple, got)) == audit([(r.doc_id, r.text, r.lang) for r in docs.collect()],
                                            [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert fa.audit_filters(docs.limit(0), labels.limit(0)).collect() == []


def test_text_failures_of_slices():
    texts = ["x", None, "A b", "c|", " ".join(map(str, range(100))), "q q " * 60]
    whole = fa.text_failures(pa.array(texts, pa.string())).tolist()
    assert whole == [sum(1 << "ABCD".index(c) for c in failures(t or "")) for t in texts]
    assert fa.text_failures(pa.array(texts, pa.string())[2:5]).tolist() == whole[2:5]


def test_packed_sums_do_not_run_over():
    n = len(fa.outcome_fields(0))
    assert n == 600 * 5 + 5 + 1
    rng = random.Random(0)
    masks = [rng.randrange(128) for _ in range(50)]
    times = [rng.choice([1, 7, 1 << 20, 1 << 40]) for _ in masks]
    total = sum(fa.pack(fa.outcome_fields(m)) * k for m, k in zip(masks, times))
    want = [sum(c) for c in zip(*([v * k for v in fa.outcome_fields(m)] for m, k in zip(masks, times)))]
    assert fa.unpack(total, n) == want
    full = fa.pack(fa.outcome_fields(31)) * ((1 << fa.WIDTH) - 1)
    assert fa.unpack(full, n)[-1] == (1 << fa.WIDTH) - 1
    with pytest.raises(OverflowError):
        fa.unpack(full + fa.pack(fa.outcome_fields(31)), n)


def test_many_parts_and_a_hot_one(spark):
    marked = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 400)).alias("part"),
        (F.col("id") % 128).cast("int").alias("mask")).repartition(7)
    kept = {r.part: r.n for r in fa.interaction_audit(marked).where("step = 1").groupBy("part").agg(
        F.max(F.col("kept") + F.col("removed")).alias("n")).collect()}
    assert kept == {r.part: r.n for r in marked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}


# ----------------------------------------------------------------- operator 12

VECTORS = "vec_id long, embedding array<float>, label int, id string, ints string, packed string"


def test_tables_score_exactly():
    rng = np.random.default_rng(3)
    for width, lo, hi in ((64, -160, 155), (5, -1, 1), (19, -70_000, 4), (8, 0, 0), (1, -4_000_000, 4_000_000)):
        a, c = rng.integers(lo, hi + 1, (11, width)), rng.integers(lo, hi + 1, (23, width))
        planes = hn.planes_for(c.min(), c.max())
        got = hn.table_scores(hn.subset_tables(a), hn.packed_planes(c, planes))
        assert (got == c @ a.T).all()
    assert [hn.planes_for(*x) for x in ((0, 0), (-1, 0), (-1, 1), (-128, 127), (-129, 0), (0, 128))] == [1, 1, 2, 8, 9, 9]


def mined(vectors, anchors=50, positives=5, negatives=3):
    """vectors: (id, vector, label)."""
    rows = []
    for i, v, label in vectors:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= 16384 for x in v):
            continue
        rows.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    out, seen = [], set()
    for a, x, label in sorted((r for r in rows if r[0] % anchors == 0), key=lambda r: (r[0], r[2], r[1])):
        if a in seen:
            continue
        seen.add(a)
        scored = sorted((-dot(x, y), i, other == label) for i, y, other in rows if i != a)
        for s, i, _ in [r for r in scored if r[2]][:positives]:
            fit = [r for r in scored if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit)]
    return sorted(out)


def mine(spark, vectors, **options):
    df = spark.createDataFrame([(*v, "x", "y", "z") for v in vectors], VECTORS)
    return sorted(tuple(r) for r in hn.mine_hard_negatives(df, **options).collect())


def test_mining_against_brute_force(spark):
    rng = random.Random(4)
    vec = lambda n=13: [rng.uniform(-1, 1) for _ in range(n)]
    hot = [0.5] * 13                                           # a third of all rows are copies: ties
    rows = [(i, hot if i % 3 == 0 else vec(), rng.choice([0, 0, 0, 1, 2])) for i in range(700)]
    rows += [(700, None, 1), (701, vec(), None), (None, vec(), 1), (702, [0.1, None] * 6, 1), (750, [float("nan")] * 13, 1),
             (703, [float("inf")] + vec(12), 0), (704, [3e38] * 13, 0), (800, vec(), 9), (850, [], 0), (705, vec(4), 1),
             (900, [0.0] * 13, 1)]
    rows += [rows[50], rows[50], rows[21], (100, vec(), 2)]     # repeated rows, an anchor with two labels
    want = mined(rows)
    assert len(want) > 100 and mine(spark, rows) == want
    # several blocks of anchors, other list lengths
    assert mine(spark, rows, block_bytes=2 * 256 * 4 * 3) == want
    assert mine(spark, rows, positives=2, negatives=7) == mined(rows, positives=2, negatives=7)


def test_mining_given_table_and_empty(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = sorted(tuple(r) for r in hn.mine_hard_negatives(df).collect())
    assert got == mined(rows) and got
    assert mine(spark, []) == [] and mine(spark, [(1, [0.5], 1)]) == [] and mine(spark, [(50, [0.5], 1)]) == []


# ----------------------------------------------------------------- operator 13

SCAN = "doc_id long, text string, notices string, labels string, score int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def scanned(text, phrases=ls.PHRASES, notices=ls.NOTICES, chars_per_edit=10):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    base = [(k, label) for p, label in phrases for k in range(len(words))
            if words[k:k + len(p.split())] == p.split()]
    matches = []
    for n, label in notices:
        k = len(n) // chars_per_edit
        for a in range(len(words)):
            for z in range(a + 1, len(words) + 1):
                run = " ".join(words[a:z])
                if len(run) > len(n) + k:
                    break
                if len(run) >= len(n) - k and (e := distance(run, n)) <= k:
                    matches.append((2 * e - len(n), n, a, z, label, e))
    found = []
    for _, n, a, z, label, e in sorted(matches):
        if all(z <= x or a >= y for _, _, _, x, y in found):
            found.append((label, n, e, a, z))
    labels = sorted({label for _, label in base})
    return (len(words), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None),
            ",".join(labels), ",".join(sorted({*labels, *(f[0] for f in found)})),
            1.0 if base else max((1 - f[2] / len(f[1]) for f in found), default=0.0),
            sorted((a, z - a, label, n, e) for label, n, e, a, z in found))


def plain(row):
    return (*row[:7], sorted((p["first_word"], p["words"], p["label"], p["notice"], p["edits"]) for p in row[7]))


def spoiled(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        k = rng.randrange(len(s) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            s.insert(k, rng.choice("aexz -é"))
        elif k < len(s) and kind == 1:
            s[k] = rng.choice("aexz .é")
        elif k < len(s):
            del s[k]
    return "".join(s)


def test_scan_against_brute_force():
    rng, scanner = random.Random(6), ls.Scanner()
    texts = ["", None, " ", "a", "CC-BY cc by CC BY-NC-SA", "the MIT License; mit  LICENSE.", "permit license",
             "cc by cc by cc by", "apache license apache license", "\x00MIT\x7fLicense", "GNU General Public License, version 3",
             "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "public license " * 50]
    for _ in range(400):
        parts = []
        for _ in range(rng.randint(1, 4)):
            n, _ = rng.choice(ls.NOTICES)
            parts.append(spoiled(rng, n, rng.randint(0, len(n) // 10 + 2)))
            parts.append(" ".join(rng.choices(["the", "license", "x", "public", "under", "gnu", "café", "under the"],
                                              k=rng.randint(0, 5))))
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    for t in texts:
        assert plain(scanner.scan(t)) == scanned(t), t


def test_scan_on_spark(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [(r.doc_id, r.text) for r in docs.collect()] + [
        (None, "Released under the M1T Licence"), (-1, None), (-1, None), (-2, "x " * 200_000 + "MIT License"),
        (-3, "liscensed under the apache licence, version 2.0")]
    got = ls.scan_licenses(spark.createDataFrame([(i, t, "p", "q", 1) for i, t in texts], SCAN)).collect()
    scanner = ls.Scanner()
    assert len(got) == len(texts)
    want = sorted(((i, *plain(scanner.scan(t))) for i, t in texts), key=str)
    assert sorted(((r.doc_id, *plain([*r[1:8], [p.asDict() for p in r.notices]])) for r in got), key=str) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].labels == "mit" and by_id[None].base_labels == "" and 0.9 < by_id[None].score < 1
    assert by_id[-2].first_word == 200_000 and by_id[-3].labels == "apache-2.0"
    for i, t in texts[:120]:                         # whole given texts, phrases by brute force
        assert (by_id[i].n_words, by_id[i].n_base, by_id[i].base_labels) == (
            (r := scanned(t, notices=()))[0], r[1], r[4])
    assert ls.scan_licenses(spark.createDataFrame([], SCAN)).count() == 0
    assert ls.Scanner(notices=()).scan("mit license")[5] == "mit"
