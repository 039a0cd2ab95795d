"""Operator 9 against brute force."""

import random

import numpy as np
import pyarrow as pa

from casekit.llm import graph, ngram_join as nj

DOCS = "doc_id long, text string, sid string, n string, label string"


def shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if n >= threshold * len(sets[a] | sets[b]) - 1e-9:
                    links[a].append(b)
    key = lambda k: -1 if rows[k][0] is None else rows[k][0]
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        rep = min([a, *(b for b in links[a] if sets[b] == sets[a])], key=key)
        out.append((rows[a][0], rows[rep][0], rows[min(seen, key=key)][0], len(links[a])))
    return sorted(out, key=str)


def near_copies(rng, n_base=25, vocabulary=400):
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for _ in range(n_base):
        base = rng.choices(words, k=rng.choice([1, 3, 5, 8, 40, 120, 400]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 30))):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own) if rng.random() < 0.7 else " \n".join(own).upper())
    rng.shuffle(rows)
    return list(enumerate(rows))


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)
    return sorted((tuple(r) for r in nj.jaccard_join(docs, **options).collect()), key=str)


def test_equals_brute_force_with_edges(spark):
    rows = near_copies(random.Random(7))
    rows += [(9000, None), (9001, ""), (9002, " \n "), (9003, "one two"), (9004, "One  two"), (9003, "one two"),
             (None, rows[0][1]), (None, "quite another text with words"), (9005, "long " * 60_000), (9006, "z " * 5)]
    assert run(spark, rows) == brute(rows)


def test_hot_group_in_blocks(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(150)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"{i}-{k}" for k in range(30))) for i in range(20)]
    want = brute(rows)
    assert run(spark, rows, block_sets=64) == want
    assert run(spark, rows, block_shingles=5_000) == want


def test_empty_table_and_keep_one(spark):
    assert run(spark, []) == []
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (4, "other words are all that is here"), (5, None)]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)
    left = nj.keep_one_of_each(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 4, 5]


def test_keep_one_with_null_ids_repeated_rows_and_clashing_names(spark):
    text = "a b c d e f"
    rows = [(1, text), (2, text.upper()), (3, text), (None, text), (None, text), (None, text + " "),
            (7, "repeated rows of one document stay once only"), (7, "repeated rows of one document stay once only"),
            (8, "one id with two texts that are alike in every way"), (8, "ONE id with two texts that are alike in every way"),
            (9, "one id with two"), (9, "texts that differ in everything else"), (None, "alone"), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1, "z") for i, t in rows],
                                 "doc_id long, text string, __gone string, id int, key string")
    left = nj.keep_one_of_each(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").strip().lower()) for r in left.collect()), key=str)
    want = {(7, rows[6][1]), (8, rows[8][1]), (9, rows[10][1]), (9, rows[11][1]), (None, text), (None, "alone"), (None, "")}
    assert got == sorted(want, key=str)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(spark, rows) == brute(rows)


def test_shingle_sets_match_words():
    rng = random.Random(1)
    texts = ["", None, "a", "A b", " a  b c d e f ", "é É\té x\x0by z\x1c w"] + [
        " ".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(200)]
    got = nj.shingle_sets(pa.array(texts, pa.string()))
    ascii_words = [" ".join((t or "").lower().replace("\x1c", "☃").split()) for t in texts]
    assert [len(g) for g in got] == [len(shingles(t)) for t in ascii_words]
    same = {}
    for g, t in zip(got, ascii_words):
        assert same.setdefault(frozenset(shingles(t)), g.tobytes()) == g.tobytes()


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(0)
    by = nj.multipliers(4000)
    common, a, b = (nj.mixed(rng.integers(0, 1 << 62, n)) for n in (80, 10, 10))
    x, y = (nj.signature(np.concatenate([common, z]), by) for z in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.03


def test_prefix_is_shortened_until_measured_recall():
    # links of the sample by longest common prefix: all have 8 letters or more in common
    assert nj.matched_prefix([0] * 8 + [3, 4, 900], 0.8, 32, 0.999, 0.995) == 8
    assert nj.recall(0.8, 32, 8) >= 0.995 > nj.recall(0.8, 32, 9)
    # one in a hundred has only six, one only five: shortened as far as needed
    assert nj.matched_prefix([0] * 6 + [10, 0, 0, 0, 990], 0.8, 32, 0.999, 0.995) == 6
    assert nj.matched_prefix([0] * 5 + [1, 9, 0, 0, 0, 990], 0.8, 32, 0.9995, 0.995) == 5
    assert nj.matched_prefix([0] * 11, 0.8, 32, 0.999, 0.995) == 8            # nothing to measure


def test_sample_finds_true_links():
    rows = [t for _, t in near_copies(random.Random(9), 60)]
    by = nj.multipliers(8 * 5)
    sets = nj.shingle_sets(pa.array(rows), 5)
    sample = nj.Sample(pa.array(rows[::3]), by, 8, 5, 5, 0.8)
    plain_sets = [shingles(t) for t in rows]
    for s, p in zip(sets, plain_sets):
        own = nj.letters(s, by, 8, 5)
        linked = {frozenset(q) for q in plain_sets[::3]
                  if q != p and len(p & q) >= 0.8 * len(p | q) - 1e-9}
        found = sample.links(s, nj.set_digest(s), own)
        assert sum(found or []) == len(linked)
        if found:
            common = [max(int(np.cumprod((nj.letters(nj.shingle_sets(pa.array([t]), 5)[0], by, 8, 5) == own), axis=1)
                              .sum(axis=1).max()) for _ in (0,))
                      for t in {frozenset(shingles(t)): t for t in rows[::3] if frozenset(shingles(t)) in linked}.values()]
            assert found == np.bincount(common, minlength=6).tolist()


def test_trie_edges_join_equal_prefixes(spark):
    rng = np.random.default_rng(2)
    trees, depth, prefix = 3, 4, 2
    letters = rng.integers(0, 2, (300, trees, depth)).astype(np.uint16)
    letters[:150, 1] = 7                                          # one hot trie node
    df = spark.createDataFrame([(k, bytearray(x.astype(">u2").tobytes())) for k, x in enumerate(letters)],
                               "sid long, letters binary").repartition(5)
    edges = [tuple(r) for r in nj.trie_edges(df, trees, depth, prefix).collect()]
    assert len(edges) <= 300 * trees and all((letters[a, t, :prefix] == letters[b, t, :prefix]).all() for a, b, t in edges)
    joined = {(r.node, r.label) for r in nj.contracted(spark.createDataFrame(edges, "a long, b long, tree int"), trees).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for t in range(trees):
        first = {}
        for k in range(300):
            x, y = root(first.setdefault(letters[k, t, :prefix].tobytes(), k)), root(k)
            parent[max(x, y)] = min(x, y)
    groups = {}
    for k in range(300):
        groups.setdefault(root(k), []).append(k)
    assert joined == {(k, r) for r, members in groups.items() if len(members) > 1 for k in members}


def test_recall_against_brute_force(spark):
    """Pairs found as candidates of all pairs at the threshold, many of them just above it."""
    rng = random.Random(12)
    rows, words = [], [f"w{i}" for i in range(5000)]
    for _ in range(60):
        base = rng.choices(words, k=204)
        for _ in range(4):
            own = list(base)
            for k in rng.sample(range(204), rng.randint(1, 4)):
                own[k] = rng.choice(words)
            rows.append(" ".join(own))
    rows = list(enumerate(rows))
    true = {r[0]: r[3] for r in brute(rows)}
    got = {r[0]: r[3] for r in run(spark, rows)}
    assert sum(true.values()) > 200 and sum(got.values()) >= 0.99 * sum(true.values())
    assert all(got[k] <= n for k, n in true.items())


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 400)] + [
        (rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(3, 3)]
    rng.shuffle(edges)
    out = {r.node: r.label for r in graph.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert out == {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_follows_from_the_threshold_not_from_a_sample(spark, monkeypatch):
    assert nj.sure_prefix(0.8, 32, 8, 0.999) == 7
    assert nj.recall(0.8, 32, 7) >= 0.999 > nj.recall(0.8, 32, 8)
    assert nj.sure_prefix(0.8, 2, 8, 0.9999) == 1

    def refuse(*args):
        raise AssertionError("documents were sampled")
    monkeypatch.setattr(nj, "Sample", refuse)
    monkeypatch.setattr(nj, "matched_prefix", refuse)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, "else")],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.jaccard_join(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
