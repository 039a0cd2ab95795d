"""Operators 2, 3 and 10: held-out accuracy, brute force, edge rows."""

import random
import zlib

import numpy as np
import pytest

from casekit.llm import decontam, lang_id, quality

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, held_out string, score int, stats int, at int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 0, 0, 0) for i, t, lang in rows], DOCS)


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


EDGE = [(10_000, None, "en"), (10_001, "", "en"), (10_002, "123 !!", "de"), (None, "the and of", "en"),
        (10_003, "the and of that " * 20_000, None), (10_004, "the", None), (10_004, "the", None),
        (10_005, "日本語", None), (10_006, "<> \x00 ퟿", None)]


# ---------------------------------------------------------------- language ID

def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    out = lang_id.identify_languages(docs, per_language=150).collect()
    assert sorted(r.doc_id for r in out) == sorted(lang)
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.98 * len(held)


def test_language_id_edges(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()
    docs = docs_of(spark, [(r.doc_id, r.text, r.lang) for r in base] + EDGE)
    out = lang_id.identify_languages(docs, per_language=30).collect()
    assert len(out) == 200 + len(EDGE)
    by = {r.doc_id: r for r in out}
    for i in (10_000, 10_001, 10_002, 10_006):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[None].held_out and by[10_003].lang_pred == "en"
    assert by[10_005].lang_pred in {"en", "de", "fr", "es"}
    assert lang_id.identify_languages(docs.limit(0)).count() == 0
    blank = lang_id.identify_languages(docs_of(spark, [(i, "some text", None) for i in range(5)])).collect()
    assert {(r.lang_pred, r.score) for r in blank} == {("und", 0.0)}


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    rows = [(i, "aaa bbb" if i % 2 else "ccc ddd", "x" if i % 2 else "y") for i in range(200)]
    wrong = [(i, t, "z" if crc(i, 4) == 2 else lang) for i, t, lang in rows]
    a = lang_id.identify_languages(docs_of(spark, rows)).collect()
    b = lang_id.identify_languages(docs_of(spark, wrong)).collect()
    assert sorted(a) == sorted(b)


def test_ngram_counts_match_brute_force():
    from collections import Counter
    mask = (1 << 32) - 1

    def brute(text, bits):
        c = [ord(x) if x.isalpha() else 32 for x in text.lower()]
        if all(x == 32 for x in c):
            return None
        c = [x for k, x in enumerate(c) if not (k and x == 32 and c[k - 1] == 32)]
        c = [32, *c, 32]
        m1, m2, m3 = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D
        one = [x * m1 & mask for x in c]
        two = [((a ^ (b * m2 & mask)) * m3) & mask for a, b in zip(one, c[1:])]
        three = [((a ^ (b * m2 & mask)) * m1) & mask for a, b in zip(two, c[2:])]
        return Counter(x >> (32 - bits) for x in one + two + three)
    for t in ["a", "The  Cat, 9 sat!", "é", "x" * 50, "12", "Straße — ÀB"]:
        got = lang_id.ngram_counts(t, 12)
        want = brute(t, 12)
        assert (got is None and want is None) or dict(zip(got[0].tolist(), got[1].tolist())) == want


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in lang_id.softmax(logits)])
    assert 3.5 < lang_id.best_temperature(logits * 4, labels) < 4.6


def test_ftrl_is_sparse():
    model = lang_id.Ftrl(50, 2)
    rng = np.random.default_rng(1)
    for _ in range(300):
        y = int(rng.integers(2))
        model.learn(np.array([y, 2 + int(rng.integers(40))]), np.array([1.0, 0.02]), y)
    w = model.weights()
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 and (w[2:] == 0).all()


# -------------------------------------------------------------------- quality

def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality.classify_quality(docs, labels).collect()
    assert len(out) == 4000
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    y, p = np.array([truth[r.doc_id] for r in held]), np.array([r.score for r in held])
    assert auc(y, p) > 0.99 and ((p >= 0.5) == y).mean() > 0.95


def test_quality_edges(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()
    docs = docs_of(spark, [(r.doc_id, r.text, r.lang) for r in base] + EDGE)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    twice = labels.unionByName(labels.limit(5)).unionByName(
        spark.createDataFrame([(None, 1, 0), (10_000, None, None)], labels.schema))
    out = quality.classify_quality(docs, twice).collect()
    assert len(out) == 300 + len(EDGE) and all(0 <= r.score <= 1 for r in out)
    none = quality.classify_quality(docs, labels.where("quality = 0")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.classify_quality(docs.limit(0), labels).count() == 0
    ones = quality.classify_quality(docs, labels.where("quality = 1")).collect()   # prior estimated
    assert all(0 <= r.score <= 1 for r in ones)


def test_risk_slope_against_differences():
    """The slope of the non-negative risk, written out plainly, by differences."""
    rng = np.random.default_rng(1)
    xp, xu = rng.normal(size=(30, 4)) * 0.3 + 1, rng.normal(size=(50, 4)) * 0.3

    def parts(z, prior):
        g = lambda x: [sum(a * c for a, c in zip(row, z[:4])) + z[4] for row in x]
        loss = lambda v, y: np.log1p(np.exp(-y * v))
        gp, gu = g(xp), g(xu)
        positive = prior * sum(loss(v, 1) for v in gp) / len(gp)
        negative = sum(loss(v, -1) for v in gu) / len(gu) - prior * sum(loss(v, -1) for v in gp) / len(gp)
        return positive, negative
    signs = set()
    for prior in (0.2, 0.7, 0.99):
        for z in (rng.normal(size=5) * 0.1, rng.normal(size=5) * 3, np.array([9.0, 9, 9, 9, -9])):
            part, slope = quality.risk_slope(xp, xu, z[:4], z[4], prior, 0.5)
            assert abs(part - parts(z, prior)[1]) < 1e-9
            signs.add(part < 0)
            target = (lambda y: -0.5 * parts(y, prior)[1]) if part < 0 else (lambda y: sum(parts(y, prior)))
            for k in range(5):
                step = np.eye(5)[k] * 1e-6
                assert abs((target(z + step) - target(z - step)) / 2e-6 - slope[k]) < 1e-5
    assert signs == {True, False}


def test_least_ratio_and_prior():
    rng = np.random.default_rng(2)
    p, u = rng.integers(0, 20, 60) / 20, rng.integers(0, 16, 90) / 20
    brute = min((u >= t).mean() / (p >= t).mean() for t in np.unique(np.quantile(p, np.linspace(0, 0.5, 161)))
                if (p >= t).mean() >= 0.5)
    assert abs(quality.least_ratio(p, u) - brute) < 1e-12
    for share in (0.3, 0.8):                     # two kinds of rows, told apart by their statistics
        good = lambda n: rng.normal(1.0, 0.7, (n, quality.N_STATS))
        bad = lambda n: rng.normal(-1.0, 0.7, (n, quality.N_STATS))
        mixed = np.concatenate([good(int(1000 * share)), bad(1000 - int(1000 * share))])
        rng.shuffle(mixed)
        assert abs(quality.estimate_prior(good(600), mixed) - share) < 0.06


def test_unlabelled_rows_have_no_label(spark):
    """Labels 0 are not learned: turning their texts into nonsense changes no score."""
    rows = [(i, f"Good text number {i} is here, and it has words. " * (1 + i % 5) if i % 3 else "@@ ## " * (i % 9), "x")
            for i in range(300)]
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    spoilt = [(i, "??" if i < 200 and i % 3 == 0 else t, x) for i, t, x in rows]
    a, b = ({r.doc_id: r.score for r in quality.classify_quality(docs_of(spark, x), labels).collect()} for x in (rows, spoilt))
    assert all(a[i] == b[i] for i, t, _ in rows if not (i < 200 and i % 3 == 0))


def test_text_statistics_against_brute_force():
    import zlib as z
    for t in ["Abc def, ghi. 12!", "a\nb\na\n", "ÀB ß\t x$", "日本 語", "w w w W"]:
        s, n, words, lines = quality.text_statistics(t), len(t), t.split(), t.split("\n")
        assert abs(s[0] - np.log1p(n)) < 1e-12
        assert abs(s[1] - sum(c.islower() for c in t) / n) < 1e-12 and abs(s[2] - sum(c.isupper() for c in t) / n) < 1e-12
        assert abs(s[6] - t.count("\n") / n) < 1e-12 and abs(s[1:9].sum() - 1) < 1e-12
        assert abs(s[11] - len(set(words)) / len(words)) < 1e-12 and abs(s[14] - len(set(lines)) / len(lines)) < 1e-12
        assert abs(s[17] - len(z.compress(t.encode(), 1)) / len(t.encode())) < 1e-12
    assert not quality.text_statistics(None).any() and not quality.text_statistics("").any()


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 "
                                "THEN 1 - quality ELSE quality END quality", "toxic")
    a = {r.doc_id: r.score for r in quality.classify_quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.classify_quality(docs, flipped).collect()}
    assert a == b


# ------------------------------------------------------------ decontamination

def substring_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcde ")
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcde "))
    return "".join(out)


def test_myers_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(600):
        p = "".join(rng.choices("ab ", k=rng.randint(1, 20)))
        t = "".join(rng.choices("ab ", k=rng.randint(0, 30)))
        limit = rng.randint(0, 20)
        want = substring_distance(p, t)
        got = decontam.myers(p, t, limit)
        assert (got is None and want > limit) or got[0] == want


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.2])
def test_matcher_equals_brute_force(rate):
    rng = random.Random(4)
    words = ["alpha", "beta", "of", "the", "gamma", "delta", "in", "to"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 14)))) for i in range(25)]
    m = decontam.Matcher(items, rate)
    n = 0
    for _ in range(250):
        item = rng.choice(items)[1]
        text = " ".join(rng.choices(words, k=6)) + " " + edited(rng, item, rng.randint(0, 6)) + " " + \
            " ".join(rng.choices(words, k=6))
        got = {h[0]: h for h in m.hits(decontam.compared(text))}
        form = decontam.compared(text)
        for i, t in items:
            want, budget = substring_distance(t, form), int(rate * len(t))
            if budget == 0:
                assert (i in got) == (f" {t} " in f" {form} ")
            else:
                assert (i in got) == (want <= budget), (t, form)
                if i in got:
                    h = got[i]
                    assert h[1] == want and substring_distance(t, form[h[4]:h[5]]) == want
            n += i in got
    assert n > 50


def test_contamination_edges(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog, twice a day."), (2, None), (3, "!!"), (4, "ab"),
             (5, "the QUICK brown fox -- jumps over the lazy dog twice a day")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    text = "x " * 50_000 + "the quick brwn fox jumps over a lazy dog twice a day" + " y" * 50_000
    docs = docs_of(spark, [(1, None, None), (2, "", None), (3, text, None), (3, text, None), (None, text, None),
                           (4, "cab", None), (5, "x AB.", None)])
    for chars in (2_000_000, 30):                     # one block, several blocks
        hits = decontam.find_contamination(docs, bench, block_chars=chars).collect()
        assert sorted((str(h.doc_id), h.item_id, h.distance) for h in hits) == sorted(
            [(d, i, 4) for d in ("3", "3", "None") for i in (1, 5)] + [("5", 4, 0)])
        left = decontam.drop_contaminated(docs, bench, block_chars=chars)
        assert left.columns == docs.columns
        assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4]
    assert decontam.find_contamination(docs.limit(0), bench).count() == 0
    assert decontam.find_contamination(docs, bench.limit(0)).count() == 0


def test_planted_items_are_found(spark):
    import duckdb
    hits = decontam.find_contamination(spark.read.parquet(f"{SF}/documents.parquet"),
                                       spark.read.parquet(f"{SF}/benchmark.parquet"))
    got = {(h.doc_id, h.item_id) for h in hits.collect()}
    want = set(duckdb.sql(f"SELECT doc_id, item_id FROM '{SF}/documents.parquet' d, '{SF}/benchmark.parquet' b "
                          "WHERE contains(d.text, b.text)").fetchall())
    assert want <= got and len(got) < len(want) + 5


def test_pipeline_drops_texts_of_no_likely_language(spark):
    from casekit.llm import lang_id as li
    texts = {"en": "the quick brown fox jumps over the lazy dog and runs",
             "de": "der schnelle braune fuchs springt ueber den faulen hund",
             "fr": "le renard brun rapide saute par dessus le chien paresseux",
             "es": "el zorro marron salta sobre el perro perezoso del campo"}
    rows = [(i, lang, t) for i, (lang, t) in enumerate(list(texts.items()) * 25)]
    rows += [(1000, None, "\u0436\u0436\u0436 \u0449\u0449"), (1001, None, "123 !"), (1002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = {r.doc_id for r in li.keep_identified(docs).collect()}
    assert kept == set(range(100))                    # letters that fit no language go too
    assert 1000 in {r.doc_id for r in li.keep_identified(docs, min_score=0.0).collect()}
