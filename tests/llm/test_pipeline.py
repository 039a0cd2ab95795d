"""The corpus pipeline against brute force, stage by stage."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from casekit.llm import chunks, decontam
from casekit.llm.common import stored

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def classes(docs):
    """doc id -> least id of its class, for texts with words."""
    sets = {i: shingles(t) for i, t in docs.items()}
    least = {i: i for i in docs}
    changed = True
    linked = [(a, b) for a in docs for b in docs if a < b
              and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(-5, None, "en", "s", 0), (-4, "12 34 !!", "en", "s", 8), (-3, "", "en", "s", 0),
             (-2, docs.collect()[0].text, "en", "s", 1), (-1, docs.collect()[0].text + " more", "en", "s", 1)]
    return docs.unionByName(spark.createDataFrame(extra, docs.schema))


def test_stages_against_brute_force(spark, given):
    rows = {r.doc_id: r.text for r in given.collect()}
    docs, columns = given, given.columns
    one = stored(cp.language_id(spark, docs, SF), "t")
    assert one.columns == columns
    kept = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    assert {r.doc_id for r in one.collect()} == set(kept)           # clean documents stay
    two = stored(cp.exact_dedup_stage(spark, one, SF), "t")
    last = {}
    for i in sorted(kept):
        last[kept[i]] = i
    kept = {i: t for t, i in last.items()}
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(kept)
    three = stored(cp.near_dedup(spark, two, SF), "t")
    least = classes(kept)
    kept = {i: t for i, t in kept.items() if least[i] == i}
    assert three.columns == columns and sorted(r.doc_id for r in three.collect()) == sorted(kept)
    four = stored(cp.decontamination(spark, three, SF), "t")
    items = [decontam.compared(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in four.collect()}
    for i, t in kept.items():
        form = decontam.compared(t)
        held = any(x in form or decontam.myers(x, form, len(x) // 10) for x in items)
        assert (i in left) == (not held)
    five = cp.pack(spark, four, SF).collect()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(chunks.tokenizer_path("byte_bpe_50k.json"))
    assert {r.doc_id for r in five} == left
    for r in five:
        ids = tok.encode(kept[r.doc_id], add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start:r.start + r.length], "<u4").tobytes())


def test_run_and_empty_table(spark, given, tmp_dir):
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_dir}/{t}.parquet")
    given.write.parquet(f"{tmp_dir}/documents.parquet")
    assert cp.run(spark, tmp_dir).count() > 100
    empty = given.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
