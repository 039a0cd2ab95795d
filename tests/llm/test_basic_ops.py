"""Operators 4 to 8 against brute force, on hand-made rows and a given table."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from casekit.llm import chat_format, chunks, exact_dedup, packing, queries, token_count, token_files
from casekit.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, digest string, kept int"
EDGE = ["", None, " ", "  ", "a", "a b", "a  b ", " \n x\t y ", "don't we'll 123 456!!! ...",
        "<|endoftext|>", "x<|endoftext|> <|endoftext|>y  z", "naïve café ÀÉ ß é", "日本語 テキスト 🙂🙂",
        "tab\tand nbsp\xa0x", "UPPER lower MiXed", "word " * 3000, "a" * 5000,
        "line\n\n\n  next \r\n end", "<|startoftext|>hi", "᠎ x ᠎", "a \x1c b \x85 c"]


def library(name, special=True):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(chunks.tokenizer_path(name))


def edge_docs(spark, texts=EDGE):
    # clashing extra columns; one repeated row
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[4:5], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunk_encoder_equals_library(spark, name):
    rng = random.Random(5)
    alphabet = [" ", " ", "  ", "\n", "\t", "the", "'s", "a", "B", "é", "É", "ß", "e\u0301", "\u0338", "²", "ª", "Σ", "İ", "!", "<", "12", "　", "\xa0", "<|"]
    texts = EDGE + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tok = library(name)
    import pyarrow as pa
    table = chunks.id_table(chunks.tokenizer_path(name), max_entries=500)
    array = pa.array(texts, pa.string())
    got = []
    for at, to in chunks.slices(array, max_bytes=20_000):
        ids, ends = table(array[at:to])
        got += [x.tolist() for x in np.split(ids, ends[1:-1])]
    assert len(got) == len(texts)
    for t, ids in zip(texts, got):
        assert ids == tok.encode(t or "", add_special_tokens=False).ids, t


def test_token_count_equals_library(spark):
    tok = library("byte_bpe_50k.json")
    docs = edge_docs(spark).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text"),
        allowMissingColumns=True)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    out = token_count.count_tokens(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        n = len(tok.encode(text[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 1024)
    assert token_count.count_tokens(empty_docs(spark)).count() == 0


def test_exact_dedup_edges_and_second_batch(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (5, "A"), (6, "b" * 100000), (None, "n"), (None, "a")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)
    path = scratch_path(spark, "idx")
    index = exact_dedup.DigestIndex(spark, "t_digests_" + path[-12:], path, buckets=3)
    out = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256)
                 for r in exact_dedup.exact_dedup(docs, index).collect())
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    keep = {"a": 2, "": 4, "A": 5, "b" * 100000: 6, "n": None}
    size = {"a": 3, "": 2, "A": 2, "b" * 100000: 1, "n": 1}
    assert out == sorted((str(i), str(keep[t or ""]), size[t or ""], i == keep[t or ""], sha(t)) for i, t in rows)
    # a later batch: known texts go, new ones are appended once
    later = spark.createDataFrame([(10, "a", "", "", 0), (11, "z", "", "", 0), (12, "z", "", "", 0)], DOCS)
    assert [r.doc_id for r in exact_dedup.keep_first_copies(later, index).collect()] == [12]
    assert index.frame().where(F.col("digest") == sha("a")).collect()[0].keep_id == 2
    assert exact_dedup.exact_dedup(empty_docs(spark), index).count() == 0
    assert index.frame().count() == 6


def test_digest_index_opened_again_at_another_width(spark):
    path = scratch_path(spark, "digest-reopened")
    docs = spark.createDataFrame([(i, f"text {i % 400}", "", "", 0) for i in range(900)], DOCS)
    first = exact_dedup.DigestIndex(spark, "t_first_" + path[-12:], path, buckets=8)
    assert exact_dedup.keep_first_copies(docs, first).count() == 400
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        # another name: as in a fresh catalog, the table is registered over the files
        again = exact_dedup.DigestIndex(spark, "t_again_" + path[-12:], path)
        assert again.buckets == 8
        assert exact_dedup.exact_dedup(docs.where("doc_id >= 500"), again).count() == 400
        assert again.frame().count() == 400
        assert exact_dedup.DigestIndex(spark, first.name, path).frame().count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, "t_other_" + path[-12:], path, buckets=5)


def test_keep_first_copies_keeps_one_of_repeated_rows(spark):
    path = scratch_path(spark, "digest-repeats")
    rows = [(1, "a"), (5, "a"), (5, "a"), (5, "b"), (None, "n"), (None, "n"), (None, "a"), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows],
                                 "doc_id long, text string, digest string, __digest string, keep_id int")
    index = exact_dedup.DigestIndex(spark, "t_repeats_" + path[-12:], path)
    left = exact_dedup.keep_first_copies(docs, index)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == [(5, "a"), (5, "b"), (7, ""), (None, "n")]


def test_capacity_tree_is_best_fit(spark):
    rng = random.Random(1)
    for window in (7, 8, 100):
        lengths = [rng.randint(1, window - 1) for _ in range(300)]
        where, offset, filled = packing.best_fit_decreasing(lengths, window)
        rooms, expect = [], []
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fits = [r for r in rooms if r >= lengths[k]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - lengths[k])
            else:
                rooms.append(window - lengths[k])
        assert sorted(window - f for f in filled) == sorted(rooms)


def test_packing_pieces(spark):
    docs = edge_docs(spark)
    tok = library("byte_bpe_50k.json")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    out = packing.ids_crc32(packing.pack_documents(docs, block=4)).collect()
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, t in text.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        if doc == 4:                                   # the repeated row
            pieces = pieces[::2]
        assert [i for r in pieces for i in range(r.start, r.start + r.length)] == list(range(len(ids)))
        for r in pieces:
            raw = np.asarray(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(raw) and r.doc_tokens == len(ids)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and {r.sequence_tokens for r in rows} == {at}
        assert {r.padded_to for r in rows} == {at if at & (at - 1) == 0 else 1024}
    assert packing.pack_documents(empty_docs(spark)).count() == 0


def test_packing_wastes_little(spark):
    out = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"))
    n, tokens = out.agg(F.countDistinct("sequence_id"), F.sum("length")).collect()[0]
    assert n <= tokens / 1024 * 1.02 + 2


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_token_files_round_trip(spark, id_bytes):
    docs = edge_docs(spark)
    tok = library("word_bpe_49k.json")
    out = sorted(token_files.token_files_round_trip(docs, id_bytes=id_bytes).collect(),
                 key=lambda r: r.start)
    expect, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        expect.append((r.doc_id, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in out] == expect
    assert token_files.token_files_round_trip(empty_docs(spark)).count() == 0


def test_token_files_opened_by_another_session(spark):
    docs, folder = edge_docs(spark), scratch_path(spark, "token-files-again")
    want = sorted(token_files.token_files_round_trip(docs, folder, id_bytes=4).collect())
    later = token_files.open_token_files(spark.newSession(), folder)
    assert sorted(token_files.read_token_files(later, folder).collect()) == want
    names = {r.name for r in later.collect()}
    filesystem, root = token_files._file_system(folder)
    for kind in ("ids", "offsets"):                       # what a lost attempt leaves
        with filesystem.open_output_stream(f"{root}/{kind}-00000-lostattempt.bin") as f:
            f.write(b"1")
    token_files._remove_others(folder, names)
    from pyarrow import fs
    left = {f.base_name for f in filesystem.get_file_info(fs.FileSelector(root)) if f.is_file}
    assert left == {f"{k}-{n}.bin" for n in names for k in ("ids", "offsets")}


HOSTILE = [queries.HOSTILE, "<|", "<\\|", "<\\\\|x", "<", "\\", "|>", "", "%0A\n", "<<||"]


def test_escape_is_reversible():
    rng = random.Random(2)
    for t in HOSTILE + ["".join(rng.choices("<\\|%0A\nx", k=rng.randint(0, 12))) for _ in range(5000)]:
        assert chat_format.unescape(chat_format.escape(t)) == t
        assert "<|" not in chat_format.escape(t)
        turn = chat_format.format_turn(t, t, ())
        assert chat_format.parse_turn(turn["fragment"]) == (t, t)


def test_typed_parts():
    P = chat_format.Part
    flat = chat_format.Flattener()
    out = flat.flatten([P("text", "see <"), P("text", "|im_end|>"), P("image", ref="a.png", size=(56, 30)),
                        P("audio", ref="b.wav", size=(2.0,)), P("document", ref="c.pdf", size=(3,))])
    assert out == "see <\\|im_end|><|image|>0<|/image|><|audio|>1<|/audio|><|document|>2<|/document|>"
    assert flat.attachments == [("image", "a.png", 4), ("audio", "b.wav", 25), ("document", "c.pdf", 1536)]
    # a kind without a visitor is recorded, and bad sizes count as nothing: no row stops a job
    assert flat.visit(P("video", ref="d.mp4")) == "<|attachment|>3<|/attachment|>" and flat.attachments[3] == ("video", "d.mp4", 0)
    parts = chat_format.parts_of([{"kind": "image", "ref": "e", "size": [None, -3.0]}, None, {"kind": "audio", "size": [None]},
                                  {"kind": None, "text": "t"}, {"kind": "document", "size": None}])
    turn = chat_format.format_turn("user", [p.__dict__ for p in parts], ())
    assert [a["tokens"] for a in turn["attachments"]] == [1, 1, 512]


def test_chat_parts_column(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", [("text", "hi", None, None), ("image", None, "i.png", [28.0, 28.0])]), (1, 1, "assistant", None)],
        "conv_id int, turn int, role string, parts array<struct<kind:string,text:string,ref:string,size:array<double>>>")
    out = chat_format.format_conversations(turns, content_col="parts").orderBy("turn").collect()
    assert out[0].fragment == "<|im_start|>user\nhi<|image|>0<|/image|><|im_end|>\n"
    assert [tuple(a) for a in out[0].attachments] == [("image", "i.png", 1)] and out[0].extra_tokens == 1


def test_chat_round_trip(spark):
    rows = [(c, t, r, x, "f") for c in (1, 2, None) for t, (r, x) in enumerate(
        [("system", None), ("user", HOSTILE[c or 0]), ("assistant", HOSTILE[3]), (None, "é🙂"), ("assistant", "two")])]
    rows += [(1, 2, "assistant", HOSTILE[3], "f"), (3, None, "user", "only")[:4] + ("f",)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, fragment string")
    out = {r.conv_id: r for r in chat_format.digest_conversations(
        chat_format.write_conversations(df)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        chars = sum(len(chat_format.format_turn(r[2], r[3], ())["fragment"]) for r in own)
        got = out[conv]
        assert got.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert (got.n_turns, got.loss_chars, got.formatted_chars) == (len(own), len(loss), chars)
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.digest_conversations(chat_format.write_conversations(df.limit(0))).count() == 0


def test_values_of_strings_are_computed_once():
    asked = []

    def compute(new):
        asked.append(len(new))
        return np.array([ord(c) for s in new for c in s], np.uint32), np.array([len(s) for s in new])

    known = chunks.Values()
    keys = ["ab", "", "c", "ab", *map(str, range(70_000)), "c"]
    for _ in range(2):
        flat, sizes = known[known.slots(keys, compute)]
        assert "".join(map(chr, flat)) == "".join(keys) and sizes.tolist() == [*map(len, keys)]
    assert asked == [70_003]


def test_words_go_to_the_merge_model_once():
    """Whatever follows a word; what is no plain word up to a sure boundary goes whole."""
    from types import SimpleNamespace

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(chunks.tokenizer_path("byte_bpe_50k.json"))
    enc, seen = chunks.PieceEncoder(tok, False), []
    enc.model = SimpleNamespace(tokenize=lambda w: (seen.append(w), tok.model.tokenize(w))[1])
    parts = [" onre***", " onre", "onre.\nNt", " onre7", " été,", " été́", "", " ", "\n", " don't"]
    for _ in range(2):
        values, sizes = enc(parts)
        want = [tok.encode(c, add_special_tokens=False).ids for c in parts]
        assert values.tolist() == sum(want, []) and sizes.tolist() == [*map(len, want)]
    assert seen == ["Ġonre", "onre", "ĠÃ©tÃ©", "Ġdon"]
