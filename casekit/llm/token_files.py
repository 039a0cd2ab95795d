"""Token-id output: flat files of unsigned integers plus 64-bit document offsets.

Layout under one folder, one pair of files per range of document ids::

    ids-00007.bin      unsigned little-endian ids (16 bits, or 32 for a larger vocabulary)
    offsets-00007.bin  int64: (documents + 1) offsets into the ids, then the document ids
    manifest.parquet   one row per pair: documents, tokens, its global base, bytes an id

The documents are range-partitioned and sorted by id, each task writes one pair, and the
base of each pair is the prefix sum of the tokens before it.  A task writes under a name
of its own attempt and renames at the end, so a task that is lost or run twice leaves
whole files only; readers open the files named in the manifest, which is what the tasks
that succeeded returned.  The manifest is written last (a folder without it holds no
data set), and files of other attempts are deleted then; ``open_token_files`` reads the
data set in any later session.  A file whose folder is a local or mounted path is memory-mapped;
in another file system it is read through that system.

Defined results
    * a null or empty text is the end id alone;
    * rows with the same id stand in order of their text; null ids stand first;
    * an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casekit.session import scratch_path

from .chunks import ids_of, slices, tokenizer_path
from .common import ship

MANIFEST = "part long, name string, documents long, tokens long"
_FULL = MANIFEST + ", base long, id_bytes int"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
_NO_ID = np.iinfo(np.int64).min          # a null document id in the offsets file


def _file_system(folder: str):
    """The file system of a folder given as a path or URI, and the path in it."""
    from pyarrow import fs
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _load(filesystem, path: str, dtype: str) -> np.ndarray:
    from pyarrow import fs
    if isinstance(filesystem, fs.LocalFileSystem):
        if os.path.getsize(path) == 0:
            return np.empty(0, dtype)
        return np.memmap(path, dtype=dtype, mode="r")
    with filesystem.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json",
                      end_id: int = 1, id_bytes: int = 2, partitions: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return the manifest with the global base of each pair.

    The driver holds one row per pair of files, never ids or documents.
    """
    spark = docs.sparkSession
    ship(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dtype = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        filesystem, root = _file_system(folder)
        filesystem.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex[:12]
        enc = ids_of(tokenizer_path(tokenizer))
        sizes, owners = [], []
        name = f"{part:05d}-{attempt}"
        tmp = f"{root}/.ids-{name}"
        with filesystem.open_output_stream(tmp) as out:
            for b in batches:
                for at, to in slices(b.column(1)):
                    flat, ends = enc(b.column(1)[at:to])
                    if len(flat) and int(flat.max()) >= 1 << (8 * id_bytes):
                        raise ValueError(f"an id does not fit into {id_bytes} bytes")
                    # the end id after each document
                    out.write(np.insert(flat, ends[1:], end_id).astype(dtype).tobytes())
                    sizes += (np.diff(ends) + 1).tolist()
                owners += b.column(0).fill_null(_NO_ID).to_pylist()
        if not sizes:
            filesystem.delete_file(tmp)
            return
        with filesystem.open_output_stream(f"{root}/.offsets-{name}") as out:
            out.write(np.concatenate([[0], np.cumsum(sizes, dtype="<i8"),
                                      np.asarray(owners, "<i8")]).astype("<i8").tobytes())
        for kind in ("ids", "offsets"):
            filesystem.move(f"{root}/.{kind}-{name}", f"{root}/{kind}-{name}.bin")
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name,
                                           "documents": len(sizes), "tokens": sum(sizes)}])

    placed = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(text_col).alias("text"))
              .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    written = placed.mapInArrow(run, MANIFEST).collect()     # a row per file
    manifest = _with_bases(spark, written, id_bytes)
    manifest.coalesce(1).write.parquet(f"{folder}/manifest.parquet")
    _remove_others(folder, {r["name"] for r in written})
    return open_token_files(spark, folder)


def open_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of files that an earlier run, or session, has written."""
    return spark.read.schema(_FULL).parquet(f"{folder}/manifest.parquet")


def _with_bases(spark: SparkSession, written: list, id_bytes: int) -> DataFrame:
    rows = sorted(written, key=lambda r: r["part"])
    bases = [0, *accumulate(r["tokens"] for r in rows)]
    return spark.createDataFrame([(r["part"], r["name"], r["documents"], r["tokens"], b, id_bytes)
                                  for r, b in zip(rows, bases)], _FULL)


def _remove_others(folder: str, names: set[str]) -> None:
    """Delete what attempts that failed, or ran twice, have left."""
    from pyarrow import fs
    filesystem, root = _file_system(folder)
    for f in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        kind, _, rest = f.base_name.lstrip(".").partition("-")
        if kind in ("ids", "offsets") and rest.removesuffix(".bin") not in names:
            filesystem.delete_file(f.path)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, read back from the files: global start, tokens, CRC-32 of
    its ids as little-endian unsigned 32-bit integers."""
    ship(manifest.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        filesystem, root = _file_system(folder)
        for b in batches:
            for r in b.to_pylist():
                dtype = {2: "<u2", 4: "<u4"}[r["id_bytes"]]
                ids = _load(filesystem, f"{root}/ids-{r['name']}.bin", dtype)
                meta = _load(filesystem, f"{root}/offsets-{r['name']}.bin", "<i8")
                offsets, docs = meta[:r["documents"] + 1], meta[r["documents"] + 1:]
                crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes())
                       for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if d == _NO_ID else d for d in docs.tolist()], pa.int64()),
                     pa.array(offsets[:-1] + r["base"], pa.int64()),
                     pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.repartition(int(manifest.sparkSession.conf.get(
        "spark.sql.shuffle.partitions")), "part")
    return files.mapInArrow(run, RESULT)


def token_files_round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read every document back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, **options)
    return read_token_files(manifest, folder)
