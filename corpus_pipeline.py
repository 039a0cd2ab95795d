"""Corpus pipeline: from raw documents to packed training sequences.

Stages, each over all that its predecessor kept:

1. language ID     documents whose language cannot be told go: no letters, or no language
                   that is likelier than all the others together
2. exact dedup     of equal texts the row with the largest id stays
3. near dedup      of each class of the n-gram Jaccard join the least id stays
4. decontamination documents that hold a benchmark item go
5. packing         the rest becomes pieces in sequences of at most 1024 tokens

Stages 1 to 4 return the columns they were given; stage 5 returns pieces.  Each stage is
written as Parquet under the shared checkpoint folder and read again as the next one's
documents, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casekit.llm import decontam, exact_dedup, lang_id, ngram_join, packing
from casekit.llm.common import stored, table
from casekit.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.keep_identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "digest-index")
    index = exact_dedup.DigestIndex(spark, "digests_" + path.rsplit("-", 1)[1], path)
    return exact_dedup.keep_first_copies(docs, index)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.ids_crc32(packing.pack_documents(docs))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup_stage),
          ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: No SQL expresses the language model, the edit distance or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
