"""From raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written
and read again as the next one's docs: quality classifier, line dedup,
SimHash near-dedup, packing.  All but the last return the columns of
documents.  An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctrecon.llm import packing, quality
from acctrecon.llm.common import cut, new_folder, table
from acctrecon.llm.line_dedup import without_repeats
from acctrecon.llm.queries import TOKENIZER
from acctrecon.llm.simhash import one_of_each
from acctrecon.plans.cut import remove_at_exit


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  It is fitted on the
    labelled ones among ``docs`` and judges each row by its text, null as the
    empty text; with no label it keeps all.  Rows that repeat a doc_id, or have
    none, are judged each by itself."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in that of the largest
    doc_id.  Null and empty texts come out empty.  Rows that repeat a doc_id are
    one document there; rows without one lose no line."""
    return without_repeats(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that of the smallest
    doc_id, those without one last; of equal ids the smallest fingerprint, then
    the smallest text.  Null and empty texts are copies of each other.  A row
    goes only for a copy of its own text, whatever ids repeat."""
    return one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents that are left, dealt to buckets of
    equal length.  Null and empty texts have a sequence of one id, rows that
    repeat a doc_id sequences of their own."""
    # workers live on through other stages, so they keep fewer chunks than a
    # packing job of its own would
    packed = packing.pack(docs, TOKENIZER, cache=PIPELINE_CACHE, added=True)
    folder = new_folder(spark, "sequences")
    packing.write_buckets(packed, folder)
    remove_at_exit(spark, folder)
    return packing.read_buckets(spark, folder)


#: Chunks that a worker of the pipeline keeps.
PIPELINE_CACHE = 1 << 17

STAGES = [("quality", classify), ("line_dedup", dedup_lines), ("near_dedup", dedup_near), ("packing", pack)]

#: SQL can express neither the field nor the hashes nor the tokenizer; the
#: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
