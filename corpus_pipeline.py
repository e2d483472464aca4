"""The corpus pipeline: five stages from raw documents to a training mix.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last
return the columns of ``documents``; the last adds ``copy_no``, the number of a
document's copy in the mix.

Edge cases, the same in every stage: rows are told apart by id and text, ids may be null or
repeated; a null, empty or blank text has no word and is rejected by the quality rules, and a
stage called on its own keeps it (mixing does so as any other row of size 0, so without
copies if the rate's draw says so); very long texts are read whole; repeated rows share every
decision (SimHash keeps one of them); an empty table gives an empty result with the same
columns; further columns are handed on as they are, also where their names clash with those of
``documents`` or of an operator in another case. ``n_chars`` is set anew by the line dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simrec.llm.common import Frame, checkpoint, table
from simrec.llm.decontaminate import decontaminate
from simrec.llm.line_dedup import dedup_lines
from simrec.llm.mixing import mix_sources
from simrec.llm.quality import quality_filter
from simrec.llm.simhash import RADIUS, SHINGLE, simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are similar to an earlier line."""
    f = Frame(dedup_lines(docs))
    if "n_chars" not in f.names:
        return f.restore(f.df)
    return f.restore(f.df.withColumn(f"_in{f.names.index('n_chars')}", F.length(f["text"]).cast("long")))


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return simhash_dedup(docs, shingle=SHINGLE, radius=RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target says."""
    return mix_sources(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_neardup", simhash_neardup),
    ("decontaminate", decontamination),
    ("mix_sources", mix),
]

#: SimHash fingerprints have no SQL form; tests/llm/test_pipeline.py has the brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``; every stage's result is cut off from its lineage."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs
