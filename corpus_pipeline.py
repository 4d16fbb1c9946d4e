"""From raw documents to training sequences, in five stages.

Toxic documents go; lines that repeat across documents go; of each group of near duplicates one document stays;
documents that hold benchmark items go; what is left is packed into sequences. Each stage takes
``(spark, docs, sf_dir)``, works on all that the stage before kept, and returns the columns of ``documents`` (the
last one returns pieces of sequences). Cases such as null texts, repeated rows and empty tables are those of the
operators: a stage drops a row only by its own decision, and every other column passes unchanged, but for ``n_chars``
where lines were cut. Between stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontamination, line_dedup, near_copies, packing, simhash, toxicity
from ledgerloom.llm.tables import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of rejection; labels are learnt from the rows not held out."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    return line_dedup.drop_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Near duplicates are linked by SimHash, as by ``simhash.near_duplicates``, and by the similarity of their shingles, which
    finds those whose fingerprints differ in more bits; groups are closed over the links of both.
    """
    prints = simhash.near_duplicates(docs).select("doc_id", "version", F.col("root").alias("part"))
    return near_copies.keep_one(docs, also=prints)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.digests(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]
#: Trained scores, components and tokens are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
