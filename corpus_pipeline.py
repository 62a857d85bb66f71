"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and gives back the columns of
documents; the last one gives tokens. Rows with nulls, empty texts or equal keys pass through each stage as that
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, lines, pieces, simhash, toxicity
from tallyframe.llm.common import table
from tallyframe.session import fresh_folder


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is trained on the labelled rows among ``docs``."""
    return toxicity.remove(docs, table(spark, sf_dir, "labels"))


def repeated_lines_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere before, up to one edit, go; so do documents of nothing else."""
    return lines.dedup(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints hang together by links of two bits or fewer (three words a shingle) stays."""
    return simhash.dedup(docs)


def benchmark_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and whether decoding gave the text back."""
    return pieces.tokens(docs)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("line dedup", repeated_lines_go),
    ("SimHash near-dedup", near_copies_go),
    ("benchmark decontamination", benchmark_passages_go),
    ("SentencePiece encoding", tokens),
]

#: SQL has neither the classifier nor the merge order of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
