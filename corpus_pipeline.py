"""A training-corpus pipeline in five stages, each an operator of panelmill.llm.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

1. quality_rules: documents that fail the base rule or the learned decision list go.
2. near_duplicates: of documents linked by SimHash (three-word shingles, 3 or fewer differing bits) the least doc_id stays.
3. repeated_passages: words of 20-word windows that start earlier in the corpus go; n_chars follows.
4. decontamination: documents that hold a benchmark item go.
5. token_ids: SentencePiece ids of what is left.

Nulls: a null text is an empty one (the first stage rejects it); a null doc_id is judged by its text and isn't dropped as
anyone's duplicate. An empty table gives an empty table. Rules and decontamination judge each row by its own text; rows with equal
doc_id are one document to near-dedup, where they stand or fall together, and to repeated passages. run() deletes a stage's rows once
the next one's are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm import decontaminate, pieces, rules, simhash, substrings
from panelmill.session import spent, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    later = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("later_doc_id")).distinct(), "later-copies")
    return docs.join(later, docs["doc_id"] == later["later_doc_id"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(docs)
    held = {c: F.col(f"rest.`{c}`") for c in docs.columns if c not in ("doc_id", "text")}
    held |= {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in held:
        held["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[held[c].alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.model_bytes(pieces.default_model()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: SQL can't express learned rules, components or the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        spent(before)
    return STAGES[-1][1](spark, docs, sf_dir)
