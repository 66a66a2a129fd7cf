"""A training corpus from raw documents: clean of insults, near copies and benchmarks, mixed, in token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written and read again as the
next one's ``docs``. All but the last return the columns of ``documents``; the last one returns
``doc_id, start, n_tokens, ids_crc32`` of the token files it has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlake.llm import decontaminate, jaccard_join, mixing, token_output, toxicity
from revlake.llm.common import release
from revlake.llm.queries import held_out, table, tokenizer_definition
from revlake.session import fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go. The model learns from the labelled rows that are not held out."""
    release(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()), "toxic")
    return toxicity.reject(docs, model, 0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the smallest id stays."""
    release(spark)
    return jaccard_join.one_of_each(docs, percent=80, width=5)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a fifth of its letters changed, go."""
    release(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as their source's target allows, up to three times."""
    release(spark)
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and where each one stands in them."""
    release(spark)
    return token_output.encode_and_read(docs, tokenizer_definition())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmarks),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]
#: SQL cannot express the model, the edit distances or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs


QUERIES, ORACLES = {"pipeline": run}, {}
