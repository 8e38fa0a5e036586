"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

Quality first, so that junk is not compared; near copies next; then benchmark passages and personal
data go; at last the documents get rates that mix them to target weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonehive.llm import decontam, mixing, near_text, pii, quality
from tonehive.llm.store import delete_at_end, scratch, shared_dir

#: Documents of this similarity on sets of five-word shingles, in per cent, are near copies (op3 alone takes 85);
#: under AGREE shared sub-signatures they are not compared, which loses about one pair in 8,000 at this similarity.
PERCENT, AGREE = 80, 3
#: Shares of expected tokens in the finished corpus. Poor and toxic text is gone but for what the classifier is
#: unsure of, about as much as this; larger shares would repeat the few doubtful documents a thousand times.
TARGETS = {"clean": 0.997, "rough": 0.002, "toxic": 0.001}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are poor or toxic by their own and their site's evidence."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the least doc_id."""
    return near_text.without_near_duplicates(docs, percent=PERCENT, agree=AGREE)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents, and cuts benchmark windows out of the others."""
    return decontam.without_contamination(docs, _table(spark, sf_dir, "benchmark"), length_col="n_chars")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in brackets in place of every span of personal data."""
    return pii.redact(docs, length_col="n_chars")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds tokens, domain posteriors and the rate at which a document is used; drops none.

    Columns are mix_tokens, mix_p_<domain> and mix_rate, with underscores added to a name that `docs` has.
    """
    mixed = mixing.mix(docs, _table(spark, sf_dir, "labels"), TARGETS)
    taken = {c.lower() for c in docs.columns}

    def fresh(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    domains = enumerate(sorted(TARGETS))
    return mixed.select("row.*", F.col("tokens").alias(fresh("mix_tokens")), *(F.col("p")[i].alias(fresh(f"mix_p_{d}")) for i, d in domains), F.col("rate").alias(fresh("mix_rate")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", remove_benchmark),
    ("personal_data", redact_personal_data),
    ("mixing", mix_to_targets),
]

#: The classifier and MinHash stages have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents. Rows with nulls, empty and very long texts and repeated rows go through.

    What a stage writes on its way is deleted when the stage is written, the stages' own tables with
    the application.
    """
    docs = _table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        delete_at_end(spark, f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
