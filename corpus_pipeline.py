"""From raw documents to token ids, in five stages that each write and reread Parquet.

Quality rules reject documents, one document of each group of near copies stays, personal data is
replaced, the rest is put in the mixed order of its sources, and every text is encoded. The result
tells each document's position in the mixed order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import lsh_forest, mixing, pii, quality_forest, transducer
from tidewright.llm.queries import OTHER_WEIGHT, WEIGHTS, tokenizer_file
from tidewright.llm.shared import bound_batches, in_file_order, ship_package, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the forest finds anomalous go."""
    ship_package(spark)
    bound_batches(spark)
    return quality_forest.keep_good(docs, quality_forest.fit(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more, the document with the least id stays."""
    ship_package(spark)
    bound_batches(spark)
    return lsh_forest.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind; n_chars stays that of the original text."""
    return pii.redacted(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, put in the order in which their sources' blocks are scheduled."""
    return mixing.mixed(docs, WEIGHTS, OTHER_WEIGHT, shared=True)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded text, and the mixed position.

    The position is read back from the files of the stage before, whose order is the mixture's.
    """
    ship_package(spark)
    bound_batches(spark)
    return transducer.digests(in_file_order(docs, "position"), tokenizer_file(), also=["position"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("personal data", personal_data),
    ("mixing sources", mixture),
    ("BPE encoding", encoding),
]

# SQL can express neither forests, nor boosted trees, nor the merges of BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
