"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import (
    bayes_dedup,
    feistel,
    lsh_forest,
    mixing,
    periodic,
    pii,
    quality_forest,
    roles,
    token_files,
    top_k,
    transducer,
    warc,
    whitening,
)
from tidewright.llm.shared import ship_package, table
from tidewright.session import work_folder

SHARDS = 24
# Target weights of the sources; sources not named have equal parts of the last weight, a NULL
# source too.
WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 2}
OTHER_WEIGHT = 10
TOP = 10


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = ready
    return ready


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_files.with_checksums(token_files.read_tokens(spark, path))


@query
def op2_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_forest.verdicts(docs, quality_forest.fit(docs, table(spark, sf_dir, "labels")))


@query
def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feistel.measured(table(spark, sf_dir, "documents"))
    dealt = feistel.sharded(rows, [F.col("doc_id"), F.col("__text")], SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.scheduled(rows, [F.xxhash64("doc_id"), F.col("doc_id")], WEIGHTS, OTHER_WEIGHT,
                            shared=True)


@query
def op5_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_copies(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op6_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.digests(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op7_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, compressed=True)
    found = warc.records(warc.read_archives(spark, path, compressed=True, with_payload=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, TOP)


@query
def op9_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.repair(table(spark, sf_dir, "conversations"))


@query
def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.fit(docs))


@query
def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_bayes_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_dedup.linked(table(spark, sf_dir, "documents"))


@query
def op13_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"), periodic.planted)
