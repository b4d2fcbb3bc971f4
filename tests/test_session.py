from collections import Counter

from helpers import bag
from pyspark.sql import functions as F

from tidewright.session import checkpointed, work_folder


def test_work_folder_is_fresh_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")


def test_checkpoint_cuts_lineage_in_the_shared_folder(spark):
    df = spark.range(20).groupBy((F.col("id") % 3).alias("k")).count()
    kept = checkpointed(df)
    assert bag(kept) == Counter([(0, 7), (1, 7), (2, 6)])
    assert "Aggregate" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()
