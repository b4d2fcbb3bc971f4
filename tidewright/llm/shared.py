"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.sizing import are_small
from tidewright.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame's rows, written once to the folder all executors share and read again.

    A lost executor then costs its running tasks only, and what follows starts from the files.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, lengthened where the frame has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


BROADCAST_BYTES = 24 << 20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, marked for a broadcast if its measured bytes fit, text included."""
    # Keys of several columns travel as a struct, which is measured by its fields.
    structs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
    flat = df.select(*[F.col(f"`{f.name}`") if f.name not in structs else F.col(f"`{f.name}`.*")
                       for f in df.schema.fields])
    names = [f"c{i}" for i in range(len(flat.columns))]
    return F.broadcast(df) if are_small(flat.toDF(*names), limit=limit) else df


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file in any file system Spark reaches."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(data)
    finally:
        out.close()


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    group: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Adds each row's position (from 0) by `order`, in the whole frame or in its `group`.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over tasks.
    Each row gets its place in its partition; the places before it come from one small row per
    partition and group. The frame should be narrow, as its rows are written once. Rows that
    are equal in `order` share a partition; give enough columns to tell different rows apart.
    With `total` the number of rows of the group is added too.
    """
    keys = [F.col(group)] if group else []
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    cell = F.struct(F.lit(0) if group is None else F.col(group))
    placed = placed.withColumn("__part", part).withColumn("__cell", cell)
    sizes = placed.groupBy("__part", "__cell").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")
    )
    whole = Window.partitionBy("__cell")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part", "__cell", "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("__total"),
    )
    found = placed.join(starts, ["__part", "__cell"])
    place = (F.col("__before") + F.col("__at") - F.col("__first")).alias(name)
    more = [F.col("__total").alias(total)] if total else []
    return found.select(*[F.col(f"`{c}`") for c in df.columns], place, *more)


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Adds each row's place (from 0) in the files the frame reads, in the order they were written.

    Spark numbers the files of a write by partition; what reads them packs them by size. A row's
    place is that in its file after the rows of the files before, found from one small row per
    file. A frame that is more than a plain read is written first. A column called `name` gives way.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        df = stored(df, "ordered")
    path = F.col("_metadata.file_path")
    kept = [c for c in df.columns if c.lower() != name.lower()]
    of, row, begins = own_names(df, "file_of_row", "row_of_file", "rows_before")
    placed = df.select(*[F.col(f"`{c}`") for c in kept], path.alias(of),
                       F.col("_metadata.row_index").alias(row))
    part = F.regexp_extract(of, r"/part-([0-9]+)[^/]*$", 1).try_cast("long")
    sizes = df.select(path.alias(of)).groupBy(of).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part, of).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(of, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(begins))
    found = placed.join(broadcast_if_small(starts), of)
    place = (F.col(begins) + F.col(row)).cast("long").alias(name)
    return found.select(*[F.col(f"`{c}`") for c in kept], place)


BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lets tasks take at most so many texts from the JVM at once, unless the session says less."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(setting, None)
    if not given or not 0 < int(given) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(work: Work) -> Work:
    """The same work, which gives the memory of a task back to the system when it ends.

    Workers live on between tasks and stages. What the allocators keep for later would add up with
    what other stages' workers and the JVM hold on the same executor.
    """

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Brings this package to the executors, once per application.

    Tasks that run in Python import it. A cluster job may pass it with --py-files instead.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = f"{work_folder(spark, 'package')}/tidewright.zip"
    write_bytes(spark, path, packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
