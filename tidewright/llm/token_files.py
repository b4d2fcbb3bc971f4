"""Token ids as Parquet files: delta-coded numbers, dictionary-coded ids, small row groups.

Each row holds a document's id list and the numbers needed to find it. Files are in ascending
order of doc_id, so the page and row group statistics of doc_id let a reader skip everything
but the pages asked for, and a reader of the numbers alone never touches the lists.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.words import Chunks, Recent, slices

END_ID = 2
# Chunks remembered by a task (twice as many at most), the longest chunk that is remembered, and
# the new chunks that are encoded at once.
CACHED_CHUNKS = 300_000
CACHED_LENGTH = 48
CHUNKS_AT_ONCE = 512

FILE_SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"
# Numbers are delta-coded (version 2 pages without a dictionary), ids take a dictionary.
FILE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_part": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


class LibraryEncoder:
    """Ids of texts by a tokenizer file of the tokenizers library, as little-endian uint32.

    The tokenizer lowers case and drops white space, and no token crosses it, so chunks between white space seen
    before are remembered, and new chunks are encoded many at a time as one text. A file for
    which that does not hold is refused.
    """

    def __init__(self, file_text: str):
        # Spark runs a task per core; threads of the library would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: Recent[bytes] = Recent(CACHED_CHUNKS)
        for probe in ("it's, A b. I'd (so) go!?", " 12. ćD  e<|endoftext|>f "):
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            if np.frombuffer(self(pa.array([probe]))[0], "<u4").tolist() != whole:
                raise ValueError("a tokenizer that minds case, or whose tokens cross white space")

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks encoded as one text; a token belongs to the chunk it begins in."""
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        data = np.array(found.ids, "<u4").tobytes()
        begins = np.cumsum([0, *(len(c) + 1 for c in chunks)])
        starts = np.fromiter((at for at, _ in found.offsets), np.int64, len(found))
        cuts = np.searchsorted(starts, begins).tolist()
        return [data[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def __call__(self, texts: pa.Array) -> list[memoryview]:
        chunks = Chunks(texts)
        found, new = self.known.values(chunks.distinct)
        for at in range(0, len(new), CHUNKS_AT_ONCE):
            places = new[at : at + CHUNKS_AT_ONCE]
            strings = [chunks.distinct[i] for i in places]
            ids = self._encode(strings)
            self.known.learn(strings, ids, CACHED_LENGTH)
            for i, x in zip(places, ids, strict=True):
                found[i] = x
        return chunks.joined(found)


_OPEN: dict[str, LibraryEncoder] = {}


def _encoder(file_text: str) -> LibraryEncoder:
    """One encoder per worker process, so that its tasks share what is remembered."""
    if file_text not in _OPEN:
        _OPEN.clear()
        _OPEN[file_text] = LibraryEncoder(file_text)
    return _OPEN[file_text]


def _encoded(batches: Iterator[pa.RecordBatch], file_text: str) -> Iterator[pa.RecordBatch]:
    encode, part, start = _encoder(file_text), TaskContext.get().partitionId(), 0
    end = np.array([END_ID], "<u4").tobytes()
    for batch in slices(batches):
        ids = [bytes(x) + end for x in encode(batch.column("text"))]
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        ends = start + np.cumsum(sizes)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
            pa.array(np.frombuffer(b"".join(ids), "<i4")),
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(ends - sizes),
                pa.array(sizes),
                lists,
            ],
            ["doc_id", "part", "start_in_part", "n_tokens", "ids"],
        )
        start = int(ends[-1])


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str) -> None:
    """Encodes `text` of every row, appends the end id and writes the files.

    A NULL text counts as empty. Rows are ordered by doc_id (NULL first), rows of one doc_id by
    a hash of their text and then the text. Columns other than doc_id and text are left out.
    The texts move once, by ranges of (doc_id, hash), so a doc_id that many rows share is
    still spread. The tokenizer file (about 2 MB) travels with the tasks.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ids = dealt.mapInArrow(lambda batches: _encoded(batches, sent.value), FILE_SCHEMA)
    ids.write.options(**FILE_OPTIONS).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before) and n_tokens, without reading the ids."""
    return _with_start(spark.read.schema(FILE_SCHEMA).parquet(path)).drop("ids")


def read_tokens(spark: SparkSession, path: str, first: int | None = None,
                last: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids; of the documents from `first` to `last` if given.

    The bounds reach the scan, which skips row groups and pages outside them.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    wanted = files
    if first is not None:
        wanted = wanted.where(F.col("doc_id") >= first)
    if last is not None:
        wanted = wanted.where(F.col("doc_id") <= last)
    return _with_start(wanted, files)


def _with_start(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    sizes = (rows if files is None else files).groupBy("part").agg(
        F.max(F.col("start_in_part") + F.col("n_tokens")).alias("__n")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    # One row per written file.
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("__before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        data = memoryview(
            np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
        ).cast("B")
        cuts = lists.offsets.to_numpy().astype(np.int64) * 4
        sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            + [pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian uint32."""
    return tokens.mapInArrow(
        _checked, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
