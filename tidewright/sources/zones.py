"""Zones of parquet tables that are replaced or merged into as a whole.

Plain parquet can neither be overwritten while it is read nor be changed in place. So a table
is a list of write-once segments: one base, then one segment per merged delta. Merging writes
the delta, and for every older row whose key it brings, the place of that row: its file and its
row number there. Readers leave those rows out by their place, so no keys are joined, and files
without such rows are read as they are.

The manifest keeps a zone map of every file: its rows, its range of key buckets, of the first key
and of change times. A merge looks only into files that may hold its keys, and a reader of a time
window lists only files whose range meets it. Large segments are written by ranges of key bucket and
time, so that both ranges are narrow. A numbered manifest appears by one rename after data and checks
are complete, so a lost executor or a failed check leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.windows import Cycle
from tidewright.operators.change import aligned
from tidewright.operators.quality import duplicate_uniques, refuse
from tidewright.operators.sizing import BROADCAST_BYTES, UNKNOWN_BYTES, are_small, read_bytes
from tidewright.operators.skew import hot_keys, key_hash, spread_join
from tidewright.sources import sketches
from tidewright.sources.files import Folder

# So many deltas are folded into one; the base stays as it is.
MAX_DELTAS = 24
# A table is rewritten as one base once its deltas reach this share of the base (and are worth the
# trouble), or once so many places of dead rows lie outside the manifest.
MAX_DELTA_SHARE = 0.2
MIN_DELTA_ROWS = 1_000_000
MAX_PLACES = 4_000_000
# Places kept in the manifest itself, and the files they may lie in; readers get them as literals.
INLINE_PLACES, INLINE_FILES = 2_000, 64
# Key buckets a file's range is told by, and the size of file that segments are cut into.
BUCKETS = 4096
FILE_BYTES = 256 << 20
# Segments of so many rows get a sketch of their unique values; smaller ones are just read.
SKETCH_ROWS = 1_000_000
# An upper bound of the bytes a key column of a fixed-width type takes per row.
_KEY_WIDTH = 24
_BASE, _DELTA = "base", "delta"
_PLACE = "file string, place bigint"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _overlap(a: Sequence | None, b: Sequence | None) -> bool:
    """Whether two closed ranges meet; an unknown one may meet any."""
    return a is None or b is None or (a[0] <= b[1] and b[0] <= a[1])


@dataclass(frozen=True)
class DataFile:
    """One file of a segment: closed ranges of its rows (None where unknown), and its dead rows."""

    name: str
    rows: int
    buckets: tuple[int, int] | None = None
    key: tuple[int, int] | None = None
    ts: tuple[str, str] | None = None
    # Places of dead rows, as far as they are kept here, and the number of those kept elsewhere.
    dead: tuple[int, ...] = ()
    spilled: int = 0

    @classmethod
    def of(cls, d: Mapping) -> DataFile:
        lists = {k: tuple(v) if v is not None else None
                 for k, v in d.items() if k in ("buckets", "key", "ts", "dead")}
        return cls(**{**d, **lists})


@dataclass(frozen=True)
class Segment:
    path: str
    kind: str
    rows: int
    files: tuple[DataFile, ...] = ()
    # The sketch of each unique key, by the key's columns.
    sketches: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, d: Mapping) -> Segment:
        return cls(**{**d, "files": tuple(DataFile.of(f) for f in d["files"])})

    def to_dict(self) -> dict:
        return {**vars(self), "files": [vars(f) for f in self.files]}


@dataclass(frozen=True)
class Manifest:
    number: int
    schema: T.StructType
    keys: tuple[str, ...]
    segments: tuple[Segment, ...]
    # The newest micro-batch merged from each stream.
    batches: dict[str, int] = field(default_factory=dict)
    # Folders with places of dead rows, beside those in the files' own entries.
    dead: tuple[str, ...] = ()
    # So many leading columns of the key decide where a row lies; 0 for all.
    lead: int = 0

    def to_json(self) -> str:
        return json.dumps(
            {
                "schema": self.schema.jsonValue(),
                "keys": list(self.keys),
                "segments": [s.to_dict() for s in self.segments],
                "batches": self.batches,
                "dead": list(self.dead),
                "lead": self.lead,
            }
        )

    @classmethod
    def from_json(cls, number: int, text: str) -> Manifest:
        d = json.loads(text)
        return cls(
            number,
            T.StructType.fromJson(d["schema"]),
            tuple(d["keys"]),
            tuple(Segment.of(s) for s in d["segments"]),
            dict(d["batches"]),
            tuple(d["dead"]),
            d.get("lead", 0),
        )

    def folders(self) -> set[str]:
        named = {s.path for s in self.segments} | set(self.dead)
        return named | {p for s in self.segments for p in s.sketches.values()}

    def live_rows(self) -> int:
        """Rows of the table, without reading it."""
        return sum(f.rows - len(f.dead) - f.spilled for s in self.segments for f in s.files)


class ZoneTable:
    """One table of a zone. One driver writes to it at a time; a second one is refused.

    That holds where a rename never replaces a file and shows at once, as on HDFS and local disks; an
    object store needs a committer or a lock of its own. `ts` names the column whose ranges let readers
    of a window leave files out; `uniques` are keys besides the merge key, checked with each merge.
    With `lead`, rows that share so many leading columns of the key lie together, for `holding`.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        ts: str | None = None,
        uniques: Sequence[Sequence[str]] = (),
        lead: int = 0,
    ) -> None:
        self.spark = spark
        self.path = path
        self.keys = tuple(keys)
        self.lead = lead
        self.ts = ts
        self.uniques = tuple(tuple(u) for u in uniques)
        self._folder = Folder(spark, path)
        self._manifests = Folder(spark, f"{path}/_manifests")

    def _numbers(self) -> list[int]:
        names = self._manifests.names()
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, number: int) -> Manifest:
        return Manifest.from_json(number, self._manifests.read_text(f"{number:010d}.json"))

    def current(self) -> Manifest | None:
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else None

    def _require(self) -> Manifest:
        found = self.current()
        if found is None:
            raise FileNotFoundError(f"nothing published at {self.path}")
        return found

    def exists(self) -> bool:
        return self.current() is not None

    def rows(self) -> int:
        """Rows of the newest segment: what the last replace or merge brought."""
        return self._require().segments[-1].rows

    def _commit(self, manifest: Manifest) -> None:
        self._manifests.create_text(f"{manifest.number:010d}.json", manifest.to_json())

    # Writing

    def _bucket(self, df: DataFrame, keys: Sequence[str]) -> Column:
        return F.pmod(key_hash(df, keys), F.lit(BUCKETS)).cast("int")

    def _has_ts(self, schema: T.StructType) -> bool:
        """Only times without a zone have a text that every session writes alike."""
        return self.ts in schema.names and isinstance(
            schema[self.ts].dataType, (T.TimestampNTZType, T.DateType))

    def _laid_out(self, df: DataFrame, keys: Sequence[str], kind: str, lead: int = 0) -> DataFrame:
        """Large frames by ranges of key bucket and change time, about `FILE_BYTES` a file.

        The size is that of the frame's sources and only decides the layout. A time that many rows
        share is split by the key's hash, leading columns that many share by the hash of the row.
        """
        estimate = read_bytes(df)
        files = ceil(estimate / FILE_BYTES)
        if files <= 1 or estimate >= UNKNOWN_BYTES or not (keys or self._has_ts(df.schema)):
            # Rows of a delta lie scattered over the splits of a large scan; even them out so
            # that the segment is a few files of a fair size.
            return df.hint("rebalance") if kind == _DELTA else df
        order = []
        if keys:
            bucket = self._bucket(df, keys)
            # As many ranges of buckets as ranges of time, or buckets alone.
            ranges = isqrt(files) if self._has_ts(df.schema) else files
            order.append(F.floor(bucket.cast("bigint") * F.lit(ranges) / F.lit(BUCKETS)))
        if self._has_ts(df.schema):
            order.append(F.col(f"`{self.ts}`"))
        order += [bucket] if keys else []
        if lead:
            order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        return df.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def _write(
        self, df: DataFrame, kind: str, keys: Sequence[str], lead: int = 0
    ) -> tuple[Segment, DataFrame]:
        keys = keys[:lead] if lead else keys
        name = f"seg-{uuid.uuid4().hex[:16]}"
        path = f"{self.path}/{name}"
        self._laid_out(df, keys, kind, lead).write.mode("errorifexists").parquet(path)
        # Read back: what is counted is what was written, not what tasks said they would write.
        written = self.spark.read.schema(df.schema).parquet(path)
        files = self._mapped(written, keys)
        rows = sum(f.rows for f in files)
        kept = {}
        if rows >= SKETCH_ROWS:
            for columns in self.uniques:
                where = f"sketch-{uuid.uuid4().hex[:16]}"
                sketches.write(written.select(*columns), rows, f"{self.path}/{where}")
                kept[",".join(columns)] = where
        return Segment(name, kind, rows, tuple(files), kept), written

    def _mapped(self, written: DataFrame, keys: Sequence[str]) -> list[DataFile]:
        """The zone map of each file of a segment, from one scan of keys and change times."""
        aggs = [F.count(F.lit(1)).alias("n")]
        first = keys[0] if keys else None
        whole = first is not None and isinstance(written.schema[first].dataType, _WHOLE)
        if keys:
            bucket = F.when(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys]),
                            self._bucket(written, keys))
            aggs += [F.min(bucket).alias("b0"), F.max(bucket).alias("b1")]
        if whole:
            aggs += [F.min(first).alias("k0"), F.max(first).alias("k1")]
        if self._has_ts(written.schema):
            text = F.date_format(F.col(f"`{self.ts}`").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
            aggs += [F.min(text).alias("t0"), F.max(text).alias("t1")]
        per_file = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(*aggs)

        def span(r, a: str, b: str):
            return (r[a], r[b]) if a in r and r[a] is not None else None

        found = [r.asDict() for r in per_file.collect()]
        return sorted((DataFile(r["name"], r["n"], span(r, "b0", "b1"), span(r, "k0", "k1"),
                                span(r, "t0", "t1")) for r in found), key=lambda f: f.name)

    def replace(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Publishes `df` as the whole table, after `check` has accepted what was written."""
        before = self.current()
        segment, written = self._write(df, _BASE, self.keys, self.lead)
        if check:
            check(written)
        number = before.number + 1 if before else 1
        batches = before.batches if before else {}
        self._commit(Manifest(number, df.schema, self.keys, (segment,), batches, lead=self.lead))
        return segment.rows

    # Reading

    def read(self) -> DataFrame:
        manifest = self._require()
        return self._live(manifest, manifest.segments)

    def read_within(self, cycle: Cycle) -> DataFrame:
        """Rows of the files that may hold change times of the window; the caller filters the rows.

        Files whose range lies outside are not even listed.
        """
        manifest = self._require()
        low, high = (t.strftime("%Y-%m-%d %H:%M:%S.%f") for t in (cycle.start, cycle.upto))

        def meets(file: DataFile) -> bool:
            return file.ts is None or (file.ts[0] < high and file.ts[1] >= low)

        return self._live(manifest, manifest.segments, meets)

    def _paths(self, chosen: Iterable[tuple[Segment, DataFile]]) -> list[str]:
        """Folders of segments chosen whole, and single files of others."""
        by_segment: dict[str, tuple[Segment, list[DataFile]]] = {}
        for segment, file in chosen:
            by_segment.setdefault(segment.path, (segment, []))[1].append(file)
        paths = []
        for segment, files in by_segment.values():
            if len(files) == len(segment.files):
                paths.append(f"{self.path}/{segment.path}")
            else:
                paths += [f"{self.path}/{segment.path}/{f.name}" for f in files]
        return paths

    def _live(
        self,
        manifest: Manifest,
        segments: Sequence[Segment],
        wanted: Callable[[DataFile], bool] = lambda file: True,
        placed: bool = False,
    ) -> DataFrame:
        """Rows that no later merge replaced, of the wanted files; with their places if asked for."""
        chosen = [(s, f) for s in segments for f in s.files if wanted(f)]
        clean = [(s, f) for s, f in chosen if not f.dead and not f.spilled]
        listed = [(s, f) for s, f in chosen if f.dead and not f.spilled]
        spilled = [(s, f) for s, f in chosen if f.spilled]
        file, place = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        names = [F.col(f"`{f.name}`") for f in manifest.schema.fields]
        at = [file.alias("__file"), place.alias("__place")]

        def scan(files: list[tuple[Segment, DataFile]]) -> DataFrame:
            return self.spark.read.schema(manifest.schema).parquet(*self._paths(files))

        def without_listed(files: list[tuple[Segment, DataFile]]) -> DataFrame:
            alive = F.lit(True)
            for _, f in files:
                if f.dead:
                    # One text for all places; a literal each would be a call each.
                    listed_there = F.expr(f"_metadata.row_index IN ({','.join(map(str, f.dead))})")
                    alive = F.when(file == f.name, ~listed_there).otherwise(alive)
            return scan(files).where(alive)

        parts = []
        if clean:
            parts.append(scan(clean).select(*names, *(at if placed else [])))
        if listed:
            parts.append(without_listed(listed).select(*names, *(at if placed else [])))
        if spilled:
            dead = self._dead(manifest, {f.name for _, f in spilled})
            if sum(f.spilled for s in manifest.segments for f in s.files) <= MAX_PLACES:
                dead = F.broadcast(dead)
            kept = without_listed(spilled).select(*names, *at).join(
                dead.toDF("__file", "__place"), ["__file", "__place"], "left_anti")
            parts.append(kept.select(*names, *(["__file", "__place"] if placed else [])))
        if parts:
            return reduce(DataFrame.union, parts)
        empty = self.spark.createDataFrame([], manifest.schema)
        return empty.selectExpr("*", "'' __file", "0L __place") if placed else empty

    def _dead(self, manifest: Manifest, names: set[str]) -> DataFrame:
        """Places of dead rows that the manifest does not hold itself."""
        found = self.spark.read.schema(_PLACE).parquet(*[f"{self.path}/{p}" for p in manifest.dead])
        every = {f.name for s in manifest.segments for f in s.files if f.spilled}
        return found if names == every and len(names) > INLINE_FILES else found.where(
            F.col("file").isin(sorted(names)))

    # Merging

    def _matching(self, manifest: Manifest, fresh: DataFrame, small: bool,
                  span: tuple[int, int] | None) -> DataFrame:
        """Live rows whose key is among `fresh`, with their places, from files that may hold it.

        `span` is the range of the first key, if known. `fresh` has the key's columns, or the leading ones.
        """
        keys, by = fresh.columns, manifest.keys[: manifest.lead] or manifest.keys
        files = [f for s in manifest.segments for f in s.files]
        hit: list[int] | None = None
        if any(f.buckets and f.buckets[1] - f.buckets[0] < BUCKETS // 2 for f in files):
            # At most `BUCKETS` numbers.
            found = fresh.select(self._bucket(fresh, by).alias("b")).distinct()
            hit = sorted(r["b"] for r in found.collect())

        def may_hold(file: DataFile) -> bool:
            if file.buckets is None or not _overlap(file.key, span):
                return False
            return hit is None or any(file.buckets[0] <= b <= file.buckets[1] for b in hit)

        old = self._live(manifest, manifest.segments, may_hold, placed=True)
        if span is not None:
            old = old.where(F.col(f"`{keys[0]}`").between(*span))
        if small:
            return old.join(F.broadcast(fresh), keys, "left_semi")
        hot = hot_keys(old.select(*keys).dropna(), keys)
        return spread_join(old.dropna(subset=keys), fresh.distinct(), keys, "left_semi", hot)

    def _replaced(self, manifest: Manifest, segment: Segment, written: DataFrame) -> DataFrame:
        """Places of live rows whose key the delta holds.

        A key with a NULL equals no other, so such rows are never replaced.
        """
        keys = list(manifest.keys)
        fresh = written.select(*keys).dropna()
        keyed = [f for f in segment.files if f.buckets]
        if not keyed:
            return self.spark.createDataFrame([], _PLACE)
        spans = [f.key for f in keyed]
        span = (min(k[0] for k in spans), max(k[1] for k in spans)) if all(spans) else None
        text = any(isinstance(manifest.schema[k].dataType, (T.StringType, T.BinaryType)) for k in keys)
        small = segment.rows * _KEY_WIDTH * len(keys) <= BROADCAST_BYTES and (
            not text or are_small(fresh))
        met = self._matching(manifest, fresh, small, span)
        return met.select(F.col("__file").alias("file"), F.col("__place").cast("bigint").alias("place"))

    def matching(self, keys_of: DataFrame) -> DataFrame:
        """The table's rows whose key occurs in another frame, from the files that may hold it."""
        manifest = self._require()
        return self._found(manifest, keys_of.select(*manifest.keys).dropna())

    def holding(self, leads_of: DataFrame) -> DataFrame:
        """The rows whose leading key columns occur in another frame, from the files that may hold them."""
        manifest = self._require()
        if not manifest.lead:
            raise ValueError(f"{self.path} is not laid out by leading columns")
        return self._found(manifest, leads_of.select(*manifest.keys[: manifest.lead]).dropna())

    def _found(self, manifest: Manifest, fresh: DataFrame) -> DataFrame:
        first = fresh.columns[0]
        whole = isinstance(manifest.schema[first].dataType, _WHOLE) and isinstance(
            fresh.schema[first].dataType, _WHOLE)
        span = None
        if whole:
            r = fresh.agg(F.min(first).alias("low"), F.max(first).alias("high")).first()
            if r["low"] is None:
                return self._live(manifest, ())
            span = (r["low"], r["high"])
        met = self._matching(manifest, fresh, are_small(fresh), span)
        return met.select(*[f"`{f.name}`" for f in manifest.schema.fields])

    def _marked(self, manifest: Manifest, found: DataFrame) -> Manifest:
        """The manifest with more dead rows, in itself while they are few."""
        files = [f for s in manifest.segments for f in s.files]
        room = max(0, INLINE_PLACES - sum(len(f.dead) for f in files))
        rows = found.limit(room + 1).collect()
        more: dict[str, list[int]] = {}
        for r in rows:
            more.setdefault(r["file"], []).append(r["place"])
        inline = {f.name for f in files if f.dead and not f.spilled} | set(more)
        if len(rows) <= room and len(inline) <= INLINE_FILES:
            def marked(f: DataFile) -> DataFile:
                return replace(f, dead=tuple(sorted({*f.dead, *more[f.name]}))) if f.name in more else f

            folders = manifest.dead
        else:
            folder = f"dead-{uuid.uuid4().hex[:16]}"
            found.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
            kept = self.spark.read.schema(_PLACE).parquet(f"{self.path}/{folder}")
            counts = {r["file"]: r["count"] for r in kept.groupBy("file").count().collect()}

            def marked(f: DataFile) -> DataFile:
                return replace(f, spilled=f.spilled + counts[f.name]) if f.name in counts else f

            folders = (*manifest.dead, folder)
        segments = tuple(replace(s, files=tuple(map(marked, s.files))) for s in manifest.segments)
        return replace(manifest, segments=segments, dead=folders)

    def upsert(
        self,
        df: DataFrame,
        check: Callable[[DataFrame, DataFrame], None] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> int:
        """Merges `df` by key: its keys are deleted, then all its rows appended.

        `check` gets the merged table and the delta before they are published, and the table's unique
        keys are checked. `batch` names a stream and the number of its micro-batch; one that was merged
        before is skipped.
        """
        before = self._require()
        if not before.keys:
            raise ValueError(f"{self.path} has no merge key")
        if batch and before.batches.get(batch[0], -1) >= batch[1]:
            return 0
        segment, written = self._write(aligned(df, before.schema), _DELTA, before.keys, before.lead)
        batches = {**before.batches, batch[0]: batch[1]} if batch else before.batches
        after = replace(before, number=before.number + 1, batches=batches)
        if segment.rows:
            after = self._marked(after, self._replaced(before, segment, written))
            after = replace(after, segments=(*after.segments, segment))
            if check:
                check(self._live(after, after.segments), written)
            for columns in self.uniques:
                self._require_unique(after, segment, written, columns)
        if segment.rows or batch:
            self._commit(after)
        self._tidy(after)
        return segment.rows

    def remove(self, keys_of: DataFrame) -> int:
        """Removes the rows whose key occurs in a frame, and tells how many; nothing is rewritten.

        A row with a NULL in its key equals no key and stays.
        """
        before = self._require()
        if not before.keys:
            raise ValueError(f"{self.path} has no merge key")
        fresh = aligned(keys_of.select(*before.keys), T.StructType(
            [before.schema[k] for k in before.keys])).dropna().distinct()
        met = self._matching(before, fresh, are_small(fresh), None)
        found = met.select(F.col("__file").alias("file"), F.col("__place").cast("bigint").alias("place"))
        after = replace(self._marked(before, found), number=before.number + 1)
        gone = before.live_rows() - after.live_rows()
        if gone:
            self._commit(after)
            self._tidy(after)
        return gone

    def holders(self, manifest: Manifest, segment: Segment, written: DataFrame, columns: Sequence[str]
                ) -> list[Segment]:
        """The older segments that may hold a value of the delta in these columns."""
        name = ",".join(columns)
        older = [s for s in manifest.segments if s.path != segment.path]
        told = {s.path: (f"{self.path}/{s.sketches[name]}", s.rows) for s in older if name in s.sketches}
        hit = sketches.holding(written.select(*columns).dropna(), told) if told else set()
        return [s for s in older if s.path not in told or s.path in hit]

    def _require_unique(self, after: Manifest, segment: Segment, written: DataFrame,
                        columns: Sequence[str]) -> None:
        """Refuses a value of the delta that any live row has as well.

        A table that kept the key before can only break it at a value of the delta, and only with
        rows of segments whose sketch may hold such a value.
        """
        values = written.select(*columns).dropna()
        holders = self.holders(after, segment, written, columns)
        at_risk = self._live(after, [*holders, segment]).select(*columns)
        if are_small(values):
            at_risk = at_risk.join(F.broadcast(values), list(columns), "left_semi")
        refuse(duplicate_uniques(at_risk, columns), f"{self.path}: duplicate {list(columns)}")

    # Tidying

    def _tidy(self, manifest: Manifest) -> None:
        """Keeps reading cheap, at a cost in proportion to the rows merged."""
        base, *deltas = manifest.segments
        if not deltas:
            return
        places = sum(f.spilled for s in manifest.segments for f in s.files)
        if places > MAX_PLACES or sum(s.rows for s in deltas) > max(
                MAX_DELTA_SHARE * base.rows, MIN_DELTA_ROWS):
            self.compact()
        elif len(deltas) >= MAX_DELTAS:
            self.fold()

    def fold(self) -> Manifest:
        """Writes all deltas as one; the base and the table's rows stay as they are."""
        before = self._require()
        base, *deltas = before.segments
        if len(deltas) < 2:
            return before
        segment, _ = self._write(self._live(before, deltas), _DELTA, before.keys, before.lead)
        folders: tuple[str, ...] = ()
        if any(f.spilled for f in base.files):
            # Places in the base are written together; those in the deltas are gone with them.
            folders = (f"dead-{uuid.uuid4().hex[:16]}",)
            kept = self._dead(before, {f.name for f in base.files if f.spilled})
            kept.hint("rebalance").write.parquet(f"{self.path}/{folders[0]}")
        after = replace(before, number=before.number + 1, segments=(base, segment), dead=folders)
        self._commit(after)
        return after

    def compact(self) -> None:
        """Rewrites the table as one base segment; its rows stay as they are."""
        before = self._require()
        if len(before.segments) == 1:
            return
        segment, _ = self._write(self._live(before, before.segments), _BASE, before.keys, before.lead)
        self._commit(replace(before, number=before.number + 1, segments=(segment,), dead=()))

    def vacuum(self, keep: int = 5) -> list[str]:
        """Removes segments that none of the last `keep` manifests names, and old manifests."""
        numbers = self._numbers()
        kept = numbers[-max(1, keep):]
        named = {p for n in kept for p in self._manifest(n).folders()}
        owned = ("seg-", "dead-", "sketch-")
        gone = [n for n in self._folder.names() if n.startswith(owned) and n not in named]
        for number in numbers[: -max(1, keep)]:
            self._manifests.remove(f"{number:010d}.json")
        for name in gone:
            self._folder.remove(name)
        return gone


class Zone:
    """A folder of tables. It comes into being with its first table.

    A zone is a source for builders: called with a name it hands out the table, and `within` hands
    out the part of it that may hold change times of a window.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def table(
        self, name: str, keys: Sequence[str] = (), ts: str | None = None,
        uniques: Sequence[Sequence[str]] = (),
    ) -> ZoneTable:
        return ZoneTable(self.spark, f"{self.path}/{name}", keys, ts, uniques)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def __call__(self, name: str) -> DataFrame:
        return self.read(name)

    def within(self, name: str, cycle: Cycle) -> DataFrame:
        return self.table(name).read_within(cycle)

    def tables(self) -> list[str]:
        return [n for n in Folder(self.spark, self.path).names() if not n.startswith("_")]
