"""State that a log of changes keeps, rewritten only where a batch touches it.

A store has the state's rows in buckets of their key's hash, and one version per batch: a small table that says for each
bucket which batch wrote its present rows. A step reads the buckets that its changes fall into, folds, writes them anew
under its own batch, and the version last. So the files that a step reads and writes follow its batch and not the
state, and every kept version can be read as it was.

Folding is by event time although batches come by arrival. The horizon is the latest time seen less the allowed delay;
changes before it are folded, later ones wait in ``pending``, which holds no more than that delay. Chunks therefore follow
one another in time, and any number of batches gives what one fold of the whole log gives. A change that comes behind
the horizon of an earlier batch is too late; it goes to ``late`` and not into the state.

A step whose version is there already does nothing; one that was cut off before its version writes over its own files.
So a repeated batch, after a lost executor or a restart, changes nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from proofmark import values as v
from proofmark.operators import changes as U

BUCKETS = 256
CODEC = "zstd"  # of the wide tables that a step writes
BEFORE, AFTER = -(1 << 62), 1 << 62  # microseconds before and after any
VERSION = "bucket int, written long, horizon long"

Fold = Callable[..., tuple[DataFrame, DataFrame]]


def fold_applications(
    apps: DataFrame, changes: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> tuple[DataFrame, DataFrame]:
    """Creates, then updates, completions, step marks and deletes; what was deleted in an earlier chunk stays so.

    State and rejected changes both come from the judged changes, which ``keep`` may write."""
    started, refused = U.apply_creates(changes, apps)
    rows = apps.unionByName(started.select(*[c for c in apps.columns if c in started.columns]), allowMissingColumns=True)
    judged = keep(U.judged_changes(changes, rows, gone=(v.DELETED_BY_USER, v.DELETED_BY_SCHEDULE)))
    state, rejected = U.fold_judged(rows, judged), judged.filter("reason IS NOT NULL")
    return state, rejected.unionByName(refused.select(*[c for c in rejected.columns if c in refused.columns]), allowMissingColumns=True)


def fold_attachments(attachments: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Added, patched and removed attachments."""
    return U.apply_attachment_patch(attachments, changes)


def _path(spark: SparkSession, p: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(p)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _there(spark: SparkSession, p: str) -> bool:
    path, files = _path(spark, p)
    return files.exists(path)


@contextmanager
def sizes_as_measured(spark: SparkSession) -> Iterator[None]:
    """Joins planned meanwhile are broadcast by the size that adaptive execution has measured, never by that of files.

    A store's files are compressed and its columns repeat their values, so a file of a few MB may hold rows that do not
    fit the driver. Without adaptive execution nothing is broadcast.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    limit, own = spark.conf.get(planned), spark.conf.get(measured, None)
    spark.conf.set(measured, own or limit)
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        spark.conf.set(planned, limit)
        if own:
            spark.conf.set(measured, own)
        else:
            spark.conf.unset(measured)


class Snapshots:
    """A store of one table's versions: ``key`` names a row, ``fold`` takes (rows, changes) to (rows, rejected).

    Changes have ``key`` and the time ``at``. ``fold`` sees whole keys and must give each row's new state from its own
    changes alone. Where it takes changes in any order, as sums and minima do, ``ordered`` is false: then each batch is
    folded as it comes, and nothing waits or is late. With ``keeps`` the fold takes a third argument, a function that
    writes a table which both its results read, so that it is made once.
    """

    def __init__(
        self, store: str, key: str, schema: T.StructType, changes: T.StructType, fold: Fold, delay_ms: int = 0, buckets: int = BUCKETS,
        ordered: bool = True, keeps: bool = False,
    ):
        self.store, self.key, self.schema, self.changes, self.fold = store, key, schema, changes, fold
        self.delay_ms, self.buckets, self.ordered, self.keeps = delay_ms, buckets, ordered, keeps

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write_rows(self, rows: DataFrame, batch: int) -> list[int]:
        """Writes rows by bucket; the buckets that have any."""
        spark, path = rows.sparkSession, f"{self.store}/rows/batch={batch}"
        rows.select("*", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path, compression=CODEC)
        folder, files = _path(spark, path)
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("bucket="))

    def _commit(self, spark: SparkSession, batch: int, version: dict[int, int], horizon: int) -> None:
        """The version, with one row more that has the horizon."""
        rows = [(b, n, None) for b, n in sorted(version.items())] + [(None, batch, horizon)]
        spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("overwrite").parquet(f"{self.store}/versions/batch={batch}")

    def committed(self, spark: SparkSession, batch: int) -> bool:
        return _there(spark, f"{self.store}/versions/batch={batch}/_SUCCESS")

    def last(self, spark: SparkSession) -> int:
        """The newest version."""
        folder, files = _path(spark, f"{self.store}/versions")
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return max(n for n in (int(x.partition("=")[2]) for x in names) if self.committed(spark, n))

    def version(self, spark: SparkSession, batch: int) -> tuple[dict[int, int], int]:
        """Which batch wrote each bucket (at most ``buckets`` rows), and the horizon."""
        rows = spark.read.schema(VERSION).parquet(f"{self.store}/versions/batch={batch}").collect()
        return {r.bucket: r.written for r in rows if r.bucket is not None}, next(r.horizon for r in rows if r.bucket is None)

    def rows(self, spark: SparkSession, batch: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state as of a batch, of some buckets or all."""
        version, _ = self.version(spark, self.last(spark) if batch is None else batch)
        by = defaultdict(list)
        for bucket, written in version.items():
            if buckets is None or bucket in buckets:
                by[written].append(bucket)
        base = f"{self.store}/rows"
        paths = [f"{base}/batch={n}/bucket={b}" for n, found in sorted(by.items()) for b in found]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def _part(self, spark: SparkSession, kind: str, batch: int) -> DataFrame:
        path = f"{self.store}/{kind}/batch={batch}"
        return spark.read.schema(self.changes).parquet(path) if _there(spark, path) else spark.createDataFrame([], self.changes)

    def _kept(self, df: DataFrame, batch: int) -> DataFrame:
        """What the fold keeps of a batch, written and read back."""
        path = f"{self.store}/kept/batch={batch}"
        df.write.mode("overwrite").parquet(path, compression=CODEC)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def late(self, spark: SparkSession) -> DataFrame:
        """Changes that came too late, with their batch."""
        return spark.read.schema(T.StructType([*self.changes.fields, T.StructField("batch", T.LongType())])).parquet(f"{self.store}/late")

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Changes that the fold refused, with the reason and the batch."""
        return spark.read.option("basePath", f"{self.store}/rejected").option("mergeSchema", "true").parquet(f"{self.store}/rejected")

    def start(self, rows: DataFrame) -> None:
        """The first version, from the rows there are."""
        if not self.committed(rows.sparkSession, -1):
            buckets = self._write_rows(rows.select(*self.schema.names), -1)
            self._commit(rows.sparkSession, -1, dict.fromkeys(buckets, -1), BEFORE)

    def step(self, batch: DataFrame, batch_id: int, until: int | None = None) -> None:
        """Folds a batch, and what waited for it; ``until`` (microseconds) moves the horizon further."""
        spark = batch.sparkSession
        if self.committed(spark, batch_id):
            return
        version, before = self.version(spark, batch_id - 1)
        batch = batch.select(*self.changes.names)
        arrived = f"{self.store}/arrived/batch={batch_id}"
        batch.write.mode("overwrite").parquet(arrived, compression=CODEC)
        batch = spark.read.schema(self.changes).parquet(arrived)
        at = F.unix_micros("at")
        latest = batch.agg((F.max(at) - self.delay_ms * 1000).alias("h")).first()["h"]
        horizon = max(h for h in (before, latest, until) if h is not None)
        if not self.ordered:
            before, horizon = BEFORE, AFTER
        too_late = F.coalesce(at < before, F.lit(True))  # also those without a time
        batch.filter(too_late).write.mode("overwrite").parquet(f"{self.store}/late/batch={batch_id}")
        open_ = self._part(spark, "pending", batch_id - 1).unionByName(batch.filter(~too_late))
        due = open_.filter(at < horizon)
        open_.filter(at >= horizon).write.mode("overwrite").parquet(f"{self.store}/pending/batch={batch_id}")
        touched = [r.bucket for r in due.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        if touched:
            keep = [lambda df: self._kept(df, batch_id)] if self.keeps else []
            with sizes_as_measured(spark):
                state, rejected = self.fold(self.rows(spark, batch_id - 1, touched), due, *keep)
                rejected.write.mode("overwrite").parquet(f"{self.store}/rejected/batch={batch_id}")
                written = self._write_rows(state.select(*self.schema.names), batch_id)
            version = {b: n for b, n in version.items() if b not in touched} | dict.fromkeys(written, batch_id)
        self._commit(spark, batch_id, version, horizon)
        for kind in ("arrived", "pending", "kept"):  # a repeated step still finds those of the batch before
            path, files = _path(spark, f"{self.store}/{kind}/batch={batch_id - 2}")
            files.delete(path, True)

    def finish(self, spark: SparkSession) -> None:
        """Folds what is pending, at the end of a replay."""
        self.step(spark.createDataFrame([], self.changes), self.last(spark) + 1, AFTER)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Deletes the rows that none of the last ``keep`` versions has, and the versions before; how many folders."""
        newest, gone = self.last(spark), 0
        used = {(n, b) for k in range(max(newest - keep + 1, -1), newest + 1) for b, n in self.version(spark, k)[0].items()}
        folder, files = _path(spark, f"{self.store}/rows")
        for status in files.listStatus(folder):
            batch = int(status.getPath().getName().partition("=")[2])
            if batch > newest:
                continue  # of a step that is under way
            for inner in files.listStatus(status.getPath()):
                name = inner.getPath().getName()
                if name.startswith("bucket=") and (batch, int(name.partition("=")[2])) not in used:
                    gone += files.delete(inner.getPath(), True)
        for k in range(-1, newest - keep + 1):
            path, _ = _path(spark, f"{self.store}/versions/batch={k}")
            files.delete(path, True)
        return gone

    def run(self, changes: DataFrame, interval: str | None = None) -> StreamingQuery:
        """Keeps the state of a stream of changes; without an interval it runs what is there and ends."""
        writer = changes.writeStream.foreachBatch(self.step).option("checkpointLocation", f"{self.store}/checkpoint")
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
