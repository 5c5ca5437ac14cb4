"""Verification of a stream.

``start`` lands each micro-batch in a message table and keeps one state row per open expectation: the first message
that fits it and the last one it saw, so far. A step looks up its batch's messages for the open rows, with the same
ordered lookups as the batch form, so a hot key is spread here as it is there; landed messages are read again only
for expectations that are new. A verdict comes out once the horizon (latest event time less the allowed delay) has
passed the time that decides it; then no message on time can change it any more, and stream and batch agree.

New expectations come from a stream of their own, whose offsets say what is new, so a step reads its own rows, the open
ones and nothing else. A function that gives their whole table is taken too; then each step has to look for new ids
among all. The first failure of a run comes out with the step that decides it (``first_failures``).

Each step overwrites what its own batch id wrote before and reads the state of the batch before it, so a repeated
batch after a lost executor or a restart leaves the same tables. Open rows of older batches are deleted, and the
decided ones of every ``COMPACT`` batches move into one partition.

``satisfied`` is the built-in stream-stream form for expectations that only need a yes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from proofmark import schemas
from proofmark import values as v
from proofmark.operators import verify as V

# A day before any message.
MARKER_DAY = "0001-01-01"
COMPACT = 64
FAILURE = "run_id string, decided_at timestamp, expectation_id long, message string"
SEEN = "struct<at:long,offset:long,event_type:string,calls:int,value:string>"
STATE = f"{schemas.EXPECTATIONS}, start_us long, end_us long, hit_us long, seen {SEEN}"

OWN = [c.split()[0] for c in schemas.EXPECTATIONS.split(",")]
MESSAGE = ["topic", "key", "event_type", "calls", "value", "ts", "offset"]

Expectations = Callable[[SparkSession], DataFrame]


def _own_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replaces just the partitions that the rows fall into."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _markers(spark: SparkSession, store: str) -> None:
    """One null row of batch -1 per table, so that a table exists before its first real row."""
    none = F.lit(-1).cast("long")
    no_message = spark.createDataFrame([(None,) * 7], schemas.MESSAGES)
    first_day = F.to_date(F.lit(MARKER_DAY)).alias("day")
    _own_partitions(no_message.select("*", first_day, none.alias("batch")), f"{store}/messages", "day", "batch")
    no_state = spark.createDataFrame([(None,) * 13], STATE)
    for done in (True, False):
        _own_partitions(no_state.select("*", F.lit(done).alias("done"), none.alias("batch")), f"{store}/state", "batch", "done")
    no_state.write.mode("overwrite").parquet(f"{store}/decided/upto=-1")
    never = spark.range(1).select(F.lit(None).cast("timestamp").alias("latest"))
    never.write.mode("overwrite").parquet(f"{store}/horizon/batch=-1")


def _delete(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _exists(spark: SparkSession, p: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(p)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _land(batch: DataFrame, batch_id: int, store: str) -> None:
    """Writes the messages and, from the same pass, the latest time up to here."""
    spark = batch.sparkSession
    n = F.lit(batch_id).cast("long").alias("batch")
    latest = Observation(f"landed_{uuid.uuid4().hex}")
    landed = batch.observe(latest, F.max(F.unix_micros("ts")).alias("latest_us"))
    _own_partitions(landed.select("*", F.to_date("ts").alias("day"), n), f"{store}/messages", "day", "batch")
    before = spark.read.schema("latest timestamp").parquet(f"{store}/horizon/batch={batch_id - 1}")
    now = F.timestamp_micros(F.lit(latest.get.get("latest_us")).cast("long"))
    before.select(F.greatest("latest", now).alias("latest")).write.mode("overwrite").parquet(f"{store}/horizon/batch={batch_id}")


def _state(spark: SparkSession, store: str, batches: str, done: bool) -> DataFrame:
    """State rows of some batches; others are not even listed."""
    read = spark.read.schema(f"{STATE}, batch long, done boolean").option("basePath", f"{store}/state")
    return read.parquet(f"{store}/state/batch={batches}/done={str(done).lower()}").filter("batch >= 0").drop("done")


def _decided(spark: SparkSession, store: str) -> DataFrame:
    """State rows of all decided expectations so far: the compacted ones and those of the batches since."""
    old = spark.read.schema(f"{STATE}, upto long").option("basePath", f"{store}/decided").parquet(f"{store}/decided")
    upto = old.agg(F.max("upto")).scalar()
    new = _state(spark, store, "*", True).filter(F.col("batch") >= upto)
    return old.filter("upto >= 0").drop("upto").unionByName(new.drop("batch"))


def _landed(spark: SparkSession, store: str, days: str = "*") -> DataFrame:
    """Landed messages; days outside the given ones are not even listed."""
    read = spark.read.schema(f"{schemas.MESSAGES}, day date, batch long").option("basePath", f"{store}/messages")
    return read.parquet(f"{store}/messages/day={days}").filter("batch >= 0")


def _span(e: DataFrame):
    """The first and the last day of the windows of expectations that have their timeouts."""
    until = F.timestamp_micros(F.unix_micros("registered_at") + F.col("timeout_ms") * 1000)
    return e.agg(F.to_date(F.min("registered_at")).alias("first"), F.to_date(F.max(until)).alias("last")).first()


def _history(spark: SparkSession, store: str, fresh: DataFrame, batch_id: int) -> DataFrame:
    """Messages landed so far on the days that the windows of ``fresh`` span."""
    bounds = _span(fresh)
    seen = spark.read.schema("latest timestamp").parquet(f"{store}/horizon/batch={batch_id}")
    latest = seen.select(F.to_date("latest")).first()[0]
    days = [MARKER_DAY]
    if bounds["first"] is not None and latest is not None:
        span = (min(bounds["last"], latest) - bounds["first"]).days + 1
        days += [str(bounds["first"] + timedelta(days=i)) for i in range(max(span, 0))]
    listed = _landed(spark, store, f"{{{','.join(days)}}}").filter(F.col("batch") <= batch_id)
    return listed.drop("day", "batch")


def _open(spark: SparkSession, store: str, batch_id: int) -> DataFrame:
    """State rows that were open before a batch."""
    return _state(spark, store, f"{{-1,{batch_id - 1}}}", False)


def _unknown(spark: SparkSession, store: str, batch_id: int, expectations: DataFrame) -> DataFrame:
    """Expectations of a whole table that no earlier batch has seen."""
    known = _open(spark, store, batch_id).select("expectation_id").unionByName(_decided_before(spark, store, batch_id))
    return expectations.join(known, "expectation_id", "left_anti")


def _decide(spark: SparkSession, batch_id: int, store: str, expectations: DataFrame | Expectations, delay_ms: int) -> None:
    """A step; ``expectations`` are the batch's own, or a function that gives the whole table."""
    before = _open(spark, store, batch_id)
    new = expectations if isinstance(expectations, DataFrame) else _unknown(spark, store, batch_id, expectations(spark))
    fresh = V.with_default_timeout(new).select(*OWN)
    open_ones = before.select(*OWN, F.col("hit_us").alias("old_hit"), F.col("seen").alias("old_seen"))
    batch = _landed(spark, store).filter(F.col("batch") == batch_id).drop("day", "batch")
    parts = [] if open_ones.isEmpty() else [V.match(batch, open_ones)]
    if not fresh.isEmpty():
        nothing = [F.lit(None).cast("long").alias("old_hit"), F.lit(None).cast(SEEN).alias("old_seen")]
        parts.append(V.match(_history(spark, store, fresh, batch_id), fresh.select("*", *nothing)))
    if parts:
        _keep(spark, store, batch_id, reduce(DataFrame.unionByName, parts), delay_ms)
    if batch_id >= 2:  # the markers stay
        _delete(spark, f"{store}/state/batch={batch_id - 2}/done=false", f"{store}/horizon/batch={batch_id - 2}")
    if batch_id and batch_id % COMPACT == 0:
        _compact(spark, store, batch_id)


def _keep(spark: SparkSession, store: str, batch_id: int, found: DataFrame, delay_ms: int) -> None:
    """Writes the state after a step, the decided rows apart."""
    state = found.select(
        *OWN, "start_us", "end_us", F.least("old_hit", "hit_us").alias("hit_us"), F.greatest("old_seen", "seen").alias("seen")
    )
    latest = spark.read.schema("latest timestamp").parquet(f"{store}/horizon/batch={batch_id}").first()["latest"]
    horizon = F.lit(latest).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_ms / 1000))
    decides = F.when(F.col("hit_us").isNotNull(), F.col("hit_us")).otherwise(F.col("end_us"))
    rejected = (F.col("presence") == v.ABSENCE) & F.col("key").isNull()
    at = F.when(rejected, F.col("start_us")).otherwise(decides)
    done = F.coalesce(F.timestamp_micros(at) < horizon, F.lit(False)).alias("done")
    _own_partitions(state.select("*", F.lit(batch_id).cast("long").alias("batch"), done), f"{store}/state", "batch", "done")
    if _exists(spark, f"{store}/state/batch={batch_id}/done=true"):
        now = V.decided(_state(spark, store, str(batch_id), True)).filter("NOT satisfied")
        _first(now).write.mode("overwrite").parquet(f"{store}/failures/batch={batch_id}")


def _first(failed: DataFrame) -> DataFrame:
    first = F.struct("decided_at", "expectation_id", "message")
    return failed.groupBy("run_id").agg(F.min(first).alias("f")).select("run_id", "f.*")


def first_failures(spark: SparkSession, store: str) -> DataFrame:
    """The failure of each run that was decided first, ``(run_id, decided_at, expectation_id, message)``.

    Steps decide in the order of time, so a run's row never changes once it is there.
    """
    if not _exists(spark, f"{store}/failures"):
        return spark.createDataFrame([], FAILURE)
    return _first(spark.read.schema(FAILURE).parquet(f"{store}/failures"))


def _decided_before(spark: SparkSession, store: str, batch_id: int) -> DataFrame:
    """Ids decided by earlier batches."""
    old = spark.read.schema(f"{STATE}, upto long").option("basePath", f"{store}/decided").parquet(f"{store}/decided")
    new = _state(spark, store, "*", True).filter(F.col("batch") < batch_id)
    return old.filter("upto >= 0").select("expectation_id").unionByName(new.select("expectation_id"))


def _compact(spark: SparkSession, store: str, batch_id: int) -> None:
    """Decided rows of the batches since the last time, as one partition; a second run finds it written."""
    path, since = f"{store}/decided/upto={batch_id}", batch_id - COMPACT
    if not _exists(spark, f"{path}/_SUCCESS"):
        rows = _state(spark, store, "*", True).filter((F.col("batch") >= since) & (F.col("batch") < batch_id))
        rows.drop("batch").repartition(1 + spark.sparkContext.defaultParallelism).write.mode("overwrite").parquet(path)
    # The batch before this one stays, as a repeated step reads it.
    _delete(spark, *[f"{store}/state/batch={k}" for k in range(max(since - 1, 0), batch_id - 1)])


def start(
    messages: DataFrame,
    expectations: DataFrame | Expectations,
    store: str,
    delay_ms: int = 0,
    interval: str | None = None,
) -> StreamingQuery:
    """Verifies a stream of messages into ``store``; without an interval it runs what is there and ends.

    ``expectations`` is a stream, or a function that is called for every batch, so that rows added to their table
    later are found.
    """
    spark = messages.sparkSession
    _markers(spark, store)
    rows = messages.select(*MESSAGE)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _land(batch, batch_id, store)
        _decide(spark, batch_id, store, expectations, delay_ms)

    def step_of_both(batch: DataFrame, batch_id: int) -> None:
        spark, asked = batch.sparkSession, f"{store}/asked/batch={batch_id}"
        batch.filter("e IS NOT NULL").select("e.*").write.mode("overwrite").parquet(asked)
        _land(batch.filter("m IS NOT NULL").select("m.*"), batch_id, store)
        _decide(spark, batch_id, store, spark.read.schema(schemas.EXPECTATIONS).parquet(asked), delay_ms)

    if isinstance(expectations, DataFrame):
        m, e = F.struct(*MESSAGE).alias("m"), F.struct(*OWN).alias("e")
        asked = expectations.select(e)
        rows = rows.select(m, F.lit(None).cast(asked.schema["e"].dataType).alias("e"))
        rows = rows.unionByName(asked.select(F.lit(None).cast(rows.schema["m"].dataType).alias("m"), "e"))
        step = step_of_both
    writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", f"{store}/checkpoint")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def verdicts(spark: SparkSession, store: str) -> DataFrame:
    """What the stream has decided so far."""
    return V.decided(_decided(spark, store))


def close(spark: SparkSession, store: str, expectations: Expectations | None = None) -> DataFrame:
    """All verdicts at the end of a replay: the stream's own, and the batch form for what is still open.

    Expectations that came as a stream are in the store. Of the landed messages, only the days that the open windows
    span are read.
    """
    done = verdicts(spark, store)
    asked = expectations(spark) if expectations else spark.read.schema(schemas.EXPECTATIONS).parquet(f"{store}/asked")
    rest = asked.join(done.select("expectation_id"), "expectation_id", "left_anti")
    bounds = _span(V.with_default_timeout(rest))
    seen = _landed(spark, store).filter(F.col("day").between(F.lit(bounds["first"]), F.lit(bounds["last"])))
    return done.unionByName(V.verify(seen.drop("day", "batch"), rest))


def satisfied(
    messages: DataFrame, expectations: DataFrame, max_timeout: str, delay: str = "0 seconds",
    kinds: Sequence[int] = (V.NO_TEST, V.TYPE_TEST, V.COUNT_TEST, V.BOTH_TESTS),
) -> DataFrame:
    """Keyed presence expectations of a stream as soon as their first fitting message is in.

    A left semi join of two streams: one row per expectation, no pairs. ``max_timeout`` bounds the state,
    the row's own deadline gives the exact answer. An absence is decided by its deadline and a row without a key by
    any message of its topic, which this join cannot say: such a row ends the query with an error, ``start`` takes it.
    A message enters the state once per kind of predicates in ``kinds``; an expectation of another kind is such a row too.
    """
    asks = V.asked(F.col("expected_type"), F.col("expected_count"))
    odd = (F.col("presence") != v.PRESENCE) | F.col("presence").isNull() | F.col("key").isNull() | ~asks.isin(*kinds)
    text = F.concat(F.lit("only keyed presence expectations can be joined as a stream: "), F.col("expectation_id").cast("string"))
    kept = F.when(odd, F.raise_error(text).cast("string")).otherwise(F.col("key"))
    expectations = expectations.withColumn("key", kept)
    asked = F.explode(F.array(*[F.lit(k) for k in kinds])).alias("asked")
    fitting = (
        messages.select("topic", "key", "event_type", "calls", "ts", asked)
        .select("topic", "key", "asked", V.token_of("asked"), "ts")
        .filter("token IS NOT NULL")
        .withWatermark("ts", delay)
        .alias("m")
    )
    open_ones = (
        V.with_default_timeout(expectations)
        .withColumn("deadline", F.timestamp_micros(F.unix_micros("registered_at") + F.col("timeout_ms") * 1000))
        .withColumn("asked", V.asked(F.col("expected_type"), F.col("expected_count")))
        .withColumn("token", V.token(F.col("expected_type"), F.col("expected_count")))
        .withWatermark("registered_at", delay)
        .alias("e")
    )
    return open_ones.join(
        fitting,
        F.expr(
            "e.topic = m.topic AND e.key = m.key AND e.asked = m.asked AND e.token = m.token "
            f"AND m.ts >= e.registered_at AND m.ts <= e.registered_at + INTERVAL {max_timeout} "
            "AND m.ts <= e.deadline"
        ),
        "left_semi",
    ).drop("asked", "token")
