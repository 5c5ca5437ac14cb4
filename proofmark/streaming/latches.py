"""Verification of a stream by one latch per expectation in Spark's state store, and the first failure of each run.

Expectations and messages are two streams, grouped by topic and key. Per group the state store (RocksDB) has the open
expectations with their latch: the first message that fits and the last one seen, so far. Messages are kept until the
watermark has passed them, for expectations that come after them. A latch closes at its deciding moment, the time of the
fitting message or the deadline: once the watermark has passed it, no message on time can change the verdict. A step with
rows of a group closes its latches; for the others each group has one event-time timer, set to the first that closes. So a
step touches the groups of its own rows and due timers, whatever the state's size, and Spark keeps the state's versions
with the checkpoint. Latches and messages lie in the state in blocks of rows, as a call of the store is a round trip
between Python and the JVM.

``first_failures`` is a second stateful step behind it, on the same watermark: verdicts come in the order of their
deciding moments, so the least failure of a run in the first step that has one is the first for good.

The state functions run in Python, one task per group at a time; a group's messages of a step are sorted once and every
expectation finds its own by binary search. A key with a third of all messages is one group, so for such keys
``verification.start`` is the form to take: it spreads a hot key over tasks and stays in the JVM.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.query import StreamingQuery

from proofmark import values as v
from proofmark.operators import verify as V

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ASKED = "run_id string, presence string, expected_type string, expected_count int, start_us long, end_us long"
SEEN = "at long, offset long, event_type string, calls int, value string"
OPEN = f"expectation_id long, {ASKED}, hit_us long, {', '.join('seen_' + c for c in SEEN.split(', '))}"
FOUND = f"expectation_id long, topic string, key string, {ASKED}, hit_us long, seen struct<{SEEN.replace(' ', ':').replace(',:', ',')}>, decided_at timestamp"
BLOCK = 256
LATCHES, MESSAGES = "latches", "messages"


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


NAMES = _names(OPEN)
END, HIT, SEEN_AT = (NAMES.index(c) for c in ("end_us", "hit_us", "seen_at"))
# A message's value, type, calls, time and offset come in the columns of an expectation.
GIVEN = ["topic", "key", "ts", "is_message", "expectation_id", *_names(ASKED)]


def _fits(presence: str, kind: str | None, count: int | None) -> tuple:
    """What a message must have, as the key of an index."""
    return (None, None) if presence == v.ABSENCE else (kind, count)


class _Group:
    """The state of one topic and key: lists of rows of two kinds, latches and messages, in blocks of up to ``BLOCK``.

    A call of the state store is a round trip to the JVM, so it carries a block, as JSON. A step writes the blocks that
    it changes and fills up the last one.
    """

    def __init__(self, state):
        self.state, self.blocks = state, {LATCHES: {}, MESSAGES: {}}
        for (kind, block), (rows,) in state.iterator():
            self.blocks[kind][block] = json.loads(rows)

    def rows(self, kind: str) -> list[list]:
        return [x for rows in self.blocks[kind].values() for x in rows]

    def replace(self, kind: str, change, new: Sequence[list] = ()) -> None:
        """``change`` gives a row's new state, or None where it goes; ``new`` rows are added."""
        before = self.blocks[kind]
        now = {k: [x for x in map(change, rows) if x is not None] for k, rows in before.items()}
        last, new = max(now, default=-1), list(new)
        if new and last >= 0:
            room = max(BLOCK - len(now[last]), 0)
            now[last], new = now[last] + new[:room], new[room:]
        for i in range(0, len(new), BLOCK):
            last += 1
            now[last] = new[i : i + BLOCK]
        for k, rows in now.items():
            if not rows:
                self.state.removeKey((kind, k))
            elif rows != before.get(k):
                self.state.updateValue((kind, k), (json.dumps(rows),))
        self.blocks[kind] = {k: rows for k, rows in now.items() if rows}

    def closes(self) -> int | None:
        """When the first latch closes, in milliseconds: the time of the key's one timer."""
        return min((_due(x) // 1000 for x in self.rows(LATCHES)), default=None)


    def close(self, until: int, change=lambda x: x, new: Sequence[list] = ()) -> list[list]:
        """Latches, changed and ``new`` ones, that close up to the millisecond ``until``; they leave the state.

        A new one takes the place of an open one with its id."""
        closed, again = [], {x[0] for x in new}

        def after(latch: list) -> list | None:
            if latch[0] in again:
                return None
            if _due(latch := change(latch)) // 1000 > until:
                return latch
            closed.append(latch)
            return None

        closed += [x for x in new if _due(x) // 1000 <= until]
        self.replace(LATCHES, after, [x for x in new if _due(x) // 1000 > until])
        return closed


class Latch(StatefulProcessor):
    """Open expectations of one topic and key."""

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getMapState("state", "kind string, block int", "rows string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        asked, new = [], []
        for _, _, _, is_message, i, text, presence, kind, calls, start, end in rows:  # in the order of ``GIVEN``
            if is_message:
                new.append([start, end, kind, calls, text])
            else:
                asked.append([i, text, presence, kind, calls, start, end, *[None] * (len(NAMES) - HIT)])
        watermark = timerValues.getCurrentWatermarkInMs()
        group = _Group(self.state)
        timer = group.closes()
        if asked:
            after_all = _Index(group.rows(MESSAGES) + new)
            asked = list({x[0]: after_all.latched(x) for x in asked}.values())  # one latch per id, the last asked
        passed = watermark * 1000
        on_time = sorted((m for m in new if m[0] >= passed), key=lambda m: m[0])
        group.replace(MESSAGES, lambda m: m if m[0] >= passed else None, on_time)
        closed = group.close(watermark - 1, _Index(new).latched if new else lambda x: x, asked)
        if group.closes() != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if group.closes() is not None:
                self.handle.registerTimer(group.closes())
        return map(partial(_found, key), closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        group = _Group(self.state)
        closed = group.close(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1))
        if group.closes() is not None:
            self.handle.registerTimer(group.closes())  # Spark drops the one it has called
        return map(partial(_found, key), closed)

    def close(self) -> None:
        pass


def _due(latch: list) -> int:
    return latch[END] if latch[HIT] is None else latch[HIT]


def _found(key: tuple, latch: list) -> Row:
    """A closed latch as a row of ``FOUND``."""
    seen = None if latch[SEEN_AT] is None else Row(**dict(zip(_names(SEEN), latch[SEEN_AT:])))
    found = dict(zip(NAMES[1:SEEN_AT], latch[1:]))
    return Row(expectation_id=latch[0], topic=key[0], key=key[1], **found, seen=seen, decided_at=_moment(_due(latch)))


def _moment(us: int):
    from datetime import datetime, timezone

    return datetime.fromtimestamp(us // 1_000_000, timezone.utc).replace(microsecond=us % 1_000_000)


class _Index:
    """Messages by what expectations ask for, in time order."""

    def __init__(self, messages: list[list]):
        self.all = sorted(messages, key=lambda m: (m[0], m[1] if m[1] is not None else -1, m[4] or ""))
        self.times = [m[0] for m in self.all]
        by = defaultdict(set)
        for at, _, kind, calls, _ in self.all:
            for asked in {(None, None), (kind, None), (None, calls), (kind, calls)}:
                by[asked].add(at)
        self.by = {asked: sorted(x) for asked, x in by.items()}

    def latched(self, latch: list) -> list:
        """The latch, a value per column of ``OPEN``, after these messages."""
        i, run, presence, kind, count, start, end, hit, *seen = latch
        fits = self.by.get(_fits(presence, kind, count), [])
        at = bisect_left(fits, start)
        if at < len(fits) and fits[at] <= end:
            hit = fits[at] if hit is None else min(hit, fits[at])
        last = bisect_right(self.times, end) - 1
        if last >= 0 and self.times[last] >= start:
            new = self.all[last]
            if seen[0] is None or (new[0], new[1] or -1) >= (seen[0], seen[1] or -1):
                seen = new
        return [i, run, presence, kind, count, start, end, hit, *seen]


class FirstFailure(StatefulProcessor):
    """The failed verdict of a run that was decided first."""

    def init(self, handle) -> None:
        self.done = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        failed = [(r.decided_at, r.expectation_id, r.message) for r in rows if not r.satisfied]
        if failed and not self.done.exists():
            self.done.update((True,))
            at, i, message = min(failed, key=lambda f: f[:2])
            yield Row(run_id=key[0], expectation_id=i, decided_at=at, message=message)

    def close(self) -> None:
        pass


def latched(messages: DataFrame, expectations: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Streams of messages and expectations to a stream of the columns of ``verify.match`` and ``decided_at``.

    Rows may be ``delay`` late. Expectations need a key; one without, which any message of its topic decides, ends the
    query with an error, ``verification.start`` takes it.
    """
    text = F.concat(F.lit("only keyed expectations can be latched: "), F.col("expectation_id").cast("string"))
    start = V.micros("registered_at")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    asked = V.with_default_timeout(expectations).select(
        "topic", F.coalesce("key", F.raise_error(text).cast("string")).alias("key"), F.col("registered_at").alias("ts"), F.lit(False).alias("is_message"),
        "expectation_id", "run_id", "presence", "expected_type", "expected_count", start.alias("start_us"), (start + F.col("timeout_ms") * 1000).alias("end_us"),
    )
    given = messages.filter("key IS NOT NULL").select(
        "topic", "key", "ts", F.lit(True).alias("is_message"), none("expectation_id", "long"), F.col("value").alias("run_id"), none("presence", "string"),
        F.col("event_type").alias("expected_type"), F.col("calls").alias("expected_count"), V.micros("ts").alias("start_us"),
        F.col("offset").cast("long").alias("end_us"),
    )
    both = asked.unionByName(given).select(*GIVEN).withWatermark("ts", delay)
    return both.groupBy("topic", "key").transformWithState(
        statefulProcessor=Latch(), outputStructType=T.StructType.fromDDL(FOUND), outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="decided_at",
    )


def first_failures(found: DataFrame) -> DataFrame:
    """The first failure of each run, ``(run_id, expectation_id, decided_at, message)``, from the stream of ``latched``."""
    # the event time goes on under another name, as ``decided`` computes its own
    verdicts = V.decided(found.withColumnRenamed("decided_at", "moment"), "moment")
    return verdicts.groupBy("run_id").transformWithState(
        statefulProcessor=FirstFailure(), outputStructType="run_id string, expectation_id long, decided_at timestamp, message string",
        outputMode="Append", timeMode="EventTime",
    )


def start(rows: DataFrame, store: str) -> StreamingQuery:
    """Appends a stream of ``latched`` or ``first_failures`` to ``store/rows``, its state in RocksDB; runs what is there and ends."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    writer = rows.writeStream.format("parquet").option("path", f"{store}/rows").option("checkpointLocation", f"{store}/checkpoint")
    return writer.outputMode("append").trigger(availableNow=True).start()


def state_size(query: StreamingQuery) -> list[dict]:
    """Rows and bytes of each stateful step, as of the last batch."""
    progress = query.lastProgress
    return [{"rows": s["numRowsTotal"], "bytes": s["memoryUsedBytes"]} for s in progress["stateOperators"]] if progress else []


def verdicts(spark: SparkSession, store: str) -> DataFrame:
    """What the stream has decided so far."""
    return V.decided(spark.read.schema(FOUND).parquet(f"{store}/rows"))
