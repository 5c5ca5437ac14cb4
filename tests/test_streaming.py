"""Streams give the verdicts of the batch form, over several files, restarts and poison rows."""

from datetime import datetime, timedelta, timezone

import pytest

from proofmark import schemas
from proofmark.operators import verify as V
from proofmark.streaming import intake, verification
from tests.test_verify import EXPECTATIONS, MESSAGES, at

T0 = datetime(2024, 1, 1, 10, 0, 0, tzinfo=timezone.utc)


def rows(df):
    return sorted(tuple(r) for r in df.select("expectation_id", "satisfied", "decided_at", "last_value", "message").collect())


def land(spark, folder, messages):
    spark.createDataFrame(messages, schemas.MESSAGES).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(schemas.MESSAGES).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_equals_batch_over_many_batches(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    in_time = sorted(MESSAGES, key=lambda m: m[5])
    expected = spark.createDataFrame(EXPECTATIONS, schemas.EXPECTATIONS)

    def expectations(session):
        return session.createDataFrame(EXPECTATIONS, schemas.EXPECTATIONS)

    seen = 0
    for i in range(0, len(in_time), 8):  # each part is a new run of the same query: a restart
        land(spark, folder, in_time[i : i + 8])
        verification.start(source(spark, folder), expectations, store).awaitTermination()
        now = verification.verdicts(spark, store).count()
        assert now >= seen
        seen = now
    # b2's message at +500 s passes every deadline but its own batch's horizon.
    assert seen >= 10
    batch = V.verify(spark.createDataFrame(MESSAGES, schemas.MESSAGES), expected)
    assert rows(verification.close(spark, store, expectations)) == rows(batch)


def test_gap_of_days_and_repeated_batch(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    day = 86_400
    messages = [
        ("t", "k", "A", None, "A", at(0), 0),
        ("t", "k", "B", None, "B", at(3 * day), 1),
        ("t", "k", "C", None, "C", at(5 * day), 2),
    ]
    e = [(i, "r", "t", "k", "PRESENCE", kind, None, at(s), day * 1000) for i, (kind, s) in enumerate(
        [("A", 0), ("B", day), ("B", 2 * day + 1), ("C", 4 * day), ("A", 1.5 * day)]
    )]

    def expectations(session):
        return session.createDataFrame(e, schemas.EXPECTATIONS)

    for m in messages:
        land(spark, folder, [m])
        verification.start(source(spark, folder), expectations, store).awaitTermination()
    batch = V.verify(spark.createDataFrame(messages, schemas.MESSAGES), expectations(spark))
    assert rows(verification.close(spark, store, expectations)) == rows(batch)
    # The last step again, as after a failure between its writes and the checkpoint.
    before = rows(verification.verdicts(spark, store))
    last = spark.createDataFrame([messages[-1]], schemas.MESSAGES)
    verification._land(last, 2, store)
    verification._decide(spark, 2, store, expectations, 0)
    assert rows(verification.verdicts(spark, store)) == before
    assert rows(verification.close(spark, store, expectations)) == rows(batch)


def test_close_reads_the_days_of_open_windows(spark, tmp_path, monkeypatch):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    day = 86_400
    messages = [("t", "k", "A", None, str(i), at(i * day), i) for i in range(12)]
    e = [(i, "r", "t", key, "PRESENCE", kind, None, at(s * day), t) for i, (key, kind, s, t) in enumerate(
        [("k", "A", 0, day * 1000), ("k", "B", 1, day * 1000), ("k", "B", 9.5, 2 * day * 1000), ("j", "B", 11, -1), (None, "B", 11, day * 1000)]
    )]
    land(spark, folder, messages)
    asked = spark.createDataFrame(e, schemas.EXPECTATIONS)
    verification.start(source(spark, folder), lambda session: session.createDataFrame(e, schemas.EXPECTATIONS), store, delay_ms=day * 1000).awaitTermination()
    batch = rows(V.verify(spark.createDataFrame(messages, schemas.MESSAGES), asked))
    read, verify = [], V.verify
    monkeypatch.setattr(V, "verify", lambda m, rest: read.append(m) or verify(m, rest))
    assert rows(verification.close(spark, store, lambda session: session.createDataFrame(e, schemas.EXPECTATIONS))) == batch
    assert sorted(r.offset for r in read[0].collect()) == [9, 10, 11]
    every = [(9, *e[0][1:])]  # a stream that has decided all
    store = str(tmp_path / "store2")
    verification.start(source(spark, folder), lambda session: session.createDataFrame(every, schemas.EXPECTATIONS), store).awaitTermination()
    assert len(rows(verification.close(spark, store, lambda session: session.createDataFrame(every, schemas.EXPECTATIONS)))) == 1
    assert read[1].count() == 0


def test_late_rows_restarts_and_compaction(spark, tmp_path, monkeypatch, compact=2):
    """Messages in shuffled files, late by less than the delay; expectations that come after their messages."""
    import random

    monkeypatch.setattr(verification, "COMPACT", compact)
    rnd = random.Random(compact)
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    messages = [("t", f"k{rnd.randrange(4)}", rnd.choice("AB"), rnd.choice([None, 1, 2]), "x", at(s + rnd.random()), s) for s in range(90)]
    wanted = [(i, "r", "t", rnd.choice(["k0", "k1", "k9", None]), rnd.choice(["PRESENCE", "PRESENCE", "ABSENCE"]), rnd.choice([None, "A"]),
               rnd.choice([None, 2]), at(rnd.randrange(90)), rnd.choice([0, 3000, 20_000])) for i in range(40)]
    known = [5]

    def expectations(session):
        return session.createDataFrame(wanted[: known[0]], schemas.EXPECTATIONS)

    for i in range(0, 90, 18):
        part = messages[i : i + 18]
        rnd.shuffle(part)
        land(spark, folder, part)
        known[0] += 7
        verification.start(source(spark, folder), expectations, store, delay_ms=16_000).awaitTermination()
    batch = V.verify(spark.createDataFrame(messages, schemas.MESSAGES), expectations(spark))
    assert rows(verification.close(spark, store, expectations)) == rows(batch)
    assert 0 < verification.verdicts(spark, store).count() < 40
    open_folders = [p for p in (tmp_path / "store" / "state").glob("batch=*/done=false") if "batch=-1" not in str(p)]
    assert len(open_folders) <= 2  # older ones are gone
    assert len(list((tmp_path / "store" / "state").glob("batch=*"))) <= 5


def test_satisfied_join_of_two_streams(spark, tmp_path):
    m, e = str(tmp_path / "m"), str(tmp_path / "e")
    land(spark, m, MESSAGES)
    keyed = [x for x in EXPECTATIONS if x[3] is not None and x[4] == "PRESENCE"]
    spark.createDataFrame(keyed, schemas.EXPECTATIONS).coalesce(1).write.parquet(e)
    open_ones = spark.readStream.schema(schemas.EXPECTATIONS).parquet(e)
    out = verification.satisfied(source(spark, m), open_ones, "120 seconds")
    q = (
        out.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = sorted(r.expectation_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = V.verify(
        spark.createDataFrame(MESSAGES, schemas.MESSAGES), spark.createDataFrame(keyed, schemas.EXPECTATIONS)
    )
    assert got == sorted(r.expectation_id for r in batch.filter("satisfied").collect())


def test_poison_row_does_not_stop_the_next(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    good = '{"id":"1","title":"t","theme":"x","timesaved":5}'
    raw = [
        (b"p", b"unserializableString", 0),
        (b"g", good.encode(), 1),
        (b"w", b'{"id":"2","timesaved":"not a number"}', 2),
        (b"x", b"\xff\xfe\x00", 3),
    ]
    for key, value, i in raw:
        spark.createDataFrame(
            [(key.decode(), value, "main", 0, i, T0 + timedelta(seconds=i), None)], schemas.RAW_MESSAGES
        ).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schemas.RAW_MESSAGES).option("maxFilesPerTrigger", 1).parquet(folder)
    intake.start(stream, store, schemas.ARCHIVE_ENTITY_JSON).awaitTermination()
    ok, bad = intake.rows(spark, store, schemas.ARCHIVE_ENTITY_JSON)
    assert [(r.key, r.entity.title, r.entity.timesaved) for r in ok.collect()] == [("g", "t", 5)]
    assert sorted((r.key, bytes(r.value)) for r in bad.collect()) == [(k.decode(), x) for k, x, i in sorted(raw) if i != 1]


def test_schemas_with_commas_inside(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    value = b'{"amount": 1.25, "at": {"x": 1, "y": 2}}'
    spark.createDataFrame([("k", value, "main", 0, 0, T0, None)], schemas.RAW_MESSAGES).write.parquet(folder)
    shape = "amount decimal(10,2), at struct<x:int,y:int>"
    intake.start(spark.readStream.schema(schemas.RAW_MESSAGES).parquet(folder), store, shape).awaitTermination()
    entity = intake.rows(spark, store, shape)[0].first().entity
    assert (str(entity.amount), entity["at"].x, entity["at"].y) == ("1.25", 1, 2)


@pytest.mark.parametrize("key, presence", [("k", "ABSENCE"), (None, "PRESENCE")])
def test_satisfied_refuses_what_it_cannot_decide(spark, tmp_path, key, presence):
    e, m = str(tmp_path / "e"), str(tmp_path / "m")
    land(spark, m, MESSAGES)
    row = (1, "r", "t", key, presence, None, None, T0, 1000)
    spark.createDataFrame([row], schemas.EXPECTATIONS).write.parquet(e)
    out = verification.satisfied(source(spark, m), spark.readStream.schema(schemas.EXPECTATIONS).parquet(e), "120 seconds")
    q = out.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="only keyed presence"):
        q.awaitTermination()



def test_arriving_slices_have_many_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from proofmark.plans import streams

    day = F.timestamp_seconds(F.col("id") * 600 + 1_700_000_000).alias("ts")
    spark.range(0, 6000, 1, 5).select("id", day).write.parquet(f"{tmp_path}/events.parquet")
    batches = []

    def look(df, _):
        batches.append((df.select(F.input_file_name()).distinct().count(), {r.id for r in df.collect()}))

    stream = streams.arriving(spark, str(tmp_path), "events", F.col("ts"))
    stream.writeStream.foreachBatch(look).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == streams.BATCHES and all(n > 1 for n, _ in batches)
    assert sum(len(ids) for _, ids in batches) == 6000 and set().union(*(ids for _, ids in batches)) == set(range(6000))
    assert [min(ids) for _, ids in batches] == sorted(min(ids) for _, ids in batches)
    late = streams.LATE_MS // 600_000 + 1  # rows that one may be late behind
    assert all(max(a) - min(b) <= late for (_, a), (_, b) in zip(batches, batches[1:]))
