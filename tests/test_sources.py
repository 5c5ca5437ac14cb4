"""Adapters: options, replayed files, headers, dry runs, gauge tables."""

from datetime import datetime

from pyspark.sql import functions as F

from proofmark import schemas, sources
from proofmark.operators import metrics as A
from proofmark.operators.messages import split_quarantine
from proofmark.session import shared_dir
from proofmark.sources import sinks

T = datetime(2024, 1, 1)


def test_kafka_options():
    src = sources.kafka("host:9092", "topic", **{"kafka.security.protocol": "SSL"})
    assert src.options["startingOffsets"] == "earliest" and src.options["includeHeaders"] == "true"
    assert src.options["kafka.security.protocol"] == "SSL" and src.streaming
    assert sinks.kafka_sink("host:9092", "topic").options["topic"] == "topic"


def test_replayed_topics(spark, tmp_path):
    good = b'{"id":"1","title":"t","theme":"x","timesaved":5}'
    rows = [("k", good, "entities", 0, 0, T, None), ("k", b"oops", "entities", 0, 1, T, None)]
    spark.createDataFrame(rows, schemas.RAW_MESSAGES).write.parquet(str(tmp_path / "raw"))
    src = sources.Source(path=str(tmp_path / "raw"))
    ok, bad = split_quarantine(sources.read_archive_entities(spark, src))
    assert [(r.id, r.title, r.time_saved) for r in ok.collect()] == [("1", "t", 5)]
    assert bad.count() == 1
    assert sorted(r.message for r in sources.read_archive_feedback(spark, src).collect()) == ["oops", good.decode()]
    stream = sources.read_archive_feedback(spark, sources.Source(path=str(tmp_path / "raw"), streaming=True))
    assert stream.isStreaming


def test_decoded_tables_and_catalogues(spark, tmp_path):
    spark.createDataFrame([("k", "FINISHED", T)], schemas.PROCESSING_EVENTS).write.json(str(tmp_path / "e"))
    src = sources.Source("json", str(tmp_path / "e"), decoded=True)
    assert sources.read_processing_events(spark, src).first().event_type == "FINISHED"
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "forms.csv").write_text("position,form_no,theme,title\n0,A,T,one\n1,B,T,two\n")
    assert sources.read_form_catalogue(spark, str(tmp_path / "f"), "csv", header="true").count() == 2
    assert sources.attachment_catalogue(spark).count() == 5
    files = sources.read_payload_catalogue(spark, str(tmp_path / "f"))
    assert files.columns == ["path", "size"] and files.first()["size"] > 0


def test_message_id_follows_own_headers_and_repeats(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string").withColumn(
        "headers", F.array(F.struct(F.lit("own").alias("key"), F.lit("x").cast("binary").alias("value")))
    )
    one, two = (sinks.with_message_id(df).first().headers for _ in range(2))
    assert [h.key for h in one] == ["own", "MESSAGE_ID"] and one == two
    assert len(bytes(one[1].value)) == 36


def test_dry_run_writes_nothing(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame([("s", False, "1", "T", [])], schemas.SUBMISSIONS)
    sink = sinks.Sink(path=str(path))
    assert sinks.write_submissions(df, sink, dry_run=True).first().key == "s"
    assert not path.exists()
    sinks.write_submissions(df, sink)
    assert spark.read.parquet(str(path)).first().key == "s"


def test_gauges_are_replaced_by_run(spark, tmp_path):
    log = spark.createDataFrame([("r1", "TC01", T, T, True, None)], schemas.RUN_LOG)
    for run in ("r1", "r2", "r1"):  # a retried job replaces its rows
        sinks.write_gauges(A.gauges(log.withColumn("run_id", F.lit(run))), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).groupBy("run_id").count().select("count").distinct().count() == 1
    assert {p.name for p in (tmp_path / "g").glob("run_id=*")} == {"run_id=r1", "run_id=r2"}


def test_stream_is_published(spark, tmp_path):
    spark.createDataFrame([("k", "v")], "key string, value string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("key string, value string").parquet(str(tmp_path / "in"))
    q = sinks.publish_stream(stream, sinks.Sink(path=str(tmp_path / "out")), str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
