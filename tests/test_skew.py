"""Half of all rows on one key, broadcast off: adaptive execution must split the key's partition in every lookup join."""

import pytest
from pyspark.sql import functions as F

from proofmark.operators import changes as U
from proofmark.operators import checks as Q
from proofmark.operators import lookups as L
from proofmark.operators import verify as V

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, x in CONF.items():
        spark.conf.set(k, x)
    yield spark
    for k, x in old.items():
        spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def rows(spark, name, n=20_000):
    """Half of ``n`` rows on key 0, in many partitions."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, n, 1, 12).select(key.alias(name), F.col("id").alias("row"), F.sha2(F.col("id").cast("string"), 256).alias("filler"))


def split(df, joins=1):
    n = df.count() if not isinstance(df, tuple) else 0
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("skew=true") >= joins, plan
    return n


def keys(spark, name, n=20_000):
    return spark.range(0, n, 1, 4).select(F.col("id").alias(name), F.col("id").alias("x"))


def test_conflicts(skewed):
    df = rows(skewed, "submission_id")
    assert split(Q.conflicts(df, ["row"])) == 9_999


def test_files_by_ids(skewed):
    asked = rows(skewed, "k").select(F.col("row").alias("request_id"), F.array("k").alias("ids"), "filler")
    stored = keys(skewed, "id").select("id", F.lit("ok").alias("file_status"), F.lit(1).cast("long").alias("size"))
    assert split(L.files_by_ids(asked.select("request_id", "ids"), stored)) == 20_000


def test_codes_and_titles(skewed):
    df = rows(skewed, "c").select(F.col("c").cast("string").alias("code"), "row", "filler", F.lit("en").alias("language"), F.lit(None).cast("string").alias("title"))
    codes = keys(skewed, "c").select(F.col("c").cast("string").alias("code"), F.lit("en").alias("language"), F.lit("t").alias("title"))
    ok, bad = L.validate_codes(df, codes)
    assert split(ok) == 20_000
    split(bad)
    assert split(L.fill_titles(df, codes)) == 20_000


def test_linked_files_and_requests(skewed):
    follow = rows(skewed, "linked_id").withColumn("show_linked", F.lit(True))
    attachments = keys(skewed, "id").select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("application_id"))
    files = keys(skewed, "id").select("id", F.col("id").alias("attachment_id"), F.lit(1).cast("long").alias("size"), F.sha2(F.col("id").cast("string"), 256).alias("filler"))
    summary, listed = L.linked_files(follow, attachments, files)
    assert split(summary) == 20_000
    apps = rows(skewed, "u").select(F.col("u").alias("user_id"), F.lit("F").alias("form_no"), "filler", F.lit("Opprettet").alias("status"))
    requests = keys(skewed, "user_id").select("user_id", F.lit("F").alias("form_no"))
    assert split(L.applications_for_requests(apps, requests)) == 20_000


def test_cascade_and_creates(skewed):
    attachments = rows(skewed, "application_id").withColumn("id", F.col("row"))
    files = rows(skewed, "attachment_id").withColumn("id", F.col("row"))
    apps = keys(skewed, "application_id").withColumn("status", F.lit("Opprettet"))
    out = U.cascade_delete(keys(skewed, "application_id", 10).select("application_id"), apps, attachments, files)
    split(out["attachments"])
    split(out["files"])
    creates = rows(skewed, "application_id").select(
        "application_id", F.lit("create").alias("op"), F.col("row").alias("change_id"), F.timestamp_seconds("row").alias("at"), "filler"
    )
    state, rejected = U.apply_creates(creates, apps.filter("application_id < 0"))
    assert split(rejected) == 9_999


def test_messages_meet_expectations(skewed):
    """Two topics and two types, so that nothing folds to a constant; half of the messages on one key."""
    kind = F.when(F.col("row") % 3 == 0, "FINISHED").otherwise("STARTED")
    messages = rows(skewed, "k").select(
        F.when(F.col("row") % 4 < 2, "a").otherwise("b").alias("topic"), F.concat(F.lit("key"), F.col("k").cast("string")).alias("key"),
        kind.alias("event_type"), F.lit(None).cast("int").alias("calls"), F.lit(1).cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("row")).alias("ts"), F.lit("v").alias("value"),
    )
    start = F.timestamp_seconds(F.lit(1_700_000_000))
    wanted = keys(skewed, "i", 4_000).select(
        F.concat(F.lit("key"), F.col("i").cast("string")).alias("key"), start.alias("registered_at"), F.col("i").alias("expectation_id"),
        F.lit("r").alias("run_id"), F.when(F.col("i") % 2 == 0, "a").otherwise("b").alias("topic"), F.lit("presence").alias("presence"),
        F.when(F.col("i") % 4 == 0, "FINISHED").otherwise("STARTED").alias("expected_type"),
        F.lit(None).cast("int").alias("expected_count"), F.lit(100_000_000).cast("long").alias("timeout_ms"),
    )
    assert split(V.verify(messages, wanted)) == 4_000
