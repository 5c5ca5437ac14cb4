"""State kept over many batches against one fold of the whole log."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from proofmark import values as v
from proofmark.operators import changes as U
from proofmark.streaming import snapshots as P

T0 = datetime(2024, 3, 1)
LOG = "change_id long, op string, application_id long, user_id string, form_no string, at timestamp, actor string, title string, step long, attachments int"
APPS = "application_id long, user_id string, form_no string, title string, step long, status string, app_source string, changed_at timestamp"


def log(seed, n, apps):
    rnd = random.Random(seed)
    ops = [U.UPDATE, U.COMPLETE, U.STEP, U.UPDATE, U.STEP, U.DELETE, U.EXTERNAL_DELETE]
    rows = []
    for k in range(n):
        op = rnd.choice(ops if rnd.random() < 0.3 else ops[:5])
        app = rnd.choice([1, rnd.randrange(apps + 5)])  # half of all changes are of one application
        rows.append((k, op, app, "u", "f", T0 + timedelta(seconds=k // 2), rnd.choice("AB"), rnd.choice([None, f"t{k}"]), k, rnd.choice([0, 0, 0, 1])))
    return rows


def store(spark, tmp_path, delay=0, buckets=8, name="s"):
    schema = spark.createDataFrame([], APPS).schema
    changes = spark.createDataFrame([], LOG).schema
    return P.Snapshots(f"{tmp_path}/{name}", "application_id", schema, changes, P.fold_applications, delay, buckets)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or sorted(df.columns))).collect()), key=repr)


@pytest.mark.parametrize("seed,shuffle_s", [(1, 0), (2, 40)])
def test_batches_equal_one_fold(spark, tmp_path, seed, shuffle_s):
    rnd = random.Random(seed)
    apps = spark.createDataFrame([(k, "u", "f", "start", 0, v.CREATED, "A", T0) for k in range(40)], APPS)
    changes = log(seed, 300, 40)
    changes.append((900, U.CREATE, 500, "u", "g", T0 + timedelta(seconds=20), "A", "new", 0, 0))
    changes.append((901, U.UPDATE, 500, "u", "g", T0 + timedelta(seconds=90), "A", "newer", 0, 0))
    arrival = sorted(changes, key=lambda r: r[5] + timedelta(seconds=rnd.uniform(0, shuffle_s)))
    kept = store(spark, tmp_path, delay=shuffle_s * 1000)
    kept.start(apps)
    for n in range(0, len(arrival), 100):
        batch = spark.createDataFrame(arrival[n : n + 100], LOG)
        kept.step(batch, n // 100)
        if n == 100:
            before = rows(kept.rows(spark))
            kept.step(batch, 1)  # once more: nothing changes
            assert rows(kept.rows(spark)) == before
    kept.finish(spark)
    whole = spark.createDataFrame(changes, LOG)
    state, rejected = P.fold_applications(apps, whole)
    assert rows(kept.rows(spark), *apps.columns) == rows(state, *apps.columns)
    assert rows(kept.rejected(spark), "change_id", "reason") == rows(rejected, "change_id", "reason")
    assert kept.late(spark).count() == 0 and {r.reason for r in rejected.collect()} >= {"deleted before", "unknown application"}


def test_a_step_reads_and_writes_what_it_touches(spark, tmp_path):
    apps = spark.createDataFrame([(k, "u", "f", "start", 0, v.CREATED, "A", T0) for k in range(400)], APPS)
    kept = store(spark, tmp_path, buckets=32)
    kept.start(apps)
    assert len(kept.version(spark, -1)[0]) == 32
    one = spark.createDataFrame([(1, U.UPDATE, 7, "u", "f", T0, "A", "x", 0, 0)], LOG)
    now = int(T0.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
    kept.step(one, 0, until=now + 1)
    version, _ = kept.version(spark, 0)
    assert sorted(version.values()) == [-1] * 31 + [0]
    bucket = next(b for b, n in version.items() if n == 0)
    assert len(kept.rows(spark, 0, [bucket]).inputFiles()) == 1
    old = {f for f in kept.rows(spark, -1).inputFiles()}
    new = {f for f in kept.rows(spark, 0).inputFiles()}
    assert len(new - old) == 1 and len(old - new) == 1
    # versions can be read as they were, until they are vacuumed
    assert kept.rows(spark, -1).filter("title = 'x'").isEmpty() and kept.rows(spark).filter("title = 'x'").count() == 1
    assert kept.vacuum(spark, keep=1) == 1 and kept.rows(spark).count() == 400
    kept.step(spark.createDataFrame([(2, U.STEP, 8, "u", "f", T0 + timedelta(seconds=1), "A", None, 5, 0)], LOG), 1, until=now + 2_000_000)
    assert kept.rows(spark).filter("step = 5").count() == 1


def test_a_step_that_was_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    apps = spark.createDataFrame([(k, "u", "f", "start", 0, v.CREATED, "A", T0) for k in range(20)], APPS)
    kept, other = store(spark, tmp_path), store(spark, tmp_path, name="other")
    batches = [spark.createDataFrame(log(5, 60, 20)[k : k + 20], LOG) for k in (0, 20, 40)]
    for s in (kept, other):
        s.start(apps)
        s.step(batches[0], 0)
    with monkeypatch.context() as m:
        m.setattr(kept, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.step(batches[1], 1)
    assert rows(kept.rows(spark)) == rows(other.rows(spark))  # nothing of it is seen
    for s in (kept, other):
        s.step(batches[1], 1)
        s.step(batches[2], 2)
        s.finish(spark)
    assert rows(kept.rows(spark)) == rows(other.rows(spark))
    assert rows(kept.rejected(spark), "change_id", "reason") == rows(other.rejected(spark), "change_id", "reason")


def test_late_changes_are_set_aside(spark, tmp_path):
    apps = spark.createDataFrame([(1, "u", "f", "start", 0, v.CREATED, "A", T0)], APPS)
    kept = store(spark, tmp_path, delay=10_000)
    kept.start(apps)
    change = lambda i, s: (i, U.UPDATE, 1, "u", "f", None if s is None else T0 + timedelta(seconds=s), "A", f"t{i}", 0, 0)
    kept.step(spark.createDataFrame([change(1, 100)], LOG), 0)
    assert kept.rows(spark).first().title == "start"  # it waits
    kept.step(spark.createDataFrame([change(2, 95), change(3, 89), change(4, None)], LOG), 1)
    kept.step(spark.createDataFrame([], LOG), 2)
    kept.finish(spark)
    assert kept.rows(spark).first().title == "t1"
    assert sorted(r.change_id for r in kept.late(spark).collect()) == [3, 4]


def test_attachments(spark, tmp_path):
    attachments = spark.createDataFrame(
        [(k, k // 3, "N6" if k % 2 else "X1", f"a{k}", "LastetOpp", None) for k in range(60)],
        "id long, application_id long, code string, title string, upload_status string, comment string",
    )
    rnd = random.Random(3)
    changes = [
        (n, rnd.choice([U.PATCH, U.PATCH, U.PATCH, U.REMOVE if n > 60 else U.PATCH]), rnd.randrange(63), None, "N6", rnd.choice([None, f"t{n}"]),
         rnd.choice([None, "SendSenere"]), rnd.choice([None, f"c{n}"]), T0 + timedelta(seconds=n))
        for n in range(120)
    ] + [(500 + k, U.ADD, 1000 + k, 5, "N6", "added", None, None, T0 + timedelta(seconds=200)) for k in range(3)]
    schema = "change_id long, op string, id long, application_id long, code string, title string, upload_status string, comment string, at timestamp"
    table = spark.createDataFrame(changes, schema)
    kept = P.Snapshots(f"{tmp_path}/a", "id", attachments.schema, table.schema, P.fold_attachments, buckets=4)
    kept.start(attachments)
    for n in range(0, len(changes), 40):
        kept.step(spark.createDataFrame(changes[n : n + 40], schema), n // 40)
    kept.finish(spark)
    state, _ = U.apply_attachment_patch(attachments, table)
    assert rows(kept.rows(spark)) == rows(state)


def test_changes_are_judged_once(spark, tmp_path):
    """A step writes the judged changes, which its state and its rejected rows read; the result stays the same."""
    apps = spark.createDataFrame([(k, "u", "f", "start", 0, v.CREATED, "A", T0) for k in range(20)], APPS)
    whole = spark.createDataFrame(log(3, 120, 20), LOG)
    kept = store(spark, tmp_path)
    kept.keeps = True
    kept.start(apps)
    kept.step(whole.limit(60), 0)
    kept.step(whole.exceptAll(whole.limit(60)), 1)
    kept.finish(spark)
    made, ways = [], []

    def keep(df):
        made.append(df)
        return spark.createDataFrame(df.collect(), df.schema)

    state, rejected = P.fold_applications(apps, whole, keep)
    assert len(made) == 1 and rejected.filter("reason IS NOT NULL").count() > 0
    for df in (rejected, P.fold_applications(apps, whole)[1]):
        ways.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join"))
    assert ways[0] < ways[1]
    assert rows(kept.rows(spark), *apps.columns) == rows(state, *apps.columns)
    assert rows(kept.rejected(spark), "change_id", "reason") == rows(rejected, "change_id", "reason")


def test_a_small_file_is_no_small_table(spark, tmp_path):
    """Files of a store say little about their rows in memory, so a step plans no broadcast by their size."""
    apps = spark.createDataFrame([(k, "u", "f", "start", 0, v.CREATED, "A", T0) for k in range(400)], APPS)
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before, plans = [spark.conf.get(c, None) for c in limits], []

    def fold(known, changes):
        out = P.fold_applications(known, changes)
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in out)
        plans.append(spark.conf.get(limits[1]))
        return out

    kept = store(spark, tmp_path)
    kept.fold = fold
    kept.start(apps)
    kept.step(spark.createDataFrame(log(7, 60, 40), LOG), 0, until=P.AFTER)
    assert len(plans) == 3 and not any("BroadcastHashJoin" in p for p in plans) and all("SortMergeJoin" in p for p in plans[:2])
    assert plans[2] == before[0] and [spark.conf.get(c, None) for c in limits] == before
    state, _ = P.fold_applications(apps, spark.createDataFrame(log(7, 60, 40), LOG))
    assert rows(kept.rows(spark), *apps.columns) == rows(state, *apps.columns)


@pytest.mark.parametrize("by_time", [False, True])
def test_slices_arrive_whole(spark, tmp_path, by_time):
    """Every slice has the same number of files, each with rows, whether the table is in the order of time or not."""
    from proofmark.plans import streams

    rnd = random.Random(4)
    times = [T0 + timedelta(days=rnd.random() * 90) for _ in range(600)]
    for k in range(3):
        part = sorted(times)[k * 200 : (k + 1) * 200] if by_time else times[k * 200 : (k + 1) * 200]
        spark.createDataFrame([(n + 200 * k, t) for n, t in enumerate(part)], "id long, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/log.parquet/{k}")
    split = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a partition per file
    try:
        frame = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/log.parquet")
        assert frame.rdd.getNumPartitions() == 3
        seen = []
        read = streams.table
        streams.table = lambda *_: frame
        try:
            stream = streams.arriving(spark, "", "log", streams.F.col("at"))
        finally:
            streams.table = read
        ran = stream.writeStream.foreachBatch(lambda b, n: seen.append((b.count(), len(b.inputFiles())))).option("checkpointLocation", f"{tmp_path}/c")
        ran.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", split)
    assert sum(n for n, _ in seen) == 600 and len(seen) == streams.BATCHES
