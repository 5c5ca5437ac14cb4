"""Physical plans of the lookups: no pairs, no Python, pruned scans."""

import random

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PLANS = [
    "verify_presence", "verify_absence", "verify_any_key", "verify_default_timeouts", "call_count_any",
    "status_within", "running_count_reached", "best_target_group", "apply_changes", "application_detail",
    "files_by_ids", "conflicts", "reconcile",
]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANS)
def test_no_pairs_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "CollectLimit"):
        assert bad not in text


def test_first_k_is_limited_before_the_shuffle(spark):
    assert plan(spark, "take_first").count("WindowGroupLimit") == 2


def test_scan_reads_only_what_is_asked(spark):
    text = plan(spark, "size_profile")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


@pytest.mark.parametrize("name, scans", [("running_count_reached", 3), ("verify_absence", 5), ("verify_presence", 11)])
def test_both_readers_of_a_lookup_share_its_shuffle(spark, name, scans):
    """Without adaptive execution the plan shows what is shared: each pass reads the messages once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in text
    assert text.count("FileScan parquet") <= scans, text.count("FileScan parquet")


def test_each_pass_reads_the_messages_once(spark):
    """Lines answer, orders ask: one scan for the first fitting line, one for the last line seen."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(spark, "call_count_any")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("/lineitem.parquet") == 2


def test_unfolded_words_are_not_written_with_their_lines(spark, tmp_path):
    """3 MB of different lines in one file: each word's row refers to its line, and the documents are built once."""
    rnd = random.Random(11)
    line = lambda: " ".join(f"{rnd.randrange(1 << 32):x}" for _ in range(40))
    rows = [(i, "\n".join(line() for _ in range(9)), "en") for i in range(1000)]
    rows += [(None, "a b\n\nc", None), (7, None, "en"), (7, "", "en"), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = entry.queries()["flatten_submissions"](spark, str(tmp_path))
    filters = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Filter" in x]
    assert not any("transform(" in x for x in filters)
    out.write.parquet(f"{tmp_path}/out")
    bytes_, found = 0, 0
    for f in (tmp_path / "out").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        found += meta.num_rows
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(k) for k in range(meta.num_columns)]
            bytes_ += sum(c.total_uncompressed_size for c in columns if c.path_in_schema == "title")
    assert found == 1002 * 360 + 5
    assert bytes_ < 2 * sum(len(r[1] or "") for r in rows)
    few = spark.read.parquet(f"{tmp_path}/out").filter("submission_id IS NULL OR length(title) = 0")
    assert sorted((tuple(r) for r in few.collect()), key=repr) == sorted(
        [
            (None, None, 0, 0, True, "a b", "a"), (None, None, 0, 1, True, "a b", "b"), (None, None, 1, 0, False, "", ""),
            (None, None, 2, 0, False, "c", "c"), ("7", "en", 0, 0, True, "", ""),
        ],
        key=repr,
    )
    words = spark.read.parquet(f"{tmp_path}/out").filter("submission_id = '5'")
    want = [("5", "en", n, k, n == 0, x, w) for n, x in enumerate(rows[5][1].split("\n")) for k, w in enumerate(x.split(" "))]
    assert sorted(map(tuple, words.collect())) == sorted(3 * want)
