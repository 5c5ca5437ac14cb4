"""State kept from batch to batch over the driver's tables: its end equals one fold of the whole log."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark.plans import state
from proofmark.plans.registry import SQL, plain, query
from proofmark.plans.streams import LATE_MS, arriving, new_store
from proofmark.streaming import snapshots


def kept(spark, sf):
    """The applications' store after a stream of all changes, in several batches with late rows."""
    changes = state.changes_of(arriving(spark, sf, "lineitem", F.col("l_shipdate")))
    apps = state.apps(spark, sf)
    store = snapshots.Snapshots(
        new_store(spark), "application_id", apps.schema, changes.schema, snapshots.fold_applications, LATE_MS, buckets=16, keeps=True
    )
    store.start(apps)
    store.run(changes).awaitTermination()
    store.finish(spark)
    return store


@query(SQL["apply_changes"])
def kept_applications(spark, sf):
    return plain(kept(spark, sf).rows(spark))


@query(SQL["rejected_changes"])
def kept_rejections(spark, sf):
    return plain(kept(spark, sf).rejected(spark).select("application_id", "change_id", "op", "at", "reason"))
