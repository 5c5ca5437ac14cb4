"""Observed metrics of streams as gauges, one row per metric and batch.

A listener hears of every batch what its ``observe`` calls counted and writes it to a table partitioned by stream and
batch. A batch that is run again replaces its own rows, so sums over batches stay right.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

GAUGE = "name string, label string, value double, at timestamp"


class GaugeListener(StreamingQueryListener):
    """Writes the observed metrics of every stream of a session to ``path``.

    A metric ``m`` observed under the name ``n`` becomes the gauge ``m`` with the label ``n``. ``run_id`` is the name
    of a stream, or its id, which a restart keeps.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.heard = spark, path, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (name, label, float(value))
            for label, row in p.observedMetrics.items()
            for name, value in row.asDict().items()
            if isinstance(value, (int, float))
        ]
        of = p.name or str(p.id)
        if rows:
            self.write(rows, p.timestamp, of, p.batchId)
        self.heard[str(p.id)] = max(p.batchId, self.heard.get(str(p.id), -1))

    def write(self, rows: list[tuple], at: str, of: str, batch: int) -> None:
        """A handful of rows; the partition of the batch is replaced."""
        df = self.spark.createDataFrame(rows, "name string, label string, value double")
        df.withColumn("at", F.lit(at).cast("timestamp")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run_id={of}/batch={batch}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last batch of an ended stream was heard of; listeners run behind."""
        last, until = query.lastProgress, time.monotonic() + seconds
        while last and self.heard.get(str(query.id), -1) < last["batchId"] and time.monotonic() < until:
            time.sleep(0.05)


def gauges(spark: SparkSession, path: str) -> DataFrame:
    """``(run_id, batch, name, label, value, at)``."""
    return spark.read.schema(f"{GAUGE}, run_id string, batch long").parquet(path)
