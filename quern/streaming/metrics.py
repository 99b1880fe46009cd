"""Counters of running streams, appended to a log of runs."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class MetricsLog(StreamingQueryListener):
    """Keeps what streams observe: one row a micro-batch, under (run, batch), until ``write`` appends them.

    The numbers come from ``observe`` in the stream's own pass; nothing is computed twice.
    """

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, int, str]] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.rows.append((p.name or str(p.id), p.batchId, p.numInputRows, json.dumps(observed, sort_keys=True, default=str)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def write(self, spark: SparkSession, path: str) -> int:
        """Appends the rows (run, batch, input_rows, metrics) to the log and forgets them; how many."""
        rows, self.rows = self.rows, []
        if rows:
            spark.createDataFrame(rows, "run string, batch long, input_rows long, metrics string").coalesce(1).write.mode("append").parquet(path)
        return len(rows)
