"""First seen in a stream of scans: keyed state of a source's last scan, its head and its items, forgotten when it has aged."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quern.streaming.leases import rocksdb

DECISIONS = "source {0}, scan_at timestamp, item {1}, ord long, status string, method string, confidence double, accepted boolean"
#: Stands for a missing order on the way to the state: whole numbers with gaps would come as floating ones.
_NO_ORDER = -(1 << 63)
_DECIDED = ["source", "scan_at", "item", "ord", "status", "method", "confidence", "accepted"]


class FirstSeen(StatefulProcessor):
    """One part of a source's items. Rows wait until the watermark has passed their scan, so that scans count in
    order of time however they were cut into micro-batches. Items are held as text."""

    def __init__(self, window_ms: int) -> None:
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, head long")
        self.seen = handle.getListState("seen", "item string")
        self.waiting = handle.getListState("waiting", "at long, item string, ord long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [(int(r.at_ms), r.item, None if r.ord == _NO_ORDER else int(r.ord)) for pdf in rows for r in pdf.itertuples(index=False)]
        if key[0] is not None:  # rows without a source only move the clock
            self.waiting.appendList(new)
            for at in {w[0] for w in new}:
                self.handle.registerTimer(at + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(w) for w in self.waiting.get()), key=lambda w: (w[0], w[1] is None)) if self.waiting.exists() else []
        at, head = self.last.get() if self.last.exists() else (None, None)
        seen = {s[0] for s in self.seen.get()} if self.seen.exists() else set()
        out, present = [], {}
        of = None
        for t, item, order in [w for w in held if w[0] < now]:
            if t != of:  # what a scan without a mark held is forgotten
                of, present = t, {}
            if item is not None:
                if item not in present or (order is not None and (present[item] is None or order > present[item])):
                    present[item] = order
                continue
            # the mark of a scan that is complete: its items are decided, and it becomes the last one
            if at is not None and t - at > 2 * self.window_ms:
                at, head, seen = None, None, set()
            for i, o in present.items():
                enough = at is not None and i not in seen and o is not None and head is not None and o > head
                fine = enough and t - at <= self.window_ms
                method = "first_seen_after_previous_head" if fine else "first_seen_scan_gap" if enough else "first_seen_insufficient_evidence"
                out.append((key[0], pd.Timestamp(t, unit="ms"), i, o, "INFERRED" if fine else "UNCERTAIN", method, 0.9 if fine else 0.0, fine))
            at, head, seen, present = t, order, set(present), {}
        left = [w for w in held if w[0] >= now]
        self.waiting.put(left) if left else self.waiting.clear()
        if at is not None and now > at + 2 * self.window_ms and not left:
            # too old for any item to count: the source starts anew
            self.last.clear()
            self.seen.clear()
        elif at is not None:
            self.last.update((at, head))
            self.seen.put([(i,) for i in seen]) if seen else self.seen.clear()
            self.handle.registerTimer(at + 2 * self.window_ms + 1)
        if out:
            yield pd.DataFrame(out, columns=_DECIDED).astype({"ord": "Int64"})

    def close(self) -> None:
        pass


def first_seen(log: DataFrame, late: str, window_seconds: int = 86_400, parts: int = 16) -> DataFrame:
    """A decision for each item of each complete scan of a streaming log (source, scan_at, item, ord).

    ``ord`` is the source's own order. A row without an item is the mark of a complete scan, its ``ord`` the scan's head;
    items of scans without a mark are never decided on, those of one scan that repeat count once with their greatest ``ord``.
    An item is accepted if the scan before is at most ``window_seconds`` old, didn't have it, and its head comes before it.
    A scan of twice that age is forgotten: what comes after it is a cold start.
    A source's items are dealt over ``parts`` keys, marks go to all of them: no source sits in one task. Rows without a
    source are the clock.
    """
    part = F.when(F.col("item").isNotNull(), F.array(F.pmod(F.xxhash64("item"), F.lit(parts)))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    rows = log.select("source", "scan_at", F.col("item").cast("string").alias("item"), F.coalesce("ord", F.lit(_NO_ORDER)).alias("ord"), F.unix_millis("scan_at").alias("at_ms"), F.explode(part).alias("part")).withWatermark("scan_at", late)
    source, item = (log.schema[c].dataType.simpleString() for c in ("source", "item"))
    decided = rows.groupBy("source", "part").transformWithStateInPandas(FirstSeen(window_seconds * 1000), DECISIONS.format(source, "string"), "append", "eventTime")
    return decided.withColumn("item", F.col("item").cast(item))


def run_first_seen(log: DataFrame, path: str, checkpoint: str, late: str, window_seconds: int = 86_400, parts: int = 16) -> None:
    """Runs the decisions over all of the log that is there; a batch that runs again writes its folder anew."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with rocksdb(log.sparkSession):
        query = first_seen(log, late, window_seconds, parts).writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
