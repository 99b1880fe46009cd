"""A leased work queue as keyed state with timers: claims, acknowledgements, failures, and leases that run out by themselves."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quern.operators.queue import MAX_ATTEMPTS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_WAITING = pa.schema([("item", pa.string()), ("at_ms", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("owner", pa.string()), ("error", pa.string())])
#: Keys that items are dealt over.
PARTS = 1024
TRANSITIONS = "item {0}, at timestamp, seq long, event string, status string, attempts int, owner string, error string"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Sets session values inside, and puts back what was there."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rocksdb(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Streams started inside keep their state in RocksDB, as timers and several states of a key need."""
    return settings(spark, {_PROVIDER: _ROCKSDB})


def _packed(rows: list[tuple]) -> tuple[bytes]:
    """Waiting rows as one value of a list state: a value a row costs more than the work on it."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _WAITING.types, strict=True)], schema=_WAITING)
    with pa.ipc.new_stream(sink, _WAITING) as out:
        out.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(values: Iterator[tuple]) -> Iterator[tuple]:
    for (value,) in values:
        yield from zip(*(c.to_pandas().tolist() for c in pa.ipc.open_stream(value).read_all().columns), strict=True)


class Leases(StatefulProcessor):
    """The items of one part. Events wait until the watermark has passed them and then count in order of time,
    so the outcome doesn't depend on how the log was cut into micro-batches."""

    def __init__(self, lease_ms: int, max_attempts: int, key: str) -> None:
        self.lease_ms, self.max_attempts, self.key = lease_ms, max_attempts, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "item string, status string, attempts int, owner string, expires long, due long")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for pdf in rows:
            new = [w for w in zip(*(pdf[c].tolist() for c in _WAITING.names), strict=True) if w[0] is not None]  # rows without an item only move the clock
            if new:
                self.waiting.appendList([_packed(new)])
                first = min(w[1] for w in new) if first is None else min(first, *(w[1] for w in new))
        if first is not None:
            self._wake(min([first, *self.handle.listTimers()]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs()
        due: dict[str, list[tuple]] = {}
        left = []
        for w in _unpacked(self.waiting.get()) if self.waiting.exists() else []:
            left.append(w) if w[1] > now else due.setdefault(w[0], []).append(w)
        items = {i: tuple(rest) for i, *rest in self.items.get()} if self.items.exists() else {}
        out: list[tuple] = []
        for item, (status, _, _, expires, _) in list(items.items()):
            if item not in due and status == "LEASED" and expires < now:
                due[item] = []
        for item, events in due.items():
            items[item] = self._moved(item, items.get(item, ("PENDING", 0, None, None, 0)), sorted(events, key=lambda w: w[1:3]), now, out)
        self.waiting.put([_packed(left)]) if left else self.waiting.clear()
        self.items.put([(i, *rest) for i, rest in items.items()])
        times = [w[1] for w in left] + [expires + 1 for status, _, _, expires, _ in items.values() if status == "LEASED"]
        self._wake(min(times) if times else None)
        if out:
            yield pd.DataFrame(out, columns=[self.key, "at", "seq", "event", "status", "attempts", "owner", "error"]).astype({"at": "datetime64[ms]", "seq": "Int64"})

    def _moved(self, item: str, state: tuple, events: list[tuple], now: int, out: list[tuple]) -> tuple:
        """The item's state after its events up to now; its transitions go to ``out``."""
        status, attempts, owner, expires, due = state

        def told(at: int, seq: int | None, event: str, by: str | None, error: str | None = None) -> None:
            out.append((item, at, seq, event, status, attempts, by, error))

        for _, at, seq, kind, by, error in [*events, (item, now, None, None, None, None)]:
            if status == "LEASED" and expires < at:
                status, owner, gone, due = "PENDING", None, owner, expires
                told(expires, None, "expired", gone)
            if kind == "claim":
                if status == "PENDING" and due <= at:
                    status, owner, attempts, expires = "LEASED", by, attempts + 1, at + self.lease_ms
                    told(at, seq, "claimed", by)
                else:
                    told(at, seq, "refused", by)
            elif kind in ("ok", "error"):
                if status != "LEASED" or owner != by:
                    told(at, seq, "foreign", by, error)
                elif kind == "ok":
                    status, owner = "DONE", None
                    told(at, seq, "done", by)
                else:
                    again = attempts < self.max_attempts
                    status, owner = "PENDING" if again else "DEAD", None
                    due = at + int(min(300, 2 ** max(0, attempts - 1)) * 1000)
                    told(at, seq, "retry" if again else "dead", by, error)
        return status, attempts, owner, expires, due

    def _wake(self, at: int | None) -> None:
        """One timer: for the first event that waits, or the first lease's end."""
        timers = list(self.handle.listTimers())
        for t in timers:
            if t != at:
                self.handle.deleteTimer(t)
        if at is not None and at not in timers:
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def lease_transitions(log: DataFrame, lease_seconds: int, late: str, max_attempts: int = MAX_ATTEMPTS, parts: int = PARTS) -> DataFrame:
    """Every transition of every item of a streaming log (item, at, seq, kind, owner, error).

    Kinds are ``claim``, ``ok`` and ``error``. A claim takes an item that is pending and due; only the owner of a
    lease that runs may acknowledge or fail it; a failure makes the item due again later, or dead at the last
    attempt. Rows without an item are the clock: they move time on. ``late``: how far the log is out of order.
    Items are dealt over ``parts`` keys. A part is never null: beside a null key pandas has the keys of a batch as
    floats, and Spark then takes them all for null.
    """
    item, kind = F.col("item"), log.schema["item"].dataType.simpleString()
    seq = F.when(item.isNotNull(), F.col("seq")).otherwise(F.lit(0).cast("long"))
    rows = log.select(item.cast("string").alias("item"), "at", seq.alias("seq"), "kind", "owner", "error", F.unix_millis("at").alias("at_ms"), F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part"))
    moved = rows.withWatermark("at", late).groupBy("part").transformWithStateInPandas(Leases(lease_seconds * 1000, max_attempts, "item"), TRANSITIONS.format("string"), "append", "eventTime")
    return moved.withColumn("item", F.col("item").cast(kind))


def run_leases(log: DataFrame, path: str, checkpoint: str, lease_seconds: int, late: str) -> None:
    """Runs the queue over all of the log that is there: ``path``/transitions, and from the same pass ``path``/dead.

    A batch that runs again writes the same folders anew.
    """
    spark = log.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        to = f"{path}/transitions/batch={number}"
        batch.write.mode("overwrite").parquet(to)
        done = batch.sparkSession.read.schema(batch.schema).parquet(to)
        done.where("event = 'dead'").select("item", "at", "attempts", "owner", "error").write.mode("overwrite").parquet(f"{path}/dead/batch={number}")

    # a partition costs a Python worker and a state store in each batch, however few rows it has
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    with rocksdb(spark), settings(spark, {"spark.sql.shuffle.partitions": str(few)}):
        query = lease_transitions(log, lease_seconds, late).writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
