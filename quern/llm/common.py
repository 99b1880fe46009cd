"""Helpers shared by the training-data operators: shared tables, whole-text batches, word hashes."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Up to this many ids or documents travel by broadcast; more, by a shuffle join.
BROADCAST_ROWS = 500_000
#: Bins that a group's values are dealt into at a time.
BINS = 1024

_local_dir: str | None = None
_recording: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("recording", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset (tests), a temporary one."""
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if _local_dir is None:
        _local_dir = "file://" + tempfile.mkdtemp(prefix="quern-shared-")
    return _local_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


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


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and returns a scan of them.

    A lost executor costs a reread, never a recomputation of what led here.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    if (tables := _recording.get()) is not None:
        tables.append(out)
    return out


@contextlib.contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """Gathers the tables written inside, for a caller who releases them once its result is stored."""
    mark = _recording.set(tables := [])
    try:
        yield tables
    finally:
        _recording.reset(mark)


def release(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned, once all that rests on them is stored."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def light(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its rows are few; counted, not guessed."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def exact_quantiles(rows: DataFrame, share: float, up: bool) -> dict[str | None, tuple[int, float]]:
    """Of each group of rows (grp, value): how many there are, and the value at place share * (n - 1), rounded up or down.

    A group's values are dealt into bins between its least and its greatest; the bin that holds the place
    is dealt again, until all its values are equal. One row for each group reaches the driver. Values are finite.
    """
    spark, place = rows.sparkSession, math.ceil if up else math.floor
    sizes, found, live = {}, {}, []

    def settle(grp: str | None, k: int, lo: float, hi: float) -> None:
        if lo == hi:
            found[grp] = lo
        else:
            live.append((grp, k, lo, hi))

    for r in rows.groupBy("grp").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect():
        sizes[r.grp] = r.n
        settle(r.grp, int(place(share * (r.n - 1))), r.lo, r.hi)
    while live:
        chosen = spark.createDataFrame(live, "name string, k long, least double, most double")
        live = []
        inside = rows.join(F.broadcast(chosen), F.col("grp").eqNullSafe(F.col("name"))).where("value between least and most")
        bins = inside.groupBy("grp", "k", F.floor((F.col("value") - F.col("least")) / (F.col("most") - F.col("least")) * BINS).alias("bin"))
        counts = bins.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        below = counts.withColumn("below", F.sum("n").over(Window.partitionBy("grp").orderBy("bin")) - F.col("n"))
        for r in below.where("k >= below and k < below + n").collect():
            settle(r.grp, r.k - r.below, r.lo, r.hi)
    return {grp: (sizes[grp], found[grp]) for grp in sizes}


def give_back() -> None:
    """Returns to the system what a worker has freed: one that serves stage after stage else holds each one's peak."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema) -> DataFrame:
    """``mapInArrow`` for functions of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is None:
                    continue
                if isinstance(out, pa.Table):
                    yield from out.to_batches()
                else:
                    yield out

    return df.mapInArrow(run, schema)


def ascii_lower_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z lowered and no other character changed."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8. ``bytes.split`` parts at exactly the six characters of WORD_PATTERN."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_hash_word = xxhash.xxh3_64_intdigest


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(_hash_word, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift), so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words make one shingle of them all."""
    if not tokens:
        return np.zeros(0, np.uint64)
    h = word_hashes(tokens)
    n = max(1, len(h) - size + 1)
    acc = np.full(n, np.uint64(min(size, len(h))), np.uint64)
    for i in range(min(size, len(h))):
        acc = mixed(acc * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(acc)


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as the signed ones that Spark has."""
    return x.view(np.int64)


def list_column(values: np.ndarray, lengths: np.ndarray | list[int], kind: pa.DataType) -> pa.ListArray:
    """Arrow lists from one flat array and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads: others, whatever their names, can't clash with its own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams seen once to four times.

    Where the estimate isn't defined or leaves 0 to its count, 1/2, 1 and 3/2 stand in.
    """
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    least = (0.5, 1.0, 1.5)
    got = [k - (k + 1) * y * up / n if n else -1.0 for k, n, up in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(d if 0 < d < k else s for d, k, s in zip(got, (1, 2, 3), least, strict=True))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def local_path(uri: str) -> str | None:
    """The mounted path of a ``file:`` URI or a plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") or "://" not in uri else None
