"""Best-fit packing with certified bin counts.

Pieces of documents are dealt to partitions of bounded size and packed there by best fit, longest
first. Dual feasible functions bound from below how many sequences a partition needs: where the count
meets the bound it is certified to be the least. The pieces of partitions that leave a gap are dealt
anew among those partitions and packed again, as long as that saves sequences.
"""

from __future__ import annotations

import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.bpe import CACHE_WORDS, word_encoder
from quern.llm.common import give_back, need, written

#: Pieces that a packing partition holds on average.
PARTITION_PIECES = 30_000
#: At most so many repacking rounds; each must save sequences to be followed by another.
ROUNDS = 3


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and ``end_id``, cut only if too long.

    Null and empty texts are the end id alone. A copy of a row has pieces of its own.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        give_back()
        for batch in batches:
            rows: list[tuple[int | None, int, int, int, int]] = []
            for doc, ids in zip(batch.column(0).to_pylist(), word_encoder(vocabulary).encode_all(batch.column(1).to_pylist(), cache_words), strict=True):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return need(docs, "doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins: best fit, longest first.

    One bit per free size marks which sizes some open bin has; the fullest bin that still takes a
    piece is then the lowest set bit from its length on.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, made = 0, 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        above = mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                mask ^= 1 << free
        else:
            free, b = capacity, made
            made += 1
        bins[k], offsets[k] = b, capacity - free
        rest = free - size
        if rest:
            if not open_bins[rest]:
                mask |= 1 << rest
            open_bins[rest].append(b)
    return bins, offsets, made


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound from dual feasible functions: for each cut e, pieces over capacity - e count as
    whole bins, pieces under e as nothing, the others by length. e = 0 is the total length's bound."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    e = np.arange(0, capacity // 2 + 1)
    whole = number[-1] - number[capacity - e]
    mid = total[capacity - e] - np.where(e > 0, total[e - 1], 0)
    bound = whole + -(-mid // capacity)
    # pieces over half a bin count one each; those of just half count a half
    half = (2 * number[-1] - number[capacity // 2] - number[(capacity - 1) // 2] + 1) // 2
    return int(max(bound.max(), half))


def _packed(dealt: DataFrame, capacity: int) -> DataFrame:
    """Packs each ``part``; ``n_bins`` and ``bound`` stand in each of its rows."""

    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", kind="stable")  # the same packing in each attempt of a task
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, made = best_fit(lengths, capacity)
        return pd.DataFrame({"uid": pdf["uid"], "length": lengths, "part": key[0], "bin": bins, "offset": offsets, "n_bins": made, "bound": least_bins(lengths, capacity)})

    return dealt.groupBy("part").applyInPandas(run, "uid long, length long, part long, bin long, offset long, n_bins long, bound long")


def _gaps(packed: DataFrame) -> tuple[int, int, int]:
    """Over the partitions that a bound doesn't certify: pieces, bins; and the number of partitions."""
    parts = packed.groupBy("part").agg(F.count("*").alias("n"), F.max("n_bins").alias("bins"), F.max("bound").alias("bound"))
    row = parts.where("bins > bound").agg(F.sum("n"), F.sum("bins"), F.count("*")).first()
    return row[0] or 0, row[1] or 0, row[2]


def pack(lengths: DataFrame, capacity: int) -> DataFrame:
    """uid, sequence_id, offset for rows of uid (distinct) and length (1 to capacity).

    The pieces of a partition are bounded in number, so no task grows with the input. Repacking
    touches only the partitions with a gap between their count and their bound.
    """
    n = lengths.count()
    parts = max(1, -(-n // PARTITION_PIECES))
    dealt = lengths.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(parts)).alias("part"))
    packed = written(_packed(dealt, capacity), "packed")
    first = 1 << 20  # numbers of partitions dealt anew
    for k in range(ROUNDS):
        pieces, bins, gapped = _gaps(packed)
        if gapped < 2:
            break
        again = max(1, -(-pieces // PARTITION_PIECES))
        loose = packed.where("n_bins > bound").select("uid", "length", (F.pmod(F.xxhash64("uid", F.lit(k)), F.lit(again)) + first * (k + 1)).alias("part"))
        redone = written(_packed(loose, capacity), "repacked")
        now = redone.groupBy("part").agg(F.max("n_bins").alias("b")).agg(F.sum("b")).first()[0]
        if now >= bins:
            break
        packed = packed.where("n_bins <= bound").unionByName(redone)
    return packed.select("uid", (F.shiftleft("part", 32) + F.col("bin")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Pieces as long as a sequence fill one each; all others go through ``pack``. Empty tables give none.
    A worker's memory grows with ``cache_words``, of words whose tokens it keeps.
    """
    pieces = written(pieces_of(docs, vocabulary, capacity, end_id, cache_words).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    places = pack(pieces.where(F.col("length") < capacity).select("uid", "length"), capacity)
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.where(F.col("length") < capacity).join(places, "uid")
    return rest.unionByName(full).drop("uid")
