"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, union-find.

Documents of equal shingle sets form a class, told apart by a 128-bit digest; only classes are
compared. Classes that share a MinHash band share a bucket. A bucket's least class is compared with
the others first; where that leaves several components in a bucket, its members of the smaller
components are compared with the rest, the likeliest partners first, until none is left untested.
Odd sketches (parity bitmaps over one-permutation MinHash samples) estimate each candidate pair from
the population count of their XOR; what may reach the threshold is confirmed on full sets. Pairs
within one component need no test, so a large group of copies costs rows in proportion to its size.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import ascii_lower_words, as_long, list_column, map_batches, mixed, need, shingle_hashes, written
from quern.llm.components import connected_components

#: Rows of a band; and the share of pairs right at the threshold that may share no band at all.
BAND_ROWS, BAND_MISS = 4, 1e-5
#: Bins that give one sample each, and bits of an odd sketch.
SAMPLES, SKETCH_BITS = 4096, 4096
#: A pair is tested on full sets unless its sketches differ by this many deviations more than at the threshold.
DEVIATIONS = 3.5
#: Members of a bucket that one task compares with as many others.
BLOCK = 1_500
#: Partners that a member proposes in each round, likeliest first.
PARTNERS = (8, 64, 512, 4096, 1 << 40)
#: Up to this many candidate ids travel by broadcast (8 bytes each); more, by a shuffle join.
BROADCAST_IDS = 250_000


def bands_for(threshold: float) -> int:
    """Number of bands so that a pair at the threshold misses all of them with chance BAND_MISS at most."""
    return math.ceil(math.log(BAND_MISS) / math.log(1 - threshold**BAND_ROWS))


class Sketcher:
    """Bands and odd sketches of sets of 64-bit hashes."""

    def __init__(self, bands: int) -> None:
        n = bands * BAND_ROWS
        self.factor = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.offset = mixed(np.arange(n + 1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.band = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in range(0, len(hashes), 4096):
            np.minimum(least, (hashes[at : at + 4096, None] * self.factor + self.offset).min(axis=0), out=least)
        key = self.band.copy()
        for row in least.reshape(-1, BAND_ROWS).T:
            key = mixed(key ^ row) + row
        return key

    @staticmethod
    def odd_sketch(hashes: np.ndarray) -> np.ndarray:
        """The least hash of each of SAMPLES bins (hashes are sorted), folded into parities."""
        _, first = np.unique(hashes & np.uint64(SAMPLES - 1), return_index=True)
        bit = (mixed(hashes[first]) % np.uint64(SKETCH_BITS)).astype(np.int64)
        odd = np.bincount(bit, minlength=SKETCH_BITS) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (digest of the set), bands, sketch; for empty sets bands are empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Sketcher(bands)
        n, h1, h2, keys, bits = [], [], [], [], []
        for text in batch.column(1):
            h = shingle_hashes(ascii_lower_words(text.as_py()), size)
            digest = xxhash.xxh3_128_digest(h.tobytes())
            n.append(len(h))
            a, b = np.frombuffer(digest, np.int64).tolist()
            h1.append(a)
            h2.append(b)
            keys.append(s.bands(h) if len(h) else np.zeros(0, np.uint64))
            bits.append(s.odd_sketch(h) if len(h) else np.zeros(0, np.int64))
        cols = [pa.array(x, pa.int64()) for x in (n, h1, h2)]
        lists = [list_column(np.concatenate(x).view(np.int64), list(map(len, x)), pa.int64()) for x in (keys, bits)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols, *lists], ["doc_id", "n_shingles", "h1", "h2", "bands", "sketch"])

    return map_batches(need(docs, "doc_id", "text"), run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id, shingles of one row of each wanted document; texts are shuffled only if the ids are many."""
    wanted = ids.select(F.col("id").alias("doc_id"))
    wanted = F.broadcast(wanted) if ids.count() <= BROADCAST_IDS else wanted
    chosen = need(docs, "doc_id", "text").join(wanted, "doc_id", "left_semi")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [as_long(shingle_hashes(ascii_lower_words(t.as_py()), size)) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), list_column(np.concatenate(sets), list(map(len, sets)), pa.int64())], ["id", "shingles"])

    return map_batches(chosen, run, "id long, shingles array<long>")


def _xor_count(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def most_different(n_a, n_b, threshold: float, m=np):
    """The XOR count up to which sets of these sizes may reach the threshold; of numbers or columns.

    A bin of the union differs with chance 1 - t. It then flips one bit, and a second if the other set
    has a sample there too. Bins that hold more than one hash add sampling noise, and parities hide
    part of the flips.
    """
    n = (n_a + n_b) * 0.5
    fill = n * (2 / (1 + threshold) / SAMPLES)
    flips = (1 - m.exp(-fill)) * (SAMPLES * (1 - threshold)) * (2 - m.exp(-n * (1 / SAMPLES)))
    hidden = m.exp(flips * (4 / SKETCH_BITS))
    variance = flips * 2 * (1 - m.exp(-n * (1 / SAMPLES))) + (hidden - 1) * (SKETCH_BITS / 4) - flips
    most = flips + m.sqrt(variance) * DEVIATIONS + 1
    return (1 - m.exp(-most * (2 / SKETCH_BITS))) * (SKETCH_BITS / 2)


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, linked of the pairs whose sketches leave a link possible."""
    side = classes.select("id", "n_shingles", "sketch")
    near = (
        pairs.join(side.toDF("a", "n_a", "sketch_a"), "a")
        .join(side.toDF("b", "n_b", "sketch_b"), "b")
        .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (_xor_count("sketch_a", "sketch_b") <= most_different(F.col("n_a"), F.col("n_b"), percent / 100, F)))
        .select("a", "b")
    )
    both = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.select("a", "b", (100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).alias("linked"))


def _proposals(members: DataFrame, percent: int, before: int, partners: int) -> DataFrame:
    """a, b, more: for the members of mixed buckets those of their partners of rank ``before`` to
    ``partners`` that lie in other components; ``more`` says that some wait for a later round.

    Ranks are the same in each round, so over the rounds every pair has its turn once at most for
    either side.
    """
    empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "more": np.zeros(0, bool)})

    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        comp = pdf["component"].to_numpy(np.int64)
        if (comp == comp[0]).all():
            return empty
        own, apart = pdf["own"].to_numpy(np.int64), key[1] != key[2]
        ids, size = pdf["id"].to_numpy(np.int64), pdf["n_shingles"].to_numpy(np.int64)
        bits, bands = np.stack(pdf["sketch"].to_numpy()).view(np.uint64), np.stack(pdf["bands"].to_numpy())
        out, waits = [], False
        for k in range(len(ids)):
            who = np.flatnonzero((own != own[k] if apart else ids != ids[k]) & (100 * np.minimum(size, size[k]) >= percent * np.maximum(size, size[k])))
            # a pair belongs to the first of the buckets that it shares
            who = who[bands[k][(bands[who] == bands[k]).argmax(axis=1)] == key[0]]
            d = np.bitwise_count(bits[who] ^ bits[k]).sum(axis=1, dtype=np.int64)
            fits = d <= most_different(size[who], size[k], percent / 100)
            who, d = who[fits], d[fits]
            turn = who[np.argsort(d, kind="stable")[before:partners]]
            turn = turn[comp[turn] != comp[k]]
            out.append(pd.DataFrame({"a": np.minimum(ids[k], ids[turn]), "b": np.maximum(ids[k], ids[turn])}))
            waits |= bool((comp[who] != comp[k]).any()) and len(who) > partners
        if waits:  # a pair of one class with itself, so that the word gets through
            out.append(pd.DataFrame({"a": ids[:1], "b": ids[:1]}))
        return pd.concat(out).drop_duplicates().assign(more=waits)

    return members.groupBy("key", "i", "j").applyInPandas(run, "a long, b long, more boolean")


def link_classes(classes: DataFrame, sets_of, percent: int) -> DataFrame:
    """id, component of the classes that any link reaches."""
    buckets = written(classes.select(F.explode("bands").alias("key"), "id"), "bands")
    hubs = buckets.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    shared = written(buckets.join(hubs, "key"), "buckets")
    sets = written(sets_of(shared.select("id").distinct()), "sets")
    tested = written(confirmed(shared.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), classes, sets, percent), "tested")
    components = written(connected_components(tested.where("linked")), "components")
    for before, partners in zip((0, *PARTNERS), PARTNERS, strict=False):
        known = shared.where("n > 2").join(components.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed_keys = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
        blocks = F.ceil(F.col("n") / BLOCK)
        own = F.pmod(F.xxhash64("id"), blocks)
        # each pair of blocks of a bucket is one group; a bucket of one block is one group
        spread = known.join(mixed_keys, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        members = spread.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component").join(classes.select("id", "n_shingles", "sketch", "bands"), "id")
        offered = written(_proposals(members, percent, before, partners), "offered")
        fresh = offered.where("a != b").select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        now = written(confirmed(fresh, classes, sets, percent), "tested")
        waiting = offered.where("more").limit(1).count()
        if now.where("linked").limit(1).count():
            tested = tested.unionByName(now)
            components = written(connected_components(tested.where("linked")), "components")
        elif waiting:
            tested = tested.unionByName(now)
        if not waiting:
            break
    return components.select(F.col("node").alias("id"), "component")


def near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents link if 100 * intersection >= percent * union of their sets of ``size``-word shingles;
    fewer words make one shingle. Texts without words, null or empty, link with nothing. Repeated rows
    are judged alike. A row without doc_id joins its set's component but is never the one kept.
    """
    seen = written(sketches(docs, size, bands_for(percent / 100)), "sketches")
    by_set = seen.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2")
    classes = written(by_set.agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    linked = link_classes(classes, lambda ids: full_sets(docs, ids, size), percent)
    of_set = classes.select("h1", "h2", "id").join(linked, "id", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    rows = seen.select("doc_id", "n_shingles", "h1", "h2").join(of_set, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
