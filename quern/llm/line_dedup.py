"""Fuzzy line deduplication in DataFrame operations only.

A line's set holds the shingles of eight characters at each of its characters; a shorter line is one
shingle. Equal lines meet first, by hash; each distinct line is signed once. Its shingles fall into
BINS bins by hash, and a band's key joins three MinHashes of a bin, each in an order of its own. Lines
that share a key share a bucket. A short line has few shingles, and one that differs may be all of its
bin, so lines of up to SHORT characters also share a bucket for each of their first shingles by hash: two
sets at the threshold have one of these in common, so no pair of short lines is lost.
Each bucket's best met line is compared with the others. Hubs are drawn anew in large buckets that hold
several components (another one in each bucket) as long as that pays; at last come all pairs that no
component joins and no test has settled. Bitmaps of the shingles, made of the lines in buckets alone, and
parity sketches in the last round, put aside pairs far from the threshold; Jaccard on full sets decides;
a distributed union-find makes components; of each, only the first occurrence of its lines stays.

Shingles are rows (an explode, hashing and aggregation in generated code) where a line is signed; they
stay in the task that has the line, as the line's hash deals out both.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import free_name, light, need, release, settings, written
from quern.llm.components import connected_components, joined_components

#: Two lines link if their sets' Jaccard similarity is at least this many hundredths.
PERCENT = 80
#: Characters of a shingle (UTF-16 units: one beyond the basic plane counts as two).
SHINGLE = 8
#: A pair at the threshold misses all eight bands of three (two a bin) with chance 0.003, one at 0.9 with 0.00003, if
#: what differs is spread over the bins; lines of up to SHORT characters, where it isn't, don't rest on bands.
BINS, TURNS, SHORT = 4, (2, 12, 22, 32, 42, 52), 48
#: Hubs are drawn anew in buckets of more than SMALL lines while at least a PAYS-th of the tests finds a link.
SMALL, PAYS = 64, 20
#: Longs of a bitmap or a parity sketch.
WORDS = 16
#: Groups by line and bin, by line and word or by key come to hundreds of thousands in a task, more than the fast map holds unasked.
_MANY_GROUPS = {"spark.sql.codegen.aggregate.fastHashMap.capacityBit": "20"}

_BLANKS = " \t\x0b\f\r"


def _filled(line: Column) -> Column:
    return F.ltrim(line, F.lit(_BLANKS)) != ""


def occurrences(docs: DataFrame) -> DataFrame:
    """id (the line's hash), doc_id, pos, line of every line that isn't blank, of rows with an id."""
    rows = need(docs, "doc_id", "text").where("doc_id is not null")
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(_filled(F.col("line"))).select(F.xxhash64("line").alias("id"), "doc_id", "pos", "line")


def _starts(units: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.length(units) - (2 * SHINGLE - 1), F.lit(1)), F.lit(2))


def _shingle(units: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(units, start, F.lit(2 * SHINGLE)))


def shingle_rows(lines: DataFrame) -> DataFrame:
    """id, h: the hash of each shingle of each line (id, line), repeated ones included."""
    units = lines.select("id", F.encode("line", "UTF-16BE").alias("units"))
    return units.select("id", "units", F.explode(_starts(F.col("units"))).alias("start")).select("id", _shingle(F.col("units"), F.col("start")).alias("h"))


def shingle_set(line: str) -> Column:
    """Distinct hashes of a line's shingles."""
    # the outer transform binds the encoded line, which each shingle would else encode again
    found = F.transform(F.array(F.encode(line, "UTF-16BE")), lambda u: F.transform(_starts(u), lambda i: _shingle(u, i)))
    return F.array_distinct(found[0])


def band_keys(shingles: DataFrame) -> DataFrame:
    """id, keys: the keys of a bin's two bands, for each bin of a line that has shingles, of rows (id, h) that are dealt out by id.

    Turning a hash by some bits gives another order: which is the least of a set rests on its first
    bits alone, so a few bits are turn enough. A bin is the first bits; the turns leave them behind.
    """
    turns = [F.shiftleft("h", t).bitwiseOR(F.shiftrightunsigned("h", 64 - t)) for t in TURNS]
    bin_ = F.shiftrightunsigned("h", 65 - BINS.bit_length()).alias("bin")
    least = shingles.groupBy("id", bin_).agg(*[F.min(x).alias(f"m{k}") for k, x in enumerate(turns)])
    return least.select("id", F.array(*[F.xxhash64(F.lit(k), *[f"m{i}" for i in range(k, k + 3)]) for k in (0, 3)]).alias("keys"))


def first_shingles(line: str) -> Column:
    """The least hashes of a line's set, so many that any set at the threshold shares one of them."""
    least = F.transform(F.array(F.sort_array(shingle_set(line))), lambda s: F.slice(s, F.lit(1), F.floor(F.size(s) * (100 - PERCENT) / 100 + 1e-9).cast("int") + 1))
    return least[0]


def _words(shingles: DataFrame, summed: Column, *more: Column) -> DataFrame:
    """id, word, bits: the shingles' bits by word of a bitmap, summed up as asked."""
    return shingles.groupBy("id", F.col("h").bitwiseAND(F.lit(WORDS - 1).cast("long")).alias("word")).agg(summed.alias("bits"), *more)


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("h", 4).bitwiseAND(F.lit(63).cast("long")).cast("int"))


def _in_order() -> Column:
    return F.array(*[F.bit_xor(F.when(F.col("word") == w, F.col("bits")).otherwise(F.lit(0).cast("long"))) for w in range(WORDS)])


def _apart(a: str, b: str) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w)))) for w in range(WORDS)), F.lit(0))


def bitmaps(shingles: DataFrame) -> DataFrame:
    """id, map (the bits that any shingle of a line sets, as WORDS longs), fill, of rows (id, h), repeated ones included, dealt out by id.

    fill is the size of the set that the bits tell of, in bitmaps; null if all bits are set.
    """
    maps = _words(shingles, F.bit_or(_bit())).groupBy("id").agg(_in_order().alias("map"))
    free = F.lit(1.0) - sum((F.bit_count(F.get("map", F.lit(w))) for w in range(WORDS)), F.lit(0)) / (64 * WORDS)
    return maps.select("id", "map", F.when(free > 0, -F.log(free)).alias("fill"))


def _alike(map_a: str, map_b: str, fill_a: str, fill_b: str) -> Column:
    """The bitmaps differ in no more bits than those of sets at the threshold do, and 4 deviations; full ones never rule a pair out.

    A bit differs if none of the common shingles sets it and one of the others does. Fills of up to 4 are
    known to some hundredths, so those of sets at the threshold differ by less than 0.85 times what it allows.
    """
    t = PERCENT / 100
    union = (F.col(fill_a) + F.col(fill_b)) / (1 + t)
    most = F.exp(union * -t) * (1 - F.exp(union * ((t - 1) / 2))) * (128 * WORDS)
    sized = (F.greatest(fill_a, fill_b) > 4) | (F.least(fill_a, fill_b) >= F.greatest(fill_a, fill_b) * (0.85 * t))
    return F.coalesce(sized & (_apart(map_a, map_b) <= most + F.sqrt(most) * 4 + 1), F.lit(True))


def odd_sketches(sets: DataFrame) -> DataFrame:
    """id, m (size of the set), odd (an odd sketch: parities of the set, as WORDS longs), of distinct rows (id, h) dealt out by id."""
    return _words(sets, F.bit_xor(_bit()), F.count("*").alias("n")).groupBy("id").agg(F.sum("n").alias("m"), _in_order().alias("odd"))


def _may_link(n_a: str, n_b: str, odd_a: str, odd_b: str) -> Column:
    """The sketches differ by no more than those of sets at the threshold do, and 3.5 deviations.

    Mean and deviation are those of the count of odd parities: sketches of very long lines, which
    saturate at half their bits, never rule a pair out.
    """
    t, bits = PERCENT / 100, 64 * WORDS
    flips = (F.col(n_a) + F.col(n_b)) * ((1 - t) / (1 + t))
    left = F.exp(flips * (-4 / bits))
    most = (1 - F.sqrt(left)) * (bits / 2) + F.sqrt(F.greatest(F.lit(0.0), (1 - left) * (bits / 4) - flips * left)) * 3.5 + 1
    return (100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)) & (_apart(odd_a, odd_b) <= most)


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) at or over the threshold. Lines travel as texts, which are smaller than their sets."""
    both = pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")
    sets = both.select("a", "b", shingle_set("line_a").alias("set_a"), shingle_set("line_b").alias("set_b"))
    sized = sets.select("a", "b", F.size("set_a").alias("m_a"), F.size("set_b").alias("m_b"), F.size(F.array_intersect("set_a", "set_b")).alias("common"))
    return written(sized.where(100 * F.col("common") >= PERCENT * (F.col("m_a") + F.col("m_b") - F.col("common"))).select("a", "b"), "linked")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _distinct_lines(lines: DataFrame) -> DataFrame:
    """id, line of every distinct line, dealt out by id."""
    return lines.select("id", "line").repartition("id").distinct()


def found_lines(docs: DataFrame) -> DataFrame:
    """id, doc_id, pos of every line that isn't blank, and short: the line itself, if it has up to SHORT characters."""
    few = F.octet_length("line") <= 3 * SHORT  # read off, not counted; a unit is three bytes of UTF-8 at most
    short = F.when(few & (F.length(F.encode("line", "UTF-16BE")) <= 2 * SHORT), F.col("line"))
    return written(occurrences(docs).select("id", "doc_id", "pos", short.alias("short")), "occurrences")


def shared_buckets(docs: DataFrame, found: DataFrame) -> DataFrame:
    """key, id, n: the lines of every bucket that holds n > 1 of them."""
    least = found.where("short is not null").select("id", "short").distinct()
    short = written(least.select(F.explode(first_shingles("short")).alias("key"), "id"), "short")  # loses no pair of short lines
    with settings(docs.sparkSession, _MANY_GROUPS):
        signed = written(band_keys(shingle_rows(_distinct_lines(occurrences(docs)))), "signed")
        keys = signed.select(F.explode("keys").alias("key"), "id").unionByName(short)
        # counts before members: a hot bucket is summed in parts, and its members meet it in a join that splits
        counts = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).where("n > 1"), "counts")
    twos = counts.where("n = 2").select("key", F.explode(F.array("a", "b")).alias("id"), "n")
    shared = written(twos.unionByName(keys.join(light(counts.where("n > 2").select("key", "n")), "key").select("key", "id", "n")), "buckets")
    release(signed, short, counts)
    return shared


def line_components(docs: DataFrame, found: DataFrame) -> DataFrame:
    """node, component of the lines that any link reaches, by id."""
    shared = shared_buckets(docs, found)
    ids = written(shared.select("id").distinct(), "ids")
    texts = written(_distinct_lines(occurrences(docs).join(light(ids), "id", "left_semi")), "texts")
    with settings(docs.sparkSession, _MANY_GROUPS):
        maps = written(bitmaps(shingle_rows(texts.repartition("id"))), "maps")

    def tested(pairs: DataFrame) -> DataFrame:
        a, b = maps.toDF("a", "map_a", "fill_a"), maps.toDF("b", "map_b", "fill_b")
        return _linked(pairs.join(a, "a").join(b, "b").where(_alike("map_a", "map_b", "fill_a", "fill_b")).select("a", "b"), texts)

    # the line that meets most others is likeliest to be what the others derive from
    degree = shared.groupBy("id").agg(F.sum("n").alias("degree"))
    hubs = shared.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", "id"))["id"].alias("hub"))
    pairs = written(shared.join(hubs, "key").where("id != hub").select(*_pair("id", "hub")).distinct(), "pairs")
    settled, links = [pairs], tested(pairs)
    components = connected_components(links)
    release(links)
    wide, rounds = True, 0
    while wide:
        known, split = _split_buckets(shared.where(F.col("n") > SMALL), components, rounds)
        drawn = known.join(split, "key").where("component != drawn.component").select(*_pair("id", "drawn.id")).distinct()
        pairs = written(_untested(drawn, settled), "pairs")
        links = tested(pairs)
        components, wide, rounds = joined_components(components, links), links.count() * PAYS > pairs.count(), rounds + 1
        settled.append(pairs)
        release(links)
    pairs = written(_untested(_pairs_left(shared, components, texts), settled), "pairs")
    links = _linked(pairs, texts)
    components = joined_components(components, links)
    release(shared, ids, maps, texts, links, pairs, *settled)
    return components


def _split_buckets(shared: DataFrame, components: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """key, id, component of the buckets' lines; and for each bucket of several components the key and a line drawn from it."""
    known = shared.join(components.toDF("id", "component"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    drawn = F.min(F.struct(F.xxhash64("id", "key", F.lit(rounds)).alias("h"), "id", "component")).alias("drawn")
    return known, known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), drawn).where("lo != hi")


def _pairs_left(shared: DataFrame, components: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: all pairs of one bucket and different components that their sketches let through."""
    known, split = _split_buckets(shared.where("n > 2"), components, 0)  # the two of a bucket have met
    members = known.join(split.select("key"), "key")
    held = written(members.groupBy("id", "component").agg(F.array_sort(F.collect_list("key")).alias("keys")), "held")  # a line's buckets, few
    with settings(texts.sparkSession, _MANY_GROUPS):
        lines = texts.join(light(held.select("id")), "id", "left_semi").repartition("id")
        sketches = written(odd_sketches(lines.select("id", F.explode(shingle_set("line")).alias("h"))), "sketches")
    members = written(held.join(sketches, "id").select(F.explode("keys").alias("key"), "id", "component", "m", "odd", "keys"), "members")
    x, y = members.toDF("key", "x", "cx", "mx", "ox", "kx"), members.toDF("key", "y", "cy", "my", "oy", "ky")
    first = F.array_min(F.array_intersect("kx", "ky")) == x["key"]  # a pair comes from the first bucket that holds both
    return x.hint("merge").join(y, (x["key"] == y["key"]) & (F.col("cx") < F.col("cy")) & _may_link("mx", "my", "ox", "oy") & first).select(*_pair("x", "y"))


def _untested(pairs: DataFrame, settled: list[DataFrame]) -> DataFrame:
    return pairs.join(functools.reduce(DataFrame.unionByName, settled), ["a", "b"], "left_anti")


def removed_lines(docs: DataFrame, name: str) -> DataFrame:
    """doc_id and, under ``name``, the places of its lines that go: all but the first of each component of lines.

    First means of least document id, then of least place. Lines differ if any character does, but
    for 64-bit hash collisions.
    """
    found = found_lines(docs)
    components = line_components(docs, found)
    tied = found.join(components.toDF("id", "component"), "id", "left").select(F.coalesce("component", "id").alias("component"), "doc_id", "pos")
    # counts first: most lines are alone in their component, and only the others need be put in order
    several = written(tied.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component"), "several")
    copies = written(tied.join(light(several), "component", "left_semi"), "copies")
    firsts = copies.groupBy("component").agg(F.min(F.struct("doc_id", "pos")).alias("keep"))
    gone = copies.join(firsts, "component").where("doc_id != keep.doc_id or pos != keep.pos")
    out = written(gone.groupBy("doc_id").agg(F.collect_set("pos").alias(name)), "gone")  # a document's own lines
    release(found, components, several, copies)
    return out


def _marked(docs: DataFrame, name: str) -> DataFrame:
    return docs.join(light(removed_lines(docs, name)), "doc_id", "left")


def _kept(text: str, gone: str) -> Column:
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    left = F.filter(numbered, lambda p: ~F.array_contains(gone, p["i"]))
    return F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda p: p["x"]), "\n"))


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256: one row per document.

    Blank lines don't count and stay. Null texts count as empty. A row without id loses nothing and
    holds nothing against others; rows of equal id are one document given twice.
    """
    rows = _marked(need(docs, "doc_id", "text"), "gone")
    text = F.coalesce("text", F.lit(""))
    n_lines = F.size(F.filter(F.split(text, "\n"), _filled))
    return rows.select("doc_id", n_lines.cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"), F.sha2(F.coalesce(_kept("text", "gone"), F.lit("")), 256).alias("kept_sha256"))


def remove_duplicate_lines(docs: DataFrame) -> DataFrame:
    """The documents without their duplicate lines; other columns and untouched texts as they are."""
    gone = free_name(docs, "gone")
    return _marked(docs, gone).select(*[_kept("text", gone).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
