"""Near-duplicate records with small edits.

Method: bit-sliced comparison. Each record's set of ``SHINGLE``-token runs is sketched into one-bit minimum hashes; records are blocked by bands
of minimum hashes, and within a block the sketches are compared bit-sliced: bit planes are stored vertically (one word holds the same
bit of 64 record pairs), carry-save counters update all distances at once, and a block of lanes is abandoned as soon as all its
distances exceed the radius. Pairs within the radius pass a longer sketch and then an exact comparison of the sets.

Records with equal sets are folded into one class before blocking and expanded at the end. A band bucket with more than ``TILE`` records
is split into tiles of pairs of chunks, so no bucket is compared in one task. Large sets take their minimum hashes from the bins of one permutation; sets of at most
``SHORT_SET`` runs, whose few values would repeat over the bins, from independent permutations, and sets up to the size that may be near such a one have both. So blocking misses a
pair of similarity 0.6 with a probability of about 4 in 10,000, and of 0.65 with 2 in 100,000 (short sets: about one in a million); the radii lie five standard deviations beyond the threshold. The last
comparison is exact but for equal 64-bit hashes of different token runs.

Defined results: null and blank texts and texts with fewer than ``SHINGLE`` tokens have an empty set and no partner; repeated rows of
a record are one record; equal records are partners.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.spans import _B, _mixed, _powers
from leafmill.operators.ranking import BROADCAST_ROWS, join_counted
from leafmill.session import cut, spread

SHINGLE, THRESHOLD = 5, 0.6
#: Minimum hashes in a band (of large and of short sets), and bands.
ROWS, SHORT_ROWS, BANDS = 4, 3, 56
#: Bits of the sketch that travel with the bands, and of the whole sketch.
SHORT_BITS, LONG_BITS = 128, 256
DEVIATIONS = 5.0
#: Sets of at most this many token runs are sketched by independent permutations.
SHORT_SET = 64
#: Sets that one row carries partners for, in the exact comparison.
PARTNERS = 500
#: A bucket with more records is compared in tiles of this many.
TILE = 2048
#: One page in SAMPLE is counted to find such buckets; it only decides on tiling.
SAMPLE = 16
#: Lanes that are compared, and abandoned, together.
LANES = 8192
#: More records in pairs than this, or four times as many pairs, are joined by shuffle instead of broadcast.
BROADCAST_IDS = 300_000
CHUNK = 1_000_000

_CLASSES: list[np.ndarray] = []
_FILL: dict[int, np.ndarray] = {}


def _classes() -> np.ndarray:
    """By code point: 1 for U+4E00-U+9FFF, 2 for other letters and digits, else 0."""
    if not _CLASSES:
        table = np.zeros(0x110000, dtype=np.uint8)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] in "LN":
                table[c] = 2
        table[0x4E00:0xA000] = 1
        _CLASSES.append(table)
    return _CLASSES[0]


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of all runs of ``width`` tokens of each text."""
    points = [np.frombuffer((t.lower() + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in points])]).astype(np.int64)
    whole = np.concatenate(points)
    kind = _classes()[whole]
    single, run = kind == 1, kind == 2
    first = single | (run & ~np.concatenate([[False], run[:-1]]))
    last = single | (run & ~np.concatenate([run[1:], [False]]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(len(whole))
    total = np.empty(len(whole) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_mixed((whole.astype(np.uint64) + np.uint64(1)) * np.uint64(_B)) * power, out=total[1:])
    tokens = _mixed((total[ends] - total[starts]) * inverse[starts])
    n = len(tokens) - width + 1
    if n > 0:
        shingles = tokens[:n].copy()
        for i in range(1, width):
            shingles = _mixed(shingles * np.uint64(0xC2B2AE3D27D4EB4F) + tokens[i : n + i])
    else:
        shingles = np.empty(0, dtype=np.uint64)
    bounds = np.searchsorted(starts, offsets)
    return [np.unique(shingles[a : max(a, b - width + 1)]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def bin_minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minimum hashes of a sorted hash set; empty bins take the value of a bin that a fixed hash chooses."""
    edges = np.array([(j << 64) // bins for j in range(bins)], dtype=np.uint64)
    at = np.append(np.searchsorted(hashes, edges), len(hashes))
    full = at[:-1] < at[1:]
    out = hashes[np.minimum(at[:-1], len(hashes) - 1)].copy()
    if not full.all():
        if bins not in _FILL:
            j = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(64) + np.arange(64, dtype=np.uint64)[None, :]
            _FILL[bins] = (_mixed((j + np.uint64(7)) * np.uint64(_B)) % np.uint64(bins)).astype(np.int64)
        todo = np.flatnonzero(~full)
        values = out.copy()
        for attempt in range(64):
            source = _FILL[bins][todo, attempt]
            good = full[source]
            out[todo[good]] = values[source[good]]
            todo = todo[~good]
            if not len(todo):
                break
        out[todo] = hashes[0]
    return out


def independent_minima(hashes: np.ndarray, first: int, count: int) -> np.ndarray:
    """The minimum hashes of a set under ``count`` independent permutations."""
    seeds = _mixed((np.arange(first, first + count, dtype=np.uint64) + np.uint64(11)) * np.uint64(_B))
    return _mixed(_mixed(hashes[:, None] ^ seeds[None, :]) * np.uint64(0xD1342543DE82EF95)).min(axis=0)


def sketch(hashes: np.ndarray, short: bool = False) -> tuple[np.ndarray, bytes]:
    """(band keys, one-bit sketch) of a sorted hash set; those of short sets have keys of their own."""
    rows = SHORT_ROWS if short else ROWS
    if short:
        every = independent_minima(hashes, 0, rows * BANDS + LONG_BITS)
        mins, rest = every[: rows * BANDS], every[rows * BANDS :]
    else:
        mins, rest = bin_minima(hashes, rows * BANDS), bin_minima(np.sort(_mixed(hashes * np.uint64(0xD1342543DE82EF95))), LONG_BITS)
    mins = mins.reshape(BANDS, rows)
    keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS if short else 0)
    for i in range(rows):
        keys = _mixed(keys * np.uint64(0xC2B2AE3D27D4EB4F) + mins[:, i])
    return keys.view(np.int64), np.packbits((_mixed(rest) & np.uint64(1)).astype(np.uint8)).tobytes()


def sorts_of(size: int, threshold: float = THRESHOLD) -> list[bool]:
    """Which sketches a set of a size has: of a short set, of a large one, or both."""
    return [short for short in (True, False) if (size * threshold <= SHORT_SET if short else size > SHORT_SET)]


def radius(bits: int, threshold: float = THRESHOLD) -> int:
    """The distance of one-bit sketches that a pair of the threshold's similarity stays within."""
    p = (1 - threshold) / 2
    return math.floor(bits * p + DEVIATIONS * math.sqrt(bits * p * (1 - p)))


def _full_add(a, b, c):
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def lanes_within(planes: np.ndarray, limit: int) -> np.ndarray:
    """Bit-sliced distances: ``planes[k]`` holds bit k of the differences of 64 pairs a word. The packed lanes within ``limit``.

    Planes are added eight at a time through carry-save adders into a vertical counter; the block is abandoned once all lanes exceed.
    """
    counter = [np.zeros_like(planes[0]) for _ in range(len(planes).bit_length() + 1)]
    within = None
    for k in range(0, len(planes), 8):
        p = planes[k : k + 8]
        s1, c1 = _full_add(p[0], p[1], p[2])
        s2, c2 = _full_add(p[3], p[4], p[5])
        s3, c3 = _full_add(p[6], p[7], s1)
        ones, c4 = s2 ^ s3, s2 & s3
        t1, f1 = _full_add(c1, c2, c3)
        twos, f2 = t1 ^ c4, t1 & c4
        fours, eights = f1 ^ f2, f1 & f2
        carry = np.zeros_like(ones)
        for level, plane in enumerate((ones, twos, fours, eights)):
            counter[level], carry = _full_add(counter[level], plane, carry)
        for level in range(4, len(counter)):
            counter[level], carry = counter[level] ^ carry, counter[level] & carry
        if k + 8 > limit or k + 8 >= len(planes):
            less, equal = np.zeros_like(ones), ~np.zeros_like(ones)
            for level in range(len(counter) - 1, -1, -1):
                if limit >> level & 1:
                    less |= equal & ~counter[level]
                    equal &= counter[level]
                else:
                    equal &= ~counter[level]
            within = less | equal
            if not within.any():
                return within
    return within


def pairs_within(left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Which rows of two arrays of packed sketches (rows x bytes) are within ``limit`` bits."""
    out = np.zeros(len(left), dtype=bool)
    for lo in range(0, len(left), LANES):
        bits = np.unpackbits(left[lo : lo + LANES] ^ right[lo : lo + LANES], axis=1)
        n = len(bits)
        packed = np.packbits(np.ascontiguousarray(bits.T), axis=1)
        wide = np.zeros((packed.shape[0], -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
        wide[:, : packed.shape[1]] = packed
        within = lanes_within(wide.view(np.uint64), limit)
        out[lo : lo + n] = np.unpackbits(within.view(np.uint8))[:n].astype(bool)
    return out


def _texts(pages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pages.where(F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\S")).select(F.col(id_col).cast("string").alias("page"), F.col(text_col).alias("text"))


def _groups(texts: list[str]):
    at, size, start = 0, 0, 0
    for at, t in enumerate(texts, 1):
        size += len(t)
        if size >= CHUNK:
            yield start, at
            start, size = at, 0
    if start < len(texts):
        yield start, len(texts)


def sketches(pages: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(page, digest, short, bands, sketch) of every record with shingles; one row for each sort of sketch it has."""

    def run(batches):
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _groups(texts):
                kept, digests, sorts, bands, bits = [], [], [], [], []
                for name, s in zip(names[lo:hi], shingle_sets(texts[lo:hi])):
                    digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                    for short in sorts_of(len(s), threshold) if len(s) else ():
                        keys, sk = sketch(s, short)
                        kept.append(name)
                        digests.append(digest)
                        sorts.append(short)
                        bands.append(keys)
                        bits.append(sk)
                flat = np.concatenate(bands) if bands else np.empty(0, dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(digests, pa.binary()), pa.array(sorts, pa.bool_()), lists, pa.array(bits, pa.binary())], names=["page", "digest", "short", "bands", "sketch"])

    return spread(_texts(pages, id_col, text_col)).mapInArrow(run, "page string, digest binary, short boolean, bands array<long>, sketch binary")


def _compare_buckets(batches, limit: int):
    """Rows (key, tile, part, page, sketch) sorted by (key, tile) to pairs of pages within the limit; tiles of two chunks compare across only."""
    kept: pa.Table | None = None

    def compare(rows: pa.Table):
        if rows.num_rows < 2:
            return []
        key, tile, part, page = (rows.column(i).to_numpy() for i in range(4))
        data = np.frombuffer(b"".join(rows.column(4).to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
        group = np.cumsum(fresh) - 1
        size = np.bincount(group)
        end = np.cumsum(size)[group]
        found = []
        for lag in range(1, int(size.max())):
            i = np.flatnonzero(np.arange(len(key)) + lag < end)
            if not len(i):
                break
            j = i + lag
            # tile >= 0: a pair of chunks of a large bucket, where only pairs across its two parts count
            good = (page[i] != page[j]) & ((tile[i] < 0) | (part[i] != part[j]))
            i, j = i[good], j[good]
            if len(i):
                near = pairs_within(data[i], data[j], limit)
                a, b = page[i[near]], page[j[near]]
                if len(a):
                    found.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0))
        return found

    def batch_of(found):
        both = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([kept, rows]) if kept is not None else rows
        keys, tiles = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        at = len(keys)
        while at and keys[at - 1] == keys[-1] and tiles[at - 1] == tiles[-1]:
            at -= 1
        if at:
            yield batch_of(compare(rows.slice(0, at)))
        kept = rows.slice(at)
    if kept is not None:
        yield batch_of(compare(kept))


def _with_chunks(rows: DataFrame, tile: int) -> DataFrame:
    """Rows (rep, short, key, sketch) with ``chunks``, into how many parts a hot bucket is cut; null for others. Very hot keys, of which there are few, are marked by broadcast."""
    sample = rows.where(F.pmod(F.xxhash64("rep"), F.lit(SAMPLE)) == 0).groupBy("key").count()
    hot = cut(sample.where(F.col("count") > max(2, tile // SAMPLE)).select(F.col("key").alias("hot"), F.ceil(F.col("count") * SAMPLE * 1.5 / tile).cast("int").alias("chunks"), "count"))
    bound = (hot.agg(F.sum("count")).first()[0] or 0) // BROADCAST_ROWS + 1
    marked = rows.join(F.broadcast(hot.where(F.col("count") >= bound)), F.col("key") == F.col("hot"), "left")  # at most BROADCAST_ROWS
    rest = hot.where(F.col("count") < bound)
    if rest.isEmpty():
        return marked
    again = marked.where(F.col("hot").isNull()).select(*rows.columns).join(rest, F.col("key") == F.col("hot"), "left")
    return marked.where(F.col("hot").isNotNull()).unionByName(again)


def candidate_pairs(reps: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(a, b): ids of class representatives whose sketches are within the radius. ``reps``: rep long, short, bands, sketch."""
    rows = reps.select("rep", "short", F.explode("bands").alias("key"), F.substring("sketch", 1, SHORT_BITS // 8).alias("sketch"))
    marked = _with_chunks(rows, tile)
    plain = marked.where(F.col("hot").isNull()).select("key", F.lit(-1).alias("tile"), F.lit(0).alias("part"), F.col("rep").alias("page"), "sketch")
    own = marked.where(F.col("hot").isNotNull()).withColumn("part", F.pmod(F.xxhash64(F.col("rep"), F.lit(3)), F.col("chunks")).cast("int"))
    # the tile of a chunk with itself, and those with each other chunk
    inside = own.select("key", (-2 - F.col("part")).alias("tile"), "part", F.col("rep").alias("page"), "sketch")
    across = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("other <> part")
    number = F.least("part", "other") * F.col("chunks") + F.greatest("part", "other")
    across = across.select("key", number.cast("int").alias("tile"), "part", F.col("rep").alias("page"), "sketch")
    dealt = plain.unionByName(inside).unionByName(across).repartition("key", "tile").sortWithinPartitions("key", "tile")
    limit = radius(SHORT_BITS, threshold)
    pairs = dealt.mapInArrow(lambda b: _compare_buckets(b, limit), "a long, b long").distinct()
    bits = reps.select("rep", "short", "sketch")
    left, right = bits.select(F.col("rep").alias("a"), "short", F.col("sketch").alias("sa")), bits.select(F.col("rep").alias("b"), "short", F.col("sketch").alias("sb"))
    pairs = pairs.join(left, "a").join(right, ["b", "short"])
    long_limit = radius(LONG_BITS, threshold)

    def refine(batches):
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                near = pa.array(pairs_within(left, right, long_limit))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(refine, "a long, b long").distinct()


def _sends(pairs: DataFrame) -> DataFrame:
    """(id, to): where each set is sent, at most about PARTNERS places a row. The pairs of one ``a`` are compared in parts of about PARTNERS, so a hub is nowhere gathered."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    parts = cut(parts.withColumn("rows", F.col("parts") * PARTNERS))
    dealt = join_counted(pairs, parts, ["a"], "rows").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    sent = dealt.select(F.col("b").alias("id"), "a", "part").unionByName(parts.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    rows = cut(sent.groupBy("id").agg(F.count("*").alias("rows")))
    every = join_counted(sent, rows, ["id"], "rows").withColumn("slot", F.pmod(F.xxhash64("a", "part"), F.ceil(F.col("rows") / PARTNERS)))
    return every.groupBy("id", "slot").agg(F.collect_list(F.struct("a", "part")).alias("to")).drop("slot")


def verified_pairs(texts: DataFrame, names: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity): candidate pairs whose sets have at least the threshold's similarity. ``names``: rep, name."""
    named = cut(_sends(pairs).join(names.select(F.col("rep").alias("id"), "name"), "id"))
    few = named.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS and pairs.limit(4 * BROADCAST_IDS + 1).count() <= 4 * BROADCAST_IDS
    hint = F.broadcast if few else (lambda x: x)
    rows = texts.join(hint(named), texts["page"] == named["name"]).select("id", "to", "text")

    def sets(batches):
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, kinds)], names=["key", "part", "source", "blob"])

        for batch in batches:
            ids, to, body = (c.to_pylist() for c in batch.columns)
            for lo, hi in _groups(body):
                held = []
                for i, places, s in zip(ids[lo:hi], to[lo:hi], shingle_sets(body[lo:hi])):
                    blob = s.tobytes()
                    for place in places:
                        held.append((place["a"], place["part"], i, blob))
                        if len(held) > 2000:
                            yield packed(held)
                            held = []
                yield packed(held)

    def compare(batches):
        own_key, own = None, None
        for batch in batches:
            out = ([], [], [])
            for key, part, _, source, blob in zip(*(c.to_pylist() for c in batch.columns)):
                other = np.frombuffer(blob, dtype=np.uint64)
                if key == source:
                    own_key, own = (key, part), other
                elif own_key == (key, part):
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    similarity = both / (len(own) + len(other) - both)
                    if similarity >= threshold:
                        for c, v in zip(out, (source, key, similarity)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["a", "b", "similarity"])

    sent = rows.mapInArrow(sets, "key long, part int, source long, blob binary").select("key", "part", (F.col("key") != F.col("source")).cast("int").alias("turn"), "source", "blob")
    return sent.repartition("key", "part").sortWithinPartitions("key", "part", "turn").mapInArrow(compare, "a long, b long, similarity double").distinct()


def _links(pages: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: page, rep; classes: rep, name, copies; links between classes: a, b, similarity)."""
    every = cut(sketches(pages, id_col, text_col, threshold))
    members = every.select("digest", "page").distinct()
    classes = members.groupBy("digest").agg(F.min("page").alias("name"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))  # unique, and fixed by the checkpoint
    sorts = every.groupBy("digest", "short").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    reps = cut(sorts.join(classes.select("digest", "rep"), "digest").drop("digest"))
    pairs = cut(candidate_pairs(reps, threshold))
    links = verified_pairs(_texts(pages, id_col, text_col), classes, pairs, threshold)
    members = join_counted(members, classes.select("digest", "rep", "copies"), ["digest"], "copies").select("page", "rep")
    return members, classes.drop("digest"), links


def near_duplicate_pairs(pages: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(page_a, page_b; a < b): all pairs of records with at least the threshold's similarity, copies expanded."""
    members, classes, links = _links(pages, id_col, text_col, threshold)
    members, links = cut(members), cut(links)
    left = members.select(F.col("page").alias("x"), F.col("rep").alias("a"))
    right = members.select(F.col("page").alias("y"), F.col("rep").alias("b"))
    across = links.select("a", "b").join(left, "a").join(right, "b").select(F.least("x", "y").alias("page_a"), F.greatest("x", "y").alias("page_b"))
    # the copies of a class are paired in parts: one side dealt out, the other sent to every part
    copied = classes.where("copies > 1").select("rep", "copies", F.ceil(F.col("copies") / PARTNERS).cast("int").alias("parts"))
    same = join_counted(members, copied, ["rep"], "copies")
    dealt = same.select("rep", F.pmod(F.xxhash64("page"), F.col("parts")).cast("int").alias("part"), F.col("page").alias("page_a"))
    sent = same.select("rep", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("page").alias("page_b"))
    within = dealt.join(sent, ["rep", "part"]).where("page_a < page_b").select("page_a", "page_b")
    return across.unionByName(within)


def near_duplicate_groups(pages: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(page, group_id, n_links): one row per record; connected records share the least page of their group; n_links counts the links of
    its class to other classes."""
    members, classes, links = _links(pages, id_col, text_col, threshold)
    links = cut(links.select("a", "b"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("n_links"))
    known = classes.join(degree.withColumnRenamed("a", "rep"), "rep", "left").join(cut(components(links)), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    groups = cut(known.groupBy("label").agg(F.min("name").alias("group_id"), F.count("*").alias("rows")))
    known = cut(join_counted(known, groups, ["label"], "rows").select("rep", "copies", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return join_counted(members, known, ["rep"], "copies").select("page", "group_id", "n_links")


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the least id of each connected component, by alternating large-star and small-star rounds."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        small = cut(small)
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.groupBy(F.col("u").alias("rep")).agg(F.min("v").alias("label")).unionByName(small.select(F.col("v").alias("rep"), F.col("v").alias("label")).distinct())
        edges = small
