"""Long exact spans shared between records.

Method: super-k-mer partitioning. The minimiser of a window of ``k`` characters is the least of the mixed hashes of its ``m``-character parts;
consecutive windows with the same minimiser form a super-k-mer. A narrow pass first keeps the minimisers that occur in two records at
all; only their super-k-mers travel, as one packed string each, to the bucket of their minimiser. Equal packed strings are merged on the
way (whole super-k-mers of copied passages fold into one row), and within a bucket the windows of the strings left are sorted and
counted, equal hashes being compared character by character. A bucket with more than ``HOT_STRINGS`` different strings is not gathered
in one task: its strings are cut again by a second minimiser, of another order, and travel to the buckets of both, at most ``LEVELS`` times; the comparison is the same in all buckets.
Keys that hold many rows (a minimiser, a copied string) are joined by broadcast instead of meeting in one task.

Positions are code points; nothing is normalised. Defined results: null and short texts share nothing; a passage repeated
within one record only is not shared; repeated rows of a record id are one record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import join_counted
from leafmill.session import cut, spread

K, M = 250, 80
#: A bucket with more different strings than this is cut again, so many times at most.
HOT_STRINGS, LEVELS = 20_000, 3
#: Code points that are hashed at once.
CHUNK = 1_000_000

_B = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 65536)
        _POWERS[:] = []
        for base in (_B, pow(_B, -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def part_hashes(points: np.ndarray, length: int) -> np.ndarray:
    """Hash of every stretch of ``length`` code points."""
    n = len(points)
    if n < length:
        return np.empty(0, dtype=np.uint64)
    power, inverse = _powers(n)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_mixed((points.astype(np.uint64) + np.uint64(1)) * np.uint64(_B)) * power, out=total[1:])
    return _mixed((total[length:] - total[: n - length + 1]) * inverse[: n - length + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of ``width`` values."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def super_kmers(points: list[np.ndarray], k: int = K, m: int = M, order: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, first window, number of windows, minimiser) of every super-k-mer of several texts. Different orders of the parts give different minimisers."""
    sizes = np.array([len(p) for p in points])
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    whole = np.concatenate(points)
    hashes = part_hashes(whole, m)
    least = sliding_min(_mixed(hashes + np.uint64(order) * np.uint64(_B)) if order else hashes, k - m + 1)
    ends = offsets + np.maximum(sizes - k + 1, 0)
    marks = np.zeros(len(whole) + 1, dtype=np.int32)
    np.add.at(marks, offsets, 1)
    np.add.at(marks, ends, -1)
    inside = np.cumsum(marks[: len(least)]) > 0
    fresh = inside.copy()
    fresh[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    fresh[offsets[(offsets < len(least)) & (ends > offsets)]] = True
    starts = np.flatnonzero(fresh)
    text = np.searchsorted(offsets, starts, side="right") - 1
    after = np.append(starts[1:], len(whole))
    return text, starts - offsets[text], np.minimum(after, ends[text]) - starts, least[starts].view(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _chunks(ids: list, texts: list, k: int):
    """Texts of at least ``k`` code points, in groups of about CHUNK code points."""
    group, size = [], 0
    for i, t in zip(ids, texts):
        if t is not None and len(t) >= k:
            group.append((i, t))
            size += len(t)
            if size >= CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


def _narrow(docs: DataFrame, k: int, m: int) -> DataFrame:
    """(doc, start, n, mini): where the super-k-mers are."""

    def run(batches):
        for batch in batches:
            for group in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist(), k):
                text, start, n, mini = super_kmers([_points(t) for _, t in group], k, m)
                ids = np.array([i for i, _ in group], dtype=np.int64)[text]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(mini)], names=["doc", "start", "n", "mini"])

    return docs.mapInArrow(run, "doc long, start int, n int, mini long")


def _cut_strings(batches, k: int):
    names = ["mini", "digest", "packed", "doc", "start"]
    for batch in batches:
        cols: tuple[list, ...] = ([], [], [], [], [])
        for doc, text, parts in zip(*(c.to_pylist() for c in batch.columns)):
            for part in parts:
                packed = text[part["start"] : part["start"] + part["n"] + k - 1]
                for c, v in zip(cols, (part["mini"], xxhash.xxh3_128_digest(packed.encode("utf-8", "surrogatepass")), packed, doc, part["start"])):
                    c.append(v)
        kinds = (pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def shared_windows(packed: list[str], low: list[int], high: list[int], group: np.ndarray, k: int = K) -> list[list[tuple[int, int]]]:
    """For each packed string the ranges (first, end) of its windows that stand in two records, within groups of equal minimiser.

    Windows are sorted by (group, hash); equal hashes count as equal only after their characters were compared.
    """
    points = [_points(s) for s in packed]
    sizes = np.array([len(p) for p in points])
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    hashes = part_hashes(np.concatenate(points), k)
    counts = sizes - k + 1
    owner = np.repeat(np.arange(len(packed)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    value = hashes[offsets[owner] + within]
    order = np.lexsort((owner, value, group[owner]))
    v, g = value[order], group[owner][order]
    first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (g[1:] != g[:-1])]))
    lo, hi = np.array(low)[owner][order], np.array(high)[owner][order]
    both = np.minimum.reduceat(lo, first) < np.maximum.reduceat(hi, first)
    sizes_of_runs = np.diff(np.append(first, len(v)))
    shared = np.zeros(len(v), dtype=bool)
    shared[order] = np.repeat(both, sizes_of_runs)
    model = np.empty(len(v), dtype=np.int64)
    model[order] = np.repeat(order[first], sizes_of_runs)
    out: list[list[tuple[int, int]]] = [[] for _ in packed]
    if not shared.any():
        return out
    flat = np.flatnonzero(shared)
    # a stretch of windows whose models also follow each other in one string is compared at once
    fresh = np.concatenate([[True], (np.diff(flat) != 1) | (owner[flat[1:]] != owner[flat[:-1]]) | (np.diff(model[flat]) != 1) | (owner[model[flat[1:]]] != owner[model[flat[:-1]]])])
    begin = np.flatnonzero(fresh)
    stop = np.append(begin[1:], len(flat))
    exact = True
    for b, e in zip(begin, stop):
        i, j, n = flat[b], model[flat[b]], e - b
        s, a, t, c = packed[owner[i]], int(within[i]), packed[owner[j]], int(within[j])
        if s[a : a + n + k - 1] != t[c : c + n + k - 1]:
            exact = False
            break
        spans = out[owner[i]]
        if spans and spans[-1][1] == a:
            spans[-1] = (spans[-1][0], a + int(n))
        else:
            spans.append((a, a + int(n)))
    return out if exact else _by_characters(packed, low, high, group, k)


def _by_characters(packed: list[str], low: list[int], high: list[int], group: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """The same by the windows' characters alone, for the case that two different windows have one hash."""
    seen: dict = {}
    for s, lo, hi, g in zip(packed, low, high, group.tolist()):
        for i in range(len(s) - k + 1):
            key = (g, s[i : i + k])
            a, b = seen.get(key, (lo, hi))
            seen[key] = (min(a, lo), max(b, hi))
    out: list[list[tuple[int, int]]] = []
    for s, g in zip(packed, group.tolist()):
        spans: list[tuple[int, int]] = []
        for i in range(len(s) - k + 1):
            a, b = seen[(g, s[i : i + k])]
            if a < b:
                if spans and spans[-1][1] == i:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i, i + 1))
        out.append(spans)
    return out


def _count_buckets(batches, k: int):
    """Sorted rows (key, digest, at, packed, low, high) to the shared window ranges of each string, counted from ``at``."""
    kept: list[tuple] = []

    def flush(rows):
        keys = [r[0] for r in rows]
        group = np.concatenate([[0], np.cumsum([a != b for a, b in zip(keys, keys[1:])])]).astype(np.int64)
        alone = np.bincount(group)[group] == 1
        rows = [r for r, x in zip(rows, alone) if not x]
        digests, firsts, ends = [], [], []
        if rows:
            spans = shared_windows([r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows], group[~alone], k)
            for r, own in zip(rows, spans):
                for a, b in own:
                    digests.append(r[1])
                    firsts.append(r[2] + a)
                    ends.append(r[2] + b)
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(firsts, pa.int32()), pa.array(ends, pa.int32())], names=["digest", "a", "b"])

    for batch in batches:
        kept.extend(zip(*(c.to_pylist() for c in batch.columns)))
        if len(kept) >= 5000:
            last, at = kept[-1][0], len(kept)
            while at and kept[at - 1][0] == last:
                at -= 1
            if at:
                yield flush(kept[:at])
                kept = kept[at:]
    if kept:
        yield flush(kept)


def _cut_again(batches, k: int, m: int, order: int):
    """Strings cut by the minimiser of another order; the key takes both."""
    names = ["key", "digest", "at", "packed", "low", "high"]
    kinds = (pa.string(), pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        if rows:
            for i, start, n, mini in zip(*(x.tolist() for x in super_kmers([_points(r[3]) for r in rows], k, m, order))):
                key, digest, at, packed, low, high = rows[i]
                for c, v in zip(cols, (f"{key} {mini}", digest, at + start, packed[start : start + n + k - 1], low, high)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)


def _bucket_sizes(strings: DataFrame) -> DataFrame:
    """(key, c): the buckets in which a comparison can find something, with their numbers of strings."""
    sizes = strings.groupBy("key").agg(F.count("*").alias("c"), F.max(F.col("low") == F.col("high")).alias("open"))
    return cut(sizes.where("c > 1 and open").select("key", "c"))


def shared_spans(docs: DataFrame, id_col: str, text_col: str, k: int = K, m: int = M, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(doc, span_start, span_end): maximal runs of characters that lie in a stretch of ``k`` or more also found in another record."""
    texts = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(text_col) >= k))
    texts = texts.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    where = _narrow(spread(texts), k, m)
    common = where.groupBy("mini").agg(F.min("doc").alias("x"), F.max("doc").alias("y"), F.count("*").alias("rows")).where("x < y")
    parts = join_counted(where, cut(common.select("mini", "rows")), ["mini"], "rows").groupBy("doc").agg(F.collect_list(F.struct("mini", "start", "n")).alias("parts"))
    cut_out = texts.join(parts, "doc").select("doc", "text", "parts").mapInArrow(lambda b: _cut_strings(b, k), "mini long, digest binary, packed string, doc long, start int")
    members = cut(cut_out)
    strings = members.groupBy("digest").agg(F.first("mini").alias("mini"), F.first("packed").alias("packed"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("copies"))
    strings = cut(strings)
    ranges = strings.where("low < high").select("digest", F.lit(0).alias("a"), (F.length("packed") - (k - 1)).alias("b"))
    rows = strings.select(F.col("mini").cast("string").alias("key"), "digest", F.lit(0).alias("at"), "packed", "low", "high")
    for level in range(1, LEVELS + 1):
        sizes = _bucket_sizes(rows)
        open_rows = join_counted(rows, sizes, ["key"], "c")
        cold = (open_rows.where(F.col("c") <= hot_strings) if level < LEVELS else open_rows).select("key", "digest", "at", "packed", "low", "high")
        ranges = ranges.unionByName(cold.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _count_buckets(b, k), "digest binary, a int, b int"))
        if level == LEVELS or sizes.where(F.col("c") > hot_strings).isEmpty():
            break
        hot = open_rows.where(F.col("c") > hot_strings).select("key", "digest", "at", "packed", "low", "high")
        rows = cut(hot.mapInArrow(lambda b, order=level: _cut_again(b, k, m, order), "key string, digest binary, at int, packed string, low long, high long"))
    by_string = ranges.groupBy("digest").agg(F.collect_set(F.struct("a", "b")).alias("own"))  # one string's windows
    by_string = cut(by_string.join(strings.select("digest", "copies"), "digest"))
    spans = join_counted(members.select("digest", "doc", "start"), by_string, ["digest"], "copies").select("doc", "start", F.explode("own").alias("o"))
    spans = spans.select("doc", (F.col("start") + F.col("o.a")).alias("s"), (F.col("start") + F.col("o.b") + (k - 1)).alias("e")).distinct()
    before = Window.partitionBy("doc").orderBy("s", "e")
    reach = F.max("e").over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", F.when(F.col("s") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc", "run").agg(F.min("s").cast("int").alias("span_start"), F.max("e").cast("int").alias("span_end")).drop("run")


def shared_report(docs: DataFrame, id_col: str, text_col: str, k: int = K) -> DataFrame:
    """One row per record: its length, how many of its characters are shared elsewhere, in how many spans, and the share."""
    spans = shared_spans(docs, id_col, text_col, k)
    sums = spans.groupBy("doc").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"), F.count("*").alias("n_spans"))
    sizes = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).agg(F.max(F.coalesce(F.length(text_col), F.lit(0))).alias("n_chars"))
    out = sizes.join(sums, "doc", "left").na.fill(0, ["shared_chars", "n_spans"])
    return out.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))
