"""Near copies with small edits: MinHash banding over the whole collection, verified on the full sets (problem 3).

1. Each text becomes its set of features (distinct words, or shingles of words), as sorted 64-bit hashes.
2. Records with the same set are one class; the class with its smallest id goes on, so that copies, however many,
   meet each other nowhere.
3. A class has b * r MinHash values; each r of them are hashed into a band.  ``plan_bands`` takes the largest r for
   which b bands still find a pair at the threshold with the wanted recall: large r keep unlike texts apart.
4. Each band value is shuffled once, with the sketch of its class, and read in order: classes with one in common are
   candidates if their sizes allow the threshold.  They are compared right there by sketches of 512 bits with a margin of
   five standard deviations, so that candidates, whose number grows faster than the data, are written nowhere.  A band
   value with many classes is split into chunks, and each two chunks meet in a task of their own.
5. The few that are left are compared on their full sets: the result has no false pair.

The bands are worked through in passes, each of which shuffles about as many bytes as the sets have; the files of a pass
are deleted after it, so that the disk holds the sets and a pass or two, however many bands there are.

No side of a join is broadcast: all grow with the data, and an array counts as one element where its size is estimated.
"""

from __future__ import annotations

import html
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import checkpointed, delete, large, release, scratch

TAG = regex.compile(r"<[^<>]*>")
#: What stands between these marks is no text.
HIDDEN = tuple(tuple(regex.compile(x, regex.I) for x in pair) for pair in (("<!--", "-->"), ("<script", "</script"), ("<style", "</style")))
WORD = regex.compile(r"[\p{L}\p{N}]+")
#: MinHash values a text may cost.
MAX_HASHES = 1200
#: Classes of one band value that a task holds; of values with more, each two chunks of so many meet in a task.
CHUNK = 8192
#: Likely pairs that a task gathers before it puts them out.
GATHERED = 500_000
#: Members of a class that are joined under one key.
MEMBERS = 1000
#: A sketch: one bit of each of so many MinHash values, in columns of 64.
LONGS = 8
BITS, SKETCH = 64 * LONGS, [f"s{k}" for k in range(LONGS)]
#: Bytes that a band value takes in a shuffle, with number, size and sketch; bytes that a pass may shuffle at least.
ENTRY, PASS_BYTES = 24 + 8 * LONGS, 64_000_000


def plan_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows a band within ``max_hashes``, finding a pair at ``threshold`` with ``recall``."""
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall within max_hashes")
    return best


def _shown(text: str) -> str:
    """The text without comments, scripts and styles; in one pass for each kind."""
    for start, end in HIDDEN:
        out, at = [], 0
        while (i := start.search(text, at)) and (j := end.search(text, i.end())):
            out += [text[at : i.start()], " "]
            at = j.end()
        text = "".join(out) + text[at:]
    return text


def words(text: str | None) -> list[str]:
    """Runs of letters or digits, lower-cased; mark-up is a space, entities are decoded."""
    if not text:
        return []
    if "<" in text:
        text = TAG.sub(" ", _shown(text))
    if "&" in text:
        text = html.unescape(text)
    return WORD.findall(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(found: list[str], seen: dict[str, int]) -> np.ndarray:
    import xxhash

    out = np.empty(len(found), np.uint64)
    for i, w in enumerate(found):
        h = seen.get(w)
        if h is None:
            if len(seen) > 500_000:
                seen.clear()
            h = seen[w] = xxhash.xxh3_64_intdigest(w)
        out[i] = h
    return out


def features(main: str | None, more: str | None, shingle: int, min_words: int, seen: dict[str, int]) -> np.ndarray | None:
    """The sorted distinct feature hashes of a record; null where ``main`` has fewer than ``min_words`` words."""
    body = words(main)
    if len(body) < max(1, min_words):
        return None
    h = _hash_words(words(more) + body, seen)
    if shingle > 1:
        if len(h) < shingle:
            return None
        n = len(h) - shingle + 1
        x = np.zeros(n, np.uint64)
        for k in range(shingle):
            x = _mix(x * np.uint64(31) + h[k : k + n])
        h = x
    return np.unique(h)


class MinHash:
    """Band values and sketches; the same for the same arguments, everywhere."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(20240607)
        n = max(bands * rows, BITS)
        # 32 bits are multiplied several times as fast; a text's least values lie far enough apart in them
        self.a = rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, n, dtype=np.uint32)

    def values(self, flat: np.ndarray, starts: np.ndarray, first: int, end: int) -> np.ndarray:
        """A row for each of the values ``first`` to ``end``, a column for each set; the sets, none empty, begin at ``starts``."""
        x, out = (flat >> np.uint64(32)).astype(np.uint32), np.empty((end - first, len(starts)), np.uint32)
        made = np.empty_like(x)
        for row, a, b in zip(out, self.a[first:end], self.b[first:end]):
            np.multiply(x, a, out=made)
            made += b
            np.minimum.reduceat(made, starts, out=row)
        return _mix(out.astype(np.uint64))

    def sketches(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row for each set."""
        odd = (self.values(flat, starts, 0, BITS) & np.uint64(1)).astype(np.uint8)
        return np.packbits(np.ascontiguousarray(odd.T), axis=1).view(np.int64)

    def band_values(self, flat: np.ndarray, starts: np.ndarray, first: int, end: int) -> np.ndarray:
        """A row for each set: its values of the bands ``first`` to ``end``."""
        v = self.values(flat, starts, first * self.rows, end * self.rows).reshape(end - first, self.rows, len(starts))
        band = np.repeat(np.arange(first, end, dtype=np.uint64)[:, None], len(starts), axis=1)
        for k in range(self.rows):
            band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + v[:, k])
        return np.ascontiguousarray(band.T).view(np.int64)


def _sets(df: DataFrame, id_col: str, main: str, more: str | None, shingle: int, min_words: int) -> DataFrame:
    """(id, feats) of the records that have enough words."""
    src = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(main).alias("main"), (F.col(more) if more else F.lit(None)).cast("string").alias("more"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for b in batches:
            for at in range(0, len(b), 2000):
                ids, sets = [], []
                for i, m, o in zip(*(b.column(c).slice(at, 2000).to_pylist() for c in range(3))):
                    if (x := features(m, o, shingle, min_words, seen)) is not None:
                        ids.append(i)
                        sets.append(x.view(np.int64))
                sizes = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))], names=["id", "feats"])

    return src.mapInArrow(run, "id string, feats array<bigint>")


def linked(df: DataFrame, id_col: str, main: str, more: str | None, shingle: int, min_words: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(members: id, class_id, several) and (links: class_a, class_b): records with equal feature sets share a class, and
    classes with class_a < class_b are linked where the Jaccard similarity of the full sets is >= ``threshold``.
    ``several`` tells ids with records in several classes.

    A class is named by the 128-bit hash of its set, so naming it needs no gathering of its members."""
    spark = df.sparkSession
    hasher = MinHash(*plan_bands(threshold, recall))
    name = F.concat(F.hex(F.xxhash64("feats")), F.hex(F.xxhash64(F.reverse("feats"), F.lit(1)))).alias("class_id")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, starts in _in_parts(batches, 1):
            sketches = hasher.sketches(flat, starts)
            yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(np.ascontiguousarray(sketches[:, k])) for k in range(LONGS)]], names=["class_id", "feats", *SKETCH])

    with scratch(spark, "near_dup") as at:
        _sets(df, id_col, main, more, shingle, min_words).select("id", name, "feats").write.parquet(f"{at}/records", compression="zstd")
        records = spark.read.parquet(f"{at}/records")
        members = records.select("id", "class_id").distinct()
        members = checkpointed(members.withColumn("several", F.count("*").over(Window.partitionBy("id")) > 1))
        distinct = records.groupBy("class_id").agg(F.first("feats").alias("feats")).mapInArrow(sketched, f"class_id string, feats array<bigint>, {', '.join(f'{c} bigint' for c in SKETCH)}")
        distinct.withColumns({"num": F.xxhash64("class_id"), "n": F.size("feats")}).write.parquet(f"{at}/sets", compression="zstd")
        del records, distinct
        delete(spark, f"{at}/records")
        release(spark)
        links = checkpointed(_similar(spark.read.parquet(f"{at}/sets"), at, hasher, threshold))
    release(spark)
    return members, links


def _in_parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows at a time, with the sets of that column one after the other, and where each begins."""
    for b in batches:
        for at in range(0, len(b), 200):
            part = b.slice(at, 200)
            lists = part.column(column)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            yield part, lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.append(0, ends[:-1])


def plan_passes(bands: int, classes: int, features: int) -> list[tuple[int, int]]:
    """First and end of the bands of each pass: none shuffles much more than ``PASS_BYTES`` or than the sets have."""
    most = max(PASS_BYTES, 8 * features)
    n = min(bands, max(1, math.ceil(bands * classes * ENTRY / most)))
    cuts = [bands * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def _similar(sets: DataFrame, at: str, hasher: MinHash, threshold: float) -> DataFrame:
    """(class_a, class_b) of ``sets`` (class_id, num, n, feats and sketch); what is needed meanwhile is written to ``at``."""
    spark = sets.sparkSession
    count = sets.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    sketches = sets.select("num", "n", *SKETCH)
    likely = None
    for k, (first, end) in enumerate(plan_passes(hasher.bands, *count)):
        _meet(_banded(sets, hasher, first, end), threshold).write.parquet(f"{at}/met{k}", compression="zstd")
        met = spark.read.parquet(f"{at}/met{k}")
        pairs = met.where("hot_band is null").select("num_a", "num_b")
        hot = met.where("hot_band is not null").select("hot_band", "num_a")
        if not hot.isEmpty():  # else its joins needn't be planned
            pairs = pairs.unionByName(_meet_hot(hot, sketches, threshold))
        if k:
            pairs = pairs.unionByName(likely)
        pairs.distinct().write.parquet(f"{at}/likely{k}", compression="zstd")
        likely = spark.read.parquet(f"{at}/likely{k}")
        del met, pairs, hot
        delete(spark, f"{at}/met{k}", f"{at}/likely{k - 1}")
        release(spark)
    full = lambda s: sets.select(F.col("num").alias(f"num_{s}"), F.col("class_id").alias(f"name_{s}"), F.col("n").alias(f"size_{s}"), F.col("feats").alias(f"feats_{s}"))
    both = large(large(likely).join(full("a"), "num_a")).join(full("b"), "num_b").withColumn("common", F.size(F.array_intersect("feats_a", "feats_b")))
    similarity = F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))
    return both.where(similarity >= threshold).select(F.least("name_a", "name_b").alias("class_a"), F.greatest("name_a", "name_b").alias("class_b"))


def _banded(sets: DataFrame, hasher: MinHash, first: int, end: int) -> DataFrame:
    """(band, num, n and sketch) of each class and each of the bands ``first`` to ``end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, starts in _in_parts(batches, 0):
            values = hasher.band_values(flat, starts, first, end)
            ends = pa.array(np.arange(0, values.size + 1, end - first, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(values.ravel())), *part.columns[1:]], names=["bands", "num", "n", *SKETCH])

    longs = ", ".join(f"{c} bigint" for c in SKETCH)
    hashed = sets.select("feats", "num", "n", *SKETCH).mapInArrow(run, f"bands array<bigint>, num bigint, n int, {longs}")
    return hashed.select(F.explode("bands").alias("band"), "num", "n", *SKETCH)


def _least_bits(threshold: float) -> float:
    """Equal bits that a pair at the threshold has but for five standard deviations; unequal values agree in half of them."""
    p = (1 + threshold) / 2
    return BITS * p - 5 * math.sqrt(BITS * p * (1 - p))


_MET = "num_a bigint, num_b bigint, hot_band bigint"


def _meet(banded: DataFrame, threshold: float) -> DataFrame:
    """(num_a, num_b) of classes that share a band value and whose sizes, and sketches if there are any, allow the threshold,
    repeated for such values; of values with more than ``CHUNK`` classes, (num_a, hot_band) for each class instead.

    The one shuffle of band values; each task reads its values in order and holds at most ``CHUNK`` classes."""
    sketch = [c for c in SKETCH if c in banded.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the classes of the last value, which may go on
        kept = *(np.empty(0, np.int64) for _ in range(3)), np.empty((0, len(sketch)), np.int64)
        hot = None
        for b in batches:
            band, num, n = (np.concatenate([k, b.column(c).to_numpy()]) for c, k in enumerate(kept[:3]))
            own = np.stack([b.column(c).to_numpy() for c in sketch], axis=1) if sketch else np.empty((len(b), 0), np.int64)
            bits = np.concatenate([kept[3], own])
            if len(band) == 0:
                continue
            starts = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
            counts = np.diff(np.append(starts, len(band)))
            if hot is not None and band[0] != hot:
                hot = None
            is_hot = counts > CHUNK
            if hot is not None:
                is_hot[0] = True
            if is_hot[-1]:  # its classes need not be kept
                hot, last = band[-1], len(band)
            else:
                last = starts[-1]
            kept = band[last:], num[last:], n[last:], bits[last:]
            hot_rows = np.repeat(is_hot, counts)[:last]
            yield from _met(num[:last][hot_rows], None, band[:last][hot_rows])
            cool = ~hot_rows
            yield from _pairs_of(band[:last][cool], num[:last][cool], n[:last][cool], bits[:last][cool], threshold)
        yield from _pairs_of(*kept, threshold)

    return banded.select("band", "num", "n", *sketch).repartition("band").sortWithinPartitions("band", "n").mapInArrow(run, _MET)


def _met(a: np.ndarray, b: np.ndarray | None, hot: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if len(a):
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a), none if b is None else pa.array(b), none if hot is None else pa.array(hot)], names=["num_a", "num_b", "hot_band"])


def _pairs_of(band: np.ndarray, num: np.ndarray, n: np.ndarray, bits: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs within each band value; rows are in the order of value and size."""
    left, d, found, least = np.arange(len(band) - 1), 1, [], _least_bits(threshold)
    bits = bits.view(np.uint64)
    while len(left):
        left = left[: np.searchsorted(left, len(band) - d)]
        left = left[(band[left] == band[left + d]) & (n[left] >= threshold * n[left + d])]  # sizes only grow apart
        likely = left
        if bits.shape[1]:
            likely = left[BITS - np.bitwise_count(bits[left] ^ bits[left + d]).sum(axis=1, dtype=np.int32) >= least]
        a, b = num[likely], num[likely + d]
        found.append((np.minimum(a, b), np.maximum(a, b)))
        d += 1
        if d % 64 == 0 and sum(len(x) for x, _ in found) > GATHERED:
            yield from _once(found)
            found = []
    if found:
        yield from _once(found)


def _once(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Each of the pairs once, without those of a class and itself."""
    pairs = np.stack([np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])])
    pairs = pairs[:, np.lexsort(pairs)]
    first = np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))[: pairs.shape[1]] & (pairs[0] != pairs[1])
    yield from _met(pairs[0][first], pairs[1][first], None)


def _meet_hot(hot: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """(num_a, num_b) of classes of one hot band value (hot_band, num_a) whose sizes and sketches allow the threshold.

    The classes of a value are split into chunks and each two chunks meet in a task of their own, which puts out only the
    pairs that the sketches let pass: neither are all pairs made anywhere, nor is a value gathered in one task."""
    sizes = hot.groupBy("hot_band").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    rows = large(hot.withColumnRenamed("num_a", "num")).join(sizes, "hot_band")
    rows = large(rows).join(sketches, "num").withColumn("chunk", F.pmod(F.xxhash64("num", "hot_band"), F.col("chunks")).cast("int"))
    # a class of chunk c meets the pairs (min(c, d), max(c, d)) for every d
    rows = rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("hot_band", F.least("chunk", "d").alias("lo"), F.greatest("chunk", "d").alias("hi"), "chunk", "num", "n", *SKETCH)
    least = _least_bits(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def meet(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """The rows of one pair of chunks: two chunks of some ``CHUNK`` rows each."""
            x = np.concatenate(parts)
            x = x[np.argsort(x[:, 5], kind="stable")]
            step = max(1, 2**17 // len(x))
            for at in range(0, len(x), step):
                own, end = x[at : at + step], np.searchsorted(x[:, 5], x[at : at + step][-1, 5] / threshold + 1, "right")
                other = x[at + 1 : end]
                same = BITS - np.bitwise_count((own[:, None, 6:] ^ other[None, :, 6:]).view(np.uint64)).sum(axis=2, dtype=np.int32)
                fits = (same >= least) & (own[:, None, 5] >= threshold * other[None, :, 5]) & (np.arange(len(own))[:, None] <= np.arange(len(other))[None, :])
                fits &= (own[:, None, 1] == own[:, None, 2]) | (own[:, None, 3] != other[None, :, 3])  # of unlike chunks, each with the other
                i, j = np.nonzero(fits)
                a, b = own[i, 4], other[j, 4]
                yield from _two(np.minimum(a, b), np.maximum(a, b))

        key, parts = None, []
        for b in batches:
            x = np.stack([b.column(c).cast(pa.int64()).to_numpy() for c in range(6 + LONGS)], axis=1)
            if not len(x):
                continue
            starts = np.flatnonzero(np.append(True, (x[1:, :3] != x[:-1, :3]).any(axis=1)))
            for s, e in zip(starts, [*starts[1:], len(x)]):
                if (own := tuple(x[s, :3])) != key:
                    if parts:
                        yield from meet(parts)
                    key, parts = own, []
                parts.append(x[s:e])
        if parts:
            yield from meet(parts)

    return rows.repartition("hot_band", "lo", "hi").sortWithinPartitions("hot_band", "lo", "hi").mapInArrow(run, "num_a bigint, num_b bigint")


def _two(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["num_a", "num_b"])


def near_duplicate_pairs(df: DataFrame, id_col: str, main: str, more: str | None = None, shingle: int = 5, min_words: int = 1, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every two different ids with records at least ``threshold`` alike.

    Copies count as alike (1.0) and are expanded here; ``near_duplicate_groups`` keeps them as one class.  The members of
    a large class come in chunks, and each two chunks meet under a key of their own.  An id with several different texts
    is alike where any of them is.  Records with a null id, or whose ``main`` is null, empty or has fewer than
    ``min_words`` words, are in no pair; ``more`` may be null."""
    members, links = linked(df, id_col, main, more, shingle, min_words, threshold, recall)
    sizes = members.groupBy("class_id").agg(F.count("*").alias("m")).where("m > 1")
    sides = links.select("class_a", "class_b", F.lit(True).alias("two")).unionByName(sizes.select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b"), F.lit(False).alias("two")))
    key, in_parts = ["class_id"], sizes.where(F.col("m") > MEMBERS).select("class_id", F.ceil(F.col("m") / MEMBERS).cast("int").alias("parts"))
    once = F.col("two") | (F.col("id_a") < F.col("id_b"))
    if not in_parts.isEmpty():
        key = ["class_id", "part"]
        of = lambda c: F.coalesce(F.col(c), F.lit(1))
        members = large(members).join(in_parts, "class_id", "left").select("id", "class_id", "several", F.pmod(F.xxhash64("id"), of("parts")).cast("int").alias("part"))
        for s in "ab":
            sides = large(sides).join(in_parts.select(F.col("class_id").alias(f"class_{s}"), F.col("parts").alias(f"parts_{s}")), f"class_{s}", "left")
            sides = sides.withColumn(f"part_{s}", F.explode(F.sequence(F.lit(0), of(f"parts_{s}") - 1)))
        sides = sides.where(F.col("two") | (F.col("part_a") <= F.col("part_b")))
        once |= F.col("part_a") < F.col("part_b")
    column = {"class_id": "class", "part": "part"}

    def expanded(a: DataFrame, b: DataFrame) -> DataFrame:
        pairs = sides
        for s, own in (("a", a), ("b", b)):
            pairs = large(pairs).join(own.select(*[F.col(k).alias(f"{column[k]}_{s}") for k in key], F.col("id").alias(f"id_{s}")), [f"{column[k]}_{s}" for k in key])
        return pairs.where(once & (F.col("id_a") != F.col("id_b"))).select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))

    several, one = members.where("several"), members.where("not several")
    pairs = expanded(one, one)  # ids of one class each meet once, and the result, which may be large, isn't shuffled
    if several.isEmpty():
        return pairs
    return pairs.unionByName(expanded(several, members).unionByName(expanded(one, several)).distinct())


def near_duplicate_groups(df: DataFrame, id_col: str, main: str, more: str | None = None, shingle: int = 5, min_words: int = 1, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(id, class_id, first_id, class_size, n_links): a row for each id and class, the smallest id and the number of the ids
    with that very set, and the number of other classes at least ``threshold`` alike.  Copies aren't expanded.  Nulls and
    short texts as above."""
    members, links = linked(df, id_col, main, more, shingle, min_words, threshold, recall)
    degree = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    size = members.groupBy("class_id").agg(F.count("*").alias("class_size"), F.min("id").alias("first_id"))
    about = large(size).join(degree, "class_id", "left")
    return large(members).join(about, "class_id").select("id", "class_id", "first_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
