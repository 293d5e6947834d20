"""Items that appear together more often than chance (problem 5).

Blocked Gram matrix: baskets are rows of a sparse binary matrix X over dense item numbers; each record block (an Arrow
batch of baskets) yields its own transpose-product, summed inside the block and by task before anything is emitted, and
Spark adds up the products.  Baskets of equal length form an integer matrix whose column pairs are counted without a
Python loop; long baskets are multiplied as dense item blocks, so no basket is ever expanded into rows.

Items below the smallest count a pair needs can be in no result pair, so they are left out of X; with a support that
is a share of the baskets this bounds the items by (mean basket size / share), whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import checkpointed

#: Baskets longer than this are multiplied as dense blocks of this many items.
LONG_BASKET, ITEM_BLOCK = 64, 256
#: Pair codes held at once before they are summed.
CODES = 1 << 20
#: An item dictionary of up to so many rows and bytes of text is broadcast; a larger one is joined by shuffling.
BROADCAST_ITEMS, BROADCAST_BYTES = 200_000, 16 << 20


def _add(total: dict, codes: np.ndarray) -> None:
    a, n = np.unique(codes, return_counts=True)
    total["a"].append(a)
    total["n"].append(n)
    total["held"] += len(a)


def _fold(total: dict) -> tuple[np.ndarray, np.ndarray]:
    if not total["a"]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, n = np.concatenate(total["a"]), np.concatenate(total["n"])
    keys, at = np.unique(a, return_inverse=True)
    sums = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
    total.update(a=[keys], n=[sums], held=len(keys))
    return keys, sums


def gram(flat: np.ndarray, starts: np.ndarray, total: dict) -> None:
    """Adds the pair counts of a record block to ``total``; a pair a < b has the code a * 2**31 + b.

    ``flat`` has the item numbers of the baskets, ascending and distinct inside each; ``starts`` where each begins."""
    sizes = np.diff(starts)
    for size in np.unique(sizes[(sizes > 1) & (sizes <= LONG_BASKET)]):
        rows = np.flatnonzero(sizes == size)
        left, right = np.triu_indices(size, 1)
        step = max(1, CODES // len(left))
        for at in range(0, len(rows), step):
            m = flat[starts[rows[at : at + step]][:, None] + np.arange(size)].astype(np.int64)
            _add(total, (m[:, left] * 2**31 + m[:, right]).ravel())
    long = np.flatnonzero(sizes > LONG_BASKET)
    for at in range(0, len(long), 512):
        rows = long[at : at + 512]
        items = np.unique(np.concatenate([flat[starts[r] : starts[r + 1]] for r in rows]))
        blocks = range(0, len(items), ITEM_BLOCK)

        def dense(block: int, items: np.ndarray = items, rows: np.ndarray = rows) -> np.ndarray:
            own = items[block : block + ITEM_BLOCK]
            x = np.zeros((len(rows), len(own)), np.float32)
            for i, r in enumerate(rows):
                x[i] = np.isin(own, flat[starts[r] : starts[r + 1]], assume_unique=True)
            return x

        for i in blocks:
            x = dense(i)
            for j in blocks:
                if j < i:
                    continue
                product = x.T @ (x if i == j else dense(j))
                if i == j:
                    product = np.triu(product, 1)
                a, b = np.nonzero(product)
                total["a"].append(items[i + a].astype(np.int64) * 2**31 + items[j + b])
                total["n"].append(product[a, b].astype(np.int64))
                total["held"] += len(a)


def cooccurring_pairs(baskets: DataFrame, rec: str, item: str, min_count: int = 3, min_share: float = 0.0, min_lift: float = 0.0) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift) with item_a < item_b by code point, of the long table ``baskets``.

    n is the number of records with any item; kept are the pairs with n_ab >= min_count, n_ab >= min_share * n and
    lift = n_ab * n / (n_a * n_b) >= min_lift (compared as whole numbers where the bounds are whole).  Null items and
    records are left out, repeated rows count once, a record with one item counts into n only."""
    long = baskets.select(F.col(rec).alias("rec"), F.col(item).alias("item")).where(F.col("rec").isNotNull() & F.col("item").isNotNull()).distinct()
    long = checkpointed(long)  # read for the totals, the item counts and the baskets
    n = long.select("rec").distinct().count()
    least = max(min_count, int(np.ceil(min_share * n - 1e-9)))
    counts = long.groupBy("item").agg(F.count("*").alias("n_item")).where(F.col("n_item") >= least)
    known, octets = counts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()
    small = known <= BROADCAST_ITEMS and octets <= BROADCAST_BYTES
    # numbered in the order of the code points, so that the order of two numbers is that of their items
    items = counts.withColumn("num", (F.row_number().over(Window.orderBy("item")) - 1).cast("int")) if small else _numbered(counts)
    looked_up = F.broadcast if small else lambda df: df.hint("merge")
    numbers = long.join(looked_up(items.select("item", "num")), "item").groupBy("rec").agg(F.sort_array(F.collect_list("num")).alias("items"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {"a": [], "n": [], "held": 0}

        def out() -> pa.RecordBatch:
            keys, sums = _fold(total)
            total.update(a=[], n=[], held=0)
            return pa.RecordBatch.from_arrays([pa.array((keys >> 31).astype(np.int32)), pa.array((keys & (2**31 - 1)).astype(np.int32)), pa.array(sums)], names=["a", "b", "n"])

        for b in batches:
            lists = b.column(0)
            gram(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64), total)
            if total["held"] > 4 * CODES:
                _fold(total)
                if total["held"] > 2 * CODES:
                    yield out()
        yield out()

    pairs = numbers.select("items").where(F.size("items") > 1).mapInArrow(products, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= least)

    def named(side: str) -> DataFrame:
        own = items.select(F.col("num").alias(side), F.col("item").alias(f"item_{side}"), F.col("n_item").alias(f"n_{side}"))
        return looked_up(own)

    out = pairs.join(named("a"), "a").join(named("b"), "b").withColumn("n", F.lit(n).cast("bigint"))
    whole = float(min_lift).is_integer()
    product = lambda *x: reduce(Column.__mul__, [F.col(c).cast("decimal(19,0)" if whole else "double") for c in x])
    out = out.where(product("n_ab", "n") >= product("n_a", "n_b") * F.lit(int(min_lift) if whole else float(min_lift)))
    return out.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n", (F.col("n_ab") * F.col("n").cast("double") / F.col("n_a") / F.col("n_b")).alias("lift"))


def _numbered(counts: DataFrame) -> DataFrame:
    """Item numbers in code point order without one large sort task: range partitions with offsets."""
    ordered = counts.repartitionByRange("item").sortWithinPartitions("item").withColumn("part", F.spark_partition_id())
    ordered = checkpointed(ordered)  # the partition numbers are part of the rows from here on
    sizes = ordered.groupBy("part").agg(F.count("*").alias("size"))
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ordered.join(F.broadcast(offsets.select("part", "offset")), "part").select(
        "item", "n_item", (F.row_number().over(Window.partitionBy("part").orderBy("item")) - 1 + F.col("offset")).cast("int").alias("num")
    )
