"""Set-similarity join with prefix filter: as a join of two tables, and against an index of one small side."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import checkpointed, large


class PrefixIndex:
    """Sets (name, tokens) by the rare tokens of their prefixes; ``uses`` has the global number of uses of their tokens.

    Finds every set with Jaccard similarity >= ``threshold`` to another one, exactly.  Tokens that no set of the index has
    stand before all others in the order, as they can't be shared."""

    def __init__(self, sets: Iterable[tuple[str, Iterable[str]]], uses: dict[str, int], threshold: float):
        self.threshold = threshold
        self.sets = [(name, frozenset(tokens)) for name, tokens in sets]
        tokens = sorted({t for _, own in self.sets for t in own}, key=lambda t: (uses.get(t, 0), t))
        self.order = {t: i for i, t in enumerate(tokens)}
        self.size = np.array([len(own) for _, own in self.sets], np.int64)
        by_prefix: list[list[tuple[int, int]]] = [[] for _ in tokens]
        by_token: list[list[int]] = [[] for _ in tokens]
        for k, (_, own) in enumerate(self.sets):
            for at, t in enumerate(sorted(map(self.order.__getitem__, own))):
                by_token[t].append(k)
                if at < self._prefix(len(own)):
                    by_prefix[t].append((k, len(own) - at))
        self.by_prefix = [np.array(x, np.int64).reshape(-1, 2) for x in by_prefix]
        self.by_token = [np.array(x, np.int64) for x in by_token]

    def _prefix(self, n: int) -> int:
        return n - math.ceil(n * self.threshold - 1e-9) + 1 if n else 0

    def like(self, tokens: Iterable[str]) -> list[tuple[str, float]]:
        """(name, similarity) of the sets at least ``threshold`` alike."""
        own = frozenset(tokens)
        n, t = len(own), self.threshold
        known = sorted(self.order[x] for x in own if x in self.order)
        prefix = [self.by_prefix[x] for x in known[: max(0, self._prefix(n) - (n - len(known)))]]
        if not prefix:
            return []
        met = np.concatenate(prefix)
        k = met[:, 0]
        size, left = self.size[k], np.repeat(np.arange(len(known), len(known) - len(prefix), -1), [len(x) for x in prefix])
        # by length, and by what both can still share from here on
        fits = (np.minimum(left, met[:, 1]) >= t / (1 + t) * (n + size) - 1e-9) & (size >= t * n - 1e-9) & (size <= n / t + 1e-9)
        if not fits.any():
            return []
        found = np.flatnonzero(np.bincount(k[fits]))
        common = np.bincount(np.concatenate([self.by_token[x] for x in known]), minlength=len(self.sets))[found]
        similarity = common / (n + self.size[found] - common)
        good = similarity >= t - 1e-9
        return [(self.sets[i][0], s) for i, s in zip(found[good].tolist(), similarity[good].tolist())]


def similar_sets(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(left_id, right_id, n_left, n_right, similarity) of every pair with Jaccard similarity >= ``threshold``; exact.

    Both sides are (id, tokens array<string>), ids distinct on each side.  Tokens are ordered by global rarity; two sets at
    the threshold share a token of their prefixes, so only those are joined: the tokens that most sets have never are.
    Length and position filters cut the candidates before the sets are compared.  Empty and null sets pair with none."""
    both = left.select(F.lit(0).alias("side"), "id", "tokens").unionByName(right.select(F.lit(1).alias("side"), "id", "tokens"))
    long = both.select("side", "id", F.explode(F.array_distinct("tokens")).alias("token"))
    uses = long.groupBy("token").agg(F.count("*").alias("uses"))
    ordered = large(long).join(uses, "token").groupBy("side", "id").agg(F.sort_array(F.collect_list(F.struct("uses", "token"))).alias("t"))
    ordered = checkpointed(ordered.select("side", "id", F.transform("t", lambda x: x.token).alias("tokens")).withColumn("n", F.size("tokens")))
    least = F.ceil(F.col("n") * threshold - 1e-9).cast("int")
    prefix = ordered.select("side", "id", "n", F.posexplode(F.slice("tokens", F.lit(1), F.col("n") - least + 1)).alias("pos", "token"))

    def of(side: int, name: str) -> DataFrame:
        return prefix.where(F.col("side") == side).select("token", *[F.col(c).alias(f"{name}_{c}") for c in ("id", "n", "pos")])

    n = F.col("l_n") + F.col("r_n")
    fits: Column = (F.least("l_n", "r_n") >= threshold * F.greatest("l_n", "r_n") - 1e-9) & (
        1 + F.least(F.col("l_n") - F.col("l_pos"), F.col("r_n") - F.col("r_pos")) - 1 >= threshold / (1 + threshold) * n - 1e-9
    )
    # the position filter holds for the first common token of a pair; a pair it wants is found by that one
    pairs = large(of(0, "l")).join(of(1, "r"), "token").where(fits).select("l_id", "r_id", "l_n", "r_n").distinct()
    for side, name in ((0, "l"), (1, "r")):
        pairs = large(pairs).join(ordered.where(F.col("side") == side).select(F.col("id").alias(f"{name}_id"), F.col("tokens").alias(f"{name}_tokens")), f"{name}_id")
    common = F.size(F.array_intersect("l_tokens", "r_tokens"))
    found = pairs.select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"), F.col("l_n").alias("n_left"), F.col("r_n").alias("n_right"), (common / (n - common)).alias("similarity"))
    return found.where(F.col("similarity") >= threshold - 1e-9)
