"""Near pairs and the groups they connect."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from comboscope.functions.storage import written

BLOCK = 256


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect exactly what the boolean matrix connects, at most one per node."""
    edges, todo = [], np.ones(len(near), dtype=bool)
    for root in range(len(near)):
        if not todo[root]:
            continue
        todo[root] = False
        stack = [root]
        while stack:
            i = stack.pop()
            for j in np.nonzero(near[i] & todo)[0]:
                todo[j] = False
                edges.append((i, j))
                stack.append(j)
    return edges


def forest(n: int, closes: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """``_forest`` of ``n`` nodes from parts (rows, columns, boolean matrix) of their matrix, which is never whole."""
    edges, group = [], np.arange(n)
    for rows, columns, close in closes:
        close &= group[rows][:, None] != group[columns][None, :]
        for k in np.nonzero(close.any(axis=1))[0]:
            others = columns[close[k]]
            joined, first = np.unique(group[others], return_index=True)
            fresh = joined != group[rows[k]]  # some may have been connected since
            if fresh.any():
                edges += [(int(rows[k]), j) for j in others[first[fresh]].tolist()]
                names = np.arange(n)
                names[joined] = group[rows[k]]
                group = names[group]
    return edges


def near_edges(rows: DataFrame, key: str, near: Callable[[pd.DataFrame], np.ndarray | list[tuple[int, int]]], block: int = BLOCK, *,
               meets: dict[int, list[int]] | None = None, few_keys: bool = False) -> DataFrame:
    """Edges (a, b) connecting rows that share ``key`` and that ``near`` finds close.

    ``rows`` has ``id``, ``key`` and whatever ``near`` reads; ``near`` maps a small frame to a boolean
    matrix or, for blocks too large for one, to the edges of its ``forest``. Keys with many rows are hashed into blocks and every two blocks meet in their own task,
    so no task holds more than two blocks. A task emits a spanning forest of what it finds rather
    than all pairs, which keeps connected groups exact with at most one edge per row. With ``meets``, rows have
    a ``kind``, each kind has its own blocks, and only kinds that it names for each other meet. With ``few_keys``, the keys'
    sizes go to the rows, which then are not brought together by key before they are copied.
    """
    meets = {0: [0]} if meets is None else meets
    kinds = F.col("kind") if len(meets) > 1 else F.lit(0)
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n"), *[F.ceil(F.count(F.when(kinds == k, 1)) / F.lit(block)).cast("int").alias(f"_b{k}") for k in meets])
    first = {k: sum((F.col(f"_b{j}") for j in list(meets)[:i]), F.lit(0)) for i, k in enumerate(meets)}
    span = lambda k: F.when(F.col(f"_b{k}") > 0, F.sequence(first[k], first[k] + F.col(f"_b{k}") - 1)).otherwise(F.array().cast("array<int>"))
    own = F.coalesce(*[F.when(kinds == k, first[k] + F.pmod(F.xxhash64("id"), F.col(f"_b{k}"))) for k in meets]).cast("int")
    others = F.coalesce(*[F.when(kinds == k, F.concat(*[span(j) for j in met])) for k, met in meets.items()])
    sizes = sizes.where("_n > 1")
    parted = rows.join(F.broadcast(sizes) if few_keys else sizes, key).withColumn("_own", own).withColumn("_other", F.explode(others))
    parted = parted.withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other"))
    kind = dict(rows.dtypes)["id"]
    meeting = [key, "_lo", "_hi"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = (pdf[meeting] == pdf[meeting].iloc[-1]).all(axis=1).to_numpy()
            rest = pdf[last]
            if not last.all():
                yield find(pdf[~last])
        if rest is not None and len(rest):
            yield find(rest)

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, part in pdf.groupby(meeting, sort=False):
            if len(part) > 1:
                ids = part["id"].to_numpy()
                found = near(part)
                for i, j in _forest(found) if isinstance(found, np.ndarray) else found:
                    a.append(ids[i])
                    b.append(ids[j])
        return pd.DataFrame({"a": a, "b": b}, dtype=object)

    together = parted.repartition(*meeting).sortWithinPartitions(*meeting)
    return together.mapInPandas(scan, f"a {kind}, b {kind}").distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each node.

    Alternates large-star and small-star steps, which need a logarithmic number of rounds even for
    long chains. Each round is written out, and the loop ends when a round changes nothing.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    current, mark = written(pairs.distinct(), "components"), None
    while True:
        current = written(_small_star(_large_star(current)), "components")
        now = tuple(current.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        if now == mark:
            break
        mark = now
    roots = current.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return nodes.select("id").join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the smallest node around."""
    there = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    both = there.unionByName(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = pairs.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
