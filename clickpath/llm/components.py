"""Connected components of a link table, by alternating large-star and small-star steps.

A task first contracts the links it holds (a bounded number) to stars of their own, which
shortens long chains at once.  Then both kinds of steps only take minima per vertex and join
them back to the links, so a vertex with very many links is pre-aggregated before the
shuffle and its join partition can be split.  Every round is written to the shared
checkpoint folder; the rounds end when one changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import prepare
from clickpath.storage import stored

#: Links that one task contracts.
CHUNK = 500_000


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every vertex of the links but the smallest of its component, and that smallest."""
    names, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[:len(u)], index[len(u):]
    low = np.arange(len(names))
    while True:
        before = low
        low = low.copy()
        np.minimum.at(low, before[a], before[b])      # hang roots on smaller neighbours
        np.minimum.at(low, before[b], before[a])
        while True:                                   # and follow to the end
            further = low[low]
            if (further == low).all():
                break
            low = further
        if (low[a] == low[b]).all():
            break
    hung = low != np.arange(len(names))
    return names[hung], names[low[hung]]


def _contracted(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if held:
            whole = pd.concat(held)
            for lo in range(0, len(whole), 2 * CHUNK):
                part = whole.iloc[lo:lo + 2 * CHUNK]
                u, v = contract(part["u"].to_numpy(np.int64), part["v"].to_numpy(np.int64))
                yield pd.DataFrame({"u": u, "v": v})

    return links.mapInPandas(run, "u long, v long")


def _star(links: DataFrame) -> DataFrame:
    """Each vertex's links with the smallest of the vertex and its neighbours: rows (u, v, low)."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    return links.join(low, "u").withColumn("low", F.least("u", "low"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    hung = _star(down)
    return (hung.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionAll(hung.select("u", F.col("low").alias("v"))).filter("u <> v").distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` to ``(u, root)``: every linked vertex and the smallest of its component.

    The root itself has no row.  Self-links and repeated links are ignored; no links, no rows.
    """
    prepare(links.sparkSession)
    plain = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    parts = max(1, -(-plain.count() // CHUNK))
    state = stored(_contracted(plain.repartition(parts)), "components")
    mark = _mark(state)
    while parts > 1 and mark[0]:      # one task had all links: nothing is left to join
        state = stored(_small_star(_large_star(state)), "components")
        now = _mark(state)
        if now == mark:
            break
        mark = now
    return state.select("u", F.col("v").alias("root"))
