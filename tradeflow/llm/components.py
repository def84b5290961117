"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import lean, release, scratch

#: Rounds after which a graph that has not settled fails the job; each round
#: at least halves the depth, so this is out of any real graph's reach.
MOST_ROUNDS = 60
#: Links that a task joins among themselves at once.
CHUNK_LINKS = 1 << 18


def least_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number reachable from each of 0 to n - 1 by links a, b."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while ((up := label[label]) != label).any():
            label = up


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) as stars that connect the same, a chunk of links at a time."""
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ends = pa.concat_arrays([table.column(c).combine_chunks() for c in ("u", "v")])
        nodes = ends.unique()
        nodes = nodes.take(pc.sort_indices(nodes))
        at = pc.index_in(ends, nodes).to_numpy()
        label = least_reachable(at[:len(table)], at[len(table):], len(nodes))
        leaves = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(leaves)), nodes.take(pa.array(label[leaves]))], names=["u", "v"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= CHUNK_LINKS:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (id, component): the smallest id reachable by links, for every id
    that occurs in ``links`` (columns a and b, any type with an order, no
    nulls). Loops and repeated links are allowed; an empty table gives none.

    Each task first joins its own links to stars, so that only what connects
    links of several tasks takes rounds. Then large-star and small-star steps
    alternate until only stars are left, often at once. A
    step groups links by node with map-side minima and joins them back, which splits
    at run time for a node with very many links; no group is collected.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v")
    edges = scratch(edges.mapInArrow(lean(_stars), edges.schema), "links")
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = scratch(both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most")), "around")
        # Stars: the neighbours are all larger, or there is one, a smaller one.
        if around.filter("least < u AND (least != most OR most > u)").count() == 0:
            break
        # Large star: every larger neighbour of u goes to the smallest around u.
        least = around.select("u", F.least("u", "least").alias("m"))
        large = scratch(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        release(edges, around)
        # Small star: u and its smaller neighbours go to the smallest of them.
        least = scratch(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        edges = scratch(large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        release(large, least)
    else:
        raise RuntimeError("components did not settle")
    release(edges)
    found = around.select(F.col("u").alias("id"), F.least("u", "least").alias("component"))
    # Any other link's ends are found.
    loops = links.filter("a = b").select(F.col("a").alias("id")).distinct()
    alone = loops.join(found.select("id"), "id", "left_anti").select("id", F.col("id").alias("component"))
    return found.unionByName(alone)
