"""Connected components of undirected edges, distributed and in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helicase.llm.common import discard, materialised, shared_dir

MOST_ROUNDS = 60


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) for the nodes of edges a-b that are not the least themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[ia], label[ib])
        new = label.copy()
        np.minimum.at(new, ia, least)
        np.minimum.at(new, ib, least)
        np.minimum.at(new, label[ia], least)
        np.minimum.at(new, label[ib], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _settled(down: DataFrame) -> bool:
    """Whether the edges (u, v) are stars: no u has two, and no v is a u."""
    roles = down.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(down.select("v", F.lit(0), F.lit(1)))
    return roles.groupBy("x").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child > 1 OR (child > 0 AND root > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's least node) for every node of the edges (a, b), by alternating large and small stars.

    Each round is written below spark.checkpoint.dir, so a lost executor costs no more than a round; the one before goes.
    """
    spark = edges.sparkSession
    path = shared_dir(spark, "cc")
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    down = materialised(down, "cc", path)
    for _ in range(MOST_ROUNDS):
        if _settled(down):
            break
        # large star: of a node's neighbours, the larger ones are tied to the least of all
        both = down.union(down.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        down = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: of a node's smaller neighbours and itself, all are tied to the least
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        down = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        last, path = path, shared_dir(spark, "cc")
        down = materialised(down, "cc", path)
        discard(spark, last)
    else:
        raise RuntimeError("components did not settle")
    stars = down.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
