"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.llm.common import for_rows, store


def _not_stars(edges: DataFrame) -> tuple[int, int]:
    """How many ``edges(u, v)`` there are, and how many nodes are not yet only a middle or hung on one middle."""
    nodes = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    seen = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    n, wrong = seen.agg(F.sum("up"), F.count(F.when((F.col("up") > 1) | (F.col("up") + F.col("down") > 1), 1))).first()
    return int(n or 0), wrong


def connected_components(links: DataFrame) -> DataFrame:
    """``doc_id, component_id`` of every end of ``links(a, b)``: the smallest id reachable. No link gives no row.

    Large star: each node hands its larger neighbours to the smallest node it sees. Small star: each node hands itself and
    its smaller neighbours to the smallest of them. Repeated until the links are stars. A node's neighbours are only ever
    summed to their least, before the shuffle, so that a node of very many links is no hot spot; each step is stored. Links
    that fill one task are not shuffled.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    rows = links.count()
    edges = store(for_rows(links, rows).distinct(), "links")
    while (found := _not_stars(for_rows(edges, rows)))[1]:
        rows = found[0]
        both = for_rows(edges, rows).select(F.inline(F.array(
            F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        large = for_rows(store(large, "large-star"), rows)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = for_rows(handed.unionByName(least.select("u", F.col("m").alias("v"))), rows).where(F.col("u") != F.col("v"))
        edges = store(small.distinct(), "small-star")
    edges = for_rows(edges, found[0])
    roots = edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id")).unionByName(roots)
