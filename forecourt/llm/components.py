"""Connected components of a large graph by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.session import checkpoint


def stars(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that is not the smallest of its component.

    Large-star points the greater neighbours of each node at the least neighbour, small-star does
    so for the smaller ones; both only ever group by node and keep at most as many rows as there
    are edges. The rounds end when every component is one star, after about log n of them.
    A hub's rows are split by adaptive execution, since both steps are plain joins on the node.
    """
    links = checkpoint(_directed(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    before = None
    while (now := _signature(links)) != before:
        before = now
        if not now[0]:
            break
        links = checkpoint(_small(_large(links)))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _directed(links: DataFrame) -> DataFrame:
    """Each link once, from its greater to its smaller end."""
    return (
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return _directed(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    to_least = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _directed(to_least.union(least))


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
