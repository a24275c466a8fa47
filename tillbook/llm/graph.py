"""Connected components of a link table, as joins and grouped minima."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import cut, parts_for

#: Links that a task takes to make stars of.
TASK_LINKS = 1 << 16


def _stars(links: DataFrame) -> DataFrame:
    """Each partition's links as stars: a link from every node to the smallest that it reaches by them."""

    def run(batches):
        smaller = {}

        def smallest(x):
            while (y := smaller.get(x, x)) != x:
                smaller[x] = x = smaller.get(y, y)
            return x

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = smallest(a), smallest(b)
                if a != b:
                    smaller[max(a, b)] = min(a, b)
        if smaller:
            nodes = [*smaller]
            yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(0).type) for c in (nodes, map(smallest, nodes))], names=["a", "b"])

    return links.mapInArrow(run, links.schema)


def _minima(both: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours; partial minima keep a hub's links apart."""
    return both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node that has a link; label is the smallest node it reaches.

    ``links`` has columns a and b of one orderable type. Links of a node to itself, repeated links and
    links in either direction are fine. Tasks of at most TASK_LINKS links make stars of theirs first; if that is one
    task, these are the components. Else each round joins every node's larger neighbours to the smallest
    one, then every node's smaller neighbours (large star, small star), until the links are stars; the
    rounds grow with the logarithm of the number of nodes.
    """
    links = cut(links.where("a <> b").select("a", "b"))
    parts = parts_for(links.count(), TASK_LINKS)
    links = cut(_stars(links.repartition(parts)))
    state = None
    while parts > 1:
        both = links.union(links.select("b", "a"))
        large = both.join(_minima(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        minima = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(minima, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = cut(small.union(minima).distinct())
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
