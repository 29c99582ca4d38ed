"""Groups of rows that share keys."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written once as a table in the shared folder, and read from there; a folder of this machine only in local mode.

    Spark's own checkpoint works out a table twice, first to count it and then to write it, and does not tell its size.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    path = f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _told(edges: DataFrame):
    """Count and sum that tell tables of edges apart."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def groups(members: DataFrame, node: str, key: str) -> DataFrame:
    """(node, group_id): nodes that share keys, directly or over others, get the smallest node among them.

    Null keys link nothing. Each node is first tied to the smallest node of each of its keys; then, round by round,
    each node is tied to the smallest one that its neighbours are tied to, which doubles the reach. So a chain of n
    nodes takes a number of rounds in the order of log n. No group is gathered and no pair of members is made.
    """
    rows = members.where(F.col(key).isNotNull()).select(F.col(node).alias("n"), F.col(key).alias("k")).distinct()
    low = rows.groupBy("k").agg(F.min("n").alias("low"))
    edges = cut(rows.join(low, "k").where("n <> low").select(F.col("n").alias("a"), F.col("low").alias("b")).distinct())
    before = _told(edges)
    while True:  # alternately tie larger and smaller neighbours to the smallest one, until nothing changes
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        pair = F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        edges = cut(large.join(least, "a").select(pair).select("e.a", "e.b").where("a <> b").distinct())
        now = _told(edges)
        if now == before:
            break
        before = now
    every = members.select(node).distinct()
    return every.join(edges, F.col(node) == F.col("a"), "left").select(node, F.coalesce("b", node).alias("group_id"))


#: Tables of rounds that are read side by side, at most, before they are put together.
_TABLES = 16


def reached(edges: DataFrame, starts: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """(start, node, steps): every node that edges (source, target) lead to from each node of starts (start), itself included, with the fewest steps.

    Breadth first: a round takes the edges that begin at what the last one found, joins them, and keeps what is new. The edges are made
    once, and where a round stands at few nodes they are not shuffled. Nodes may lie on cycles.
    Null ends are passed over. Turn the edges round to walk the other way.
    """
    along = cut(edges.where("source IS NOT NULL AND target IS NOT NULL").select("source", "target").distinct())
    new = cut(starts.where("start IS NOT NULL").select("start", F.col("start").alias("node"), F.lit(0).alias("steps")).distinct())
    found = [new]
    for step in range(1, most_rounds):
        ends = cut(new.select(F.col("node").alias("source")).distinct())
        onwards = cut(along.join(ends, "source", "left_semi"))
        next_ = new.join(onwards, F.col("node") == F.col("source")).select("start", F.col("target").alias("node")).distinct()
        every = reduce(DataFrame.unionByName, found)
        new = cut(next_.join(every, ["start", "node"], "left_anti").withColumn("steps", F.lit(step)))
        if new.isEmpty():
            return every
        found = [*found, new] if len(found) < _TABLES else [cut(every), new]
    raise RuntimeError(f"paths of more than {most_rounds} steps")
