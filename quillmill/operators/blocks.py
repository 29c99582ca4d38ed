"""Blocks of documents: making, joining, rendering, grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def line_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, raw_text): the lines of a text in order; a null text has none."""
    return df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("ord", "raw_text"))


def joined_in_order(blocks: DataFrame, key: str, text: Column, by: str = "\n") -> DataFrame:
    """(key, text): the blocks of each key put together in order. A group is one document's blocks."""
    parts = F.array_sort(F.collect_list(F.struct("ord", F.coalesce(text, F.lit("")).alias("t"))))
    return blocks.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), by).alias("text"))


def rendered(block_type: Column, text: Column, latex: Column, asset: Column, ext: Column) -> Column:
    """The Markdown of one block."""
    image = F.concat(F.lit('<img src="image/'), asset, F.lit("."), ext, F.lit('">'))
    return F.when(block_type == "image", image).when((block_type == "formula") & latex.isNotNull(), F.concat(F.lit("$"), latex, F.lit("$"))).otherwise(text)


def islands(rows: DataFrame, partition: str | list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """rows with the number of the run each belongs to: a run begins where `starts` holds."""
    window = W.partitionBy(partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.coalesce(starts, F.lit(True)).cast("long")).over(window))


def gaps(rows: DataFrame, partition: str, order: str, number: str) -> DataFrame:
    """rows with `expected`, where a number does not follow the one before it."""
    before = F.lag(number).over(W.partitionBy(partition).orderBy(order))
    return rows.withColumn("expected", (before + 1).cast("long")).where(F.col(number) != F.col("expected"))


def noise_candidates(blocks: DataFrame, least: int = 3) -> DataFrame:
    """blocks with type noise_candidate where a header, footer or page line stands often in its document; none is dropped."""
    often = F.count("*").over(W.partitionBy("document_id", "normalized_text"))
    shape = F.col("normalized_text").rlike(r"^(第\s*\d+\s*页.*|Page\s+\d+.*|[-—]?\s*\d+\s*[-—]?|(https?://|www\.)\S+)$")
    noisy = F.col("type").isin("header", "footer", "paragraph") & shape & ((often >= least) | F.col("type").isin("header", "footer"))
    return blocks.withColumn("type", F.when(noisy, "noise_candidate").otherwise(F.col("type")))


def dangling(blocks: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """Blocks that no owner names."""
    return blocks.join(owners.select(key).distinct(), key, "left_anti")
