"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\t\n\x0b\f\r"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Only where the setting is absent in local mode (tests) a temporary folder of this machine is used.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        base = _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="spark-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_LOCAL: dict[str, str] = {}


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read of the table, not the work before it.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed."""
    context = spark.sparkContext
    if _SHIPPED.get("app") == context.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(target))
    _SHIPPED["app"] = context.applicationId


_SHIPPED: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plus(df: DataFrame, **columns: Column) -> DataFrame:
    """df with these columns; a column of df with one of their names (in any case) is replaced."""
    names = {c.lower() for c in columns}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in names], *[v.alias(k) for k, v in columns.items()])


def words_of(text: Column) -> Column:
    """Native: the words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    flat = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        flat = F.replace(flat, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")
