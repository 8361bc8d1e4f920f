"""What several operators of this folder share: scratch tables, words, null-safe keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only local sessions without that setting get one of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quarry-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage, survives lost executors, and gives later plans the true size in bytes, by which Spark itself
    decides whether a side is small enough to broadcast.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(column: Column | str = "text") -> Column:
    """16 bytes that stand for a text; null and empty are the same text."""
    return F.unhex(F.md5(text_or_empty(column)))


def row_key(docs: DataFrame) -> Column:
    """A key of the whole row: 16 bytes of the text and 8 of all columns; maps and variants, which have no hash, count as JSON."""

    def hashable(kind: str) -> bool:
        return "map<" not in kind and "variant" not in kind

    rest = [
        F.col(f"`{f.name}`") if hashable(f.dataType.simpleString()) else F.to_json(F.struct(F.col(f"`{f.name}`")))
        for f in docs.schema
    ]
    return F.unhex(F.concat(F.md5(text_or_empty()), F.lpad(F.hex(F.xxhash64(*rest)), 16, "0")))
