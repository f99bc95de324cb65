"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, made from ``names`` by leading underscores."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        made.append(name)
    return made


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 4, is 2; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package has written in the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
