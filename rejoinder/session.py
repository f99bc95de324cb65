"""Session construction and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "rejoinder", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that tasks can import it wherever they run."""
    root = os.path.dirname(os.path.abspath(__file__))
    app = spark.sparkContext.applicationId
    if _shipped.get("app") == app:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="rejoinder-code-"), "rejoinder.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped["app"] = app


_shipped: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _folder_of_this_machine()


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="rejoinder-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/rejoinder/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """As ``written``, in buckets by ``keys``, as many as a shuffle has partitions: a join on these keys reads the
    rows where they lie. The name of the table only tells the reader of the buckets and is dropped at once."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    dealt.option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay
    return back
