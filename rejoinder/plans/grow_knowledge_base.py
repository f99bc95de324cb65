"""The knowledge base as versions: import, growth and removal are whole or not there.

Tables are folders that are written once and never changed. A version is a manifest that lists, for each table, the folders it
consists of. A new manifest is written aside and renamed last, so a reader sees the old or the new version and a failed run
leaves the old one. Two writers cannot make the same version: the second rename finds the name taken and fails.
Growth adds folders with the new rows only; what is there is not written again.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rejoinder.operators import knowledge_base as kb_ops
from rejoinder.operators.retrieval import KnowledgeBase
from rejoinder.sources.files import classify_examples
from rejoinder.session import written

EDGES = ("paragraph_topic", "counter_topic", "contains", "countered_with")


class Version(NamedTuple):
    number: int
    tables: dict[str, list[str]]


class VersionTaken(RuntimeError):
    """Another writer has made this version."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def current(spark: SparkSession, root: str) -> Version:
    """The latest version; number 0 without tables if there is none."""
    store, folder = _files(spark, f"{root}/manifests")
    if not store.exists(folder):
        return Version(0, {})
    names = sorted(s.getPath().getName() for s in store.listStatus(folder) if s.getPath().getName().endswith(".json"))
    return at(spark, root, int(names[-1].removesuffix(".json"))) if names else Version(0, {})


def at(spark: SparkSession, root: str, number: int) -> Version:
    text = spark.read.option("wholetext", True).text(f"{root}/manifests/{number:012d}.json").first()[0]
    return Version(number, json.loads(text)["tables"])


def _publish(spark: SparkSession, root: str, before: Version, tables: dict[str, list[str]]) -> Version:
    store, aside = _files(spark, f"{root}/manifests/aside-{uuid.uuid4().hex}")
    stream = store.create(aside)
    stream.write(bytearray(json.dumps({"tables": tables}, sort_keys=True).encode()))
    stream.close()
    _, place = _files(spark, f"{root}/manifests/{before.number + 1:012d}.json")
    if store.exists(place) or not store.rename(aside, place):
        store.delete(aside, False)
        raise VersionTaken(f"version {before.number + 1} of {root} is there already")
    return Version(before.number + 1, tables)


def _added(df: DataFrame, root: str, name: str) -> str:
    path = f"{root}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def table(spark: SparkSession, version: Version, name: str) -> DataFrame:
    """A table of a version; older folders may lack columns that newer ones have."""
    parts = [spark.read.parquet(path) for path in version.tables[name]]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def load(spark: SparkSession, root: str, version: Version | None = None) -> KnowledgeBase:
    version = version or current(spark, root)
    return KnowledgeBase(*(table(spark, version, name) for name in KnowledgeBase._fields))


def _edges(kb: KnowledgeBase) -> dict[str, DataFrame]:
    return {
        "paragraph_topic": kb_ops.topic_edges(kb.paragraphs, kb.topics),
        "counter_topic": kb_ops.topic_edges(kb.counters, kb.topics),
        "contains": kb_ops.contains_edges(kb.sentences, kb.paragraphs),
        "countered_with": kb_ops.countered_with_edges(kb.counters, kb.paragraphs),
    }


def import_nodes(spark: SparkSession, nodes: dict[str, DataFrame], root: str) -> Version:
    """A version of the given ``paragraphs``, ``sentences`` and ``counters`` only, with their topics and edges."""
    before = current(spark, root)
    tables = {name: [_added(df, root, name)] for name, df in nodes.items()}
    tables["topics"] = [_added(kb_ops.build_topics(spark.read.parquet(tables["paragraphs"][0])), root, "topics")]
    kb = load(spark, root, Version(0, tables))
    tables |= {name: [_added(df, root, name)] for name, df in _edges(kb).items()}
    return _publish(spark, root, before, tables)


def grow(spark: SparkSession, root: str, lines: DataFrame) -> tuple[Version, DataFrame, DataFrame]:
    """Add the generated examples of ``lines (line, value)``: the version, the import's counts, the lines that were no JSON.

    New are their paragraphs, their new topics and the topic edges of the new paragraphs. Counters whose
    topic was not known before get their edge too.
    """
    before = current(spark, root)
    found = written(classify_examples(lines), "examples")
    accepted = found.filter(F.col("outcome") == "accepted").drop("outcome", "value")
    kb = load(spark, root, before)
    paragraphs = _added(kb_ops.import_examples(accepted, kb.paragraphs), root, "paragraphs")
    fresh = kb_ops.merge_topics(kb.topics.select("name"), accepted).filter("created").select("name")
    topics = _added(fresh, root, "topics")
    new = spark.read.parquet(paragraphs)
    every = kb.topics.select("name").unionByName(spark.read.parquet(topics))
    added = {
        "paragraphs": paragraphs, "topics": topics,
        "paragraph_topic": _added(kb_ops.topic_edges(new, every), root, "paragraph_topic"),
        "counter_topic": _added(kb_ops.topic_edges(kb.counters, spark.read.parquet(topics)), root, "counter_topic"),
    }
    tables = {name: [*paths, *([added[name]] if name in added else [])] for name, paths in before.tables.items()}
    rejected = found.filter(F.col("outcome") == "rejected").select("line", "value")
    return _publish(spark, root, before, tables), kb_ops.import_stats(accepted), rejected


def remove_synthetic(spark: SparkSession, root: str) -> Version:
    """A version without synthetic paragraphs and their edges. Topics stay."""
    before = current(spark, root)
    paragraphs = table(spark, before, "paragraphs")
    gone = written(paragraphs.filter(kb_ops.synthetic()).select(F.col("id").alias("_gone")), "removed")
    tables = dict(before.tables)
    tables["paragraphs"] = [_added(paragraphs.filter(~kb_ops.synthetic()), root, "paragraphs")]
    for name, key in (("paragraph_topic", "id"), ("contains", "paragraph_id"), ("countered_with", "paragraph_id")):
        edges = table(spark, before, name)
        tables[name] = [_added(edges.join(gone, edges[key] == gone["_gone"], "left_anti"), root, name)]
    return _publish(spark, root, before, tables)


def counts(spark: SparkSession, version: Version) -> DataFrame:
    """(version, table, rows) of the nodes and edges of a version."""
    names = [*KnowledgeBase._fields, *EDGES]
    return kb_ops.union_all(
        [table(spark, version, n).agg(F.count("*").alias("rows")).select(F.lit(version.number).alias("version"), F.lit(n).alias("name"), "rows") for n in names]
    )
