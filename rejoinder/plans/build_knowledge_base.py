"""Node tables to a written knowledge base, and its growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rejoinder.operators.knowledge_base import build_topics
from rejoinder.operators.retrieval import KnowledgeBase
from rejoinder.sources.files import write_tables


def rebuild(kb_nodes: dict[str, DataFrame], path: str) -> None:
    """Replace the knowledge base at ``path`` by the given node tables and their topics."""
    write_tables({"topics": build_topics(kb_nodes["paragraphs"]), **kb_nodes}, path)


def load(spark: SparkSession, path: str) -> KnowledgeBase:
    return KnowledgeBase(*(spark.read.parquet(f"{path}/{name}") for name in KnowledgeBase._fields))
