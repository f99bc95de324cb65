"""A whole table of queries assessed against the knowledge base."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rejoinder.functions import fixed_values as fixed
from rejoinder.operators.assessment import assess, response_requests
from rejoinder.operators.retrieval import KnowledgeBase, retrieve_context
from rejoinder.session import written


def assess_queries(
    queries: DataFrame, kb: KnowledgeBase, method: str = "semantic",
    num_results: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity",
) -> DataFrame:
    """Retrieve, score and level every query (``query_id, query, embedding``)."""
    return assess(queries, retrieve_context(queries, kb, method, num_results, order_by))


def assess_and_request(
    queries: DataFrame, kb: KnowledgeBase, method: str = "semantic",
    num_results: int = fixed.RESULTS_PER_LAYER, order_by: str = "similarity",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assessment, retrieved rows and request texts from one retrieval."""
    context = written(retrieve_context(queries, kb, method, num_results, order_by), "context")
    assessed = assess(queries, context)
    return assessed, context, response_requests(queries, assessed, context)
