"""The operators as queries over whole tables, with production parameters, and their statements for another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import (
    exact_search,
    language,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    periodic_runs,
    privacy,
    secret_scan,
    sharding,
    target_resampling,
    token_files,
    toxicity,
)
from tallyward.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: operator(table(spark, directory, name))


QUERIES: dict[str, Query] = {
    "op1_exact_search": _over("embeddings", exact_search.search_embeddings),
    "op2_packing": _over("documents", packing.pack),
    "op3_language": _over("documents", language.identify_documents),
    "op4_neighbours": _over("embeddings", neighbours.near_embeddings),
    "op5_toxicity": lambda spark, directory: toxicity.toxic_documents(
        table(spark, directory, "documents"), table(spark, directory, "labels")
    ),
    "op6_private_data": _over("documents", privacy.private_documents),
    "op7_mixing": _over("documents", mixing.mix_documents),
    "op8_sharding": _over("documents", sharding.shard_documents),
    "op9_near_duplicates": _over("documents", near_duplicates.grouped_documents),
    "op10_secret_scan": _over("documents", secret_scan.scanned_documents),
    "op11_periodic_runs": _over("documents", periodic_runs.run_documents),
    "op12_token_files": _over("documents", token_files.filed_documents),
    "op13_target_resampling": lambda spark, directory: target_resampling.resampled_documents(
        table(spark, directory, "documents"), table(spark, directory, "benchmark")
    ),
}

STATEMENTS: dict[str, str] = {
    "op1_exact_search": exact_search.SEARCH_SQL,
    "op7_mixing": mixing.MIX_SQL,
    "op8_sharding": sharding.SHARD_SQL,
    "op9_near_duplicates": near_duplicates.GROUPS_SQL,
    "op13_target_resampling": target_resampling.RESAMPLE_SQL,
}
