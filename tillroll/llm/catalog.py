"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    alignment,
    archives,
    contextual,
    hilbert,
    lengths,
    multiindex,
    oddsketch,
    packing,
    pareto,
    rulelist,
    secrets,
    simhash,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    """Every query by name; each takes (spark, folder of Parquet tables)."""
    found = [
        hilbert.op1_hilbert_shards,
        packing.op2_ordered_packing,
        archives.op3_legacy_archives,
        contextual.op4_contextual_pii,
        simhash.op5_simhash_vantage,
        pareto.op6_pareto_mix,
        rulelist.op7_decision_list,
        secrets.op8_secret_worklist,
        lengths.op9_length_histogram,
        multiindex.op10_multi_index_search,
        whitening.op11_jacobi_davidson,
        alignment.op12_shared_cuts,
        oddsketch.op13_odd_sketches,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_legacy_archives": archives.OP3_SQL,
        "op6_pareto_mix": pareto.OP6_SQL,
        "op10_multi_index_search": multiindex.OP10_SQL,
    }
