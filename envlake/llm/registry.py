"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from envlake.llm import ann, bpe, codes, exact_dedup, language, licenses, line_dedup, lm, overlap, packing, quality, ranking, simhash


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over its whole table."""
    return {
        "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
        "op2_mixture_packing": packing.op2_mixture_packing,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_site_line_dedup": line_dedup.op4_site_line_dedup,
        "op5_license_scan": licenses.op5_license_scan,
        "op6_quality_qda": quality.op6_quality_qda,
        "op7_language_id": language.op7_language_id,
        "op8_byte_bpe": bpe.op8_byte_bpe,
        "op9_stupid_backoff": lm.op9_stupid_backoff,
        "op10_collision_counting": ann.op10_collision_counting,
        "op11_divide_skip": overlap.op11_divide_skip,
        "op12_dual_tree": ranking.op12_dual_tree,
        "op13_slice_masks": codes.op13_slice_masks,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express."""
    return {
        "op3_exact_dedup": exact_dedup.OP3_SQL,
        "op4_site_line_dedup": line_dedup.OP4_SQL,
        "op5_license_scan": licenses.OP5_SQL,
        "op9_stupid_backoff": lm.OP9_SQL,
        "op11_divide_skip": overlap.OP11_SQL,
        "op12_dual_tree": ranking.OP12_SQL,
        "op13_slice_masks": codes.OP13_SQL,
    }
