"""The numbered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from epicentre.llm import automata_dedup, bond_negatives, katz, langid, license_scan, mixing, oph_minhash, packing, quality_cascade, sharding, turn_repair, uniform_topk, wrapper_html
from epicentre.llm.common import table, workers_find_us


def _on(name: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_us(spark)
        return fn(table(spark, sf_dir, name))

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_decreasing": _on("documents", packing.packed_pieces),
        "op2_katz_backoff": _on("documents", katz.scored),
        "op3_suffix_automata": _on("documents", automata_dedup.kept_words),
        "op4_oph_minhash": _on("documents", oph_minhash.linked_documents),
        "op5_water_filling": _on("documents", mixing.mixed_sizes),
        "op6_template_markup": _on("documents", license_scan.license_places),
        "op7_uniform_threshold": _on("embeddings", uniform_topk.top_scores),
        "op8_sampled_splitters": _on("documents", sharding.shard_rows),
        "op9_rank_order": _on("documents", langid.identified),
        "op10_quality_cascade": _on("documents", quality_cascade.verdicts),
        "op11_wagner_fischer": _on("conversations", turn_repair.repaired),
        "op12_union_free_wrappers": _on("pages", wrapper_html.page_texts),
        "op13_bond_scan": _on("embeddings", bond_negatives.hard_negatives),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_katz_backoff": katz.SCORED_SQL,
        "op3_suffix_automata": automata_dedup.KEPT_SQL,
        "op4_oph_minhash": oph_minhash.LINKED_SQL,
        "op6_template_markup": license_scan.PLACES_SQL,
        "op7_uniform_threshold": uniform_topk.TOP_SCORES_SQL,
        "op9_rank_order": langid.IDENTIFIED_SQL,
        "op10_quality_cascade": quality_cascade.VERDICTS_SQL,
        "op11_wagner_fischer": turn_repair.REPAIRED_SQL,
        "op12_union_free_wrappers": wrapper_html.PAGE_TEXTS_SQL,
        "op13_bond_scan": bond_negatives.HARD_NEGATIVES_SQL,
    }
