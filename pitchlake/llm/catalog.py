"""The registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm import decontaminate, exact_dedup, html_extract, licenses, packing, passage_dedup, periodic, quality, secrets, simhash, suffix_dedup, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": suffix_dedup.query,
    "op2_best_fit_packing": packing.query,
    "op3_secret_scan": secrets.query,
    "op4_html_extraction": html_extract.query,
    "op5_warc_revisits": warc.query,
    "op6_quality_classifier": quality.query,
    "op7_license_scan": licenses.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_simhash_near_dedup": simhash.query,
    "op10_benchmark_decontamination": decontaminate.query,
    "op11_vector_code_compression": vector_codes.query,
    "op12_substring_dedup": passage_dedup.query,
    "op13_periodic_runs": periodic.query,
}
ORACLES: dict[str, str] = {"op1_suffix_array_dedup": suffix_dedup.ORACLE, "op5_warc_revisits": warc.ORACLE, "op8_exact_dedup": exact_dedup.ORACLE,
                           "op11_vector_code_compression": vector_codes.query,
    "op11_vector_code_compression": vector_codes.ORACLE,
                           "op12_substring_dedup": passage_dedup.ORACLE, "op13_periodic_runs": periodic.ORACLE}
