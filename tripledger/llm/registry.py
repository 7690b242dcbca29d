"""The registered queries of this package, the SQL they are checked with, and the pipeline's stages."""

from __future__ import annotations

import importlib
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# Query name: its module.
OPERATORS = {
    "op1_token_files": "token_files",
    "op2_streaming_exact_dedup": "exact_dedup",
    "op3_importance_resampling": "resampling",
    "op4_hilbert_shards": "hilbert",
    "op5_chat_formatting": "chat",
    "op6_best_fit_packing": "packing",
    "op7_string_kernel_language": "language",
    "op8_setsketch_near_dedup": "near_dedup",
    "op9_merkle_fixity": "fixity",
    "op10_greedy_tiling_decontamination": "decontamination",
    "op11_spelling_variants": "spelling",
    "op12_signature_tree_join": "signature_tree",
    "op13_pointer_jumping_alignment": "alignment",
}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this library, wherever the driver was started: once per application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    with tempfile.NamedTemporaryFile(prefix="tripledger-", suffix=".zip", delete=False) as file:
        with zipfile.ZipFile(file, "w") as archive:
            for source in sorted((root / "tripledger").rglob("*.py")):
                archive.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(file.name)
    _shipped.add(spark.sparkContext.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def run(spark: SparkSession, *arguments) -> DataFrame:
        ship(spark)
        return query(spark, *arguments)

    return run


def queries() -> dict[str, Query]:
    return {
        name: shipped(getattr(importlib.import_module(f"tripledger.llm.{module}"), name))
        for name, module in OPERATORS.items()
    }


def oracle_sql() -> dict[str, str]:
    found = {}
    for module in OPERATORS.values():
        found |= getattr(importlib.import_module(f"tripledger.llm.{module}"), "ORACLE", {})
    return found
