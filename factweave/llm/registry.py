"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules and the queries they hold.
MODULES = {
    "op01_packing": "op1_packing",
    "op02_toxicity": "op2_toxicity",
    "op03_setsketch": "op3_setsketch",
    "op04_language": "op4_language",
    "op05_html": "op5_html",
    "op06_quality": "op6_quality",
    "op07_lines": "op7_lines",
    "op08_fmindex": "op8_fmindex",
    "op09_subspace": "op9_subspace",
    "op10_sharding": "op10_sharding",
    "op11_spelling": "op11_spelling",
    "op12_whitening": "op12_whitening",
    "op13_chat": "op13_chat",
}


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"factweave.llm.{module}"), name) for module, name in MODULES.items()}


def llm_oracle_sql() -> dict[str, str]:
    from factweave.llm import op10_sharding, op11_spelling, oracles

    return {"op3_setsketch": oracles.OP3, "op8_fmindex": oracles.OP8, "op9_subspace": oracles.OP9, "op10_sharding": op10_sharding.op10_sql(), "op11_spelling": op11_spelling.OP11}
