"""A training corpus from the documents table, stage by stage: the stages and
their code are in ``orderlens.llm.pipeline``."""

from __future__ import annotations

from orderlens.llm.pipeline import ORACLE_SQL, STAGES, line_dedup, near_duplicates, packing, quality_rules, run, secret_scan

__all__ = ["ORACLE_SQL", "STAGES", "line_dedup", "near_duplicates", "packing", "quality_rules", "run", "secret_scan"]
