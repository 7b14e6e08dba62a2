"""What the driver contract adds from this package: its queries, the pipeline and their SQL."""

from __future__ import annotations

import corpus_pipeline

from pairloom.llm.oracle import ORACLE
from pairloom.llm.queries import QUERIES

LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}
LLM_ORACLE = {**ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
