"""All queries of this subpackage."""

from __future__ import annotations

from velotide.llm import queries_data, queries_model, queries_text

QUERIES = {**queries_text.QUERIES, **queries_model.QUERIES, **queries_data.QUERIES}
ORACLE = {**queries_text.ORACLE, **queries_model.ORACLE, **queries_data.ORACLE}
