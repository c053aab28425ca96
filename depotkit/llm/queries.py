"""The queries of this package and the oracles of those that SQL can express."""

from __future__ import annotations

from depotkit.llm import (
    divergence, language, licenses, line_dedup, mixing, neighbours, packing, quality, resampling, secrets, simhash, token_counts, warc,
)

QUERIES = {
    "op1_warc": warc.op1_query,
    "op2_mixing": mixing.op2_query,
    "op3_licenses": licenses.op3_query,
    "op4_token_counts": token_counts.op4_query,
    "op5_line_dedup": line_dedup.op5_query,
    "op6_secrets": secrets.op6_query,
    "op7_quality": quality.op7_query,
    "op8_neighbours": neighbours.op8_query,
    "op9_packing": packing.op9_query,
    "op10_simhash": simhash.op10_query,
    "op11_resampling": resampling.op11_query,
    "op12_language": language.op12_query,
    "op13_divergence": divergence.op13_query,
}
ORACLES = {
    "op2_mixing": mixing.OP2_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op7_quality": quality.OP7_SQL,
    "op11_resampling": resampling.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
