"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqprep.llm import (
    ann,
    bpe,
    conversation,
    decontaminate,
    html_text,
    jaccard_join,
    language,
    line_dedup,
    periodic_runs,
    secrets,
    substring_dedup,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_toxicity": toxicity.op4_toxicity,
    "op9_nearest": ann.op9_nearest,
    "op10_html_text": html_text.op10_html_text,
    "op5_language_id": language.op5_language_id,
    "op2_warc": warc.op2_warc,
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_conversation_repair": conversation.op12_conversation_repair,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}
ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": jaccard_join.OP1_SQL,
    "op2_warc": warc.OP2_SQL,
    "op6_secret_scan": secrets.OP6_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
