"""The query of every text operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremorlake.llm.attention import op11_quality_classifier
from tremorlake.llm.bpe import op6_byte_bpe, op7_token_counts
from tremorlake.llm.divergence import op12_source_divergence
from tremorlake.llm.embeddings import op10_embedding_near_dedup
from tremorlake.llm.html import op3_html_extraction
from tremorlake.llm.minhash import op2_minhash
from tremorlake.llm.packing import op9_packing
from tremorlake.llm.quality import op4_quality_rules
from tremorlake.llm.resampling import op13_importance_resampling
from tremorlake.llm.secrets import op8_secret_scans
from tremorlake.llm.toxicity import op1_toxicity
from tremorlake.llm.warc import op5_warc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_minhash": op2_minhash,
    "op3_html_extraction": op3_html_extraction,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc": op5_warc,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_secret_scans": op8_secret_scans,
    "op9_packing": op9_packing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_source_divergence": op12_source_divergence,
    "op13_importance_resampling": op13_importance_resampling,
}
