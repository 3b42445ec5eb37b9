"""Queries and SQL of the training-data operators, by the names under which they are registered."""

from __future__ import annotations

from halocline.llm import chat_format, decontamination, divergence, exact_dedup, secret_scan, url_filter
from halocline.llm.chat_format import op11_chat_format
from halocline.llm.decontamination import op3_decontamination
from halocline.llm.divergence import op13_divergence
from halocline.llm.html_text import op2_html_text
from halocline.llm.packing import op5_packing
from halocline.llm.pii import op9_pii
from halocline.llm.quality import op10_quality
from halocline.llm.resampling import op12_resampling
from halocline.llm.secret_scan import op1_secret_scan
from halocline.llm.simhash import op8_simhash
from halocline.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_html_text": op2_html_text,
    "op3_decontamination": op3_decontamination,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_packing": op5_packing,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_chat_format": op11_chat_format,
    "op12_resampling": op12_resampling,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = secret_scan.ORACLE_SQL | decontamination.ORACLE_SQL | url_filter.ORACLE_SQL | exact_dedup.ORACLE_SQL | chat_format.ORACLE_SQL | divergence.ORACLE_SQL
