"""Registry of the queries of this folder: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from thermograph.llm.op1_secret_scan import op1_secret_scan
from thermograph.llm.op2_html_extract import op2_html_extract
from thermograph.llm.op3_jaccard_join import op3_jaccard_join
from thermograph.llm.op4_quality_rules import op4_quality_rules
from thermograph.llm.op5_chat_format import op5_chat_format
from thermograph.llm.op6_line_dedup import op6_line_dedup
from thermograph.llm.op7_bpe import op7_bpe
from thermograph.llm.op8_license_scan import op8_license_scan
from thermograph.llm.op9_language_id import op9_language_id
from thermograph.llm.op10_decontaminate import op10_decontaminate
from thermograph.llm.op11_minhash_dedup import op11_minhash_dedup
from thermograph.llm.op12_spelling_variants import op12_spelling_variants
from thermograph.llm.op13_source_audit import op13_source_audit
from thermograph.llm.sql import SQL

QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_html_extract, op3_jaccard_join, op4_quality_rules, op5_chat_format,
    op6_line_dedup, op7_bpe, op8_license_scan, op9_language_id, op10_decontaminate,
    op11_minhash_dedup, op12_spelling_variants, op13_source_audit)}
ORACLE_SQL = SQL
