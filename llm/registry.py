"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from llm import sql
from llm.op1_substring_dedup import op1_substring_dedup
from llm.op2_suffix_dedup import op2_suffix_dedup
from llm.op3_license_scan import op3_license_scan
from llm.op4_html_extraction import op4_html_extraction
from llm.op5_quality_rules import op5_quality_rules
from llm.op6_ngram_jaccard_join import op6_ngram_jaccard_join, op6_ngram_jaccard_links
from llm.op7_sentencepiece import op7_sentencepiece
from llm.op8_decontamination import op8_decontamination
from llm.op9_lm_scoring import op9_lm_scoring
from llm.op10_chat_formatting import op10_chat_formatting
from llm.op11_hard_negatives import op11_hard_negatives
from llm.op12_phrase_collocations import op12_phrase_collocations
from llm.op13_line_dedup import op13_line_dedup

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_html_extraction": op4_html_extraction,
    "op5_quality_rules": op5_quality_rules,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_line_dedup": op13_line_dedup,
}

#: results beside those of the numbered queries
FURTHER = {"op6_ngram_jaccard_links": op6_ngram_jaccard_links}

ORACLE_SQL = {
    "op1_substring_dedup": sql.OP1,
    "op2_suffix_dedup": sql.OP2,
    "op6_ngram_jaccard_join": sql.OP6,
    "op6_ngram_jaccard_links": sql.OP6_LINKS,
    "op8_decontamination": sql.OP8,
    "op9_lm_scoring": sql.OP9,
    "op10_chat_formatting": sql.OP10,
    "op11_hard_negatives": sql.OP11,
    "op12_phrase_collocations": sql.OP12,
    "op13_line_dedup": sql.OP13,
}
