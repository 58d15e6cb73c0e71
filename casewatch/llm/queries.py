"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from casewatch.llm.decontamination import op7_decontamination
from casewatch.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from casewatch.llm.html_text import op4_html_text
from casewatch.llm.jaccard_join import op13_jaccard_join
from casewatch.llm.langid import op6_language_id
from casewatch.llm.line_dedup import op10_line_dedup
from casewatch.llm.lm_scoring import op2_lm_scoring
from casewatch.llm.mixing import op8_mixing
from casewatch.llm.phrases import OP12_SQL, op12_phrases
from casewatch.llm.resampling import OP11_SQL, op11_resampling
from casewatch.llm.sharding import op3_sharding
from casewatch.llm.simhash import op9_simhash
from casewatch.llm.toxicity import op5_toxicity

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sharding": op3_sharding,
    "op4_html_text": op4_html_text,
    "op5_toxicity": op5_toxicity,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_line_dedup": op10_line_dedup,
    "op11_resampling": op11_resampling,
    "op12_phrases": op12_phrases,
    "op13_jaccard_join": op13_jaccard_join,
}

#: Twins of the operators that SQL can express.
ORACLE = {"op1_exact_dedup": OP1_SQL, "op11_resampling": OP11_SQL, "op12_phrases": OP12_SQL}
