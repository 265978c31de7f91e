"""Queries of this subpackage: one for each operator, and the SQL where SQL can express it."""

from __future__ import annotations

from veritide.llm.decontaminate import OP8_SQL, op8_decontamination
from veritide.llm.dialogue import OP13_SQL, op13_conversation_repair
from veritide.llm.langid import op3_language_id
from veritide.llm.license_scan import op2_license_scan
from veritide.llm.mixing import OP4_SQL, op4_mixing
from veritide.llm.ngram_lm import op6_lm_scoring
from veritide.llm.pii import op5_pii
from veritide.llm.quality_rules import OP10_SQL, op10_quality_rules
from veritide.llm.sharding import OP1_SQL, op1_sharding
from veritide.llm.simhash import op7_simhash_near_dedup
from veritide.llm.token_counts import op9_token_counts
from veritide.llm.topk import OP12_SQL, op12_exact_top_k
from veritide.llm.whiten import op11_embedding_whitening

QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_license_scan, op3_language_id, op4_mixing, op5_pii, op6_lm_scoring, op7_simhash_near_dedup, op8_decontamination, op9_token_counts, op10_quality_rules,
    op11_embedding_whitening, op12_exact_top_k, op13_conversation_repair,
)}
SQL: dict[str, str] = {"op1_sharding": OP1_SQL, "op4_mixing": OP4_SQL, "op8_decontamination": OP8_SQL, "op10_quality_rules": OP10_SQL, "op12_exact_top_k": OP12_SQL, "op13_conversation_repair": OP13_SQL}
