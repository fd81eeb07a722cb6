"""The queries of the corpus operators, by name, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from claimforge.llm.attention_lm import op9_lm_scoring
from claimforge.llm.exact_topk import OP7_SQL, op7_exact_topk
from claimforge.llm.fill_middle import OP12_SQL, op12_fill_in_middle
from claimforge.llm.jaccard_join import op10_ngram_jaccard_join
from claimforge.llm.language_id import op6_language_id
from claimforge.llm.line_dedup import op2_line_dedup
from claimforge.llm.mixing import OP4_SQL, op4_source_mixing
from claimforge.llm.multi_index import op5_multi_index_ann
from claimforge.llm.packing import op8_best_fit_packing
from claimforge.llm.simhash import op11_simhash_near_dedup
from claimforge.llm.token_counts import op3_token_counts
from claimforge.llm.toxicity import op1_toxicity
from claimforge.llm.whitening import op13_embedding_whitening

QUERIES = {
    "op3_token_counts": op3_token_counts,
    "op4_source_mixing": op4_source_mixing,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op1_toxicity": op1_toxicity,
    "op6_language_id": op6_language_id,
    "op9_lm_scoring": op9_lm_scoring,
    "op2_line_dedup": op2_line_dedup,
    "op5_multi_index_ann": op5_multi_index_ann,
    "op7_exact_topk": op7_exact_topk,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES: dict[str, str] = {"op4_source_mixing": OP4_SQL, "op7_exact_topk": OP7_SQL, "op12_fill_in_middle": OP12_SQL}
