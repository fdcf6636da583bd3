"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from aqarlens.llm.bpe import op5_bpe
from aqarlens.llm.brown import op9_lm_scoring
from aqarlens.llm.digest_runs import OP4_SQL, op4_exact_dedup
from aqarlens.llm.fuzzy_lines import op3_fuzzy_lines
from aqarlens.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from aqarlens.llm.hyperplanes import op6_embedding_near_dedup
from aqarlens.llm.jaccard import op7_ngram_jaccard
from aqarlens.llm.mixing import op8_mix_sources
from aqarlens.llm.part_codes import OP11_SQL, op11_part_codes
from aqarlens.llm.repeats import op2_suffix_dedup
from aqarlens.llm.token_counts import op12_token_counts
from aqarlens.llm.toxicity import op10_toxicity
from aqarlens.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_bpe": op5_bpe,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_mix_sources": op8_mix_sources,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_toxicity": op10_toxicity,
    "op11_part_codes": op11_part_codes,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_warc": OP1_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op11_part_codes": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
