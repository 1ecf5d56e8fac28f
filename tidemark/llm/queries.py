"""The queries of this folder and, where SQL can say the same, their statements."""

from __future__ import annotations

from tidemark.llm.bpe import op3_byte_bpe
from tidemark.llm.embedding_dedup import OP4_SQL, op4_embedding_dedup
from tidemark.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from tidemark.llm.language import op6_language_id
from tidemark.llm.lexical_search import OP11_SQL, op11_lexical_search
from tidemark.llm.minhash import op8_minhash_dedup
from tidemark.llm.mixing import op10_mix_sources
from tidemark.llm.pii import op2_personal_data
from tidemark.llm.source_divergence import OP13_SQL, op13_source_divergence
from tidemark.llm.suffix_dedup import op9_suffix_dedup
from tidemark.llm.token_counts import op7_token_counts
from tidemark.llm.toxicity import op5_toxicity
from tidemark.llm.vector_search import OP12_SQL, op12_vector_search

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_search": op12_vector_search,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {
    "op1_exact_dedup": OP1_SQL, "op4_embedding_dedup": OP4_SQL, "op11_lexical_search": OP11_SQL, "op12_vector_search": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
