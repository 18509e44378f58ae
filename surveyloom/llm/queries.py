"""Registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from surveyloom.llm.best_fit_packing import op2_best_fit_packing
from surveyloom.llm.bpe import op7_bpe
from surveyloom.llm.chat_format import OP9_SQL, op9_chat_format
from surveyloom.llm.embedding_dedup import op1_embedding_dedup
from surveyloom.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from surveyloom.llm.line_dedup import OP11_SQL, op11_line_dedup
from surveyloom.llm.ngram_join import op5_ngram_join
from surveyloom.llm.packed_matrices import op8_packed_matrices
from surveyloom.llm.quality_rules import op6_quality_rules
from surveyloom.llm.repeat_removal import op4_repeat_removal
from surveyloom.llm.spelling_variants import OP12_SQL, op12_spelling_variants
from surveyloom.llm.style_tree import op10_style_tree
from surveyloom.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_warc": op3_warc,
    "op4_repeat_removal": op4_repeat_removal,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_packed_matrices": op8_packed_matrices,
    "op9_chat_format": op9_chat_format,
    "op10_style_tree": op10_style_tree,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {"op3_warc": OP3_SQL, "op9_chat_format": OP9_SQL, "op11_line_dedup": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_hard_negatives": OP13_SQL}
