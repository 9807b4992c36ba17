"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from fonolith.llm.anchor_dedup import OP11_SQL, op11_substring_dedup
from fonolith.llm.bpe import op7_bpe
from fonolith.llm.conversation_trie import OP13_SQL, op13_conversation_trie
from fonolith.llm.embedding_dedup import OP6_SQL, op6_embedding_dedup
from fonolith.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from fonolith.llm.language_id import op8_language_id
from fonolith.llm.line_dedup import OP10_SQL, op10_line_dedup
from fonolith.llm.lm_scoring import op2_lm_scoring
from fonolith.llm.minhash import OP4_SQL, op4_minhash
from fonolith.llm.mixing import op9_mixing
from fonolith.llm.quality_rules import OP3_SQL, op3_quality_rules
from fonolith.llm.repeat_removal import OP5_SQL, op5_repeat_removal
from fonolith.llm.toxicity import op1_toxicity

QUERIES = {"op1_toxicity": op1_toxicity, "op3_quality_rules": op3_quality_rules, "op2_lm_scoring": op2_lm_scoring, "op4_minhash": op4_minhash, "op5_repeat_removal": op5_repeat_removal, "op6_embedding_dedup": op6_embedding_dedup, "op7_bpe": op7_bpe, "op8_language_id": op8_language_id, "op9_mixing": op9_mixing, "op10_line_dedup": op10_line_dedup, "op11_substring_dedup": op11_substring_dedup, "op12_hard_negatives": op12_hard_negatives, "op13_conversation_trie": op13_conversation_trie}
SQL = {"op3_quality_rules": OP3_SQL, "op4_minhash": OP4_SQL, "op5_repeat_removal": OP5_SQL, "op6_embedding_dedup": OP6_SQL, "op10_line_dedup": OP10_SQL, "op11_substring_dedup": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_conversation_trie": OP13_SQL}
