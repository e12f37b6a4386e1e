"""Queries of this subpackage, by name, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from hirelens.llm.bpe import bpe
from hirelens.llm.conversations import CONVERSATION_REPAIR_SQL, conversation_repair
from hirelens.llm.decontaminate import decontamination
from hirelens.llm.exact_dedup import EXACT_DEDUP_SQL, exact_dedup
from hirelens.llm.hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from hirelens.llm.jaccard_join import JACCARD_JOIN_SQL, jaccard_join
from hirelens.llm.language_id import language_id
from hirelens.llm.packing import packing
from hirelens.llm.substring_dedup import SUBSTRING_DEDUP_SQL, substring_dedup
from hirelens.llm.token_counts import token_counts
from hirelens.llm.toxicity import toxicity
from hirelens.llm.url_rules import url_rules
from hirelens.llm.warc import WARC_SQL, warc

QUERIES = {
    "op1_language_id": language_id,
    "op2_bpe": bpe,
    "op3_token_counts": token_counts,
    "op4_warc": warc,
    "op5_exact_dedup": exact_dedup,
    "op6_url_rules": url_rules,
    "op7_toxicity": toxicity,
    "op8_decontamination": decontamination,
    "op9_substring_dedup": substring_dedup,
    "op10_jaccard_join": jaccard_join,
    "op11_conversation_repair": conversation_repair,
    "op12_packing": packing,
    "op13_hard_negatives": hard_negatives,
}

ORACLES = {
    "op4_warc": WARC_SQL,
    "op5_exact_dedup": EXACT_DEDUP_SQL,
    "op9_substring_dedup": SUBSTRING_DEDUP_SQL,
    "op10_jaccard_join": JACCARD_JOIN_SQL,
    "op11_conversation_repair": CONVERSATION_REPAIR_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
