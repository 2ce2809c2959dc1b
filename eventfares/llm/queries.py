"""The operators as registered queries, and SQL for the same rows where SQL can express them."""

from __future__ import annotations

from eventfares.llm import bpe, collocations, conversations, embed, exact, jaccard, langid, lines, mixing, sharding, tokens, warc, wordbpe

QUERIES = {
    "op1_warc": warc.op1,
    "op2_byte_bpe": bpe.op2,
    "op3_exact_dedup": exact.op3,
    "op4_mixing": mixing.op4,
    "op5_embedding_dedup": embed.op5,
    "op6_sharding": sharding.op6,
    "op7_jaccard_join": jaccard.op7,
    "op8_token_counts": tokens.op8,
    "op9_line_dedup": lines.op9,
    "op9_passage_dedup": lines.op9,  # its older name for the form that finds passages
    "op10_language_id": langid.op10,
    "op11_word_bpe": wordbpe.op11,
    "op12_conversation_repair": conversations.op12,
    "op13_collocations": collocations.op13,
}

ORACLE = {
    "op1_warc": warc.OP1_SQL,
    "op3_exact_dedup": exact.OP3_SQL,
    "op5_embedding_dedup": embed.OP5_SQL,
    "op7_jaccard_join": jaccard.OP7_SQL,
    "op9_line_dedup": lines.OP9_SQL,
    "op9_passage_dedup": lines.OP9_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
