"""The training-data queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from matchloom.llm import chat, decontaminate, html, jaccard, langid, lines, mixing, quality, tokens, topk

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_html_text": html.op2_html_text,
    "op3_langid": langid.op3_langid,
    "op4_token_count": tokens.op4_token_count,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_quality": quality.op7_quality,
    "op8_chat_format": chat.op8_chat_format,
    "op9_mix": mixing.op9_mix,
    "op10_line_dedup": lines.op10_line_dedup,
}
SQL = {"op1_topk": topk.SQL, "op5_decontaminate": decontaminate.SQL, "op6_jaccard_join": jaccard.SQL, "op8_chat_format": chat.SQL}
