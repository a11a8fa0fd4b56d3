"""Named queries of this package and their DuckDB SQL where SQL can express them."""

from shelfspark.llm import (
    bpe, compact_windows, decontaminate, html_extract, near_dedup, pieces, quality, secrets, source_audit, sql, substring_dedup, toxicity,
    turn_trie, url_filter)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_secrets": secrets.op3_secrets,
    "op4_quality": quality.op4_quality,
    "op5_toxicity": toxicity.op5_toxicity,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op6_passages": compact_windows.op6_passages,
    "op7_html": html_extract.op7_html,
    "op8_url_filter": url_filter.op8_url_filter,
    "op11_sentencepiece": pieces.op11_sentencepiece,
    "op12_conversation_trie": turn_trie.op12_conversation_trie,
    "op13_source_audit": source_audit.op13_source_audit,
}
SQL = dict(sql.SQL)
