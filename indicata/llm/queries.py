"""The registered queries of this package and their SQL."""

from indicata.llm import (
    chat_tree,
    line_dedup,
    merkle,
    ngram_join,
    pfair,
    piece_tokens,
    quality_rules,
    sharding,
    substring_dedup,
    topk_search,
    turn_repair,
    url_filter,
    warc_revisit,
)

QUERIES = {
    f.__name__: f
    for f in (
        quality_rules.op1_quality_rules,
        substring_dedup.op2_substring_dedup,
        warc_revisit.op3_warc_revisit,
        url_filter.op4_url_filter,
        chat_tree.op5_chat_tree,
        topk_search.op6_topk_search,
        pfair.op7_pfair_mixing,
        ngram_join.op8_ngram_join,
        piece_tokens.op9_piece_tokens,
        sharding.op10_sharding,
        turn_repair.op11_turn_repair,
        merkle.op12_merkle_manifest,
        line_dedup.op13_line_dedup,
    )
}

ORACLE_SQL = {
    "op2_substring_dedup": substring_dedup.OP2_SQL,
    "op3_warc_revisit": warc_revisit.OP3_SQL,
    "op4_url_filter": url_filter.OP4_SQL,
    "op5_chat_tree": chat_tree.OP5_SQL,
    "op6_topk_search": topk_search.OP6_SQL,
    "op8_ngram_join": ngram_join.OP8_SQL,
    "op11_turn_repair": turn_repair.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
