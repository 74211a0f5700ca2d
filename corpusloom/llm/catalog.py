"""The queries of the training-data operators."""

from . import collision_search, decontaminate, html_text, near_dedup, packing, phrases, ranked_search, ring_sharding, suffix_dedup, token_counts, toxicity, url_filter, warc

QUERIES = {
    "op1_ordinal_toxicity": toxicity.op1_ordinal_toxicity,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
    "op4_warc_round_trip": warc.op4_warc_round_trip,
    "op5_redirect_equivalence": url_filter.op5_redirect_equivalence,
    "op6_shortest_pack_first": packing.op6_shortest_pack_first,
    "op7_suffix_array_dedup": suffix_dedup.op7_suffix_array_dedup,
    "op8_collision_counting_search": collision_search.op8_collision_counting_search,
    "op9_main_text": html_text.op9_main_text,
    "op10_template_decontamination": decontaminate.op10_template_decontamination,
    "op11_phrase_collocations": phrases.op11_phrase_collocations,
    "op12_bounded_ring": ring_sharding.op12_bounded_ring,
    "op13_treap_search": ranked_search.op13_treap_search,
}
ORACLES: dict[str, str] = {
    "op3_minhash_near_dedup": near_dedup.ORACLE,
    "op4_warc_round_trip": warc.ORACLE,
    "op5_redirect_equivalence": url_filter.ORACLE,
    "op11_phrase_collocations": phrases.ORACLE,
    "op12_bounded_ring": ring_sharding.ORACLE,
    "op13_treap_search": ranked_search.ORACLE,
}
