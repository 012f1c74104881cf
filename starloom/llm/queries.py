"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from starloom.llm import (
    decontamination,
    dedup,
    extraction,
    language,
    mixing,
    packing,
    prefix_trie,
    quality,
    structure,
    tokens,
    toxicity,
    urls,
    warc,
)

QUERIES = {
    "op1_token_counts": tokens.op1_token_counts,
    "op2_html_style_tree": extraction.op2_html_style_tree,
    "op3_mix_curriculum": mixing.op3_mix_curriculum,
    "op4_toxicity_nnpu": toxicity.op4_toxicity_nnpu,
    "op5_warc_segments": warc.op5_warc_segments,
    "op6_quality_mcd": quality.op6_quality_mcd,
    "op7_decontaminate_lsi": decontamination.op7_decontaminate_lsi,
    "op8_url_gbt": urls.op8_url_gbt,
    "op9_language_hd": language.op9_language_hd,
    "op10_minmax_dedup": dedup.op10_minmax_dedup,
    "op11_pack_bounded": packing.op11_pack_bounded,
    "op12_conversation_trie": prefix_trie.op12_conversation_trie,
    "op13_structure_dawg": structure.op13_structure_dawg,
}
SQL = {name: sql for name, sql in {
    "op1_token_counts": tokens.SQL,
    "op2_html_style_tree": extraction.SQL,
    "op3_mix_curriculum": mixing.SQL,
    "op4_toxicity_nnpu": toxicity.SQL,
    "op5_warc_segments": warc.SQL,
    "op6_quality_mcd": quality.SQL,
    "op7_decontaminate_lsi": decontamination.SQL,
    "op8_url_gbt": urls.SQL,
    "op9_language_hd": language.SQL,
    "op10_minmax_dedup": dedup.SQL,
    "op11_pack_bounded": packing.SQL,
    "op12_conversation_trie": prefix_trie.SQL,
    "op13_structure_dawg": structure.SQL,
}.items() if sql}
