"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from . import cover_tree, lines, minhash, packing, pii, suffix_index, suffix_tree, toxicity, url_filter, winnowing

QUERIES = {
    "op1_suffix_tree": suffix_tree.query,
    "op2_url_filter": url_filter.query,
    "op3_minhash": minhash.query,
    "op4_suffix_index": suffix_index.query,
    "op5_winnowing": winnowing.query,
    "op6_toxicity": toxicity.query,
    "op7_line_dedup": lines.query,
    "op8_cover_tree": cover_tree.query,
    "op9_packing": packing.query,
    "op10_pii": pii.query,
}

ORACLES = {
    "op3_minhash": minhash.SQL,
    "op4_suffix_index": suffix_index.SQL,
    "op5_winnowing": winnowing.SQL,
    "op7_line_dedup": lines.SQL,
    "op8_cover_tree": cover_tree.SQL,
    "op10_pii": pii.SQL,
}
