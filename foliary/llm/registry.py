"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import exact_dedup, fill_middle, fingerprints, language, lexical_search, license_scan, mixing, ngram_join, packing, passages, sharding, token_counts, token_files

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_packing": packing.op2_packing,
    "op3_language": language.op3_language,
    "op4_mixing": mixing.op4_mixing,
    "op5_passages": passages.op5_passages,
    "op6_sharding": sharding.op6_sharding,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_token_files": token_files.op9_token_files,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_licenses": license_scan.op11_licenses,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

SQL = {
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op12_fill_middle": fill_middle.OP12_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
