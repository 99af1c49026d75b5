"""The corpus operators' queries and their SQL, by name."""

from __future__ import annotations

from tickflow.llm import codes, extract, lines, packing, quality, rules, runs, shards, simhash, substrings, templates, urls, warc

QUERIES = {
    "op1_url_filter": urls.op1_url_filter,
    "op2_simhash": simhash.op2_simhash,
    "op3_quality": quality.op3_quality,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_sharding": shards.op5_sharding,
    "op6_decontamination": templates.op6_decontamination,
    "op7_packing": packing.op7_packing,
    "op8_substrings": substrings.op8_substrings,
    "op9_lines": lines.op9_lines,
    "op10_warc": warc.op10_warc,
    "op11_runs": runs.op11_runs,
    "op12_html_extraction": extract.op12_html_extraction,
    "op13_vector_codes": codes.op13_vector_codes,
}
#: Not here: op2, op6 and op9 (XXH64 or a canonical form that is not in SQL; tested by brute force), op3 (a fitted model; its held-out accuracy is tested), op7 (token ids; tested as an exact round trip), op11 (CRC-32 and LCP trees; tested against the definition), op12 (inferred wrappers; tested against pages of known articles), op13 (rounds of a codebook; tested against a plain version).
SQL = {
    "op1_url_filter": urls.OP1_SQL,
    "op4_quality_rules": rules.OP4_SQL,
    "op5_sharding": shards.OP5_SQL,
    "op8_substrings": substrings.OP8_SQL,
    "op10_warc": warc.OP10_SQL,
}
