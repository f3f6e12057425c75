"""The queries opN_<name> and, where SQL can say the same, their oracles."""

from __future__ import annotations

from chronolake.llm import ann, langid, license, mixing, packing, pii, resample, simhash, sketch, suffix, trie, urlfilter, warc

QUERIES = {
    "op1_license_scan": license.op1_license_scan,
    "op2_pii": pii.op2_pii,
    "op3_fingerprints": sketch.op3_fingerprints,
    "op4_ann": ann.op4_ann,
    "op5_language_id": langid.op5_language_id,
    "op6_mixing": mixing.op6_mixing,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_packing": packing.op8_packing,
    "op9_warc": warc.op9_warc,
    "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    "op11_url_filter": urlfilter.op11_url_filter,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_resample": resample.op13_resample,
}
ORACLE_SQL: dict[str, str] = {"op9_warc": warc.OP9_SQL, "op11_url_filter": urlfilter.OP11_SQL, "op12_prefix_trie": trie.OP12_SQL, "op13_resample": resample.OP13_SQL}
