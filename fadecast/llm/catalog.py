"""The queries of the operators and their SQL."""

from __future__ import annotations

from fadecast.llm import decontaminate, langid, licenses, linededup, mixing, neardup, pii, pitmanyor, quality, urls, vafile, warc, whitening

QUERIES = {
    "op1_language_mixture": langid.op1_language_mixture,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_url_filter": urls.op4_url_filter,
    "op5_warc_segments": warc.op5_warc_segments,
    "op6_pii_tagger": pii.op6_pii_tagger,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_minhash_forest": neardup.op8_minhash_forest,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_pitman_yor": pitmanyor.op11_pitman_yor,
    "op12_centroid_clusters": vafile.op12_centroid_clusters,
    "op13_whiten_embeddings": whitening.op13_whiten_embeddings,
}

ORACLES = {
    "op3_quality_rules": quality.ORACLE,
    "op5_warc_segments": warc.ORACLE,
    "op8_minhash_forest": neardup.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op10_mix_sources": mixing.ORACLE,
    "op12_centroid_clusters": vafile.ORACLE,
}
