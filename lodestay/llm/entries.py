"""Queries and SQL of this subpackage, for the registry."""

from __future__ import annotations

from lodestay.llm import interaction, linededup, maxent, media, mixing, packing, pii, quality, secrets, sharding, simhash, tokencount, whitening

QUERIES = {
    "op1_skip_chain": pii.op1_skip_chain,
    "op2_progressive_jpeg": media.op2_progressive_jpeg,
    "op3_line_edit_join": linededup.op3_line_edit_join,
    "op4_external_shuffle": sharding.op4_external_shuffle,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_maxent": maxent.op6_maxent,
    "op7_simhash": simhash.op7_simhash,
    "op8_quality_rules": quality.op8_quality_rules,
    "quality_ablations": quality.quality_ablations,
    "op9_token_counts": tokencount.op9_token_counts,
    "op10_karmarkar_karp": packing.op10_karmarkar_karp,
    "op11_entropy_secrets": secrets.op11_entropy_secrets,
    "op12_lehmer_audit": interaction.op12_lehmer_audit,
    "op13_incremental_whitening": whitening.op13_incremental_whitening,
}
ORACLE_SQL = {"op5_mix_sources": mixing.OP5_SQL, "op8_quality_rules": quality.OP8_SQL, "quality_ablations": quality.ABLATIONS_SQL, "op12_lehmer_audit": interaction.OP12_SQL}
