"""Queries of the corpus operators, by name."""

from __future__ import annotations

from tidemark.llm import licences, merkle, phrases, warc
from tidemark.llm.embeddings import op3_cross_polytope
from tidemark.llm.jaccard import op7_lsh_forest
from tidemark.llm.language import op11_byte_language
from tidemark.llm.mixing import op9_cube_mix
from tidemark.llm.packing import op10_window_packing
from tidemark.llm.pages import op5_min_cut_text
from tidemark.llm.quality import op6_isolation_rules
from tidemark.llm.secrets import op4_secret_forest
from tidemark.llm.sharding import op8_interleaved_shards

QUERIES = {f.__name__: f for f in (
    licences.op1_license_scan, warc.op2_warc_index, op3_cross_polytope, op4_secret_forest,
    op5_min_cut_text, op6_isolation_rules, op7_lsh_forest, op8_interleaved_shards, op9_cube_mix, op10_window_packing,
    op11_byte_language, merkle.op12_merkle_manifest, phrases.op13_phrase_collocations)}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licences.oracle(),
    "op2_warc_index": warc.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_phrase_collocations": phrases.ORACLE,
}
