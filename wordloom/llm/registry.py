"""Registered queries of the subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from wordloom.llm import (
    decontam,
    divergence,
    exact,
    extract,
    langid,
    oracles,
    pieces,
    quality,
    secrets,
    simhash,
    spelling,
    substrings,
    surrogates,
    transcripts,
)

REGISTRY = {
    "op1_html": (extract.op1_html, None),
    "op2_secrets": (secrets.op2_secrets, oracles.secret_spans()),
    "op3_surrogates": (surrogates.op3_surrogates, None),
    "op4_decontaminate": (decontam.op4_decontaminate, oracles.decontaminate()),
    "op5_sentencepiece": (pieces.op5_sentencepiece, None),
    "op6_transcripts": (transcripts.op6_transcripts, None),
    "op7_langid": (langid.op7_langid, None),
    "op8_quality": (quality.op8_quality, oracles.quality()),
    "op9_simhash": (simhash.op9_simhash, None),
    "op10_substrings": (substrings.op10_substrings, oracles.substrings()),
    "op11_exact": (exact.op11_exact, oracles.exact_duplicates()),
    "op12_divergence": (divergence.op12_divergence, oracles.divergence()),
    "op13_spelling": (spelling.op13_spelling, None),  # SQL has no crc32
}
