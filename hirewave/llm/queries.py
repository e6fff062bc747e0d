"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from hirewave.llm import (conversations, embedding, licenses, mixing, quality, resampling, sentencepiece_bpe, simhash, sketch,
                          substring, token_files, urls, warc_zip)

QUERIES = {
    "op1_simhash_dedup": simhash.query,
    "op2_substring_dedup": substring.query,
    "op3_quality_classifier": quality.query,
    "op4_embedding_dedup": embedding.query,
    "op5_sentencepiece": sentencepiece_bpe.query,
    "op6_license_scan": licenses.query,
    "op7_document_fingerprints": sketch.query,
    "op8_warc_zip": warc_zip.query,
    "op9_source_mixing": mixing.query,
    "op10_url_filter": urls.query,
    "op11_token_files": token_files.query,
    "op12_conversation_repair": conversations.query,
    "op13_importance_resampling": resampling.query,
}

ORACLES = {"op8_warc_zip": warc_zip.ORACLE, "op10_url_filter": urls.ORACLE}
