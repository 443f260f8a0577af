"""Queries of the subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

import corpus_pipeline

from . import html_text, jpeg, line_dedup, mixing, ngram_join, order_minhash, packing, toxicity, url_filter, warc

QUERIES = {
    "op1_order_minhash": order_minhash.op1_order_minhash,
    "op2_warc": warc.op2_warc,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_packing": packing.op6_packing,
    "op7_html_text": html_text.op7_html_text,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_jpeg": jpeg.op9_jpeg,
    "op10_mixing": mixing.op10_mixing,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op3_url_filter": url_filter.ORACLE_SQL,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
