"""The ten registered queries, each over its whole table, and SQL where SQL can express one."""

from __future__ import annotations

from . import byte_bpe, html_text, matroska, neighbours, packing, secrets, simhash, token_files, toxicity, warc

QUERIES = {
    "op1_nn_descent": neighbours.op1,
    "op2_toxicity": toxicity.op2,
    "op3_token_files": token_files.op3,
    "op4_byte_bpe": byte_bpe.op4,
    "op5_secret_scan": secrets.op5,
    "op6_warc": warc.op6,
    "op7_packing": packing.op7,
    "op8_matroska": matroska.op8,
    "op9_simhash": simhash.op9,
    "op10_html_text": html_text.op10,
}

ORACLES: dict[str, str] = {"op6_warc": warc.ORACLE}
