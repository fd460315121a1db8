"""The queries of the training-data operators and the SQL that some of them can be held against."""

from __future__ import annotations

from . import binary, lines, mixing, ngram_join, packing, pii, quality, sharding, topk, urls

QUERIES = {
    "op1_packing": packing.op1,
    "op2_mixing": mixing.op2,
    "op3_ans_files": binary.op3,
    "op4_ngram_join": ngram_join.op4,
    "op5_url_rules": urls.op5,
    "op6_host_rules": quality.op6,
    "op7_hamming_top_k": topk.op7,
    "op8_sharding": sharding.op8,
    "op9_line_dedup": lines.op9,
    "op10_personal_data": pii.op10,
}

ORACLES = {
    "op4_ngram_join": ngram_join.OP4_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op5_url_rules": urls.OP5_SQL,
    "op6_host_rules": quality.OP6_SQL,
    "op7_hamming_top_k": topk.OP7_SQL,
    "op9_line_dedup": lines.OP9_SQL,
}
