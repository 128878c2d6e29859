"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from recsmith.llm import (bpe, byte_bpe, embedding_dedup, hard_negatives, mixing, quality, secret_scan, simhash, token_counts, topk,
                          toxicity, warc, whitening)
from recsmith.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_warc": warc.op1_warc,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_simhash": simhash.op3_simhash,
    "op4_mixing": mixing.op4_mixing,
    "op5_quality": quality.op5_quality,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_topk": topk.op9_topk,
    "op10_secrets": secret_scan.op10_secrets,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_whitening": whitening.op12_whitening,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op4_mixing": mixing.oracle(),
    "op9_topk": topk.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
