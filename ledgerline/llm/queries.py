"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from ledgerline.llm import (bpe, covertree, lm, manifest, packing, pieces, pii, quality, sharding, simhash, spelling,
                            toxicity, warc)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_bpe": bpe.op2_bpe,
    "op3_lm": lm.op3_lm,
    "op4_covertree": covertree.op4_covertree,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_simhash": simhash.op6_simhash,
    "op7_warc": warc.op7_warc,
    "op8_pii": pii.op8_pii,
    "op9_packing": packing.op9_packing,
    "op10_sharding": sharding.op10_sharding,
    "op11_manifest": manifest.op11_manifest,
    "op12_pieces": pieces.op12_pieces,
    "op13_spelling": spelling.op13_spelling,
}

ORACLE = {"op4_covertree": covertree.OP4_SQL, "op7_warc": warc.OP7_SQL,
          "op11_manifest": manifest.OP11_SQL}
