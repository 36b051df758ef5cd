"""Queries of the training-data operators: name -> fn(spark, sf_dir), and DuckDB
SQL for those that SQL can express."""

from __future__ import annotations

from tastemesh.llm import (bagminhash, fertility, heapbpe, iblt, lines, manifest, packing, ring,
                           toolcalls, transducer, wavelet, weaklabel, whitening)

QUERIES = {f.__name__: f for f in (
    packing.op1_vector_best_fit_packing,
    iblt.op2_invertible_bloom_fingerprints,
    wavelet.op3_wavelet_matrix_shards,
    fertility.op4_tokeniser_fertility,
    weaklabel.op5_weak_label_scorer,
    ring.op6_bounded_load_ring,
    lines.op7_rarity_prefix_line_dedup,
    transducer.op8_transducer_bpe,
    toolcalls.op9_tool_call_linking,
    bagminhash.op10_bagminhash_near_dedup,
    manifest.op11_postorder_merkle_manifest,
    heapbpe.op12_heap_token_counts,
    whitening.op13_jacobi_davidson_whitening,
)}

ORACLE: dict[str, str] = {
    "op2_invertible_bloom_fingerprints": iblt.OP2_SQL,
    "op7_rarity_prefix_line_dedup": lines.OP7_SQL,
    "op9_tool_call_linking": toolcalls.OP9_SQL,
    "op11_postorder_merkle_manifest": manifest.OP11_SQL,
}
