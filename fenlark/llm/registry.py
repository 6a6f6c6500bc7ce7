"""The training-data queries and, where SQL can express them, the SQL that gives the same rows."""

from __future__ import annotations

from . import ann, decontaminate, divergence, licenses, minhash, mtree, periodic, pieces, pii, quality, secrets, sql, suffix_dedup, warc

QUERIES = {
    f.__name__: f
    for f in (
        decontaminate.op1_decontaminate,
        pii.op2_pii_weak_supervision,
        pieces.op3_sentencepiece,
        suffix_dedup.op4_suffix_array_dedup,
        minhash.op5_minhash_near_dedup,
        secrets.op6_secret_scan,
        warc.op7_warc,
        quality.op8_quality_classifier,
        licenses.op9_license_diagonals,
        ann.op10_cross_polytope_ann,
        mtree.op11_mtree_topk,
        periodic.op12_periodic_runs,
        divergence.op13_source_divergence,
    )
}

ORACLES: dict[str, str] = {"op5_minhash_near_dedup": sql.NEAR_DUPLICATES, "op7_warc": warc.SQL, "op11_mtree_topk": mtree.SQL, "op13_source_divergence": divergence.SQL}
