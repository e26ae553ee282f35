"""The operators' queries and their SQL, as the entry module offers them."""

from __future__ import annotations

import corpus_pipeline
from loomgraph.llm import bpe, codes, decontaminate, licenses, mix, near, pii, quality, ranking, tokens, topk, toxicity, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_mix": mix.op2_mix,
        "op3_near_duplicates": near.op3_near_duplicates,
        "op4_licenses": licenses.op4_licenses,
        "op5_tokens": tokens.op5_tokens,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_decontaminate": decontaminate.op7_decontaminate,
        "op8_quality": quality.op8_quality,
        "op9_pii": pii.op9_pii,
        "op10_top_k": topk.op10_top_k,
        "op11_vector_codes": codes.op11_vector_codes,
        "op12_bpe": bpe.op12_bpe,
        "op13_ranking": ranking.op13_ranking,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op1_warc": warc.SQL, "op2_mix": mix.SQL, "op3_near_duplicates": near.SQL, "op7_decontaminate": decontaminate.SQL, "op10_top_k": topk.SQL, "op11_vector_codes": codes.SQL, "op13_ranking": ranking.SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in sql.items() if v}
