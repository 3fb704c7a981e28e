"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from penprint.llm import collocations, compression, decontaminate, mixing, near, pages, pitman_yor, records, repair, revisits, rules, toxicity, vectors

QUERIES = {
    "op1_pages": pages.op1_pages,
    "op2_records": records.op2_records,
    "op3_revisits": revisits.op3_revisits,
    "op4_mix": mixing.op4_mix,
    "op5_quality": compression.op5_quality,
    "op6_near": near.op6_near,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_pitman_yor": pitman_yor.op8_pitman_yor,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_vectors": vectors.op10_vectors,
    "op11_collocations": collocations.op11_collocations,
    "op12_rules": rules.op12_rules,
    "op13_repair": repair.op13_repair,
}

ORACLES = {
    "op3_revisits": revisits.SQL,
    "op4_mix": mixing.SQL,
    "op11_collocations": collocations.SQL,
    "op12_rules": rules.SQL,
    "op13_repair": repair.SQL,
}
