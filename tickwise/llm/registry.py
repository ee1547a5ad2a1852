"""Registered queries of the llm operators and their SQL."""

from __future__ import annotations

from . import centroids, decontam, extract, mixing, neardup, periods, quality, secret_scan, sharding, substrings, topk, toxicity, urlfilter

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_mixing": mixing.op2_mixing,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_urlfilter": urlfilter.op4_urlfilter,
    "op5_decontam": decontam.op5_decontam,
    "op6_sharding": sharding.op6_sharding,
    "op7_secrets": secret_scan.op7_secrets,
    "op8_neardup": neardup.op8_neardup,
    "op9_extract": extract.op9_extract,
    "op10_quality": quality.op10_quality,
    "op11_centroids": centroids.op11_centroids,
    "op12_substrings": substrings.op12_substrings,
    "op13_periods": periods.op13_periods,
}
SQL = {
    "op1_topk": topk.SQL,
    "op2_mixing": mixing.SQL,
    "op4_urlfilter": urlfilter.SQL,
    "op5_decontam": decontam.SQL,
    "op8_neardup": neardup.SQL,
    "op11_centroids": centroids.SQL,
    "op12_substrings": substrings.SQL,
}
