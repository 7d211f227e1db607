"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprint, lines, manifest, minhash, mixing, search, sharding, simhash, substrings, toxicity, wavelet, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_minhash": minhash.op2_minhash,
    "op3_sharding": sharding.op3_sharding,
    "op4_lines": lines.op4_lines,
    "op5_bpe": bpe.op5_bpe,
    "op6_topk": search.op6_topk,
    "op7_wavelet": wavelet.op7_wavelet,
    "op8_substrings": substrings.op8_substrings,
    "op9_mixing": mixing.op9_mixing,
    "op10_merkle": fingerprint.op10_merkle,
    "op11_simhash": simhash.op11_simhash,
    "op12_manifest": manifest.op12_manifest,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_lines": lines.OP4_SQL,
    "op6_topk": search.OP6_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_merkle": fingerprint.OP10_SQL,
    "op12_manifest": manifest.OP12_SQL,
}
