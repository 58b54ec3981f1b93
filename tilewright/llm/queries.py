"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, itq, lines, lmscore, merkle, mixing, quality, simhash, sql, tokencount, topk, trie, urlrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": topk.op1_topk,
    "op2_simhash": simhash.op2_simhash,
    "op3_urlrules": urlrules.op3_urlrules,
    "op4_bpe": bpe.op4_bpe,
    "op5_quality": quality.op5_quality,
    "op6_tokencount": tokencount.op6_tokencount,
    "op7_merkle": merkle.op7_merkle,
    "op8_lmscore": lmscore.op8_lmscore,
    "op9_lines": lines.op9_lines,
    "op10_mixing": mixing.op10_mixing,
    "op11_itq": itq.op11_itq,
    "op12_divergence": divergence.op12_divergence,
    "op13_trie": trie.op13_trie,
}

ORACLE_SQL: dict[str, str] = {"op1_topk": sql.OP1, "op3_urlrules": sql.OP3, "op7_merkle": sql.OP7, "op12_divergence": sql.OP12, "op13_trie": sql.OP13}
