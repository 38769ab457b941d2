"""Queries of the operators, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, codec, decontaminate, htmltext, langid, lemp, neardup, repair, syncmers, tokencount, toxicity, urlfilter, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": lambda s, d: warc.op1(s, table(s, d, "pages")),
    "op2_syncmers": lambda s, d: syncmers.op2(s, table(s, d, "documents")),
    "op3_toxicity": lambda s, d: toxicity.op3(s, table(s, d, "documents"), table(s, d, "labels")),
    "op4_decontaminate": lambda s, d: decontaminate.op4(s, table(s, d, "documents"), table(s, d, "benchmark")),
    "op5_neardup": lambda s, d: neardup.op5(s, table(s, d, "documents")),
    "op6_url_filter": lambda s, d: urlfilter.op6(s, table(s, d, "pages")),
    "op7_token_counts": lambda s, d: tokencount.op7(s, table(s, d, "documents")),
    "op8_sentencepiece": lambda s, d: codec.op8(s, table(s, d, "documents")),
    "op9_html": lambda s, d: htmltext.op9(s, table(s, d, "pages")),
    "op10_chat": lambda s, d: chat.op10(s, table(s, d, "conversations")),
    "op11_lemp": lambda s, d: lemp.op11(s, table(s, d, "documents"), table(s, d, "benchmark")),
    "op12_repair": lambda s, d: repair.op12(s, table(s, d, "conversations")),
    "op13_langid": lambda s, d: langid.op13(s, table(s, d, "documents")),
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.OP1_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op5_neardup": neardup.OP5_SQL,
    "op10_chat": chat.OP10_SQL,
    "op11_lemp": lemp.OP11_SQL,
    "op12_repair": repair.OP12_SQL,
}
