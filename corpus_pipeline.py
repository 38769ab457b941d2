"""A corpus from ``documents``: toxic texts out, one of each group of near copies, benchmark passages out, encoded.

Cases, for every stage: rows with a null id or text stay unless the stage's rule takes them; an empty text is not toxic by itself, in no group of near
copies, and not contaminated, and encodes to no ids; very long texts are judged whole; no rows give no rows; columns beyond those of ``documents`` are ignored. Of repeated
rows the second stage leaves one, if they hold words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import codec, decontaminate, neardup, toxicity
from foliant.llm.common import keep, table
from foliant.llm.pieces import load_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts that score below the threshold. The classifier is fitted to a bounded sample of labelled rows of ``docs``; without labels of both classes it keeps all."""
    rows = docs.select(*COLUMNS)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(rows, model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, of the least id in it: five-word shingles, similarity 0.8. A null id counts only where a group has no other."""
    # the written mark is unique and stays the same, so that rows that are repeated can be told apart
    rows = keep(docs.select(*COLUMNS).withColumn("mark", F.monotonically_increasing_id()), "marked")
    found = neardup.near_duplicates(rows, mark="mark")
    one = found.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("root").agg(F.min(F.struct("node", "row")).alias("of")).select("of.row")
    # texts without words are in no group, so each of them stays
    marks = one.unionByName(found.where("n_shingles = 0").select("row"))
    return rows.join(marks, rows["mark"] == marks["row"], "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark passages cover a twentieth or more of the words; items that are null or repeat change nothing."""
    found = decontaminate.find_items(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return decontaminate.judge(found).where(~F.col("contaminated")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids) of each document; a null text has no ids."""
    rows = docs.select("doc_id", "text")
    return codec.encode(rows, load_pieces()).select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("encoding", encode),
]

#: The classifier and the encoder can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
