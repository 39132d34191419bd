"""From raw documents to tokens: toxic texts go, one text of each group of near copies stays, passages that an earlier text holds
are cut, texts with benchmark items go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and reads no more than its docs and small side tables. ``run`` writes each stage's rows to
the shared folder and reads them back for the next.

Stages keep rows as they are: NULL and empty texts pass all filters, repeated rows count as copies of one text, columns beyond
the usual ones travel along whatever their names. A text that is wholly cut stays as an empty one.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.llm import bpe, decontaminate, jaccard_join, substring_dedup, toxicity
from idwarden.llm.repeats import keyed
from idwarden.llm.store import save, small, table

TOXIC_FROM = 0.5
RANKS = "byte_bpe_multi_50k.tiktoken"

#: Byte-pair ids and their pre-image have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that no name can clash."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("__")).alias("__rest"))


def _unpacked(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c).alias(c) for c in like.columns))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model of ``labels.toxic`` scores below ``TOXIC_FROM``."""
    model = toxicity.model_for(docs, table(spark, sf_dir, "labels"))
    return _unpacked(toxicity.score(_packed(docs), model, out="__score").where(F.col("__score") < TOXIC_FROM), docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by shingles, the row of the smallest doc_id; texts without words all stay."""
    rows = jaccard_join.groups(docs.select("doc_id", "text"), with_component=True).where("n_shingles > 0")
    rows = save(rows.select("component", F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), "__text", F.col("doc_id").isNull().alias("unnamed")), "near-copies")
    kept = rows.groupBy("component").agg(F.min(F.struct("unnamed", "__id", "__text")).alias("kept")).select("component", "kept.*")
    marks = rows.groupBy("component", "__id", "__text").agg(F.count("*").alias("copies"))
    losers = marks.join(kept.select("__id", "__text", F.lit(True).alias("stays")), ["__id", "__text"], "left").where("stays IS NULL OR copies > 1")
    losers = small(save(losers.select("__id", "__text", F.coalesce("stays", F.lit(False)).alias("stays")), "copies"))
    packed = keyed(_packed(docs), "doc_id", "text", "__rest")
    clear = packed.join(losers, ["__id", "__text"], "left_anti")
    # Rows that occur several times, of which one stays: seldom any.
    repeated = packed.join(losers.where("stays"), ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"])
    return _unpacked(clear.select("doc_id", "text", "__rest").unionByName(repeated.select("doc_id", "text", "__rest")), docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of 50 words or more that a smaller doc_id holds."""
    rows = substring_dedup.remove(_packed(docs))
    cut = F.col("n_removed") > 0
    rows = rows.select("doc_id", F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text"), "__rest", cut.alias("__cut"))
    back = _unpacked(rows, docs) if "n_chars" not in docs.columns else rows.select(*(
        F.when(F.col("__cut"), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__rest.n_chars")).alias(c) if c == "n_chars"
        else F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c).alias(c) for c in docs.columns
    ))
    return back


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``."""
    packed = keyed(_packed(docs), "doc_id", "text", "__rest")
    found = decontaminate.find(packed.select(F.struct("__id", "__text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    holders = small(save(found.select("doc_id.*").distinct(), "benchmark-holders"))
    return _unpacked(packed.join(holders, ["__id", "__text"], "left_anti"), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids (little-endian unsigned 32-bit integers), n_tokens, and digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path(RANKS)
    tokens = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).select("doc_id", "token_ids")
    return bpe.decode(tokens, path).select(
        "doc_id", "token_ids", (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", one_of_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    return reduce(lambda docs, stage: save(stage[1](spark, docs, sf_dir), stage[0]), STAGES, table(spark, sf_dir, "documents"))
