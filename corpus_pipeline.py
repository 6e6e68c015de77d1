"""Corpus preparation: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes the documents its predecessor kept and, but for the last, returns them
with the same columns, whatever their names; n_chars follows the text where it is there.
Rows that share a doc_id are one document to line dedup and near-dedup; repeated rows
stay or go together. A row with a null doc_id is compared with no other. An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import op01_packing, op03_setsketch, op04_language, op07_lines, op08_fmindex
from factweave.llm._store import written


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and one struct of all other columns: no operator replaces those."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("own"))


def _unpacked(found: DataFrame, docs: DataFrame, changed: Column) -> DataFrame:
    """The columns of ``docs`` again; n_chars is counted anew where ``changed`` holds."""

    def column(name: str) -> Column:
        if name in ("doc_id", "text"):
            return F.col(name)
        own = F.col("own").getField(name)
        return F.when(changed, F.length("text")).otherwise(own).cast(docs.schema[name].dataType) if name == "n_chars" else own

    return found.select(*[column(c).alias(c) for c in docs.columns])


#: A text of so many letters whose cosine with every language is below this is none: vectors
#: of noise have cosines of 0.03 in 1,024 dimensions, so this is three deviations.
JUDGED_LETTERS, LEAST_COSINE = 100, 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: null texts and those without a letter go, and so do texts of
    JUDGED_LETTERS letters that are near no prototype. A null lang becomes the prediction.
    Where no language was learned (or ``docs`` has no lang) every text with a letter stays
    as it is. A text of any length is read whole, in some 60 times its bytes."""
    named = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))
    learned = op04_language.learn(named)
    if not learned.limit(1).count():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = op04_language.predict(_packed(docs), learned)
    letters = F.length(F.regexp_replace("text", r"\P{L}", ""))
    kept = found.where((F.col("lang_pred") != "und") & ~((F.col("cosine") < LEAST_COSINE) & (letters >= JUDGED_LETTERS)))
    own = lambda c: F.col(c) if c in ("doc_id", "text") else F.col("own").getField(c)
    filled = lambda c: F.coalesce(own(c), F.col("lang_pred").cast(docs.schema[c].dataType)) if c == "lang" else own(c)
    return kept.select(*[filled(c).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines. One whose lines all were later
    copies goes."""
    found = op07_lines.remove_repeats(_packed(docs))
    cut = F.col("n_removed") > 0
    kept = found.where(~(cut & (F.btrim("text", F.lit(op07_lines.BLANK + "\n")) == "")))
    return _unpacked(kept, docs, cut)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the least id. Documents
    are linked as the near-dedup query links them: sets of two-word shingles, 0.8."""
    found = op03_setsketch.near_duplicates(docs.select("doc_id", "text"), shingle=2, percent=80)
    lost = written(found.where("not kept and component_id is not null").select("doc_id").distinct())
    if lost.count() <= op03_setsketch.BROADCAST_IDS:
        lost = F.broadcast(lost)
    return docs.join(lost, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words of benchmark windows cut out. One of which no word is
    left goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = op08_fmindex.remove_spans(_packed(docs), benchmark)
    cut = F.col("n_hit") > 0
    return _unpacked(found.where(~(cut & (F.col("n_hit") == F.col("n_words")))), docs, cut)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as the packing query returns them."""
    return op01_packing.with_crc32(op01_packing.pack(docs, op01_packing.default_tokenizer()))


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Language prototypes, suffix ranks and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
