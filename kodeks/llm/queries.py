"""Queries of the problems that serve training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kodeks.llm import boilerplate, canon, leakage, markup, packing, pairs, readability, scan, skeleton
from kodeks.session import cut, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defects(table(spark, sf_dir, "questions"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_kinds(table(spark, sf_dir, "questions"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_texts(table(spark, sf_dir, "questions"))


def p2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique runs of the clean contents; all of them come from one host."""
    clean = markup.clean_texts(table(spark, sf_dir, "questions"))
    pages = cut(clean.select(F.lit("questions").alias("host"), F.concat_ws("/", "nro", "field", F.hex(F.xxhash64("text"))).alias("page"), "text"))
    return boilerplate.unique_runs(pages, "host", "page", "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.map_titles(table(spark, sf_dir, "llm_references"), "ref_id", table(spark, sf_dir, "act_catalog"))


def p3_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.title_candidates(table(spark, sf_dir, "llm_references"), "ref_id", table(spark, sf_dir, "act_catalog"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = skeleton.cell_cases(table(spark, sf_dir, "act_chars"))
    titles = skeleton.text_cases(table(spark, sf_dir, "llm_references"), "ref_id", "tytul").distinct()
    return cells.select(F.lit("char").alias("record_kind"), F.col("char_id").alias("record_id")).unionByName(titles.select(F.lit("reference").alias("record_kind"), F.col("ref_id").alias("record_id")))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = skeleton.skeleton_groups(table(spark, sf_dir, "llm_references"), "tytul")
    cells = skeleton.skeleton_groups(table(spark, sf_dir, "act_chars"), "text")
    return cells.select(F.lit("char").alias("record_kind"), "*").unionByName(titles.select(F.lit("reference").alias("record_kind"), "*"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.find_noise(table(spark, sf_dir, "act_pages"))[1]


def p6_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.repaired(table(spark, sf_dir, "act_pages"))


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_sizes"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_ratings"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_clean, p2_runs, p3_found, p3_candidates, p5_found, p5_groups, p6_found, p6_text, p8_pack, p9_found, p10_found)}
SQL: dict[str, str] = {}
