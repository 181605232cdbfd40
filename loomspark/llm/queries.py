"""Queries of this package, by problem, and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .forms import consistent, quotes_seen_by_readers, vocabulary
from .groups import grouped_splits
from .leaks import leaked_items
from .mixing import mix
from .overlaps import cross_split_overlaps, overlap_report
from .pieces import split_oversized
from .replies import Tongues, defective_replies, language_names
from .stuffing import stuffed_pages
from .tongues import fit_profiles

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = split_oversized(table(spark, sf_dir, "documents"), table(spark, sf_dir, "candidates"), with_text=False)
    return pieces.filter(F.col("piece") == 1).select("doc_id", "section").distinct()


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "documents"), table(spark, sf_dir, "candidates"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_splits(table(spark, sf_dir, "utterances")).filter("parted and key is not null").select("key").distinct()


def p2_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_splits(table(spark, sf_dir, "utterances")).select("id", "new_split").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_seen_by_readers(table(spark, sf_dir, "proposed_objects"), table(spark, sf_dir, "documents"))


def p3_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text in consistent form, and whether that changed it."""
    documents, objects = table(spark, sf_dir, "documents"), table(spark, sf_dir, "proposed_objects")
    forms = consistent(documents.select("doc_id", "text"), ["text"], vocabulary(documents.select("text"), objects.select("quote")))
    return forms.select("doc_id", (F.col("text") != F.col("text_form")).alias("changed"), "text_form")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = cross_split_overlaps(table(spark, sf_dir, "utterances"))
    return pairs.select(F.least("id_eval", "id_train").alias("id_a"), F.greatest("id_eval", "id_train").alias("id_b")).distinct()


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_report(cross_split_overlaps(table(spark, sf_dir, "utterances")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes, documents = table(spark, sf_dir, "outcomes"), table(spark, sf_dir, "documents")
    profiles = fit_profiles(documents.select("text", "lang"), outcomes.select("ask", "taught_reply", "untaught_reply"))
    return defective_replies(outcomes, Tongues(profiles, language_names(outcomes, profiles.codes)))


def p6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "exam_items"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_pages(spark, sf_dir).filter("stuffed").select("doc_id").distinct()


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p2_found": p2_found,
    "p2_splits": p2_splits,
    "p3_found": p3_found,
    "p3_forms": p3_forms,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_leaks": p6_leaks,
    "p7_mix": p7_mix,
    "p7_report": p7_report,
    "p8_found": p8_found,
    "p8_pages": p8_pages,
}

SQL: dict[str, str] = {
    "p1_found": """
        SELECT DISTINCT c.doc_id, c.section
        FROM candidates c JOIN documents d ON c.doc_id = d.doc_id
        WHERE length(decode(array_slice(encode(d.text), c.range.start + 1, c.range.stop))) > 1500
    """,
}
