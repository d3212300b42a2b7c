"""Queries of the llm subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import addresses, entities, language, leaks, packing, pieces
from tallyweave.sources.tables import table


def _address_records(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "suppliers").select(F.concat(F.lit("sup:"), F.col("supplier_row_id").cast("string")).alias("rec"), "address")
    b = table(spark, d, "location_records").select(F.concat(F.lit("loc:"), F.col("location_row_id").cast("string")).alias("rec"), F.col("invoice_to_address").alias("address"))
    return a.unionByName(b)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return addresses.location_pairs(_address_records(spark, d))


def p5_locations(spark: SparkSession, d: str) -> DataFrame:
    """Each address record with its location."""
    return addresses.locations(_address_records(spark, d))


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Observations with the suppliers they name and the confidence."""
    return entities.match_entities(table(spark, d, "observed_supplier_identity"), table(spark, d, "suppliers"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("obs_id", "supplier_id").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return language.label_findings(table(spark, d, "documents"), table(spark, d, "document_inventory"))


def p4_languages(spark: SparkSession, d: str) -> DataFrame:
    """Main language of each document and language of each paragraph, with confidences."""
    return language.languages(table(spark, d, "documents"))


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items that they hold, the words held in order, their share of the item, and the words held in any order."""
    return leaks.leaks(table(spark, d, "eval_items"), table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage in the item's order; reordered ones are in p8_leaks only."""
    return p8_leaks(spark, d).where("n_words > 0").select("item_id", "doc_id").distinct()


def budget(spark: SparkSession, d: str, name: str) -> tuple[int, int]:
    """(max_tokens, overlap_tokens) of a budget."""
    r = table(spark, d, "size_budgets").where(F.col("budget_name") == name).first()
    return r["max_tokens"], r["overlap_tokens"]


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """A container number for each document, several for one above the budget."""
    return packing.pack(table(spark, d, "documents"), budget(spark, d, "container")[0])


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, the least that any packing needs, and the share of room used."""
    most = budget(spark, d, "container")[0]
    return p7_containers(spark, d).agg(
        F.countDistinct("container_no").alias("containers"), F.ceil(F.sum("n_tokens") / most).alias("at_least"), (F.sum("n_tokens") / (F.countDistinct("container_no") * most)).alias("fill")
    )


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Ordered pieces of the documents above the budget."""
    return pieces.split_documents(table(spark, d, "documents"), *budget(spark, d, "piece"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_pieces(spark, d).where("piece_no = 1").select("doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p4_found, p4_languages, p5_found, p5_locations, p7_containers, p7_fill, p8_found, p8_leaks, p9_found, p9_pieces)}
SQL = {
    "p9_found": r"select doc_id from documents where len(regexp_extract_all(text, '[\pL\pN_]+|[^\pL\pN_\s\pZ]+')) > (select max_tokens from size_budgets where budget_name = 'piece')",
}
