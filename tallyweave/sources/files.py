"""Readers of files, page JSON and master data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = """document string, page int, image string, image_width int, image_height int, engine string, language string, status string, error string,
    blocks array<struct<text:string,confidence:double,bbox:array<int>,polygon:array<array<int>>>>"""
MASTERS = {
    "suppliers": "supplier_id string, name string, vat_id string, country string, email string, address string, bank_iban string",
    "chart_of_books": "company_code string, company_name string, business_units array<struct<business_unit_code:string,business_unit_name:string,locations:array<struct<location_code:string,location_name:string,invoice_to_address:string>>>>",
    "tax_master": "code string, country string, tax_type string, rate double, name string",
    "payment_terms": "payment_term_id string, days int, text_aliases array<string>",
    "po_master": "po_id string, po_number string, supplier_id string, currency string, po_lines array<struct<line_id:string,description:string,quantity:double,uom:string,unit_price:string>>",
}
KEYS = {"suppliers": ["supplier_id"], "chart_of_books": ["company_code"], "tax_master": ["code"], "payment_terms": ["payment_term_id"], "po_master": ["po_id"]}


def discover(spark: SparkSession, folder: str, pattern: str = "*.pdf", content: bool = False) -> DataFrame:
    """(path, file_name, stem, n_bytes, modified_at[, content]) of files below a folder. Contents are not read unless asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    cols = ["path", name.alias("file_name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified_at")]
    return df.select(*cols, *(["content"] if content else []))


def in_order(files: DataFrame) -> DataFrame:
    """Files with their place in the order of lower-case paths, and the first number of the stem."""
    return files.withColumn("page_number", F.regexp_extract("stem", r"\d+", 0).try_cast("int")).orderBy(F.lower("path"))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Evidence rows (doc_id, page, block_index, content, confidence, x0, y0, x1, y1, source) of page JSON files; failed pages have none."""
    raw = spark.read.schema(PAGE).option("multiLine", True).json(path)
    rows = raw.where("coalesce(status, 'success') = 'success'").select(F.col("document").alias("doc_id"), "page", F.posexplode("blocks").alias("block_index", "b"))
    box = [F.try_element_at("b.bbox", F.lit(i + 1)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select("doc_id", "page", "block_index", F.col("b.text").alias("content"), F.col("b.confidence").alias("confidence"), *box, F.lit("ocr").alias("source"))


def master(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A master table from a JSON array under its schema; malformed files fail at once, keys that are missing or repeat when checked."""
    return spark.read.schema(MASTERS[name]).option("multiLine", True).option("mode", "FAILFAST").json(path)


def checked(df: DataFrame, name: str) -> DataFrame:
    """df, or an error that names one key that is missing or repeats."""
    keys = KEYS[name]
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or " + " or ".join(f"coalesce(trim({k}), '') = ''" for k in keys)).take(1)
    if bad:
        raise ValueError(f"{name}: key missing or repeated: {bad[0]}")
    return df
