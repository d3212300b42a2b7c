"""The five master tables together, with lookups by normalised keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.sources import files

#: Lookups: name -> (table, column or path, how its key is normalised).
LOOKUPS = {
    "supplier_by_id": ("suppliers", "supplier_id", X.code_key), "supplier_by_vat": ("suppliers", "vat_id", X.identifier_key), "supplier_by_name": ("suppliers", "name", X.name_key), "supplier_by_email": ("suppliers", "email", lambda c: F.lower(X.code_key(c))), "supplier_by_iban": ("suppliers", "bank_iban", X.account_key),
    "company_by_code": ("chart_of_books", "company_code", X.code_key), "company_by_name": ("chart_of_books", "company_name", X.name_key),
    "tax_by_code": ("tax_master", "code", X.code_key), "taxes_by_country": ("tax_master", "country", lambda c: F.upper(X.code_key(c))), "taxes_by_name": ("tax_master", "name", X.name_key),
    "term_by_id": ("payment_terms", "payment_term_id", X.code_key), "terms_by_days": ("payment_terms", "days", lambda c: c.cast("string")),
    "po_by_id": ("po_master", "po_id", X.code_key), "pos_by_number": ("po_master", "po_number", X.code_key), "pos_by_supplier": ("po_master", "supplier_id", X.code_key),
}


@dataclass(frozen=True)
class MasterStore:
    """Master tables by name; each is read only when asked for."""

    tables: dict[str, DataFrame]

    @staticmethod
    def from_folder(spark: SparkSession, folder: str, names: tuple[str, ...] = tuple(files.MASTERS), check: bool = True) -> MasterStore:
        """From JSON files `name`.json in a folder; with check, missing or repeated keys raise."""
        loaded = {n: files.master(spark, f"{folder}/{n}.json", n) for n in names}
        return MasterStore({n: files.checked(df, n) if check else df for n, df in loaded.items()})

    @staticmethod
    def from_records(spark: SparkSession, **records: list[dict]) -> MasterStore:
        """From lists of records by table name; missing fields are null, unknown ones raise."""
        out = {}
        for name, rows in records.items():
            schema = spark.createDataFrame([], files.MASTERS[name]).schema
            unknown = {k for r in rows for k in r} - set(schema.names)
            if unknown:
                raise ValueError(f"{name}: unknown fields {sorted(unknown)}")
            out[name] = spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)
        return MasterStore(out)

    def find(self, lookup: str, key: str | int) -> DataFrame:
        """Rows of one of LOOKUPS whose normalised key equals that of `key`; none for null and blank ones."""
        name, column, normal = LOOKUPS[lookup]
        of: Column = normal(F.col(column))
        return self.tables[name].where((of == normal(F.lit(str(key)))) & (of != ""))

    def index(self, lookup: str) -> DataFrame:
        """(key, n_rows) of a lookup's table: how many rows stand under each normalised key, null and blank ones left out."""
        name, column, normal = LOOKUPS[lookup]
        return self.tables[name].groupBy(normal(F.col(column)).alias("key")).agg(F.count(F.lit(1)).alias("n_rows")).where("key <> ''")
