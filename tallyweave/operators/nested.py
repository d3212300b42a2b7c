"""Nested records to flat tables that keep parent-child links, by higher-order projections.

Each function takes rows whose records lie in arrays and returns one flat table; positions count from 1 and count null
elements. Null and empty arrays, null elements and missing keys give no row or null columns, never an error. Nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The parser stops behind the first value; wrapped with this mark, a payload with anything behind its value is told from a valid one.
END = "end of payload"
#: Key of the envelope that holds a feed's records.
ENVELOPES = {"po_master": "purchase_orders", "chart_of_books": "companies"}


def _list(v: str) -> str:
    """SQL: the variant v as an array of variants; a lone object is an array of one, a string may hold either as JSON text.

    Null, scalars and text that is no JSON give an empty array.
    """
    plain = "coalesce(try_variant_get({0}, '$', 'array<variant>'), if(try_variant_get({0}, '$', 'map<string,variant>') is not null, array({0}), null)"
    inner = plain.format(f"try_parse_json(try_variant_get({v}, '$', 'string'))") + ")"
    return f"{plain.format(v)}, {inner}, cast(array() as array<variant>))"


def feed_records(feed: DataFrame, master: str) -> DataFrame:
    """(row_id, recs) of the feed rows of one master: the payload's records as variants. Payloads that are no valid JSON are left out."""
    envelope = ENVELOPES[master]
    return (
        feed.where((F.col("master_name") == master) & F.col("payload").isNotNull())
        .select(F.col("feed_id").alias("row_id"), F.expr(f"try_variant_get(try_parse_json(concat('[', payload, ',\"{END}\"]')), '$', 'array<variant>')").alias("doc"))
        .where(f"size(doc) = 2 and try_variant_get(doc[1], '$', 'string') = '{END}'")
        .select("row_id", F.expr("doc[0]").alias("root"))
        .select("row_id", F.expr(f"if(try_variant_get(root, '$.{envelope}', 'variant') is not null, {_list(f"try_variant_get(root, '$.{envelope}', 'variant')")}, {_list('root')})").alias("recs"))
    )


def _object(v: str) -> str:
    return f"try_variant_get({v}, '$', 'map<string,variant>') is not null"


def _text(v: str, key: str) -> str:
    return f"try_variant_get({v}, '$.{key}', 'string')"


def order_lines(orders: DataFrame) -> DataFrame:
    """po_master: (row_id, po_id, line_pos, line_id, description, quantity, uom, unit_price), one row per non-null line."""
    return orders.selectExpr(
        "po_row_id as row_id", "po_id",
        """inline(filter(transform(po_lines, (l, i) -> if(l is null, null, struct(i + 1 as line_pos, l.line_id as line_id, l.description as description,
           l.quantity as quantity, l.uom as uom, l.unit_price as unit_price))), s -> s is not null))""",
    )


def feed_order_lines(feed: DataFrame) -> DataFrame:
    """Order lines of a feed's payloads: the columns of order_lines and order_pos; every leaf is text."""
    line = f"""struct(p + 1 as order_pos, {_text('o', 'po_id')} as po_id, i + 1 as line_pos, {_text('l', 'line_id')} as line_id, {_text('l', 'description')} as description,
        {_text('l', 'quantity')} as quantity, {_text('l', 'uom')} as uom, {_text('l', 'unit_price')} as unit_price)"""
    lines = _list("try_variant_get(o, '$.po_lines', 'variant')")
    return feed_records(feed, "po_master").selectExpr("row_id", f"inline(filter(flatten(transform(recs, (o, p) -> transform({lines}, (l, i) -> if({_object('l')}, {line}, null)))), s -> s is not null))")


def feed_orders(feed: DataFrame) -> DataFrame:
    """Orders of a feed's payloads: (row_id, order_pos, po_id, po_number, supplier_id, currency, n_lines)."""
    order = f"struct(p + 1 as order_pos, {_text('o', 'po_id')} as po_id, {_text('o', 'po_number')} as po_number, {_text('o', 'supplier_id')} as supplier_id, {_text('o', 'currency')} as currency, size({_list("try_variant_get(o, '$.po_lines', 'variant')")}) as n_lines)"
    return feed_records(feed, "po_master").selectExpr("row_id", f"inline(filter(transform(recs, (o, p) -> if({_object('o')}, {order}, null)), s -> s is not null))")


def orders(po_master: DataFrame) -> DataFrame:
    """po_master without its lines: (row_id, po_id, po_number, supplier_id, currency, n_lines)."""
    return po_master.selectExpr("po_row_id as row_id", "po_id", "po_number", "supplier_id", "currency", "coalesce(size(po_lines), 0) as n_lines")


def locations(books: DataFrame) -> DataFrame:
    """chart_of_books: (row_id, company_code, unit_pos, business_unit_code, location_pos, location_code, location_name, invoice_to_address)."""
    return books.selectExpr(
        "book_row_id as row_id", "company_code",
        """inline(filter(flatten(transform(business_units, (u, i) -> coalesce(transform(u.locations, (l, j) -> if(l is null, null, struct(i + 1 as unit_pos,
           u.business_unit_code as business_unit_code, j + 1 as location_pos, l.location_code as location_code, l.location_name as location_name,
           l.invoice_to_address as invoice_to_address))), array()))), s -> s is not null))""",
    )


def units(books: DataFrame) -> DataFrame:
    """chart_of_books: (row_id, company_code, unit_pos, business_unit_code, business_unit_name, n_locations), one row per non-null unit."""
    return books.selectExpr(
        "book_row_id as row_id", "company_code",
        """inline(filter(transform(business_units, (u, i) -> if(u is null, null, struct(i + 1 as unit_pos, u.business_unit_code as business_unit_code,
           u.business_unit_name as business_unit_name, coalesce(size(u.locations), 0) as n_locations))), s -> s is not null))""",
    )


def companies(books: DataFrame) -> DataFrame:
    """chart_of_books without its units: (row_id, company_code, company_name, n_units)."""
    return books.selectExpr("book_row_id as row_id", "company_code", "company_name", "coalesce(size(business_units), 0) as n_units")


def feed_locations(feed: DataFrame) -> DataFrame:
    """Locations of a feed's payloads: the columns of locations and company_pos."""
    leaf = f"""struct(p + 1 as company_pos, {_text('c', 'company_code')} as company_code, i + 1 as unit_pos, {_text('u', 'business_unit_code')} as business_unit_code,
        j + 1 as location_pos, {_text('l', 'location_code')} as location_code, {_text('l', 'location_name')} as location_name, {_text('l', 'invoice_to_address')} as invoice_to_address)"""
    inner = f"transform({_list("try_variant_get(u, '$.locations', 'variant')")}, (l, j) -> if({_object('l')}, {leaf}, null))"
    mid = f"flatten(transform({_list("try_variant_get(c, '$.business_units', 'variant')")}, (u, i) -> {inner}))"
    return feed_records(feed, "chart_of_books").selectExpr("row_id", f"inline(filter(flatten(transform(recs, (c, p) -> {mid})), s -> s is not null))")


def nodes(books: DataFrame, po_master: DataFrame, feed: DataFrame) -> DataFrame:
    """Every non-null location and order line of the three sources: (src_table, row_id, node_path, parent_key, child_key).

    node_path joins the positions by '.', keys are '' where missing; keys keep their blanks.
    """
    def out(df: DataFrame, table: str, path: list[str], parent: str, child: str) -> DataFrame:
        return df.select(F.lit(table).alias("src_table"), "row_id", F.concat_ws(".", *path).alias("node_path"), F.coalesce(parent, F.lit("")).alias("parent_key"), F.coalesce(child, F.lit("")).alias("child_key"))

    parts = [
        out(locations(books), "chart_of_books", ["unit_pos", "location_pos"], "business_unit_code", "location_code"),
        out(order_lines(po_master), "po_master", ["line_pos"], "po_id", "line_id"),
        out(feed_locations(feed), "master_feed", ["company_pos", "unit_pos", "location_pos"], "business_unit_code", "location_code"),
        out(feed_order_lines(feed), "master_feed", ["order_pos", "line_pos"], "po_id", "line_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
