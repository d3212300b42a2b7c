import json

from tallyweave.operators import nested
from tallyweave.sources.files import MASTERS

BOOK = "book_row_id long, row_id string, " + MASTERS["chart_of_books"] + ", l string"
PO = "po_row_id long, row_id string, " + MASTERS["po_master"] + ", i string"


def unit(code, locs):
    return {"business_unit_code": code, "business_unit_name": None, "locations": locs}


def loc(code):
    return {"location_code": code, "location_name": "n", "invoice_to_address": None}


def test_books_and_orders(spark):
    books = spark.createDataFrame([(1, "x", "c", "n", [unit("u1", [loc("a"), None, loc(None)]), None, unit(None, None), unit("u4", []), unit("u5", [loc("b")])], "z"), (2, "x", None, None, None, "z"), (3, "x", "c", "n", [], "z")], BOOK)
    got = [(r.row_id, r.unit_pos, r.business_unit_code, r.location_pos, r.location_code) for r in nested.locations(books).collect()]
    assert got == [(1, 1, "u1", 1, "a"), (1, 1, "u1", 3, None), (1, 5, "u5", 1, "b")]
    assert [(r.row_id, r.unit_pos, r.n_locations) for r in nested.units(books).collect()] == [(1, 1, 3), (1, 3, 0), (1, 4, 0), (1, 5, 1)]
    assert [r.n_units for r in nested.companies(books).collect()] == [5, 0, 0]
    line = {"line_id": "1", "description": None, "quantity": None, "uom": None, "unit_price": None}
    po = spark.createDataFrame([(1, "x", "p", None, None, None, [None, line, line], "z"), (2, "x", None, None, None, None, None, "z")], PO)
    assert [(r.row_id, r.line_pos, r.line_id) for r in nested.order_lines(po).collect()] == [(1, 2, "1"), (1, 3, "1")]
    assert [r.n_lines for r in nested.orders(po).collect()] == [3, 0]
    assert nested.order_lines(po.limit(0)).count() == 0 and nested.locations(books.limit(0)).count() == 0


def test_feed_shapes(spark):
    line = {"line_id": 10, "ext": {"a": [1]}}
    payloads = [
        {"po_id": "P", "po_lines": [line, None, {"line_id": "x"}]},
        {"purchase_orders": [{"po_id": "A", "po_lines": line}, {"po_lines": json.dumps([line, line])}], "meta": None},
        [{"po_id": "L", "po_lines": None}, {"po_id": "M", "po_lines": []}, {"po_id": "N", "po_lines": [{}]}],
    ]
    rows = [(i, "po_master", json.dumps(p)) for i, p in enumerate(payloads)]
    rows += [(90, "po_master", '{"po_id": "P", "po_lines": [{"line'), (91, "po_master", json.dumps(payloads[0]) + " x"), (92, "po_master", None), (93, None, "{}"), (94, "po_master", ""), (95, "po_master", "7")]
    feed = spark.createDataFrame(rows, "feed_id long, master_name string, payload string")
    got = [(r.row_id, r.order_pos, r.po_id, r.line_pos, r.line_id) for r in nested.feed_order_lines(feed).collect()]
    assert sorted(got, key=str) == sorted([(0, 1, "P", 1, "10"), (0, 1, "P", 3, "x"), (1, 1, "A", 1, "10"), (1, 2, None, 1, "10"), (1, 2, None, 2, "10"), (2, 3, "N", 1, None)], key=str)
    assert nested.feed_orders(feed).count() == 6
    book = {"companies": [{"company_code": "c", "business_units": {"business_unit_code": "u", "locations": json.dumps([loc("a"), loc(None)])}}]}
    feed = spark.createDataFrame([(1, "chart_of_books", json.dumps(book))], "feed_id long, master_name string, payload string")
    empty_books, empty_po = spark.createDataFrame([], BOOK), spark.createDataFrame([], PO)
    assert sorted(map(tuple, nested.nodes(empty_books, empty_po, feed).collect())) == [("master_feed", 1, "1.1.1", "u", "a"), ("master_feed", 1, "1.1.2", "u", "")]
