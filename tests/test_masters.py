from decimal import Decimal

from tallyweave.operators import issues as I
from tallyweave.operators import masters as M
from tallyweave.operators import pages as P


def outcome(df):
    return {r.obs_id: (r.status, r.master_id, r.method) for r in df.collect()}


def test_suppliers(spark):
    keys = "vat string, name string, email string, iban string, country string"
    master = spark.createDataFrame([("A", "V1", "alpha", "a@x", "I1", "DE"), ("B", "V2", "beta", "b@x", "I2", "FR"), ("C", "V3", "beta", "c@x", "I2", "DE"), ("D", "V3", "delta", None, None, None), ("A", "V1", "alpha", "a@x", "I1", "DE")], f"cand_id string, {keys}")
    seen = [
        (1, "V1", None, None, None, None), (2, "V1", None, None, None, "FR"), (3, "V1", "beta", None, None, None), (4, "V3", None, None, None, None), (5, "V3", None, None, None, "DE"), (6, "V9", "beta", None, None, "DE"),
        (7, None, "beta", None, None, None), (8, None, "alpha", None, None, "FR"), (9, None, None, "a@x", None, "FR"), (10, None, None, "a@x", None, None), (11, None, None, None, "I2", None), (12, None, None, None, None, "DE"), (13, "", "", None, "I1", "DE"), (14, None, "delta", None, None, None),
    ]
    assert outcome(M.match_suppliers(spark.createDataFrame(seen, f"obs_id long, {keys}"), master)) == {
        1: ("matched", "A", "exact_vat_id"), 2: ("ambiguous", None, "conflicting_vat_and_country"), 3: ("ambiguous", None, "conflicting_identity_evidence"), 4: ("ambiguous", None, "ambiguous_vat_id"),
        5: ("matched", "C", "exact_vat_id"), 6: ("matched", "C", "exact_normalized_name_country"), 7: ("ambiguous", None, "ambiguous_normalized_name"), 8: ("ambiguous", None, "conflicting_name_and_country"),
        9: ("ambiguous", None, "conflicting_email_and_country"), 10: ("matched", "A", "exact_email"), 11: ("ambiguous", None, "ambiguous_iban"), 12: ("no_match", None, "none"), 13: ("matched", "A", "exact_iban"), 14: ("matched", "D", "exact_normalized_name"),
    }
    assert M.match_suppliers(spark.createDataFrame(seen, f"obs_id long, {keys}"), master.limit(0)).where("status <> 'no_match'").count() == 0


def test_buyers(spark):
    places = spark.createDataFrame([("L1", "north", "U1", "C1"), ("L1", "north", "U2", "C1"), ("L2", "south", "U1", "C1"), ("L3", "east", "U3", "C2")], "location_code string, location_name string, bu_code string, company_code string")
    units = spark.createDataFrame([("1", "U1", "sales", "C1", None), ("2", "U2", "stock", "C1", "L1"), ("3", "U3", "sales", "C2", "L3"), ("4", "U1", "renamed", "C3", None)], "ordinal string, bu_code string, bu_name string, company_code string, only_location string")
    companies = spark.createDataFrame([("1", "C1", "one ltd"), ("2", "C2", "two ltd"), ("3", "C9", "one ltd")], "ordinal string, company_code string, company_name string")
    cols = ["location_code", "location_name", "address", "bu_code", "bu_name", "company_code", "company_name"]
    seen = {
        1: ("L2",), 2: ("L1",), 3: ("L1", None, None, "U2"), 4: ("L1", None, None, "U9"), 5: ("L2", None, None, None, None, "C2"), 6: (None, "east"), 7: ("L9",), 8: (None, None, "some street"), 9: ("L1", None, None, None, "stock"), 10: ("L1", None, None, None, "nothing"),
        11: (None, None, None, "U2"), 12: (None, None, None, None, "sales"), 13: (None, None, None, None, "sales", "C2"), 14: (None, None, None, "U2", None, "C2"), 15: (None, None, None, "U8"), 16: (None,) * 5 + ("C1",), 17: (None,) * 6 + ("one ltd",), 18: (None,) * 5 + ("C8", "one ltd"), 19: (), 20: (None, None, None, "U1", None, "C1"),
    }
    rows = [(k, *v, *(None,) * (7 - len(v))) for k, v in seen.items()]
    got = outcome(M.match_buyers(spark.createDataFrame(rows, "obs_id long, " + ", ".join(f"{c} string" for c in cols)), places, units, companies))
    assert got == {
        1: ("matched", "L2", "exact_location_code"), 2: ("ambiguous", None, "ambiguous_location_code"), 3: ("matched", "L1", "hierarchical_location"), 4: ("ambiguous", None, "conflicting_bu_and_location"), 5: ("ambiguous", None, "conflicting_company_and_location"),
        6: ("matched", "L3", "exact_location_code"), 7: ("no_match", None, "none"), 8: ("no_match", None, "none"), 9: ("matched", "L1", "hierarchical_location"), 10: ("ambiguous", None, "ambiguous_location_code"),
        11: ("matched", "L1", "exact_business_unit_code"), 12: ("ambiguous", None, "ambiguous_business_unit"), 13: ("matched", "L3", "exact_normalized_bu_name"), 14: ("ambiguous", None, "conflicting_company_and_bu"), 15: ("no_match", None, "none"),
        16: ("matched", "C1", "exact_company_code"), 17: ("matched", "C1", "exact_company_name"), 18: ("no_match", None, "none"), 19: ("no_match", None, "none"), 20: ("matched", "U1", "exact_business_unit_code"),
    }


def test_taxes(spark):
    d = Decimal
    master = spark.createDataFrame([("A", "DE", "VAT", "full", d(19)), ("B", "DE", "VAT", "low", d(7)), ("C", "DE", "LEVY", "low", d(7)), ("E", "DE", "VAT", "extra", d(7)), ("F", "FR", "VAT", "full", d(20))], "code string, country string, kind string, name string, rate decimal(18,6)")
    seen = [
        (1, "A", None, None, None, None), (2, "A", "FR", None, None, None), (3, "A", "DE", "VAT", "low", d(19)), (4, "Z", "DE", "VAT", "full", d(19)), (5, None, "DE", "VAT", None, d(19)), (6, None, "DE", "VAT", None, d(7)), (7, None, "DE", "VAT", "full", d(7)),
        (8, None, "DE", None, "full", d(19)), (9, None, "DE", None, "full", d(7)), (10, None, "DE", None, "full", None), (11, None, "DE", None, "low", None), (12, None, "DE", None, None, d(19)), (13, None, None, "VAT", "full", d(19)), (14, "A", "DE", None, "unheard", d(19)), (15, None, "DE", None, "low", d(7)),
    ]
    got = outcome(M.match_taxes(spark.createDataFrame(seen, "obs_id long, code string, country string, kind string, name string, rate decimal(18,6)"), master))
    assert got == {
        1: ("matched", "A", "exact_tax_code"), 2: ("ambiguous", None, "conflicting_tax_code_and_properties"), 3: ("ambiguous", None, "conflicting_tax_code_and_properties"), 4: ("no_match", None, "none"), 5: ("matched", "A", "exact_country_tax_type_rate"),
        6: ("ambiguous", None, "ambiguous_country_tax_type_rate"), 7: ("ambiguous", None, "conflicting_tax_name_and_rate"), 8: ("matched", "A", "exact_country_name_rate"), 9: ("ambiguous", None, "conflicting_name_and_rate"), 10: ("matched", "A", "exact_country_name"),
        11: ("ambiguous", None, "ambiguous_country_name"), 12: ("no_match", None, "none"), 13: ("no_match", None, "none"), 14: ("matched", "A", "exact_tax_code"), 15: ("ambiguous", None, "ambiguous_country_name_rate"),
    }


def test_orders(spark):
    cols = "number string, supplier string, currency string, descriptions array<string>"
    master = spark.createDataFrame([("P1", "N1", "S1", "EUR", ["toner"]), ("P2", "N2", "S1", "EUR", []), ("P3", "N2", "S2", "USD", []), ("P4", "N2", "S2", "EUR", [])], f"cand_id string, {cols}")
    seen = [
        (1, "N1", "S1", "EUR", []), (2, "N1", "S1", None, []), (3, "N1", None, "EUR", []), (4, "N1", None, None, ["toner"]), (5, "n1", None, None, []), (6, "p1", None, None, []), (7, "N1", "S2", None, []), (8, "N1", "S9", None, []), (9, "N1", None, "USD", []),
        (10, "N2", "S1", None, []), (11, "N2", "S2", "USD", []), (12, "N2", "S9", None, []), (13, "N2", "S9", "USD", []), (14, "N2", None, None, []), (15, "N9", "S1", "EUR", []), (16, None, "S1", "EUR", []), (17, "N2", "S1", "USD", []),
    ]
    assert outcome(M.match_orders(spark.createDataFrame(seen, f"obs_id long, {cols}"), master)) == {
        1: ("matched", "P1", "exact_po_number_supplier_currency"), 2: ("matched", "P1", "exact_po_number_supplier"), 3: ("matched", "P1", "exact_po_number_currency"), 4: ("matched", "P1", "exact_po_number_line_evidence"), 5: ("matched", "P1", "exact_po_number"), 6: ("matched", "P1", "exact_po_number"),
        7: ("ambiguous", None, "conflicting_po_and_supplier"), 8: ("no_match", None, "conflicting_po_constraints"), 9: ("no_match", None, "conflicting_po_constraints"), 10: ("matched", "P2", "exact_po_number_supplier"), 11: ("matched", "P3", "exact_po_number_supplier_currency"),
        12: ("ambiguous", None, "ambiguous_po_number"), 13: ("matched", "P3", "exact_po_number_currency"), 14: ("ambiguous", None, "ambiguous_po_number"), 15: ("no_match", None, "none"), 16: ("no_match", None, "none"), 17: ("matched", "P2", "exact_po_number_supplier"),
    }


def test_terms(spark):
    master = spark.createDataFrame([("T30", 30, ["30 days", "net"]), ("T14", 14, ["14 days"]), ("T0", 0, ["now"]), ("T0B", 0, ["net"])], "term_id string, days int, aliases array<string>")
    seen = [(1, "T30", None, None), (2, "T30", None, 14), (3, "T30", "14 days", None), (4, "T99", "net", 30), (5, None, "14 days", None), (6, None, "14 days", 14), (7, None, "14 days", 30), (8, None, "net", None), (9, None, "net", 30), (10, None, "other", 14), (11, None, None, 0), (12, None, None, 99), (13, None, None, None), (14, "T30", "other", 30)]
    assert outcome(M.match_terms(spark.createDataFrame(seen, "obs_id long, term_id string, text string, days int"), master)) == {
        1: ("matched", "T30", "exact_payment_term_id"), 2: ("ambiguous", None, "conflicting_term_id_and_signals"), 3: ("ambiguous", None, "conflicting_term_id_and_signals"), 4: ("no_match", None, "none"), 5: ("matched", "T14", "exact_normalized_alias"), 6: ("matched", "T14", "composite_alias_and_days"),
        7: ("ambiguous", None, "conflicting_text_and_days"), 8: ("ambiguous", None, "ambiguous_alias"), 9: ("matched", "T30", "composite_alias_and_days"), 10: ("matched", "T14", "exact_numeric_days"), 11: ("ambiguous", None, "ambiguous_days"), 12: ("no_match", None, "none"), 13: ("no_match", None, "none"), 14: ("matched", "T30", "exact_payment_term_id"),
    }


def test_page_groups(spark):
    page = "page_no int, numbers array<string>, current int, total int, continues boolean"

    def groups(*pages):
        rows = [(1, [(i, *p) for i, p in enumerate(pages, 1)])]
        return [(r.group_no, r.score) for r in P.grouped(spark.createDataFrame(rows, f"doc_id long, pages array<struct<{page.replace(' ', ':').replace(',:', ',')}>>")).orderBy("page_no").collect()]

    assert groups((["A1"], None, None, False), (["A1"], None, None, False), (["B2"], None, None, True)) == [(1, 0), (1, 10), (2, 0)]
    assert groups(([], 1, 3, False), ([], 2, 3, True), ([], 1, 2, False), ([], 2, 2, False), ([], 3, 3, True)) == [(1, 0), (1, 23), (2, 0), (2, 15), (1, 23)]
    assert groups(([], 1, 1, False), ([], None, None, True)) == [(1, 0), (2, 0)]  # the first group has all its pages
    assert groups((["A1"], 1, 2, False), (["A1"], 1, 2, False)) == [(1, 0), (2, 0)]
    assert P.grouped(spark.createDataFrame([(1, None)], f"doc_id long, pages array<struct<{page.replace(' ', ':').replace(',:', ',')}>>")).count() == 0


def test_assemblies(spark):
    kind = "array<struct<group_no:int,first_page:int,last_page:int,role:string,relevance:string,number:string,currency:string,totals:boolean,shared:boolean,links:int>>"

    def relations(*groups):
        rows = [(1, [(i, *g) for i, g in enumerate(groups, 1)])]
        return [(r.assembly_no, r.relationship) for r in P.assembled(spark.createDataFrame(rows, f"doc_id long, groups {kind}")).orderBy("group_no").collect()]

    pay, sup = ("invoice", "payable_candidate"), ("supporting_document", "supporting")
    assert relations((1, 1, *sup, None, None, False, False, 0), (2, 2, *pay, "A", "EUR", True, False, 0), (3, 3, *sup, None, None, False, False, 0)) == [(1, "standalone_supporting"), (2, "primary_anchor"), (2, "supporting_isolated")]
    assert relations((1, 1, *pay, "A", "EUR", True, False, 0), (2, 2, "unknown", "ambiguous", None, None, False, False, 0), (3, 3, *pay, "B", "EUR", True, False, 0)) == [(1, "primary_anchor"), (1, "continuation"), (2, "primary_anchor")]
    assert relations((1, 1, *pay, "A", "EUR", True, False, 0), (3, 3, "continuation", "ambiguous", " a ", None, False, False, 0), (4, 4, "invoice", "ambiguous", "A", "USD", True, False, 0)) == [(1, "primary_anchor"), (1, "continuation"), (1, "supporting_isolated")]
    assert relations((1, 1, *pay, "A", None, True, False, 0), (2, 2, "invoice", "ambiguous", "A", None, True, False, 0), (3, 3, "invoice", "ambiguous", None, None, True, False, 1)) == [(1, "primary_anchor"), (1, "continuation"), (1, "continuation")]


def test_merged_and_appended(spark):
    facts = spark.createDataFrame([("k", 2, "b", None), ("k", 1, None, "x"), ("k", 3, "c", " X "), ("k", 4, "B", "y"), ("e", 1, " ", None)], "key string, at int, f string, g string")
    got = {(r.key, r.field): (r.value, r.n_conflicts, r.conflicts) for r in P.merged(facts, ["key"], "at", ["f", "g"]).collect()}
    assert got == {("k", "f"): ("b", 1, "3:c"), ("k", "g"): ("x", 1, "4:y")}
    a, b = (spark.createDataFrame(rows, "ids string, row string, n int") for rows in ([("e1", None, 1), ("e1", None, 1), (None, None, 2)], [("e1", None, 3), ("e2", None, 4), ("e2", None, 5), (None, None, 6)]))
    assert sorted(r.n for r in P.appended(a, b, ["ids", "row"]).collect()) == [1, 1, 2, 4, 5, 6]


def test_issues(spark):
    checks = [I.Check("STOP", "INFO", "a", "v = 'stop'", True), I.Check("BAD", "ERROR", "b", "n < 0"), I.Check("NOTE", "INFO", "a", "v is null"), I.Check("HALT", "BLOCKING", "c", "n is null")]
    df = spark.createDataFrame([(1, "stop", -1), (2, None, -1), (3, "x", None), (4, "x", 1)], "id long, v string, n int")
    found = I.issues(df, "id", checks)
    assert {(r.id, r.code, r.position) for r in I.ordered(found, ["id"]).collect()} == {(1, "STOP", 1), (2, "NOTE", 1), (2, "BAD", 2), (3, "HALT", 1)}
    assert {r.id: (r.status, r.n_error, r.n_info) for r in I.verdicts(df, "id", found).collect()} == {1: ("VALID", 0, 1), 2: ("INVALID", 1, 1), 3: ("BLOCKED", 0, 0), 4: ("VALID", 0, 0)}
