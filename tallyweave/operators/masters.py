"""Matching against master data by ordered rules: supplier, buyer, tax, purchase order and payment term.

Every matcher gives (obs_id, status, master_id, method): matched with one master record, ambiguous, or no_match. Candidates are met by equality of normalised
keys and reduced to counts per observation, so no candidate list is gathered. Null and blank keys match nothing; the first rule that applies decides.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.skew import salted_join

#: (condition, status, master id or None, method) in order.
Rule = tuple[Column, str, Column | None, str]


def given(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("")) != ""


def decided(df: DataFrame, rules: Iterable[Rule], kind: str = "string") -> DataFrame:
    """(obs_id, status, master_id, method) of df by the first rule whose condition holds; no_match, null and 'none' if none does."""
    rules = list(rules)
    none = F.lit(None).cast(kind)
    chosen = lambda k, last: reduce(lambda acc, r: F.when(r[0], (F.lit(r[1]), none if r[2] is None else r[2].cast(kind), F.lit(r[3]))[k]).otherwise(acc), reversed(rules), last)
    return df.select("obs_id", chosen(0, F.lit("no_match")).alias("status"), chosen(1, none).alias("master_id"), chosen(2, F.lit("none")).alias("method"))


def met_by(pairs: DataFrame, sets: dict[str, Column]) -> DataFrame:
    """Per observation, how many candidates (distinct cand_id) lie in each set (n_name) and the least of them (m_name)."""
    per = pairs.groupBy("obs_id", "cand_id").agg(*(F.max(F.coalesce(c, F.lit(False))).alias(s) for s, c in sets.items()))
    return per.groupBy("obs_id").agg(*(F.count_if(s).alias(f"n_{s}") for s in sets), *(F.min(F.when(F.col(s), F.col("cand_id"))).alias(f"m_{s}") for s in sets))


SUPPLIER_SIGNALS = ("vat", "name", "email", "iban")


def match_suppliers(observed: DataFrame, master: DataFrame) -> DataFrame:
    """observed (obs_id, vat, name, email, iban, country) against master (cand_id, same keys): VAT, then name, email and account, each held against the country.

    Two signals whose candidates have none in common contradict each other whatever else is known. A country that no VAT or name candidate bears, or not the
    only e-mail or account candidate, makes the match ambiguous; among VAT and name candidates it picks. All signals meet in one join; hot keys are salted.
    """
    def long(df: DataFrame, key: str) -> DataFrame:
        rows = F.array(*(F.struct(F.lit(s).alias("signal"), F.concat_ws("|", F.lit(s), F.col(s)).alias("k"), F.coalesce(F.col(s), F.lit("")).alias("v")) for s in SUPPLIER_SIGNALS))
        return df.select(key, "country", F.inline(F.filter(rows, lambda r: r["v"] != ""))).drop("v")

    right = long(master, "cand_id").select("k", "cand_id", F.col("country").alias("_country")).distinct()
    pairs = salted_join(long(observed, "obs_id"), right, "k", "inner", spread=F.xxhash64("obs_id"))
    agrees = F.col("country") == F.col("_country")
    flags = pairs.groupBy("obs_id", "cand_id").agg(*(F.max(F.col("signal") == s).alias(s) for s in SUPPLIER_SIGNALS), *(F.max((F.col("signal") == s) & F.coalesce(agrees, F.lit(False))).alias(f"{s}_c") for s in SUPPLIER_SIGNALS))
    sets = {x: F.col(x) for s in SUPPLIER_SIGNALS for x in (s, f"{s}_c")} | {f"{a}_{b}": F.col(a) & F.col(b) for a, b in combinations(SUPPLIER_SIGNALS, 2)}
    df = observed.select("obs_id", "country").dropDuplicates(["obs_id"]).join(met_by(flags, sets), "obs_id", "left")
    n, m, land = (lambda s: F.coalesce(F.col(f"n_{s}"), F.lit(0))), (lambda s: F.col(f"m_{s}")), given("country")
    apart = reduce(lambda a, b: a | b, ((n(a) > 0) & (n(b) > 0) & (n(f"{a}_{b}") == 0) for a, b in combinations(SUPPLIER_SIGNALS, 2)))
    rules: list[Rule] = [
        (apart, "ambiguous", None, "conflicting_identity_evidence"),
        (land & (n("vat") > 0) & (n("vat_c") == 0), "ambiguous", None, "conflicting_vat_and_country"),
        (F.when(land, n("vat_c")).otherwise(n("vat")) == 1, "matched", F.when(land, m("vat_c")).otherwise(m("vat")), "exact_vat_id"),
        (n("vat") > 0, "ambiguous", None, "ambiguous_vat_id"),
        (land & (n("name_c") == 1), "matched", m("name_c"), "exact_normalized_name_country"),
        (land & (n("name_c") > 1), "ambiguous", None, "ambiguous_name_country"),
        (land & (n("name") > 0), "ambiguous", None, "conflicting_name_and_country"),
        (n("name") == 1, "matched", m("name"), "exact_normalized_name"),
        (n("name") > 1, "ambiguous", None, "ambiguous_normalized_name"),
    ]
    for s in ("email", "iban"):
        rules += [
            (land & (n(s) == 1) & (n(f"{s}_c") == 0), "ambiguous", None, f"conflicting_{s}_and_country"),
            (n(s) == 1, "matched", m(s), f"exact_{s}"),
            (n(s) > 1, "ambiguous", None, f"ambiguous_{s}"),
        ]
    return decided(df, rules)


def match_buyers(observed: DataFrame, places: DataFrame, units: DataFrame, companies: DataFrame) -> DataFrame:
    """observed (obs_id, location_code, location_name, address, bu_code, bu_name, company_code, company_name) against an organisation.

    places (location_code, location_name, bu_code, company_code), units (ordinal, bu_code, bu_name, company_code, only_location) and companies
    (ordinal, company_code, company_name) hold normalised keys. Evidence of a location decides at that level, else of a unit, else of a company; a code
    that is given hides the name. Codes of the levels above must agree; a unit's name, taken from the first record of its code, only narrows. An address
    alone is evidence that nothing matches.
    """
    def keyed(code: str, name: str) -> Column:
        return F.when(given(code), F.concat(F.lit("c|"), F.col(code))).when(given(name), F.concat(F.lit("n|"), F.col(name)))

    def by_key(df: DataFrame, code: str, name: str, keep: list[Column]) -> DataFrame:
        both = F.array(F.struct(F.lit("c|").alias("p"), F.col(code).alias("v")), F.struct(F.lit("n|").alias("p"), F.col(name).alias("v")))
        return df.select(F.explode(F.filter(both, lambda x: F.coalesce(x["v"], F.lit("")) != "")).alias("x"), *keep).select(F.concat("x.p", "x.v").alias("_k"), *(F.col(c) for c in df.select(*keep).columns)).distinct()

    first_name = units.where(given("bu_code")).groupBy("bu_code").agg(F.min_by("bu_name", "ordinal").alias("_first_name"))
    place_rows = places.join(first_name, "bu_code", "left")
    cand = F.concat_ws("|", F.coalesce("location_code", F.lit("")), F.coalesce("bu_code", F.lit("")), F.coalesce("company_code", F.lit("")))
    place_index = by_key(place_rows, "location_code", "location_name", [cand.alias("cand_id"), F.col("bu_code").alias("_bu"), F.col("company_code").alias("_co"), F.col("_first_name")])
    obs = observed.dropDuplicates(["obs_id"]).withColumns({"_lk": keyed("location_code", "location_name"), "_uk": keyed("bu_code", "bu_name"), "_ck": keyed("company_code", "company_name")})
    pairs = salted_join(obs.select("obs_id", F.col("_lk").alias("_k"), "bu_code", "bu_name", "company_code"), place_index, "_k", "inner", spread=F.xxhash64("obs_id"))
    unit_ok, co_ok = ~given("bu_code") | (F.col("bu_code") == F.col("_bu")), ~given("company_code") | (F.col("company_code") == F.col("_co"))
    named = unit_ok & (F.col("bu_name") == F.col("_first_name"))
    at = met_by(pairs, {"l0": F.lit(True), "l1": unit_ok, "l2": named, "l3": unit_ok & co_ok, "l4": named & co_ok})
    unit_rows = units.groupBy("company_code", "bu_code").agg(*(F.min_by(c, "ordinal").alias(c) for c in ("bu_name", "only_location")))
    unit_index = by_key(unit_rows, "bu_code", "bu_name", [F.concat_ws("|", F.coalesce("only_location", F.lit("")), F.coalesce("bu_code", F.lit("")), F.coalesce("company_code", F.lit(""))).alias("cand_id"), F.col("company_code").alias("_co")])
    pairs = salted_join(obs.select("obs_id", F.col("_uk").alias("_k"), "company_code"), unit_index, "_k", "inner", spread=F.xxhash64("obs_id"))
    unit = met_by(pairs, {"u0": F.lit(True), "u1": co_ok})
    company_index = by_key(companies.where(given("company_code")), "company_code", "company_name", [F.col("company_code").alias("_code"), F.col("ordinal")]).groupBy("_k").agg(F.min_by("_code", "ordinal").alias("_company"))
    df = salted_join(obs.join(at, "obs_id", "left").join(unit, "obs_id", "left"), company_index.withColumnRenamed("_k", "_ck"), "_ck", "left", spread=F.xxhash64("obs_id"))
    n = lambda s: F.coalesce(F.col(f"n_{s}"), F.lit(0))
    place = given("location_code") | given("location_name") | given("address")
    narrowed = given("bu_name") & (n("l2") > 0)
    left, one = F.when(narrowed, n("l4")).otherwise(n("l3")), F.when(narrowed, F.col("m_l4")).otherwise(F.col("m_l3"))
    part = lambda c, k: F.element_at(F.split(c, "[|]"), k)
    more = given("bu_code") | narrowed | given("company_code")
    unit_given = given("bu_code") | given("bu_name")
    unit_id = F.when(part(F.col("m_u1"), 1) != "", part(F.col("m_u1"), 1)).otherwise(part(F.col("m_u1"), 2))
    return decided(
        df,
        [
            (place & (n("l0") == 0), "no_match", None, "none"),
            (place & given("bu_code") & (n("l1") == 0), "ambiguous", None, "conflicting_bu_and_location"),
            (place & given("company_code") & (left == 0), "ambiguous", None, "conflicting_company_and_location"),
            (place & (left == 1) & more, "matched", part(one, 1), "hierarchical_location"),
            (place & (left == 1), "matched", part(one, 1), "exact_location_code"),
            (place, "ambiguous", None, "ambiguous_location_code"),
            (unit_given & (n("u0") == 0), "no_match", None, "none"),
            (unit_given & (n("u1") == 0), "ambiguous", None, "conflicting_company_and_bu"),
            (unit_given & (n("u1") == 1) & given("bu_code"), "matched", unit_id, "exact_business_unit_code"),
            (unit_given & (n("u1") == 1), "matched", unit_id, "exact_normalized_bu_name"),
            (unit_given, "ambiguous", None, "ambiguous_business_unit"),
            (F.col("_company").isNotNull() & given("company_code"), "matched", F.col("_company"), "exact_company_code"),
            (F.col("_company").isNotNull(), "matched", F.col("_company"), "exact_company_name"),
        ],
    )


def match_taxes(observed: DataFrame, master: DataFrame) -> DataFrame:
    """observed (obs_id, code, country, kind, name, rate) against master (code, country, kind, name, rate decimal); keys normalised, codes unique.

    An explicit code decides alone: unknown, it ends the search; known, country, rate, kind and a name that another code of its country owns must not
    contradict it. Else country with kind and rate, then with name and rate, then with name. A rate alone matches nothing. A country's taxes are one small
    array, so observations meet one row each.
    """
    tax = F.struct("code", "kind", "name", "rate")
    lands = master.groupBy("country").agg(F.array_sort(F.collect_list(tax)).alias("_all"))
    codes = master.select("code", F.col("country").alias("c_country"), F.col("kind").alias("c_kind"), F.col("name").alias("c_name"), F.col("rate").alias("c_rate"))
    df = observed.dropDuplicates(["obs_id"])
    df = salted_join(df, codes, "code", "left", spread=F.xxhash64("obs_id"))
    df = df.join(lands.select(F.col("country").alias("c_country"), F.col("_all").alias("_own")), "c_country", "left")
    df = salted_join(df, lands, "country", "left", spread=F.xxhash64("obs_id"))
    named = lambda t: t["name"] == F.col("name")
    rated = lambda t: t["rate"] == F.col("rate")
    have = lambda f: F.filter(F.coalesce("_all", F.array().cast(lands.schema["_all"].dataType)), f)
    df = df.withColumns({
        "_alt": F.try_element_at(F.filter("_own", named), F.lit(1))["code"],
        "_typed": have(lambda t: (t["kind"] == F.col("kind")) & rated(t)), "_named": have(named), "_both": have(lambda t: named(t) & rated(t)),
    })
    known, rate = F.col("c_country").isNotNull(), F.col("rate").isNotNull()
    differs = lambda a, b: given(a) & (F.col(a) != F.col(b))
    conflict = differs("country", "c_country") | (rate & F.coalesce(F.col("rate") != F.col("c_rate"), F.lit(False))) | differs("kind", "c_kind") | (differs("name", "c_name") & F.coalesce(F.col("_alt") != F.col("code"), F.lit(False)))
    n, one = (lambda s: F.size(s)), (lambda s: F.try_element_at(s, F.lit(1))["code"])
    land_rate, land_name = given("country") & rate, given("country") & given("name")
    typed = land_rate & given("kind")
    return decided(
        df,
        [
            (given("code") & ~known, "no_match", None, "none"),
            (given("code") & F.coalesce(conflict, F.lit(False)), "ambiguous", None, "conflicting_tax_code_and_properties"),
            (given("code"), "matched", F.col("code"), "exact_tax_code"),
            (typed & given("name") & (n("_named") > 0) & ~F.coalesce(F.arrays_overlap("_named", "_typed"), F.lit(False)), "ambiguous", None, "conflicting_tax_name_and_rate"),
            (typed & (n("_typed") == 1), "matched", one("_typed"), "exact_country_tax_type_rate"),
            (typed & (n("_typed") > 1), "ambiguous", None, "ambiguous_country_tax_type_rate"),
            (land_name & rate & (n("_both") == 1), "matched", one("_both"), "exact_country_name_rate"),
            (land_name & rate & (n("_both") > 1), "ambiguous", None, "ambiguous_country_name_rate"),
            (land_name & rate & (n("_named") > 0), "ambiguous", None, "conflicting_name_and_rate"),
            (land_name & (n("_named") == 1), "matched", one("_named"), "exact_country_name"),
            (land_name & (n("_named") > 1), "ambiguous", None, "ambiguous_country_name"),
        ],
    )


def match_orders(observed: DataFrame, master: DataFrame) -> DataFrame:
    """observed (obs_id, number, supplier, currency, descriptions array) against master (cand_id, number, supplier, currency, descriptions array).

    The number as written, then in upper case, then as an order's id in either form: the first that finds orders decides. One order must not contradict the
    supplier or currency observed (ambiguous if that supplier has orders at all); of several, those of the supplier, then of the currency stay, if any.
    """
    stages = [("number", lambda c: F.col(c)), ("number", lambda c: F.upper(c)), ("cand_id", lambda c: F.col(c)), ("cand_id", lambda c: F.upper(c))]
    keys = lambda cols: F.array(*(F.struct(F.lit(i).alias("stage"), F.concat_ws("|", F.lit("n" if c == "number" else "i"), x).alias("k")) for i, (c, x) in enumerate(cols)))
    obs = observed.dropDuplicates(["obs_id"])
    left = obs.where(given("number")).select("obs_id", "supplier", "currency", "descriptions", F.inline(keys([(c, f("number")) for c, f in stages])))
    right = master.select(F.explode(F.filter(F.array(F.concat(F.lit("n|"), "number"), F.concat(F.lit("i|"), "cand_id")), lambda x: x.isNotNull())).alias("k"), "cand_id", F.col("supplier").alias("_supplier"), F.col("currency").alias("_currency"), F.col("descriptions").alias("_descriptions"))
    pairs = salted_join(left, right, "k", "inner", spread=F.xxhash64("obs_id"))
    pairs = pairs.withColumn("_first", F.min("stage").over(Window.partitionBy("obs_id"))).where("stage = _first")
    s, c = F.col("supplier") == F.col("_supplier"), F.col("currency") == F.col("_currency")
    met = met_by(pairs, {"all": F.lit(True), "s": s, "c": c, "sc": s & c, "line": F.arrays_overlap("descriptions", "_descriptions")})
    owners = master.where(given("supplier")).select("supplier").distinct().withColumn("_owns", F.lit(True))
    df = salted_join(obs.select("obs_id", "supplier", "currency").join(met, "obs_id", "left"), owners, "supplier", "left", spread=F.xxhash64("obs_id"))
    n, m, sup, cur = (lambda x: F.coalesce(F.col(f"n_{x}"), F.lit(0))), (lambda x: F.col(f"m_{x}")), given("supplier"), given("currency")
    one = n("all") == 1
    bad = (sup & (n("s") == 0)) | (cur & (n("c") == 0))
    by_s = sup & (n("s") > 0)
    by_c = cur & (F.when(by_s, n("sc")).otherwise(n("c")) > 0)
    rest = F.when(by_s & by_c, n("sc")).when(by_s, n("s")).when(by_c, n("c")).otherwise(n("all"))
    last = F.when(by_s & by_c, m("sc")).when(by_s, m("s")).when(by_c, m("c")).otherwise(m("all"))
    few = (n("all") > 1) & (rest == 1)
    rules: list[Rule] = [(one & bad & sup & F.coalesce("_owns", F.lit(False)), "ambiguous", None, "conflicting_po_and_supplier"), (one & bad, "no_match", None, "conflicting_po_constraints")]
    for cond, has_s, has_c, id_ in ((one, sup, cur, m("all")), (few, by_s, by_c, last)):
        rules += [(cond & has_s & has_c, "matched", id_, "exact_po_number_supplier_currency"), (cond & has_s, "matched", id_, "exact_po_number_supplier"), (cond & has_c, "matched", id_, "exact_po_number_currency")]
        if cond is one:
            rules.append((one & (n("line") > 0), "matched", id_, "exact_po_number_line_evidence"))
        rules.append((cond, "matched", id_, "exact_po_number"))
    return decided(df, [*rules, (n("all") > 1, "ambiguous", None, "ambiguous_po_number")])


def match_terms(observed: DataFrame, master: DataFrame) -> DataFrame:
    """observed (obs_id, term_id, text, days) against master (term_id, days, aliases array of normalised texts): id, then text, then days.

    An id decides alone and must not contradict days or text; an unknown one ends the search. A text that is an alias is held against the days.
    """
    term = F.struct("term_id", "days")
    alias = master.select(F.explode("aliases").alias("text"), term.alias("t")).distinct().groupBy("text").agg(F.array_sort(F.collect_list("t")).alias("_alias"))
    by_days = master.where("days is not null").groupBy("days").agg(F.count_distinct("term_id").alias("_n_days"), F.min("term_id").alias("_of_days"))
    by_id = master.select("term_id", F.col("days").alias("_days"), F.lit(True).alias("_known"))
    df = observed.dropDuplicates(["obs_id"])
    for right, key in ((by_id, "term_id"), (alias, "text"), (by_days, "days")):
        df = salted_join(df, right, key, "left", spread=F.xxhash64("obs_id"))
    days, some = F.col("days").isNotNull(), F.coalesce(F.size("_alias"), F.lit(0)) > 0
    agree = F.filter("_alias", lambda t: t["days"] == F.col("days"))
    left = F.when(days, agree).otherwise(F.col("_alias"))
    conflict = (days & F.coalesce(F.col("days") != F.col("_days"), F.lit(True))) | (given("text") & some & ~F.exists("_alias", lambda t: t["term_id"] == F.col("term_id")))
    text, one = given("text") & some, F.try_element_at(left, F.lit(1))["term_id"]
    return decided(
        df,
        [
            (given("term_id") & F.col("_known").isNull(), "no_match", None, "none"),
            (given("term_id") & F.coalesce(conflict, F.lit(False)), "ambiguous", None, "conflicting_term_id_and_signals"),
            (given("term_id"), "matched", F.col("term_id"), "exact_payment_term_id"),
            (text & days & (F.size(agree) == 0), "ambiguous", None, "conflicting_text_and_days"),
            (text & (F.size(left) == 1) & days, "matched", one, "composite_alias_and_days"),
            (text & (F.size(left) == 1), "matched", one, "exact_normalized_alias"),
            (text, "ambiguous", None, "ambiguous_alias"),
            (F.col("_n_days") == 1, "matched", F.col("_of_days"), "exact_numeric_days"),
            (F.col("_n_days") > 1, "ambiguous", None, "ambiguous_days"),
        ],
    )
