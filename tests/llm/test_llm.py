import random
import re
from collections import defaultdict
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweave.llm import addresses as A
from tallyweave.llm import entities as E
from tallyweave.llm import language as L
from tallyweave.llm import leaks as K
from tallyweave.llm import packing, pieces
from tallyweave.llm.graph import classes
from tallyweave.llm.sampling import least_hashes
from tallyweave.llm.sizes import TOKEN, n_tokens

# ---- graph, samples, sizes


def test_classes(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)] + [(500, 500 + i) for i in range(1, 90)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in classes(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert classes(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_hashes(spark):
    df = spark.range(20_000)
    a = sorted(r.id for r in least_hashes(df, F.col("id"), 500).collect())
    b = sorted(r.id for r in least_hashes(df.repartition(9), F.col("id"), 500).collect())
    assert a == b and len(a) == 500
    assert least_hashes(df.limit(3), F.col("id"), 5).count() == 3 and least_hashes(df.limit(0), F.col("id"), 5).count() == 0


TEXTS = ["", "a", "Total: 12,50 EUR", "x_1 -- y\n\n(z)", "ใบส่งของ 3", "a b", "…!? ß", None]


def test_sizes_in_the_engine_and_outside(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i long, t string")
    for r in df.select("t", n_tokens(F.col("t")).alias("n")).collect():
        assert r.n == len(TOKEN.findall(r.t or "")), r.t


# ---- addresses


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Nondvenstraße 172, 41148 Stonburg, DE", "nondvenstr. 172 stonburg 41148 germany", True),
        ("Nondvenstraße 172, 41148 Stonburg, DE", "Nondvenstraße 173, 41148 Stonburg, DE", False),
        ("Nondvenstraße 172a, 41148 Stonburg", "Nondvenstraße 172, 41148 Stonburg", False),
        ("Nondvenweg 172, 41148 Stonburg", "Nondvenstraße 172, 41148 Stonburg", False),
        ("Block D; 78 Funkur Rd.; Fandale; 4171; South Africa", "78 Fnukur Road, Fandale, 4171, ZA", True),
        ("2nd Floor, No. 169, Moltdruk Ave, Skarkrom", "169 Moltdruk Avenue, Skarkrom, GH", True),
        ("174, boulevard Tisstalmar; Grisac; 41926; FR", "174, BD TISSTAMLAR,GRISAC,41926,FR", True),
        ("Avenida Klultpe, 87, 4129-344 Siroso, PT", "Siroso, Avª Klultpe nº87, Portugal", True),
        ("78 b Relzis Rd. Sirase", "78b Relzis Road, Sirase, GH", True),
        ("139 r. Zaltklarlon Grisigny (41441) France", "139 rue Zaltklarlon, 41441 Grisigny, FR", True),
        ("5 Sendtu Avenue, Mendkloof 4108, ZA", "5 Sendtu Avenue, Walkloof 4114, ZA", False),
    ],
)
def test_address_pairs(a, b, same):
    x, y = (tuple(A.parse(t)) for t in (a, b))
    assert A.same_location(x, y) is same and A.same_location(y, x) is same


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_address_is_parsed(text):
    A.parse(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", max_size=7), st.text(alphabet="abc", max_size=7))
def test_osa(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    for most in (1, 2, 9):
        assert A.osa(a, b, most) == min(d[-1][-1], most + 1)


def test_location_pairs_match_brute_force(spark):
    rnd = random.Random(5)
    base = [(f"{rnd.choice('bdfgklmnprst')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{rnd.choice('kptvz')}{rnd.choice('aeiou')}{rnd.choice('lmnrs')}ok", rnd.choice(["straße", "weg"]), rnd.randrange(1, 30), 41000 + rnd.randrange(6)) for _ in range(60)]
    towns = ["Stonburg", "Grisheim", "Walstedt", "Konoja", "Primla", "Sirac"]
    rows = []
    for i in range(400):
        s, k, n, p = rnd.choice(base) if rnd.random() > 0.34 else base[0]
        if rnd.random() < 0.2:
            j = rnd.randrange(len(s) - 1)
            s = s[:j] + s[j + 1] + s[j] + s[j + 2 :]
        t = towns[p - 41000]
        rows.append((f"r{i:03}", rnd.choice([f"{s.title()}{k} {n}, {p} {t}", f"{t} ({p}); {s}{k} {n}; Germany", f"{p} {t.upper()}\n{s.upper()}{k.upper()} {n}\nDE", f"{s.title()}{k} {n}, {t}"]), "clash"))
    rows += [("n1", None, "c"), ("n2", "  ", "c"), ("z1", "!!", "c")]
    df = spark.createDataFrame(rows, "rec string, address string, location string")
    got = {(r.rec_a, r.rec_b) for r in A.location_pairs(df.repartition(5), window=12).collect()}
    parsed = {r: tuple(A.parse(a)) for r, a, _ in rows if a and a.strip()}
    reps = defaultdict(list)
    for r, p in parsed.items():
        reps[p].append(r)
    keys, parent = list(reps), {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, x in enumerate(keys):
        for y in keys[:i]:
            if A.same_location(x, y):
                parent[find(x)] = find(y)
    cls = {r: find(p) for p, rs in reps.items() for r in rs}
    want = {(a, b) for a in cls for b in cls if a < b and cls[a] == cls[b]}
    assert got == want
    assert A.location_pairs(df.limit(0)).count() == 0


def test_windows_in_a_dense_town(spark):
    """A third of the records in one town, forty streets to a house number: the windows find what a full comparison finds."""
    rnd = random.Random(8)
    streets = ["".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") + rnd.choice("lmnrs") for _ in range(3)) for _ in range(400)]
    towns = ["Stonburg"] + ["".join(rnd.choice("gklmnprst") + rnd.choice("aeiou") for _ in range(4)) for _ in range(30)]
    rows = []
    for i in range(1500):
        street, number = rnd.choice(streets), rnd.randrange(1, 13)
        town = towns[0] if rnd.random() < 1 / 3 else rnd.choice(towns)
        for _ in range(2):
            k = rnd.randrange(1, len(street) - 1)
            s = street if rnd.random() < 0.5 else street[:k] + rnd.choice("aeiou") + street[k + 1 :]
            rows.append((f"r{len(rows)}", f"{s.title()}straße {number}, {town}"))
    rows += [("n1", "n/a"), ("n2", "-"), ("n3", "Hauptstrasse, Berlin"), ("n4", "Hauptstr., Berlin")]
    df = spark.createDataFrame(rows, "rec string, address string")
    at = {r.rec: r.location for r in A.locations(df, per_task=300).collect()}
    assert all(at[f"n{k}"] is None for k in (1, 2, 3, 4))
    parsed = sorted({tuple(A.parse(a)) for _, a in rows[:-4]})
    where = defaultdict(set)
    for (rec, a) in rows[:-4]:
        where[tuple(A.parse(a))].add(at[rec])
    by_number = defaultdict(list)
    for p in parsed:
        by_number[p[2]].append(p)
    links = [(a, b) for group in by_number.values() for i, a in enumerate(group) for b in group[:i] if A.same_location(a, b)]
    assert len(links) > 300 and sum(where[a] == where[b] for a, b in links) >= 0.99 * len(links)


# ---- entities

MASTER = [
    ("S1", "Fandgik Werkzeuge GmbH", "DE041727033", "DE007275417479593406", "Nendvikstraße 172, 41148 Stonburg, DE", "x"),
    ("S1", "Fandgik Werkzeuge GmbH", "DE041727033", "DE007275417479593406", "Nendvikstraße 172, 41148 Stonburg, DE", "x"),
    ("S2", "Fandgik Logistik GmbH", "DE041999888", "DE001111417479590000", "Nendvikstraße 172, 41148 Stonburg, DE", "x"),
    ("S3", "Horpelun Trading Ltd", "GB041555111", None, "5 Ninski Street, Sirham, EB29 0AP, UK", "x"),
    ("S4", "Horpelun Trading Limited", "GB041555111", "", None, "x"),
    (None, "Nobody Ltd", "GB041000001", None, None, "x"),
    ("S5", None, None, None, None, "x"),
]
SEEN = [
    (1, "WERKZEUGE FANDGIK G.M.B.H.", "DE-041.727033", None, None, "y"),
    (2, "Fnadgik Werkzeuge", None, "de 0072 7541 7479 5934 06", "Nendvikstr. 172, Stonburg", "y"),
    (3, "Horpelun Trading PLC", "GB 0415 5511 1", None, None, "y"),
    (4, "Quite Other AG", "DE045123456", None, "Somestraße 3, 41000 Town", "y"),
    (5, None, None, None, None, "y"),
    (6, "Fandgik Logistik", None, "DE00111141747959OOOO", None, "y"),
    (1, "WERKZEUGE FANDGIK G.M.B.H.", "DE-041.727033", None, None, "y"),
]


def test_entities(spark):
    cols = "name string, vat_id string, bank_iban string, address string"
    m = spark.createDataFrame(MASTER, f"supplier_id string, {cols}, sup_rep string")
    o = spark.createDataFrame(SEEN, f"obs_id long, {cols}, confidence string")
    got = E.match_entities(o, m)
    pairs = {(r.obs_id, r.supplier_id) for r in got.collect()}
    assert pairs == {(1, "S1"), (2, "S1"), (3, "S3"), (3, "S4"), (6, "S2")}
    assert all(0.5 <= r.confidence <= 1 for r in got.collect())
    assert E.match_entities(o.limit(0), m).count() == 0 and E.match_entities(o, m.limit(0)).count() == 0


def test_values_that_many_suppliers_share_still_match(spark):
    cols = "name string, vat_id string, bank_iban string, address string"
    rows = [(f"S{i}", f"{a}{b}pelun Trading Ltd", "GB041555111", None, None) for i, (a, b) in enumerate((a, b) for a in ("Ha", "Ke", "Lo", "Mi", "Nu", "Pa", "Re") for b in ("bo", "da", "fi", "gu", "ke", "lu", "mo"))]
    m = spark.createDataFrame([*rows, *((f"T{i}", "Fandgik GmbH", None, "DE007275417479593406", None) for i in range(50))], f"supplier_id string, {cols}")
    o = spark.createDataFrame([(1, None, "GB 0415 5511 1", None, None), (2, None, None, "DE00 7275 4174 7959 3406", None)], f"obs_id long, {cols}")
    got = {(r.obs_id, r.supplier_id) for r in E.match_entities(o, m).collect()}
    assert got == {(1, f"S{i}") for i in range(49)} | {(2, f"T{i}") for i in range(50)}


def test_values_that_most_suppliers_share_count_beside_another(spark):
    """The same pairs whether 60 or 140 suppliers share an account: a close second field finds its supplier, also if that one is shared as well."""
    cols = "name string, vat_id string, bank_iban string, address string"
    rnd = random.Random(3)
    name = lambda: "".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(4)).capitalize()
    names, account = [name() for _ in range(140)], "DE007275417479593406"
    for n in (60, 140):
        master = [(f"S{i}", f"{names[i]} GmbH", f"DE04{i:07}", account, None) for i in range(n)] + [(f"T{i}", "Fandgik GmbH", f"DE05{i:07}", account, f"Nendvikstraße {i + 1}, 41148 Stonburg") for i in range(n)]
        seen = [(1, f"{names[7]} GmbH", None, "DE00 7275 4174 7959 3406", None), (2, None, None, account, None), (3, "Fandgik GmbH", None, account, "Nendvikstr. 9, 41148 Stonburg"), (4, None, "DE040000011", account, None)]
        got = E.candidates(*(x.withColumnRenamed("id", k) for x, k in ((E.encoded(spark.createDataFrame([(r[0], *r[1:]) for r in seen], f"id long, {cols}"), "id"), "obs_rep"), (E.encoded(spark.createDataFrame(master, f"id string, {cols}"), "id"), "sup_rep"))))
        pairs = {(r.obs_rep, r.sup_rep) for r in got.collect()}
        assert {(1, "S7"), (3, "T8"), (4, "S11")} <= pairs
        assert n == 60 or len([p for p in pairs if p[0] == 2]) == 0 and len(pairs) < 2 * n + 10


def test_values_that_most_suppliers_share_match_alone_as_well(spark, monkeypatch):
    """Whatever SHARED is, the matches are the same as when all pairs are listed."""
    cols = "name string, vat_id string, bank_iban string, address string"
    rnd, account, street = random.Random(5), "DE007275417479593406", "Nendvikstraße 172, 41148 Stonburg"
    pick = lambda *x: rnd.choice(x)
    rows = lambda n, vat: [(pick("Fandgik GmbH", "Fandgik Logistik GmbH", "Horpelun AG", "Fandgyk GmbH", None), pick(vat(i), None), pick(account, "DE001111417479590000", None), pick(street, "Somestraße 3, 41000 Town", None)) for i in range(n)]
    master = [(f"S{i}", "Fandgik GmbH", f"DE04{i:07}", None, None) for i in range(80)] + [(f"T{i}", *r) for i, r in enumerate(rows(120, lambda i: f"DE05{i:07}"))]
    seen = [(1, "Fandgik GmbH", None, None, None), *((i + 2, *r) for i, r in enumerate(rows(60, lambda i: f"DE0500000{i % 9}1")))]
    m, o = spark.createDataFrame(master, f"supplier_id string, {cols}"), spark.createDataFrame(seen, f"obs_id long, {cols}")
    found = []
    for shared in (64, 10**6):
        monkeypatch.setattr(E, "SHARED", shared)
        monkeypatch.setattr(E, "calibrate", lambda scored: E.UNFITTED)
        found.append({(r.obs_id, r.supplier_id, round(r.confidence, 9)) for r in E.match_entities(o, m).collect()})
    assert found[0] == found[1] and {(1, f"S{i}") for i in range(80)} <= {x[:2] for x in found[0]}


def test_parts_of_all_vectors_within_the_radius_meet():
    rnd = random.Random(1)
    letters, digits, within, apart_too = "abdegiklmnoprstuv", "0123456789", 0, 0
    for n in [*range(4, 21)] * 60:
        field = rnd.choice(["name", "iban", "address"])
        alphabet = digits if field == "iban" else letters
        x = y = "".join(rnd.choice(alphabet) for _ in range(n))
        for _ in range(rnd.randrange(1, 4)):
            k = rnd.randrange(len(y))
            y = rnd.choice([y[:k] + rnd.choice(alphabet) + y[k + 1 :], y[:k] + y[k + 1 :], y[:k] + rnd.choice(alphabet) + y[k:], y[:k] + y[k + 1 : k + 2] + y[k] + y[k + 2 :]]) or "ab"
        vx, vy = (E.bits(E.qgrams(v)) for v in (x, y))
        far = sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(vx, vy))
        head = "7|" if field == "address" else ""
        met = not set(E.part_keys(field, head + x, *vx, True)).isdisjoint(E.part_keys(field, head + y, *vy, False))
        if far <= E.radius_of(field, head + x):
            within += 1
            assert met, (x, y)
        else:
            apart_too += not met
    assert within > 300 and apart_too > 100


def test_close_values_equal_a_full_comparison(spark):
    rnd = random.Random(4)

    def edited(s, alphabet):
        for _ in range(rnd.randrange(4)):
            k = rnd.randrange(len(s))
            s = rnd.choice([s[:k] + rnd.choice(alphabet) + s[k + 1 :], s[:k] + s[k + 1 :], s[:k] + rnd.choice(alphabet) + s[k:], s[:k] + s[k + 1 : k + 2] + s[k] + s[k + 2 :]]) or "ab"
        return s

    def values(rows):
        out = []
        for v in sorted(set(rows)):
            lo, hi = E.bits(E.qgrams(v[1:].partition("|")[2] if v[0] == "a" else v[1:]))
            out.append((v, lo, hi))
        return out

    left, right = ["npevsen", "nfirnas"], ["npesven", "nfinras"]
    for n in [*range(3, 22)] * 8:
        for field, head, alphabet in (("n", "", "abdegiklmnoprstuv"), ("i", "", "0123456789"), ("a", rnd.choice(["7|", "1234|"]), "abdegiklmnoprstuv")):
            s = "".join(rnd.choice(alphabet) for _ in range(n))
            left += [field + head + edited(s, alphabet), f"v{n}00000"]
            right += [field + head + edited(s, alphabet), f"v{n}00000"]
    a, b = values(left), values(right)

    def close(x, y):
        if x[0][0] != y[0][0] or x[0][0] == "a" and x[0].split("|")[0] != y[0].split("|")[0]:
            return False
        long, u, v = len(x[0]) > E.LONG, x[0], y[0]
        d = list(range(len(v) + 1))
        for i, p in enumerate(u, 1):
            row = [i]
            for j, q in enumerate(v, 1):
                row.append(min(row[-1] + 1, d[j] + 1, d[j - 1] + (p != q)))
            d = row
        apart = sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x[1:], y[1:]))
        return u == v or u[0] != "v" and d[-1] <= E.EDITS + long and apart <= E.RADIUS[{f[0]: f for f in E.FIELDS}[u[0]]] + 2 * long

    want = {(x[0], y[0]) for x in a for y in b if close(x, y)}
    made = [spark.createDataFrame(rows, "value string, lo long, hi long").withColumn("codes", F.array().cast("array<long>")) for rows in (a, b)]
    assert {(r.value, r.r_value) for r in E.close_values(*made).collect()} == want and ("npevsen", "npesven") in want


def test_no_table_is_sent_through_the_driver(spark, monkeypatch, tmp_path):
    """Spark takes these tables for small ones, as it does with a value's keys, of which it counts one."""
    cols, plans, cut = "name string, vat_id string, bank_iban string, address string", [], E.cut

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(E, "cut", noted)
    for name, key, rows in (("m", "supplier_id string", MASTER), ("o", "obs_id long", SEEN)):
        spark.createDataFrame([r[:5] for r in rows], f"{key}, {cols}").write.parquet(str(tmp_path / name))
    noted(E.match_entities(*(spark.read.parquet(str(tmp_path / name)) for name in "om")))
    assert sum("Join" in p for p in plans) >= 4 and not [p for p in plans if "Broadcast" in p]


def test_confidences_say_how_often_matches_are_right(spark):
    rnd = random.Random(12)
    name = lambda: "".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(3)).capitalize()
    master = [(f"S{i}", f"{name()} {rnd.choice(['Media', 'Tools', 'Print'])} Ltd", f"GB0{rnd.randrange(10**8):08}", f"GB00{rnd.randrange(10**16):016}" if rnd.random() < 0.7 else None, f"{rnd.randrange(1, 200)} {name()} Road, {name()}") for i in range(1500)]

    def read(s):
        if s is None or rnd.random() < 0.45:
            return None
        k = rnd.randrange(len(s))
        return s[:k] + rnd.choice("aeiou" if s[k].isalpha() else "0123456789") + s[k + 1 :] if rnd.random() < 0.25 else s

    listed = [(i, m[0], *map(read, m[1:])) for i, m in enumerate(rnd.choices(master, k=2500))]
    strangers = [(10_000 + i, None, f"{name()} {rnd.choice(['Media', 'Tools', 'Print'])} Ltd", f"GB0{rnd.randrange(10**8):08}" if rnd.random() < 0.5 else None, None, None) for i in range(800)]
    cols, truth = "name string, vat_id string, bank_iban string, address string", {r[0]: r[1] for r in listed + strangers}
    seen = spark.createDataFrame([(r[0], *r[2:]) for r in listed + strangers], f"obs_id long, {cols}")
    got = E.match_entities(seen, spark.createDataFrame(master, f"supplier_id string, {cols}")).toPandas()
    right = (got.obs_id.map(truth) == got.supplier_id).astype(float)
    for low, high in ((0.5, 0.8), (0.8, 0.97), (0.97, 1.01)):
        band = (got.confidence >= low) & (got.confidence < high)
        assert band.sum() < 25 or abs(right[band].mean() - got.confidence[band].mean()) < 0.15, (low, band.sum(), right[band].mean(), got.confidence[band].mean())
    full = {r[0] for r in listed if any(r[2:])}
    assert right.mean() > 0.95 and right.sum() > 0.85 * len(full)


def test_names():
    assert E.name_parts("Fa. Trunku & Vumruk Bürobedarf Gesellschaft mit beschränkter Haftung") == E.name_parts("Trunku und Vumruk Bürobedarf GmbH")
    assert E.vat_digits("GH-A-V.AT-04128O516") == E.vat_digits("GHA-VAT-041280516") and E.iban_digits("de 00 12") == "0012"


# ---- language

SAMPLE = {
    "en": "The goods stay our property until the whole sum has reached our bank. Please quote the reference with every payment.",
    "de": "Die Ware bleibt bis zur vollständigen Bezahlung unser Eigentum. Bitte geben Sie bei jeder Zahlung das Zeichen an.",
    "fr": "La marchandise demeure notre propriété jusqu'au paiement complet. Merci d'indiquer la référence sur chaque règlement.",
    "es": "La mercancía sigue siendo nuestra hasta que se haya pagado del todo. Rogamos que indiquen la referencia en cada pago.",
    "th": "สินค้ายังเป็นของบริษัทจนกว่าจะได้รับเงินครบถ้วน กรุณาระบุเลขอ้างอิงทุกครั้งที่ชำระเงิน",
}


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(SAMPLE))
        parts = [" ".join(rnd.sample(SAMPLE[lang].split(), k=max(1, len(SAMPLE[lang].split()) * 3 // 4))) for _ in range(rnd.randrange(1, 5))]
        label = lang if rnd.random() > 0.1 else rnd.choice(["xx", "", None, "en-GB", "German"])
        rows.append((i, "\n\n".join(f"{p} {rnd.randrange(999)} EUR" for p in parts), label, lang))
    return rows


def test_language(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:3] for r in rows] + [(900, None, "en"), (901, "", "en"), (902, "12 34\n\n#", "en"), (903, SAMPLE["en"] + " more of it\n\n" + SAMPLE["en"] + "\n\n" + SAMPLE["de"], "English")], "doc_id long, text string, lang string")
    model = L.train(docs)
    found = {(r.doc_id, r.seg_no): r.lang for r in L.languages(docs.withColumn("seg_no", F.lit(1)), model).collect()}
    assert np.mean([found[i, 0] == lang for i, _, _, lang in rows]) >= 0.98
    assert found[900, 0] is found[901, 0] is found[902, 0] is None
    assert [found[903, k] for k in range(4)] == ["en", "en", "en", "de"]
    inv = spark.createDataFrame([(903, "English|German"), (903, "English"), (0, None), (1, rows[1][3]), (None, "en")], "doc_id long, language_hints string")
    out = {tuple(r) for r in L.label_findings(docs, inv, model).collect()}
    assert {x for x in out if x[1] == 903} == {("segment", 903, 1, "en"), ("segment", 903, 2, "en"), ("segment", 903, 3, "de")}
    assert ("language_hints", 0, 0, found[0, 0]) in out and not any(x[0] == "language_hints" and x[1] == 1 for x in out)
    assert L.label_findings(docs.limit(0), inv, model).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("en-GB",), ("DEU",), (" français ",), ("ไทย",), ("xx",), ("",), (None,), ("pt_PT",), ("Entish",)], "v string")
    assert [r.l for r in df.select(L.label(F.col("v")).alias("l")).collect()] == ["en", "de", "fr", "th", None, None, None, "pt", None]


def test_no_labels_reject_everything(spark):
    docs = spark.createDataFrame([(1, SAMPLE["en"], None)], "doc_id long, text string, lang string")
    assert L.languages(docs).count() == 2


# ---- packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_plan_holds_every_item_once(histogram):
    plan, used = packing.plan(histogram, 50, 25), defaultdict(int)
    for sizes, times in plan:
        assert sum(sizes) <= 50 and times > 0
        for s in sizes:
            used[s] += times
    assert dict(used) == histogram


def test_plan_wastes_little():
    rnd = random.Random(2)
    h = defaultdict(int)
    for _ in range(20_000):
        h[max(1, min(2048, int(rnd.lognormvariate(5.8, 0.8))))] += 1
    n = sum(t for _, t in packing.plan(h, 2048))
    assert n <= 1.01 * sum(s * c for s, c in h.items()) / 2048 + 1


def test_nnls():
    rng = np.random.default_rng(0)
    a, x = rng.random((20, 8)), np.array([0, 1.0, 0, 2, 3, 0, 0, 0.5])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)


def test_pack(spark):
    rnd = random.Random(4)
    texts = [" ".join(["w"] * rnd.choice([1, 3, 7, 7, 7, 19, 20, 21, 45, 0])) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i % 290, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, size int")
    rows = packing.pack(df, 20, salts=4).collect()
    room = defaultdict(int)
    for r in rows:
        room[r.container_no] += r.n_tokens
    assert max(room.values()) <= 20 and sum(room.values()) == sum(len((t or "").split()) for t in texts)
    assert sorted({r.doc_id for r in rows}) == list(range(290)) and sorted(room) == list(range(1, len(room) + 1))
    assert packing.pack(df.limit(0), 20).count() == 0


# ---- leaks


def test_tiles_are_greedy_and_disjoint():
    assert K.tiles([1, 2, 3, 4, 9, 5, 6], [5, 6, 1, 2, 3, 4]) == [(0, 2, 4), (5, 0, 2)]
    assert K.tiles([1, 1, 1], [1, 1]) == [(0, 0, 2)] and K.tiles([], [1]) == []


ITEM = "Asked about K21150 the depot in Klisdiwick answered that 48 site surveys had left for Prargiburg before 20 May on a green docket while the clerk of Vovwil Ltd traced 4,649.03 MYR back to cable drums that Rinkles had booked twice"
OTHER = "Asked about B99999 the depot in Zendgusford answered that 12 filter mats had left for Konoja before 3 June on a brown docket while the clerk of Tumske Ltd traced 77.10 EUR back to label rolls that Bulti had booked twice"


def test_leaks(spark):
    filler = "Our records show that this sum is still open on your account since last year. " * 30
    words = ITEM.split()
    docs = [
        (1, filler + ITEM.upper().replace(" ", "\n") + filler, "x"),
        (2, filler + " ".join(words[4:34]).replace("Klisdiwick", "Klisdlwick").replace("surveys", "survyes") + filler, "x"),
        (3, filler + " ".join(words[:15]) + filler, "x"),
        (4, filler + OTHER + filler, "x"),
        (5, " ".join(words[:14]) + " Page 2 of 8 see below " + " ".join(words[14:]), "x"),
        (1, ITEM, "x"),
        (6, None, "x"),
        (7, "", "x"),
        (8, filler * 40 + ITEM, "x"),
        (9, filler + " ".join([*words[20:], "see", "above", *words[:20]]), "x"),
    ]
    items = [(10, ITEM), (11, "too short to leak"), (12, None), (13, ITEM + " and more")]
    i, d = spark.createDataFrame(items, "item_id long, item_text string"), spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    rows = sorted((r.item_id, r.doc_id, r.n_words, r.any_order) for r in K.leaks(i, d).collect())
    assert sorted((n, k) for n, k, m, _ in rows if m) == sorted([(n, k) for n in (10, 13) for k in (1, 2, 5, 1, 8)])
    assert {(n, k) for n, k, m, _ in rows if not m} == {(10, 9), (13, 9)}  # the halves are there, in the other order
    assert sorted((r.item_id, r.doc_id, r.n_words, r.any_order) for r in K.leaks(i, d, block_chars=10).collect()) == rows
    assert K.leaks(i.limit(0), d).count() == 0 and K.leaks(i, d.limit(0)).count() == 0


def test_leaks_of_items_that_share_their_text(spark):
    rnd = random.Random(6)
    other = lambda: " ".join("".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(30))
    items = [(i, ITEM) for i in range(6)] + [(10 + i, other() + " " + OTHER) for i in range(5)] + [(20 + i, other()) for i in range(9)]
    docs = [(1, "Dear all " + ITEM + " and so on"), (2, "Dear all " + OTHER + " and so on"), (3, "Dear all and so on")]
    i, d = spark.createDataFrame(items, "item_id long, item_text string"), spark.createDataFrame(docs, "doc_id long, text string")
    want = {(n, 1) for n in range(6)} | {(10 + n, 2) for n in range(5)}
    for size in (K.BLOCK_CHARS, 10, 700):
        assert {(r.item_id, r.doc_id) for r in K.leaks(i, d, block_chars=size).collect()} == want


def test_leaks_against_brute_force(spark):
    """Verbatim runs of 25 words are found wherever they start, also with their marks as blanks or gone, and shorter runs or other sentences of the same build are not."""
    rnd = random.Random(9)
    name = lambda: "".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(3)).capitalize()
    sentence = lambda: f"When the {rnd.choice(['site surveys', 'label rolls', 'filter mats'])} reached {name()} on {rnd.randrange(10, 29)}.0{rnd.randrange(1, 10)}.2024, the clerk counted {rnd.randrange(99)} crates with a {rnd.choice(['green', 'grey'])} seal, although order K-{rnd.randrange(10000, 99999)} asked for {rnd.randrange(99)} crates with a {rnd.choice(['green', 'grey'])} one."
    items = [(i, " ".join(sentence() for _ in range(3))) for i in range(40)]
    docs, want = [], set()
    for k in range(400):
        i, text = rnd.choice(items)
        words = text.split()
        n = rnd.choice((25, 25, 28, 20))
        at = rnd.randrange(len(words) - n + 1)
        part = " ".join(words[at : at + n])
        part = rnd.choice((part, part.upper(), re.sub(r"[.,-]", " ", part), re.sub(r"[.,-]", "", part), part.replace(" ", "\n")))
        far = "our goods stay with us until all is paid " * 12
        docs.append((k, f"Dear all. {sentence()} {far} {part} {far} {sentence()} Yours."))
        if n >= 25:
            want.add((i, k))
    got = K.leaks(spark.createDataFrame(items, "item_id long, item_text string"), spark.createDataFrame(docs, "doc_id long, text string")).where("n_words > 0").collect()
    assert {(r.item_id, r.doc_id) for r in got} == want


# ---- pieces


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["word", "Other", "end.", "\n", "\n\n", "x,", "—"]), min_size=1, max_size=300), st.integers(8, 40), st.integers(0, 7))
def test_pieces_cover_the_text(parts, most, overlap):
    text = " ".join(parts)
    spans = [m.span() for m in TOKEN.finditer(text)]
    got = pieces.split_text(text, most, overlap)
    if not spans:
        assert got == []
        return
    first, last = {a: i for i, (a, _) in enumerate(spans)}, {b: i + 1 for i, (_, b) in enumerate(spans)}
    at = [(first[a], last[e], n) for a, e, n in got]
    assert at[0][0] == 0 and at[-1][1] == len(spans)
    assert all(n == e - a <= most for a, e, n in at)
    assert all(b[0] == a[1] - overlap and b[1] > a[1] for a, b in zip(at, at[1:]))
    natural = pieces.boundaries(text, pieces.Tokens.of(text))[0].tolist()
    for a, e, _ in at[:-1]:
        assert e in natural or not any(a + overlap < c <= a + most for c in natural)


def test_depths_equal_a_plain_count():
    rnd = random.Random(0)
    words = [rnd.choice("abcdef") for _ in range(120)]
    cuts, block = [10, 30, 31, 77, 119], 20

    def cosine(k):
        x, y = words[max(0, k - block) : k], words[k : k + block]
        v = lambda s: np.array([s.count(c) for c in "abcdef"], float)
        return v(x) @ v(y) / (np.linalg.norm(v(x)) * np.linalg.norm(v(y)))

    s = [cosine(k) for k in cuts]
    got = dict(zip(cuts, pieces.depths(np.array(words), cuts, block)))
    for i, k in enumerate(cuts):
        left = i
        while left and s[left - 1] >= s[left]:
            left -= 1
        right = i
        while right < len(s) - 1 and s[right + 1] >= s[right]:
            right += 1
        assert got[k] == pytest.approx(s[left] - s[i] + s[right] - s[i])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBb1_ .,\n\tไİß\U0001d400\U0001f600\u00a0"), max_size=60))
def test_tokens_in_arrays(text):
    got, want = pieces.Tokens.of(text), list(TOKEN.finditer(text))
    assert list(zip(got.starts.tolist(), got.ends.tolist())) == [m.span() for m in want]
    assert got.lines.tolist()[1:] == [text[a.end() : b.start()].count("\n") for a, b in zip(want, want[1:])]
    low = ["".join(x if len(x := c.lower()) == 1 or ord(c) > 0xFFFF else c for c in m[0]) for m in want]
    assert len(set(zip(low, got.words.tolist()))) == len(set(low)) == len(set(got.words.tolist()))


def test_pieces_end_in_the_deepest_valley():
    """Two topics of sentences: the cut lies where they meet, not at the paragraph ends within them."""
    rnd = random.Random(5)
    topic = lambda words: [" ".join(rnd.choices(words.split(), k=9)).capitalize() + "." for _ in range(14)]
    one, two = topic("goods boxes pallets truck driver depot crates seal"), topic("interest bank account due sum payment rate month")
    text = " ".join(one[:5]) + "\n\n" + " ".join(one[5:]) + " " + " ".join(two[:6]) + "\n\n" + " ".join(two[6:])
    a, e, _ = pieces.split_text(text, 200, 0, fill=0.3)[0]
    assert text[a:e] == " ".join(one[:5]) + "\n\n" + " ".join(one[5:])


def test_split_documents(spark):
    long = ("A sentence of some words here. " * 40 + "\n\n") * 6
    df = spark.createDataFrame([(1, long, 3), (2, "short", 3), (3, None, 3), (4, "", 3), (5, "x" * 5000, 3), (1, long, 3), (6, "w " * 300_000, 3)], "doc_id long, text string, piece_no int")
    got = pieces.split_documents(df, 100, 10).collect()
    assert {r.doc_id for r in got} == {1, 6} and max(r.n_tokens for r in got) == 100
    assert pieces.split_documents(df.limit(0), 100, 10).count() == 0
    assert {r.doc_id for r in pieces.split_documents(df, 100, 10, only_oversized=False).collect()} == {1, 2, 5, 6}


def test_queries_are_registered():
    from tallyweave.llm import queries as Q

    assert {"p1_found", "p4_found", "p5_found", "p7_containers", "p8_found", "p9_found"} <= set(Q.QUERIES)
    assert datetime(2024, 1, 1) < datetime.now()
