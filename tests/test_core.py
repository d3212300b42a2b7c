import json
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyweave.functions import text as X
from tallyweave.operators import blocks as B
from tallyweave.operators import consensus as C
from tallyweave.operators import extract as R
from tallyweave.operators import layout as L
from tallyweave.operators import matching as M
from tallyweave.operators.skew import hot_keys, salted_join
from tallyweave.sources import files, providers, sinks


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


def test_scalars(spark):
    for text, want in (("1.234,56", "1234.56"), ("1,234.56", "1234.56"), ("1.234", "1.234"), ("1,5", "1.5"), ("1.234.567", "1234.567"), ("$12", "12"), ("", None), ("x", None), ("1 234,56", None), (None, None)):
        got = one(spark, text, X.to_decimal)
        assert got == (None if want is None else Decimal(want)), text
    for text, want in (("2024-3-7", "2024-03-07"), ("31.12.2024", "2024-12-31"), ("12/31/2024", "2024-12-31"), ("01/02/2024", None), ("2024-13-01", None), ("x", None)):
        assert one(spark, text, X.iso_date) == want, text
    assert one(spark, "  ＡＢ  Straße. ", X.name_key) == "ab strasse"
    assert one(spark, "de 12-3.4", X.identifier_key) == "DE1234"
    assert one(spark, "Ünï", X.unaccented) == "Uni"
    assert one(spark, " 19 % ", X.rate) == Decimal("19")
    assert one(spark, "a 1.200,00 b 3,50", X.amounts) == ["1.200,00", "3,50"]


def test_blocks(spark):
    docs = spark.createDataFrame([(1, "Invoice\n\nA-1\nTotal 3"), (2, None), (3, "")], "doc_id long, text string")
    df = B.blocks(docs)
    assert [(r.block_index, r.content) for r in df.orderBy("block_index").collect()] == [(0, "Invoice"), (2, "A-1"), (3, "Total 3")]
    assert B.label_values(docs, "^Invoice$").first()["value"] == "A-1"
    assert [r.scope for r in B.scope_filled(docs, {"t": "Total"}).orderBy("block_index").collect()] == [None, None, "t"]
    assert B.look_ahead(docs, "^Invoice$", "[0-9]$", 5).first()["found"] == "A-1" and B.look_ahead(docs, "^Invoice$", "zzz").first()["found"] is None


def test_layout(spark):
    cells = spark.createDataFrame([(1, i, float(i), float(y), "c") for i, y in enumerate((10, 15, 21, 23, 34, 36))], "page_id long, cell_id long, x double, y double, content string")
    assert [r.row_no for r in L.rows(cells).orderBy("cell_id").collect()] == [1, 1, 1, 2, 2, 3]
    labels = spark.createDataFrame([(1, 1, 0.0, 19.0, "l")], cells.schema)
    values = spark.createDataFrame([(1, 2, 50.0, 39.0, "v"), (1, 3, 30.0, 60.0, "v"), (1, 4, 90.0, 0.0, "v")], cells.schema)
    assert tuple(L.nearest_right(labels, values).first()) == (1, 1, 2, 50.0)
    stop = spark.createDataFrame([(1, 9, 20.0, 20.0, "b")], cells.schema)
    assert L.nearest_right(labels, values, 20.0, stop).count() == 0


def test_matching(spark):
    master = spark.createDataFrame([("A", "v1", "n1"), ("B", "v2", "n1"), ("C", None, "n3")], "master_id string, vat string, name string")
    obs = spark.createDataFrame([(1, "v1", None), (2, "v1", "n3"), (3, None, "n1"), (4, "", "n3"), (5, "zz", None), (6, None, None), (6, None, None)], "obs_id long, vat string, name string")
    got = {r.obs_id: (r.status, r.master_id, r.method) for r in M.match_by_signals(obs, master, ["vat", "name"]).collect()}
    assert got == {1: ("matched", "A", "exact_vat"), 2: ("ambiguous", None, "conflicting_vat_name"), 3: ("ambiguous", None, "ambiguous_name"), 4: ("matched", "C", "exact_name"), 5: ("no_match", None, "none"), 6: ("no_match", None, "none")}
    c = {r.obs_id: r.method for r in M.cascade(obs.where("obs_id < 6"), master, [("vat", F.col("vat"), F.col("vat")), ("name", F.col("name"), F.col("name"))]).collect()}
    assert c == {1: "vat", 2: "vat", 3: "name", 4: "name", 5: "none"}


def test_hot_keys_join_like_plain_ones(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 90).cast("string"))).alias("k"))
    small = big.select("k").distinct().withColumn("v", F.length("k"))
    assert hot_keys(big, "k") == ["hot"]
    assert salted_join(big, small, "k").exceptAll(big.join(small, "k", "left")).count() == 0
    assert salted_join(big, small, "k", "inner").count() == 3000


def test_consensus(spark):
    df = spark.createDataFrame([("k", "a", 1, None), ("k", "b", 2, "x"), ("k", "a", 3, "x"), (None, "z", 4, "x")], "key string, f string, ev long, g string")
    obs = C.observations(df, "key", ["f", "g"], "ev")
    assert {(r.field, r.value, r.n_values) for r in C.consensus(obs).collect()} == {("f", None, 2), ("g", "x", 1)}
    assert {(r.value, r.n_seen) for r in C.conflicts(obs).collect()} == {("a", 2), ("b", 1)}
    assert C.first_known(df, "key", ["f", "g"], ["ev"]).first()["g"] == "x"
    t = spark.createDataFrame([(1, 1, "VAT", None), (1, 2, None, "5"), (1, 3, "GST", None)], "doc long, n long, name string, amount string")
    assert [(r.cluster, r["name"], r.amount, r.n_rows) for r in C.complementary(t, ["doc"], ["n"], ["name", "amount"]).orderBy("cluster").collect()] == [(1, "VAT", "5", 2), (2, "GST", None, 1)]
    a = spark.createDataFrame([(1, 1, "p", None), (1, 2, None, "7")], "doc long, n long, q string, r string")
    b = spark.createDataFrame([(1, 8, "p", "7"), (1, 9, None, "7")], "doc long, n long, q string, r string")
    assert sorted((r.left_id, r.right_id) for r in C.paired(a, b, ["doc"], ["q", "r"], "n").collect()) == [(1, 8), (2, 9)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A_2.PDF").write_bytes(b"x")
    (tmp_path / "in" / "b_10.pdf").write_bytes(b"yy")
    found = files.discover(spark, str(tmp_path / "in"), "*.{pdf,PDF}", content=True)
    assert [r.page_number for r in files.in_order(found).collect()] == [2, 10]

    class Engine:
        def read(self, path, content):
            if content == b"x":
                raise ValueError("broken")
            yield {"content": "hi", "confidence": 0.5, "bbox": [1, 2, 3, 4]}

    got = {r.status: r for r in providers.recognized(found, Engine).collect()}
    assert got["failed"].error == "broken" and got["success"].content == "hi" and got["success"].y1 == 4.0
    page = {"document": "d", "page": 1, "status": "success", "blocks": [{"text": "t", "confidence": 0.9, "bbox": [1, 2, 3, 4]}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    assert files.pages(spark, str(tmp_path / "p.json")).first()["x1"] == 3
    (tmp_path / "m.json").write_text(json.dumps([{"code": "a"}, {"code": "a"}]))
    try:
        files.checked(files.master(spark, str(tmp_path / "m.json"), "tax_master"), "tax_master")
        raise AssertionError
    except ValueError as e:
        assert "repeated" in str(e)
    f = spark.createDataFrame([("x",), ("y",)], "file string")
    body = {r.file: json.loads(r.body) for r in sinks.envelopes(f, spark.createDataFrame([("x", 1)], "file string, n int"), spark.createDataFrame([("y", None)], "file string, why string")).collect()}
    assert body == {"x": {"file": "x", "payables": [{"n": 1}], "declined": []}, "y": {"file": "y", "payables": [], "declined": [{"why": None}]}}
    sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "i int, dates array<string>"), str(tmp_path / "csv"))
    assert pd.concat(pd.read_csv(p) for p in (tmp_path / "csv").glob("*.csv")).dates.tolist() == ["a|b"]


def test_evidence_of_all_sources(spark):
    from tallyweave.sources import evidence as E

    pages = spark.createDataFrame([("d", 1, "A long line of native text\n\nand more"), ("d", 2, " . "), ("d", 3, None)], "doc_id string, page int, text string")
    assert [r.kind for r in E.native_pages(pages).orderBy("page").collect()] == ["native", "image", "image"]
    ocr = E.from_recognition(spark.createDataFrame([("d", 2, 0, "Total", 0.9, [[1.6, 2.0], [9.0, 2.0], [9.0, 5.4], [1.6, 5.4]])], "doc_id string, page int, block_index int, content string, confidence double, polygon array<array<double>>"))
    seen = E.from_vision(spark.createDataFrame([("d", 3, "one\ntwo", True), ("d", 4, None, False)], "doc_id string, page int, answer string, ok boolean"))
    rows = E.from_native(pages).unionByName(ocr).unionByName(seen)
    assert rows.columns == list(E.COLUMNS) and rows.select("evidence_id").distinct().count() == rows.count() == 6
    r = ocr.first()
    assert (r.x0, r.y0, r.x1, r.y1, r.confidence) == (2.0, 2.0, 9.0, 5.0, 0.9) and seen.where("confidence is not null").count() == 0
    wanted = spark.createDataFrame([("d", 1), ("d", 2), ("d", 2)], "doc_id string, page int")
    got = E.acquired(wanted, ocr, seen.withColumn("page", F.lit(1)), ["doc_id", "page"])
    assert sorted((r.page, r.origin) for r in got.collect()) == [(1, "read"), (1, "read"), (2, "cache")]
    langs = spark.createDataFrame([("de-DE",), ("th",), (None,), ("xx",)], "language string")
    assert [r.model for r in E.models_for(langs, {"de": "latin", "th": "thai"}, "base").collect()] == ["latin", "thai", "base", "base"]
    known = spark.createDataFrame([("x/page_001.png",), ("x/page-002.png",)], "path string")
    paths = spark.createDataFrame([("d", i, f"x/page-00{i}.png") for i in (1, 2, 3)], "doc_id string, page int, path string")
    assert [r.path for r in E.image_paths(paths, known).orderBy("page").collect()] == ["x/page_001.png", "x/page-002.png", None]


def test_renderers_and_vision_fail_alone(spark, tmp_path):
    found = spark.createDataFrame([("a", b"x"), ("b", b"y")], "path string, content binary")

    class Draw:
        def render(self, path, content, dpi):
            if content == b"y":
                raise ValueError("torn")
            yield {"page": 1, "image": b"png", "width": 2, "height": 3}

    images = providers.rendered(found, Draw)
    total = {r.path: (r.n_pages, r.n_failed, r.n_bytes, r.n_pixels) for r in sinks.render_manifest(images).collect()}
    assert total == {"a": (1, 0, 3, 6), "b": (0, 1, None, None), None: (1, 1, 3, 6)}

    class Ask:
        def ask(self, image, prompt):
            if image == "b":
                raise RuntimeError("key s3cret refused")
            return f"{prompt} {image}"

    got = {r.page: (r.answer, r.ok, r.error) for r in providers.asked(spark.createDataFrame([("d", 1, "a"), ("d", 2, "b")], "doc_id string, page int, path string"), Ask, "read", ("s3cret",)).collect()}
    assert got == {1: ("read a", True, None), 2: (None, False, "key *** refused")}
    assert providers.asked(spark.createDataFrame([("d", 1, "a")], "doc_id string, page int, path string"), providers.NoVision, "read").first()["ok"] is False
    sinks.write_each(spark.createDataFrame([("a.pdf", "{}"), ("b.pdf", "{}")], "file string, body string"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("file=*")) == ["file=a.pdf", "file=b.pdf"]


def test_store(spark, tmp_path):
    from tallyweave.sources.store import LOOKUPS, MasterStore

    s = MasterStore.from_records(spark, suppliers=[{"supplier_id": "S1", "name": " Alpha. ", "vat_id": "de 12-3"}, {"supplier_id": "S2", "name": "alpha"}], payment_terms=[{"payment_term_id": "T", "days": 30}])
    assert s.find("supplier_by_vat", "DE123").first()["supplier_id"] == "S1" and s.find("supplier_by_name", "ALPHA").count() == 2
    assert s.find("terms_by_days", 30).count() == 1 and s.find("supplier_by_email", "").count() == 0 and len(LOOKUPS) == 15
    assert {r["key"]: r.n_rows for r in s.index("supplier_by_name").collect()} == {"alpha": 2}
    try:
        MasterStore.from_records(spark, suppliers=[{"nom": "x"}])
        raise AssertionError
    except ValueError as e:
        assert "nom" in str(e)
    (tmp_path / "payment_terms.json").write_text(json.dumps([{"payment_term_id": "T", "days": 30, "text_aliases": ["net"]}]))
    assert MasterStore.from_folder(spark, str(tmp_path), ("payment_terms",)).find("term_by_id", " T ").count() == 1


def test_entry(spark):
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 90
    assert entry.entry(spark).count() > 0


def test_extraction(spark):
    lines = ["toner | 3 | 1.200,50 | 3601,50 EUR", "Description | Quantity | Unit price | Amount", "a  2  3.00  6.00", "12 | 1 | 2 | 3", "Total: EUR 3 601,50", ": x", "b | x | 1 | 2", None]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc_id long, block_index int, content string")
    assert [tuple(r)[2:] for r in R.table_lines(df).orderBy("block_index").collect()] == [("toner", 3.0, 1200.5, 3601.5, "EUR"), ("a", 2.0, 3.0, 6.0, "")]
    got = R.labelled(df, {"total": "(?i)total"}).first()
    assert (got.field, got.value) == ("total", "EUR 3 601,50")
    assert tuple(spark.createDataFrame([(got.value,)], "v string").select(*R.money(F.col("v"))).first()) == ("EUR", Decimal("3601.5"))
    v = spark.createDataFrame([(1, "$"), (2, "$"), (3, "EUR"), (4, "$")], "k long, code string")
    h = spark.createDataFrame([(1, "USD"), (1, None), (2, "USD"), (2, "GHS"), (3, "USD")], "k long, hint string")
    assert {r.k: r.code for r in R.contexts(v, "k", "code", h, "hint").collect()} == {1: "USD", 2: "$", 3: "EUR", 4: "$"}
    cells = spark.createDataFrame([(1, i, x, 0.0, "c") for i, x in enumerate((5.0, 9.0, 30.0))], "page_id long, cell_id long, x double, y double, content string")
    assert [r.bucket for r in L.x_buckets(cells, 10.0).orderBy("cell_id").collect()] == [1, 1, 2]


def test_streams(spark):
    from tallyweave.operators.orphans import OrphanState, step
    from tallyweave.streaming import streams

    d = "/root/testdata/sf0.001"
    refs = streams.table_stream(spark, d, "po_master").select(F.col("po_row_id").alias("ref_id"), F.col("supplier_id").alias("ref_key"), F.col("created_at").alias("ref_at"))
    parents = spark.read.parquet(f"{d}/suppliers.parquet").select(F.col("supplier_row_id").alias("parent_id"), F.col("supplier_id").alias("ref_key"), F.col("loaded_at").alias("valid_from"), F.col("deleted_at").alias("valid_to"))
    state = streams.orphans_on_stream(refs, step(OrphanState.new(spark, buckets=2), new_parents=parents))
    assert state.orphans().count() == entry.queries()["p3_found"](spark, d).count()
    seen = streams.first_seen(streams.table_stream(spark, d, "events").select(F.col("event_id").alias("evidence_id"), "ts"))
    assert streams.run_all(seen, "append").count() == spark.read.parquet(f"{d}/events.parquet").select("event_id").distinct().count()
