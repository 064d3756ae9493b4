"""End-to-end jobs on authored pages, streaming resume, and the driver contract."""

import os


from tests.test_extract import BASE, ITEM_TD, ITEM_TH, KIDS, LARGE, LISTING, MENU, SIZES, SMALL

MENU_B = """<html><body><div class="category"><ul class="list rest_item_list ab1">
<li><a href="/b-taco/soda">Soda</a></li></ul></div></body></html>"""


def _write_pages(spark, path):
    pages = [("/", LISTING), ("/a-burger", MENU), ("/a-burger/classic", ITEM_TH), ("/a-burger/double", ITEM_TD),
             ("/fries", KIDS), ("/b-taco", MENU_B), ("/b-taco/soda", SIZES), ("/soda/small", SMALL),
             ("/soda/large", LARGE), ("/soda/kids", KIDS)]
    rows = [(i, f"{BASE}{u}", h) for i, (u, h) in enumerate(pages)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.mode("overwrite").parquet(path)


def test_ingest_enrich_publish(spark, scratch):
    from menulake.plans.jobs import EnrichInputs, IngestOptions, run_all
    pages = os.path.join(scratch, "pages")
    _write_pages(spark, pages)
    root = os.path.join(scratch, "lake")
    lookup = spark.createDataFrame([("a burger two", "Fast Food", "American", 0)],
                                   "name string, restaurant_category string, restaurant_cultural_cuisine string, "
                                   "lookup_pos int")
    empty = spark.createDataFrame([], "key string, attempt int, answer string")
    opts = IngestOptions(listing_url=f"{BASE}/", base_url=BASE, max_items_per_brand=2)
    out = run_all(spark, pages, root, "2024-01-01T00:00:00", opts,
                  EnrichInputs(lookup, empty, empty, "lookup_pos"))
    # brands: a-burger (last name wins), b-taco; c (other host) has no stored page
    assert out["ingest"]["brands"] == 3
    assert out["ingest"]["menu_items"] == 3          # two of a-burger (limit 2), soda of b-taco
    assert out["ingest"]["variations"] == 5          # classic, double, and three soda sizes
    assert all(s["ok"] for s in out["enrich"])
    pub = out["publish"]
    assert pub["brands"]["inserted"] == 3 and pub["variations"]["inserted"] == 5
    brands = {r["brand_name"]: r for r in spark.read.parquet(f"{root}/published/brands").collect()}
    assert brands["A Burger Two"]["category_source"] == "lookup"
    assert brands["B Taco"]["restaurant_category"] == "Fast Food"
    items = {r["name"]: r for r in spark.read.parquet(f"{root}/published/menu_items").collect()}
    assert items["Classic"]["estimated_price"] == "9.99"
    assert items["Soda"]["menu_item_image_url"] == f"{BASE}/item-photos/small.jpg"
    stats = spark.read.json(f"{root}/stats").first()
    assert stats["processed"] == 5
    # a second publish of the same run matches everything and modifies nothing
    from menulake.plans.jobs import publish
    again = publish(spark, root, "2024-01-02T00:00:00")
    assert again["brands"]["inserted"] == 0 and again["brands"]["modified"] == 0


def test_stream_ingest_resumes(spark, scratch):
    from menulake.streaming.ingest import stream_ingest
    src = os.path.join(scratch, "src")
    _write_pages(spark, src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    assert stream_ingest(spark, src, out, ckpt) == 1
    n = spark.read.parquet(out).count()
    assert n == 10
    assert stream_ingest(spark, src, out, ckpt) == 0          # nothing new: no batch
    assert spark.read.parquet(out).count() == n


def test_stream_upsert_replay_is_harmless(spark, scratch):
    from menulake.streaming.ingest import latest_stream_snapshot, stream_upsert
    src = os.path.join(scratch, "fresh")
    spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int").write.parquet(src + "/1")
    base = spark.createDataFrame([("a", 0), ("z", 9)], "_id string, v int")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    stream = spark.readStream.schema("_id string, v int").parquet(src + "/*")
    assert stream_upsert(spark, stream, out, ckpt, "_id", "v", base=base) == 1
    first = sorted(tuple(r) for r in latest_stream_snapshot(spark, out).collect())
    assert first == [("a", 1), ("b", 2), ("z", 9)]
    # a replay of batch 0 (fresh checkpoint, same output) rewrites the same snapshot
    stream = spark.readStream.schema("_id string, v int").parquet(src + "/*")
    stream_upsert(spark, stream, out, os.path.join(scratch, "ckpt2"), "_id", "v", base=base)
    assert sorted(tuple(r) for r in latest_stream_snapshot(spark, out).collect()) == first


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25 and sum(r["variations"] for r in rows) > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_publish_replay_same_run_is_idempotent(spark, scratch):
    from menulake.plans.jobs import publish
    from menulake.sources.io import write_snapshot
    root = os.path.join(scratch, "lake")
    b = spark.createDataFrame([("b1", "Brand One", 0)], "_id string, brand_name string, brand_pos long")
    write_snapshot({"brands": b}, f"{root}/enriched", "r1")
    first = publish(spark, root, "r1")
    again = publish(spark, root, "r1")      # replay of the same run
    assert first["brands"]["inserted"] == 1 and again["brands"]["inserted"] == 1
    assert spark.read.parquet(f"{root}/published/brands").count() == 1


def _keyed_document(folder, file, brand, items=()):
    import json
    os.makedirs(folder, exist_ok=True)
    doc = {brand: {"url": f"https://s.org/{brand}", "restaurant_logo": "", "items": [
        {"name": n, "url": f"https://s.org/{brand}/{n}", "category": "C",
         "nutritional_values": {"serving_sizes": [{"size_label": "S", "nutrition": {"calories": "100"}}]}} for n in items]}}
    with open(os.path.join(folder, file), "w") as fh:
        json.dump(doc, fh)


def test_stream_keyed_documents_resume(spark, scratch):
    from menulake.sources.io import latest_snapshot
    from menulake.streaming.ingest import stream_keyed_documents
    src, root, ckpt = (os.path.join(scratch, x) for x in ("docs", "lake", "ckpt"))
    _keyed_document(src, "a.json", "Brand A", ["One"])
    assert stream_keyed_documents(spark, src, root, ckpt, "2024-01-01") == 1
    assert stream_keyed_documents(spark, src, root, ckpt, "2024-01-01") == 0      # nothing new
    _keyed_document(src, "b.json", "Brand B")
    _keyed_document(src, "c.json", "Brand C", ["Two"])
    assert stream_keyed_documents(spark, src, root, ckpt, "2024-01-02", max_files=1) == 2
    # the newest snapshot holds the brands of all three batches
    names = lambda: sorted(r["brand_name"] for r in latest_snapshot(spark, f"{root}/raw", "brands").collect())
    assert names() == ["Brand A", "Brand B", "Brand C"]
    assert latest_snapshot(spark, f"{root}/raw", "variations").count() == 2
    # a later dated run sorts behind the stream's snapshots
    from menulake.sources.io import write_snapshot
    later = latest_snapshot(spark, f"{root}/raw", "brands").drop("run_ts").limit(1)
    write_snapshot({"brands": later}, f"{root}/raw", "2024-01-03")
    assert len(names()) == 1


def test_resumed_ingest_keeps_the_saved_brands(spark, scratch):
    from menulake.plans.jobs import IngestOptions, ingest
    from menulake.sources.io import latest_snapshot
    pages, root = os.path.join(scratch, "pages"), os.path.join(scratch, "lake")
    _write_pages(spark, pages)
    one = IngestOptions(listing_url=f"{BASE}/", base_url=BASE, brands=["B Taco"])
    rest = IngestOptions(listing_url=f"{BASE}/", base_url=BASE, resume=True)
    assert ingest(spark, pages, root, "2024-01-01", one)["brands"] == 1
    assert ingest(spark, pages, root, "2024-01-02", rest)["brands"] == 3
    got = latest_snapshot(spark, f"{root}/raw", "brands").collect()
    assert len(got) == 3 and "B Taco" in {r["brand_name"] for r in got}
    assert ingest(spark, pages, root, "2024-01-03", rest)["brands"] == 3          # nothing new
    assert {r["run_ts"] for r in latest_snapshot(spark, f"{root}/raw", "brands").collect()} == {"2024-01-02"}


def test_publish_keeps_one_row_per_id(spark, scratch):
    from menulake.plans.jobs import publish
    from menulake.sources.io import write_snapshot
    root = os.path.join(scratch, "lake")
    rows = spark.createDataFrame([("b1", "First", 0), ("b1", "Last", 2), ("b2", "Two", 1)],
                                 "_id string, brand_name string, brand_pos long")
    write_snapshot({"brands": rows}, f"{root}/enriched", "r1")
    want = {"inserted": 2, "matched": 0, "modified": 0, "errors": 0, "validation_errors": 0}
    assert publish(spark, root, "r1")["brands"] == want
    for run in ("r2", "r3"):
        assert publish(spark, root, run)["brands"] == want | {"inserted": 0, "matched": 2}
        published = spark.read.parquet(f"{root}/published/brands/run_ts={run}").collect()
        assert sorted(tuple(r) for r in published) == [("b1", "Last"), ("b2", "Two")]


def test_later_columns_stay_and_bad_files_raise(spark, scratch):
    import pytest
    from menulake.sources.io import latest_snapshot, snapshot_before, write_snapshot
    write_snapshot({"brands": spark.createDataFrame([("b1", "A")], "_id string, brand_name string")}, scratch, "2024-01-01T00:00:00")
    write_snapshot({"brands": spark.createDataFrame([("b1", "A", "u")], "_id string, brand_name string, source_url string")}, scratch, "2024-01-02T00:00:00")
    df = latest_snapshot(spark, scratch, "brands")
    assert df.columns == ["_id", "brand_name", "source_url", "run_ts"] and df.first()["run_ts"] == "2024-01-02T00:00:00"
    assert snapshot_before(spark, scratch, "brands", "2024-01-01T00:00:00") is None
    folder = next(os.path.join(d, f) for d, _, fs in os.walk(scratch) if "01-02" in d for f in fs if f.endswith(".parquet"))
    with open(folder, "wb") as fh:
        fh.write(b"no parquet")
    with pytest.raises(Exception):
        snapshot_before(spark, scratch, "brands", "2024-01-03").collect()


def test_stream_upsert_repeated_keys(spark, scratch):
    from menulake.streaming.ingest import latest_stream_snapshot, stream_upsert
    src = os.path.join(scratch, "fresh")
    spark.createDataFrame([("a", 1), ("a", 2)], "_id string, v int").coalesce(1).write.parquet(src + "/1")
    base = spark.createDataFrame([("a", 0)], "_id string, v int")
    stream = spark.readStream.schema("_id string, v int").parquet(src + "/*")
    out = os.path.join(scratch, "out")
    stream_upsert(spark, stream, out, os.path.join(scratch, "ckpt"), "_id", "v", base=base)
    assert [tuple(r) for r in latest_stream_snapshot(spark, out).collect()] == [("a", 2)]


def test_ingredients_that_are_no_text_are_null(spark, scratch):
    import json
    from menulake.operators.normalize import to_variations
    from menulake.sources.io import read_keyed
    sizes = {"serving_sizes": [{"size_label": "S", "nutrition": {}}]}
    items = [{"name": n, "url": n, "nutritional_values": sizes} | extra for n, extra in (
        ("a", {"ingredients": "salt"}), ("b", {"ingredients": ["salt", "oil"]}), ("c", {"ingredients": 5}), ("d", {}), ("e", {"ingredients": None}))]
    with open(os.path.join(scratch, "x.json"), "w") as fh:
        json.dump({"B": {"url": "u", "items": items}}, fh)
    _, _, servings = read_keyed(spark, scratch)
    got = [r["ingredients"] for r in to_variations(servings, "t").orderBy("item_pos").collect()]
    assert got[:4] == ["salt", None, None, ""] and got[4] in ("", None)


def test_streams_read_a_table_that_is_a_folder(spark, scratch):
    from menulake.plans.catalog import QUERIES
    from tests.conftest import SF_SMALL
    for name, table in (("stream_page_titles", "pages"), ("stream_upsert_orders", "orders")):
        sf = os.path.join(scratch, name)
        spark.read.parquet(f"{SF_SMALL}/{table}.parquet").repartition(3).write.parquet(f"{sf}/{table}.parquet")
        got, want = (sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in (sf, SF_SMALL))
        assert got and got == want


def _raw_lake(spark, root, run):
    from menulake.plans import bindings as B, domain
    from menulake.plans.jobs import EnrichInputs
    from menulake.sources.io import write_snapshot
    from tests.conftest import SF_SMALL
    part = B.read(spark, SF_SMALL, "part")
    write_snapshot({"brands": domain.brands(spark, SF_SMALL), "menu_items": domain.menu_items(spark, SF_SMALL).drop("brand_name"),
                    "variations": domain.variations(spark, SF_SMALL)}, f"{root}/raw", run)
    return EnrichInputs(B.category_lookup(part), B.brand_answers(part), B.item_answers(part), "lookup_pos")


def _written(root, column):
    """The folders under a lake whose files hold a column."""
    import pyarrow.parquet as pq
    return sorted({os.path.relpath(d, root) for d, _, fs in os.walk(root) for f in fs
                   if f.endswith(".parquet") and column in pq.ParquetFile(os.path.join(d, f)).schema_arrow.names})


def test_enriched_tables_are_written_once(spark, scratch, monkeypatch):
    from menulake.plans import jobs
    from menulake.sources.io import latest_snapshot
    root = os.path.join(scratch, "lake")
    inputs = _raw_lake(spark, root, "r1")
    steps = jobs.enrich(spark, root, "r1", inputs)
    assert all(s.ok for s in steps)
    # servings (the largest table) are in the raw and in the enriched snapshot, and nowhere else
    assert _written(root, "serving_pos") == ["enriched/variations/run_ts=r1", "raw/variations/run_ts=r1"]
    got = {c: latest_snapshot(spark, f"{root}/enriched", c).drop("run_ts") for c in jobs.COLLECTIONS}
    assert not set(jobs.STATUS_COLUMNS) & {c for df in got.values() for c in df.columns}
    assert got["variations"].where("golden_ratio IS NULL").count() < got["variations"].count() == latest_snapshot(spark, f"{root}/raw", "variations").count()
    assert got["menu_items"].where("menu_item_image_url IS NOT NULL AND macronutrient_profile IS NOT NULL AND description IS NOT NULL").count() > 0
    want = {c: sorted(map(str, df.collect())) for c, df in got.items()}
    # written again, and without its last steps: the last good tables are the snapshot
    jobs.enrich(spark, root, "r1", inputs)
    assert {c: sorted(map(str, latest_snapshot(spark, f"{root}/enriched", c).drop("run_ts").collect())) for c in want} == want

    def broken(*_):
        raise ValueError("broken")

    monkeypatch.setattr(jobs, "attach_images", broken)
    monkeypatch.setattr(jobs, "score_variations", broken)
    steps = jobs.enrich(spark, root, "r1", inputs)
    assert [s.name for s in steps if not s.ok] == ["ratio", "image"]
    items, rows = (latest_snapshot(spark, f"{root}/enriched", c).drop("run_ts") for c in ("menu_items", "variations"))
    assert items.where("macronutrient_profile IS NOT NULL").count() > 0 and "menu_item_image_url" not in items.columns
    assert rows.count() == len(want["variations"]) and rows.where("golden_ratio IS NOT NULL").count() == 0
    assert not set(jobs.STATUS_COLUMNS) & {*items.columns, *rows.columns}
