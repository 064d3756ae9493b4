"""Edge rows and golden values for the DataFrame operators (FIXTURES.md §2-§3)."""

import json
import os

from pyspark.sql import functions as F

from menulake.functions.nutrition import golden_ratio, ratio_class
from menulake.functions.text import amount_or_zero
from menulake.operators import quality, select, stats
from menulake.operators.enrich import classify_missed, enrich_items
from menulake.operators.joins import lookup_brand, merge_partials, merge_resume, skip_done
from menulake.operators.normalize import nested_to_flat, to_brands, to_menu_items, to_variations
from menulake.operators.score import score_variations
from menulake.operators.upsert import upsert
from menulake.schemas import RAW_KEYED_TYPE

# Golden input: (calories, protein) text of the 25 flat items of one example run;
# the published report for them is 0 / 10 / 15 and min .035, max .812, mean .452, median .477.
# The 25 scored rows of a published example run (calories, protein).
EXAMPLE_25 = [
    ("319.0", "1.5g"), ("289.0", "1.0g"), ("300.0", "3.0g"), ("190.0", "4.0g"), ("253.0", "1.0g"),
    ("550.0", "30.0g"), ("322.0", "25.0g"), ("610.0", "34.0g"), ("529.0", "32.0g"), ("533.0", "33.0g"),
    ("379.0", "29.0g"), ("431.0", "30.0g"), ("557.0", "27.0g"), ("221.0", "17.0g"), ("546.0", "22.0g"),
    ("746.0", "33.0g"), ("704.0", "28.0g"), ("820.0", "33.0g"), ("448.0", "13.0g"), ("271.0", "22.0g"),
    ("362.0", "13.0g"), ("742.0", "31.0g"), ("669.0", "32.0g"), ("428.0", "24.0g"), ("524.0", "25.0g"),
]


def test_ratio_report_matches_example_run(spark):
    df = spark.createDataFrame(EXAMPLE_25, "cal string, p string")
    scored = df.select(F.struct(amount_or_zero("cal").alias("calories"),
                                amount_or_zero("p").alias("protein_g")).alias("nutrition"))
    scored = score_variations(scored)
    r = stats.ratio_report(scored).first()
    assert (r["total_items"], r["processed"], r["skipped"], r["no_nutrition_data"]) == (25, 25, 0, 0)
    assert tuple(r["ratio_stats"]) == (0, 10, 15)
    assert tuple(r["ratio_distribution"]) == (0.035, 0.812, 0.452, 0.477)


def test_ratio_status_zero_counts_as_done(spark):
    df = spark.createDataFrame([(0.0, 10.0, 100.0), (None, 10.0, 100.0)],
                               "golden_ratio double, p double, cal double")
    df = df.select("golden_ratio", F.struct(F.col("cal").alias("calories"),
                                             F.col("p").alias("protein_g")).alias("nutrition"))
    got = [(r["ratio_status"], r["golden_ratio"]) for r in score_variations(df).collect()]
    assert got == [("skipped", 0.0), ("processed", 1.0)]


def test_upper_median_even_count(spark):
    df = spark.createDataFrame([(x, "processed") for x in (0.1, 0.2, 0.3, 0.4)],
                               "golden_ratio double, ratio_status string")
    assert stats.ratio_distribution(df).first()["median"] == 0.3


def test_upper_median_is_that_of_the_sorted_ratios(spark):
    import random
    r = random.Random(3)
    for n in (1, 2, 7, 200, 999):
        ratios = [round(r.choice((1, 1, 40, -3, 90_000)) * r.choice((r.random(), 0.25)), 3) for _ in range(n)]
        rows = [(x, "processed", r.choice(("Good", "Poor", None))) for x in ratios]
        rows += [(None, "processed", None), (5.0, "skipped", "Good"), (None, "no_data", None), (9.0, None, None)]
        df = spark.createDataFrame(rows, "golden_ratio double, ratio_status string, golden_ratio_category string")
        want = sorted(ratios)[n // 2]
        assert stats.ratio_distribution(df).first()["median"] == want
        report = stats.ratio_report(df).first()
        assert (report["total_items"], report["processed"], report["skipped"]) == (n + 4, n + 1, 1)
        assert report["ratio_distribution"]["median"] == want
        assert tuple(report["ratio_distribution"]) == tuple(stats.ratio_distribution(df).first())
    assert tuple(stats.ratio_distribution(df.limit(0)).first()) == (None,) * 4
    empty = stats.ratio_report(df.limit(0)).first()
    assert (empty["total_items"], empty["processed"], empty["ratio_distribution"]) == (0, 0, None)


def test_ratio_rounding_ties(spark):
    df = spark.createDataFrame([(2.0, 64.0), (40.0, 400.0), (5.0, 0.0)], "p double, cal double")
    got = [(r[0], r[1]) for r in df.select(golden_ratio("p", "cal").alias("r"))
           .select("r", ratio_class("r")).collect()]
    assert got == [(0.312, "Poor"), (1.0, "Excellent"), (0.0, "Poor")]


def test_dedup_last_and_first(spark):
    df = spark.createDataFrame([("a", 1, "a1"), ("b", 2, "b2"), ("a", 3, "a3")], "url string, pos int, v string")
    last = sorted(tuple(r) for r in select.dedup_last(df, "url", "pos").collect())
    first = sorted(tuple(r) for r in select.dedup_first(df, "url", "pos").collect())
    assert last == [("a", 1, "a3"), ("b", 2, "b2")]
    assert first == [("a", 1, "a1"), ("b", 2, "b2")]


def test_first_image_skips_null_and_empty(spark):
    df = spark.createDataFrame([("i", 0, 0, None), ("i", 0, 1, ""), ("i", 0, 2, "http://x/3.jpg"),
                                ("i", 0, 3, "http://x/4.jpg")],
                               "menu_item_id string, item_pos long, serving_pos long, image_url string")
    assert select.first_image(df).first()["image_url"] == "http://x/3.jpg"


def test_limits(spark):
    df = spark.createDataFrame([(f"b{i % 3}", i) for i in range(12)], "brand_name string, item_pos long")
    assert select.limit_items_per_brand(df, 2).count() == 6
    assert select.limit_items_per_brand(df, 0).count() == 12
    b = spark.createDataFrame([(f"n{i}", i) for i in range(5)], "name string, brand_pos long")
    assert [r["name"] for r in select.limit_brands(b, 2).collect()] == ["n0", "n1"]
    assert select.only_brands(b, ["n1", "N2"]).count() == 1


def test_lookup_brand_trim_lower_last_wins(spark):
    brands = to_brands(spark.createDataFrame([(0, "Taco Place", "u", ""), (1, "Nope", "u2", ""),
                                              (2, "", "u3", "")],
                                             "brand_pos long, name string, url string, restaurant_logo string"),
                       "t0")
    lookup = spark.createDataFrame([(" taco place\t", "Fast Food", "Mexican", 0),
                                    ("TACO PLACE", "Fast Casual", "Tex-Mex", 1)],
                                   "name string, restaurant_category string, restaurant_cultural_cuisine string, p int")
    lb = {r["brand_name"]: r for r in lookup_brand(brands, lookup, "t1", "p").collect()}
    assert (lb["Taco Place"]["restaurant_category"], lb["Taco Place"]["category_source"]) == ("Fast Casual", "lookup")
    assert lb["Nope"]["needs_answer"] and not lb[""]["needs_answer"]
    assert lb[""]["last_updated"] == "t0"
    answers = spark.createDataFrame([(lb["Nope"]["_id"], 1, '{"restaurant_category": "Bakery"}')],
                                    "key string, attempt int, answer string")
    out = {r["brand_name"]: r for r in classify_missed(lookup_brand(brands, lookup, "t1", "p"), answers, "t1").collect()}
    assert (out["Nope"]["restaurant_category"], out["Nope"]["restaurant_cultural_cuisine"],
            out["Nope"]["category_source"]) == ("Fast Food", "American", "ai_generated")


def test_item_answers_numeric_price_and_fallback(spark):
    items = spark.createDataFrame(
        [("i1", "b1", "Soup", "Bowls", None, None, None), ("i2", "b1", "Pie", "Sweets", None, None, None),
         ("i3", "b1", "Tea", "Drinks", "Hot tea", "2.00", ["A", "B", "C"])],
        "_id string, restaurant_brand_id string, name string, category string, description string, "
        "estimated_price string, cuisine_types array<string>")
    brands = spark.createDataFrame([("b1", "Cafe")], "_id string, brand_name string")
    answers = spark.createDataFrame(
        [("i1", 1, '{"description": "Warm soup", "estimated_price": 8.5, "cuisine_types": ["X", "Y", "Z"]}'),
         ("i2", 1, '{"description": "Pie", "estimated_price": "3", "cuisine_types": ["X", "Y"]}')],
        "key string, attempt int, answer string")
    got = {r["_id"]: r for r in enrich_items(items, brands, answers).collect()}
    assert (got["i1"]["estimated_price"], list(got["i1"]["cuisine_types"])) == ("8.5", ["X", "Y", "Z"])
    assert got["i2"]["description"] == "A delicious sweets item from Cafe."
    assert got["i2"]["estimated_price"] == "9.99"
    assert got["i3"]["text_status"] == "skipped"


def test_validation_edges(spark):
    df = spark.createDataFrame(
        [("a", "b", "  ", "$1,299.00"), ("c", "b", "ok", "5d"), ("d", "b", "ok", "market price"),
         ("e", "b", "ok", " 12 ")],
        "_id string, restaurant_brand_id string, name string, estimated_price string")
    s = quality.split_valid(df, "menu_items")
    assert [r["_id"] for r in s.invalid.select("data._id").collect()] == ["a"]
    prices = {r["_id"]: r["estimated_price"] for r in quality.with_errors(df, "menu_items").collect()}
    assert prices == {"a": "$1,299.00", "c": None, "d": None, "e": " 12 "}
    v = spark.createDataFrame([("v", "m", -1.0, -1.0, 100.1, "Fair"), ("w", "m", 5.0, 0.0, 50.0, "Good")],
                              "id string, menu_item_id string, p double, t double, golden_ratio double, "
                              "golden_ratio_category string")
    v = v.select("id", "menu_item_id", F.struct(F.col("p").alias("protein_g"), F.col("t").alias("trans_fat_g"))
                 .alias("nutrition"), "golden_ratio", "golden_ratio_category")
    got = {r["_id"]: r for r in quality.with_errors(v, "variations").collect()}
    assert got["v"]["nutrition"]["protein_g"] is None and got["v"]["nutrition"]["trans_fat_g"] == -1.0
    assert got["v"]["golden_ratio"] is None and got["v"]["golden_ratio_category"] is None
    assert got["w"]["golden_ratio"] == 50.0 and list(got["w"]["errors"]) == []


def test_upsert_semantics(spark):
    base = spark.createDataFrame([("k1", "x", 1, "keep"), ("k2", "y", 2, "keep")],
                                 "_id string, a string, b int, only_base string")
    fresh = spark.createDataFrame([("k1", None, 1), ("k2", "y", 2), ("k3", "z", 3)], "_id string, a string, b int")
    res = upsert(base, fresh, "_id", "b")
    t = {r["_id"]: r for r in res.table.collect()}
    assert t["k1"]["a"] is None and t["k1"]["only_base"] == "keep"
    assert t["k3"]["only_base"] is None
    c = res.counts.first()
    assert (c["inserted"], c["matched"], c["modified"]) == (1, 2, 1)


def test_resume_and_partials(spark):
    done = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    fresh = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in merge_resume(done, fresh, "k").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert [r["k"] for r in skip_done(fresh, done, "k").collect()] == [3]
    parts = [done, fresh, spark.createDataFrame([(1, "z")], "k int, v string")]
    assert sorted(tuple(r) for r in merge_partials(parts, "k").collect()) == [(1, "z"), (2, "B"), (3, "c")]


def test_read_keyed_document_and_normalize(spark, scratch):
    doc = {"Brand A": {"url": "https://s.org/a", "restaurant_logo": "https://s.org/l.png", "items": [
        {"name": "One", "url": "https://s.org/a/1", "category": "C",
         "nutritional_values": {"serving_sizes": [
             {"size_label": "Small", "nutrition": {"calories": "100", "protein": "10g"}, "image_url": None},
             {"size_label": "Large", "nutrition": {"calories": "1,200", "total_fat": "5g", "fat": "6g"}}]},
         "allergens": {"contains": ["Milk"], "does_not_contain": [], "unknown": [], "allergy_information": ""},
         "ingredients": "milk"},
        {"url": "https://s.org/a/2"}]},
        "Brand B": {"url": "https://s.org/b", "restaurant_logo": "", "items": []}}
    path = os.path.join(scratch, "doc.json")
    with open(path, "w") as fh:
        json.dump(doc, fh)
    from menulake.sources.io import read_keyed
    rb, ri, rs = read_keyed(spark, path)
    assert [r["name"] for r in rb.orderBy("brand_pos").collect()] == ["Brand A", "Brand B"]
    items = to_menu_items(ri).orderBy("item_pos").collect()
    assert [i["name"] for i in items] == ["One", "Unknown Item"]
    assert items[1]["category"] == "Uncategorized"
    v = to_variations(rs, "t").orderBy("serving_pos").collect()
    assert [x["label"] for x in v] == ["Small", "Large"]
    assert v[1]["nutrition"]["calories"] == 1200.0 and v[1]["nutrition"]["fat_g"] == 6.0
    assert list(v[1]["allergens"]["contains"]) == ["Milk"] and v[0]["ingredients"] == "milk"
    assert v[0]["menu_item_id"] == items[0]["_id"]
    b = to_brands(rb, "t").orderBy("brand_pos").collect()
    assert b[1]["brand_image_url"] is None


def test_nested_to_flat_keeps_order(spark):
    df = spark.createDataFrame([({"X": {"url": "u", "restaurant_logo": "", "items": [
        {"name": "a"}, {"name": "b"}]}}, 0)], "doc " + RAW_KEYED_TYPE.simpleString() + ", doc_pos long")
    _, ri, _ = nested_to_flat(df)
    assert [r["name"] for r in ri.orderBy("item_pos").collect()] == ["a", "b"]


def test_snapshot_round_trip_and_latest(spark, scratch):
    from menulake.sources.io import latest_snapshot, read_records, write_snapshot
    df1 = spark.createDataFrame([("a", 1)], "_id string, v int")
    df2 = spark.createDataFrame([("a", 2), ("b", 3)], "_id string, v int")
    write_snapshot({"brands": df1}, scratch, "2024-01-01")
    write_snapshot({"brands": df2}, scratch, "2024-02-01")
    write_snapshot({"brands": df2}, scratch, "2024-02-01")   # replay: same partition rewritten
    got = sorted(tuple(r) for r in latest_snapshot(spark, scratch, "brands").select("_id", "v").collect())
    assert got == [("a", 2), ("b", 3)]
    path = os.path.join(scratch, "records.json")
    with open(path, "w") as fh:
        json.dump([{"_id": "x", "v": 1}], fh)
    assert read_records(spark, path, "_id string, v int").count() == 1
    bad = os.path.join(scratch, "bad.json")
    with open(bad, "w") as fh:
        json.dump({"_id": "x"}, fh)
    try:
        read_records(spark, bad, "_id string")
        raise AssertionError("a non-array file must fail")
    except ValueError:
        pass


def test_normalize_layout_branches_on_schema(spark):
    from menulake.sources.io import normalize_layout
    keyed = spark.createDataFrame([({"X": {"url": "u", "restaurant_logo": "", "items": [{"name": "a"}]}},)],
                                  "doc " + RAW_KEYED_TYPE.simpleString())
    layout, frames = normalize_layout(keyed)
    assert layout == "keyed" and frames[1].count() == 1
    v = spark.createDataFrame([("v", 1.0)], "_id string, nutrition double")
    assert normalize_layout(v)[0] == "variations"
    assert normalize_layout(spark.createDataFrame([("i",)], "_id string"))[0] == "items"


def test_non_numeric_nutrient_text_becomes_null(spark):
    v = spark.createDataFrame([("v", "m", "abc", "-2", "7")],
                              "_id string, menu_item_id string, p string, c string, f string")
    v = v.select("_id", "menu_item_id", F.struct(F.col("p").alias("protein_g"), F.col("c").alias("carbs_g"),
                                                 F.col("f").alias("fat_g")).alias("nutrition"))
    n = quality.with_errors(v, "variations").first()["nutrition"]
    assert (n["protein_g"], n["carbs_g"], n["fat_g"]) == (None, None, 7.0)


def test_upsert_new_columns_and_null_keys(spark):
    base = spark.createDataFrame([(f"k{i}", i, "b") for i in range(50)] + [(None, -1, "nullkey")],
                                 "_id string, v int, only_base string")
    fresh = spark.createDataFrame([(f"k{i}", i * (i % 3), "x") for i in range(40, 60)] + [(None, 7, "y")],
                                  "_id string, v int, extra string")
    res = upsert(base, fresh, "_id", "v")
    assert res.table.columns == ["_id", "v", "only_base", "extra"] and res.table.count() == 62
    c = res.counts.first()
    assert (c["inserted"], c["matched"]) == (11, 10)


def test_upsert_repeated_keys_last_wins(spark):
    base = spark.createDataFrame([("a", 0, "old")], "_id string, v int, w string")
    fresh = spark.createDataFrame([("a", 1, "x", 2), ("a", 2, "y", 1), ("b", 3, "z", 0), ("b", 3, "z", 0)],
                                  "_id string, v int, w string, pos int")
    res = upsert(base, fresh, "_id", "pos", keep_order=False)
    assert sorted(tuple(r) for r in res.table.collect()) == [("a", 1, "x"), ("b", 3, "z")]
    assert tuple(res.counts.first()) == (1, 1, 1, 0)


def test_fetch_stats_empty_log_and_stats_written_only_with_ratios(spark, scratch):
    log = spark.createDataFrame([], "source long, url string, ok boolean, attempts int, ts timestamp_ntz")
    r = stats.fetch_log_stats(log).first()
    assert (r["total_requests"], r["successful"], r["success_pct"]) == (0, 0, 0.0)
    from menulake.sources.io import write_stats
    none_scored = spark.createDataFrame([("no_data", None, None)],
                                        "ratio_status string, golden_ratio double, golden_ratio_category string")
    assert write_stats(stats.ratio_report(none_scored), scratch, "r1") is False
    scored = spark.createDataFrame([("processed", 0.5, "Good")],
                                   "ratio_status string, golden_ratio double, golden_ratio_category string")
    assert write_stats(stats.ratio_report(scored), scratch, "r2") is True
    assert spark.read.json(os.path.join(scratch, "stats")).first()["ratio_stats"]["good"] == 1


def test_ids_already_present_are_kept(spark):
    from menulake.functions.ids import kept_id, stable_id
    df = spark.createDataFrame([("x", "a"), ("", "a"), (None, "a")], "_id string, name string")
    want = df.select(stable_id("name")).first()[0]
    assert [r[0] for r in df.select(kept_id(df, "_id", "name")).collect()] == ["x", want, want]
    assert [r[0] for r in df.drop("_id").select(kept_id(df.drop("_id"), "_id", "name")).collect()] == [want] * 3


def test_steps_are_counted_while_they_are_written(spark, scratch):
    rows = [("mapped",)] * 3 + [("no_id",)] * 2
    df, seen = stats.observe_steps(spark.createDataFrame(rows, "image_status string"), "image_status")
    df.write.parquet(os.path.join(scratch, "step"))
    want = stats.step_counts(spark.read.parquet(os.path.join(scratch, "step")), "image", "image_status").collect()
    assert sorted(stats.observed_steps(seen, "image"), key=str) == sorted((r.asDict() for r in want), key=str)
    df, seen = stats.observe_steps(df.limit(0), "image_status")
    df.write.parquet(os.path.join(scratch, "none"))
    assert stats.observed_steps(seen, "image") == []


def test_variation_stages_read_each_expression_once(spark):
    from menulake.operators.normalize import to_variations
    from menulake.operators.score import score_variations
    raw = spark.createDataFrame(
        [("B", "I", "u", "S", {"calories": "10", "protein": "2g", "fat": "none", "total_fat": "1,000 g"}, "", 0, 0), ("B", None, "u", None, None, "i", 1, 0)],
        "brand_name string, item_name string, item_url string, size_label string, nutrition map<string,string>, image_url string, item_pos int, serving_pos int"
    ).selectExpr("*", "cast(null as struct<contains:array<string>,does_not_contain:array<string>,unknown:array<string>,allergy_information:string>) allergens", "'' ingredients")
    scored = score_variations(to_variations(raw, "t"))
    a, b = scored.orderBy("item_pos").collect()
    assert (a["nutrition"]["fat_g"], a["golden_ratio"], a["golden_ratio_category"]) == (1000.0, 2.0, "Excellent")
    assert b["nutrition"]["calories"] is None and b["nutrition"] is not None and (b["label"], b["golden_ratio"]) == ("1 serving", 0.0)
    # ids hash once a level, and a ratio parses its two numbers alone
    plan = scored.select("_id", "menu_item_id", "golden_ratio", "golden_ratio_category")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") == 3 and plan.count("regexp_extract(") == 2


def test_the_report_sums_servings_up_before_they_meet_their_items(spark, scratch):
    from menulake.operators.joins import profile_items
    from menulake.plans import domain
    from menulake.plans.reports import brand_protein_report

    sf = "/root/testdata/sf0.001"
    li, part = spark.read.parquet(f"{sf}/lineitem.parquet"), spark.read.parquet(f"{sf}/part.parquet")
    twice = part.where("p_partkey % 5 = 0")         # a key's rows with another name, and once more as they are
    part = part.unionByName(twice.withColumn("p_name", F.concat("p_name", F.lit(" b")))).unionByName(twice.where("p_partkey % 10 = 0"))
    odd = li.limit(500)
    li = (li.unionByName(odd.withColumn("l_partkey", F.lit(None).cast("long"))).unionByName(odd.withColumn("l_partkey", F.lit(10**9).cast("long")))
          .unionByName(li.withColumn("l_partkey", F.lit(5).cast("long"))).where("l_partkey IS NULL OR l_partkey % 7 <> 3"))      # unknown parts, a hot one, parts with no serving
    part.write.parquet(f"{scratch}/part.parquet")
    li.write.parquet(f"{scratch}/lineitem.parquet")

    items, scored = domain.menu_items(spark, scratch), domain.scored_variations(spark, scratch)
    cat = F.col("golden_ratio_category")
    per_item = scored.groupBy("menu_item_id").agg(
        F.count(F.lit(1)).alias("variations"), *[F.count_if(cat == c).alias(c.lower()) for c in ("Excellent", "Good", "Poor")],
        F.sum(F.round(F.col("golden_ratio") * 1000).cast("long")).alias("milli"),
        F.min_by("nutrition", F.struct("item_pos", "serving_pos")).alias("nutrition"))
    prof = profile_items(items.join(per_item, items["_id"] == per_item["menu_item_id"], "left").drop("menu_item_id"), None)
    want = prof.groupBy("brand_name").agg(
        F.count(F.lit(1)).alias("items"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("variations", "excellent", "good", "poor")],
        F.sum("milli") / F.sum("variations") / 1000,
        *[F.count_if(F.array_contains("macronutrient_profile", t)) for t in ("High Protein", "Low Carb", "Keto Friendly", "Balanced")])
    report = brand_protein_report(spark, scratch)
    got = report.drop("restaurant_category", "restaurant_cultural_cuisine", "category_source")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert sum(r["variations"] for r in want.collect()) > li.count() / 2
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1 and "SortAggregate(key=[item_pos" in plan


def test_valid_rows_are_told_without_a_lambda(spark):
    from menulake.operators.quality import split_valid, with_errors
    rows = spark.createDataFrame([("a", "i", "n"), ("", "i", "n"), (None, " ", "n"), ("b", "\t", None), ("c", "i", ""), (" ", None, "n")],
                                 "_id string, restaurant_brand_id string, name string").repartition(2)
    split = split_valid(rows, "menu_items")
    plan = split.valid._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array" not in plan
    checked = with_errors(rows, "menu_items").collect()
    assert sorted(tuple(r) for r in split.valid.collect()) == sorted(tuple(r)[:3] for r in checked if not r["errors"]) == [("a", "i", "n")]
    assert sorted(map(str, ((*r["data"], r["errors"]) for r in split.invalid.collect()))) == sorted(str((*tuple(r)[:3], r["errors"])) for r in checked if r["errors"])
    # a required column that is missing, or isn't text, makes every row invalid
    for df in (rows.drop("name"), rows.withColumn("name", rows["name"].cast("binary"))):
        assert split_valid(df, "menu_items").valid.count() == 0 and split_valid(df, "menu_items").invalid.count() == 6
