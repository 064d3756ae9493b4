"""Registry of the queries checked by the driver: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or frames Spark derives from them) in
full; none uses id subsets, modulo samples or row caps. Limits appear only in
the two operators whose feature is a limit (P-02, P-03).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menulake.functions.ids import stable_id
from menulake.functions.nutrition import enrich_serving_rows, macro_shares, profile_tags
from menulake.functions.text import (
    amount_or_zero, check_url, parse_amount, parse_unit, snake_case,
)
from menulake.operators import quality, select, stats
from menulake.operators.enrich import brand_requests, item_requests
from menulake.operators.joins import merge_partials, merge_resume, skip_done
from menulake.operators.normalize import to_menu_items
from menulake.operators.upsert import upsert
from menulake.plans import bindings as B
from menulake.plans import domain
from menulake.plans.reports import brand_protein_report
from menulake.sources.io import first_page_keys, latest_per_key, read_pages, write_stats

Query = Callable[[SparkSession, str], DataFrame]


def _tags_text(c: Column) -> Column:
    return F.array_join(c, ",")


def _date_text(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


# -- normalization (N, D-01, F-06, F-07, F-13) ---------------------------------

def q_to_brands(spark, sf):
    return domain.brands(spark, sf).select(
        "_id", "brand_name", "brand_image_url", "source_url", "eatery_full_verification_status",
        "creation_date", "last_updated", "brand_pos")


def q_to_menu_items(spark, sf):
    return domain.menu_items(spark, sf).select(
        "_id", "restaurant_brand_id", "name", "category", "source_url", "is_active", "item_pos")


def q_kept_ids(spark, sf):
    """D-01 where a third of the items has an id, a third an empty one and a third none."""
    raw = B.raw_items(B.read(spark, sf, "part"))
    own = F.concat(F.lit("item-"), F.col("item_pos").cast("string"))
    third = F.col("item_pos") % 3
    raw = raw.withColumn("_id", F.when(third == 0, own).when(third == 1, F.lit("")))
    return to_menu_items(raw).select("_id", "restaurant_brand_id", "item_pos")


def q_to_variations(spark, sf):
    v = domain.variations(spark, sf)
    return v.select("_id", "menu_item_id", "restaurant_brand_id", "label",
                    F.col("serving.serving_text").alias("serving_text"), "nutrition.*",
                    "ingredients", "image_url", "is_active")


# -- text functions (F-01, F-02, F-03, F-05) -----------------------------------

def q_nutrient_text(spark, sf):
    li = B.read(spark, sf, "lineitem")
    n = B.nutrition_text()
    t = li.select(n.alias("n"))
    sodium, carbs, fat = F.col("n")["sodium"], F.col("n")["total_carbohydrates"], F.col("n")["fat"]
    return t.select(
        sodium.alias("sodium_text"), parse_amount(sodium).alias("sodium_amount"),
        amount_or_zero(sodium).alias("sodium_or_zero"), parse_unit(sodium).alias("sodium_unit"),
        carbs.alias("carbs_text"), parse_amount(carbs).alias("carbs_amount"),
        parse_unit(carbs).alias("carbs_unit"),
        parse_amount(fat).alias("fat_alt_amount"), amount_or_zero(fat).alias("fat_alt_or_zero"))


def q_snake_keys(spark, sf):
    docs = B.read(spark, sf, "documents")
    part = B.read(spark, sf, "part")
    a = docs.select(F.col("doc_id").alias("id"), F.lit("doc").alias("kind"),
                    snake_case("source").alias("key_a"), snake_case("text").alias("key_b"))
    b = part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"),
                    snake_case("p_name").alias("key_a"),
                    snake_case(F.concat_ws(" - ", "p_type", "p_brand")).alias("key_b"))
    return a.unionByName(b)


# -- scores and tags (F-08, F-09, F-10, F-11, F-12, A-01, A-02) ----------------

def q_variation_tags(spark, sf):
    n = F.col("nutrition")
    fields = ("calories", "protein_g", "carbs_g", "fat_g", "sodium_mg", "sugars_g")
    # by stages, so that each number and each share is made once a row
    v = domain.variations(spark, sf).select("_id", *[F.abs(F.coalesce(n[f], F.lit(0.0))).alias(f) for f in fields])
    v = v.withColumn("s", macro_shares(*fields[:4]))
    s = F.col("s")
    return v.select("_id", s["protein_pct"].alias("protein_pct"), s["carbs_pct"].alias("carbs_pct"),
                    s["fat_pct"].alias("fat_pct"), s["total_kcal"].alias("total_kcal"),
                    _tags_text(profile_tags(*fields, shares=s)).alias("tags"))


def q_variation_ratios(spark, sf):
    return domain.scored_variations(spark, sf).select(
        "_id", "menu_item_id", "golden_ratio", "golden_ratio_category", "ratio_status")


def q_ratio_counts(spark, sf):
    return stats.ratio_counts(domain.scored_variations(spark, sf))


def q_ratio_distribution(spark, sf):
    return stats.ratio_distribution(domain.scored_variations(spark, sf))


def q_written_report(spark, sf):
    """The run report as written next to the enriched tables, read back."""
    root = _stream_root(spark)
    report = stats.ratio_report(domain.scored_variations(spark, sf))
    write_stats(report, root, "r1")
    written = spark.read.schema(report.schema).json(f"{root}/stats/run_ts=r1")
    return written.select("total_items", "processed", "skipped", "no_nutrition_data", "errors",
                          "ratio_stats.*", "ratio_distribution.*")


def serving_arrays(li: DataFrame) -> DataFrame:
    """Two nested servings per lineitem row (bounded by construction, no grouping).

    The second serving states its kcal with a thousands separator and names its
    sugar ``sugar``; the first serving of line 1 already carries a ratio of 0.0.
    """
    # both maps are made of the same texts, each a column of its own
    li = li.withColumns({f"_{k}": v for k, v in B.nutrition_parts().items()})
    n = {k: F.col(f"_{k}") for k in B.nutrition_parts()}
    big = B.text_map({k: v for k, v in n.items() if k not in ("calories", "sugars")}
                     | {"calories": F.format_number(F.col("l_quantity") * 180, 0), "sugar": n["sugars"]})
    first = F.struct(F.lit("Regular").alias("size_label"), B.text_map(n).alias("nutrition"),
                     F.when(F.col("l_linenumber") == 1, F.lit(0.0)).alias("golden_ratio"))
    second = F.struct(F.lit("Family").alias("size_label"), F.map_filter(big, lambda k, v: v.isNotNull()).alias("nutrition"),
                      F.lit(None).cast("double").alias("golden_ratio"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.array(first, second).alias("servings"))


def q_enrich_servings(spark, sf):
    e = enrich_serving_rows(serving_arrays(B.read(spark, sf, "lineitem")), "servings")
    return e.select("l_orderkey", "l_linenumber", "l_partkey", "pos", "size_label",
                    _tags_text(F.col("macronutrient_profile")).alias("tags"),
                    "golden_ratio", "golden_ratio_category")


# -- first-of-group (D-04, D-05) and item steps (J-02, J-03) -------------------

def q_first_variation(spark, sf):
    fv = select.first_variation(domain.variations(spark, sf))
    return fv.select("menu_item_id", *[F.col("nutrition")[c].alias(c) for c in (
        "calories", "protein_g", "carbs_g", "fat_g", "sodium_mg", "sugars_g")])


def q_first_image(spark, sf):
    return select.first_image(domain.variations(spark, sf))


def q_item_profiles(spark, sf):
    p = domain.profiled_items(spark, sf)
    return p.select("_id", "profile_status", _tags_text("macronutrient_profile").alias("tags"))


def q_item_images(spark, sf):
    return domain.imaged_items(spark, sf).select("_id", "image_status", "menu_item_image_url")


# -- brand steps (J-01, E-01, E-03, A-03) --------------------------------------

def q_enriched_brands(spark, sf):
    return domain.enriched_brands(spark, sf).select(
        "_id", "brand_name", "restaurant_category", "restaurant_cultural_cuisine", "category_source",
        "lookup_hit", "last_updated")


def q_brand_step_counts(spark, sf):
    return stats.brand_step_counts(domain.enriched_brands(spark, sf))


def q_brand_requests(spark, sf):
    part = B.read(spark, sf, "part")
    from menulake.operators.joins import lookup_brand
    lb = lookup_brand(domain.brands(spark, sf), B.category_lookup(part), B.RUN_TS, "lookup_pos")
    return brand_requests(lb)


# -- item text (E-02, E-03) and step counts (A-04) -----------------------------

def q_item_text(spark, sf):
    t = domain.text_items(spark, sf)
    return t.select("_id", "text_status", "description", "estimated_price",
                    F.array_join("cuisine_types", ",").alias("cuisine_types"))


def q_item_requests(spark, sf):
    return item_requests(domain.menu_items(spark, sf), domain.brands(spark, sf))


def q_step_counts(spark, sf):
    a = stats.step_counts(domain.profiled_items(spark, sf), "profile", "profile_status")
    b = stats.step_counts(domain.text_items(spark, sf), "item_text", "text_status")
    c = stats.step_counts(domain.imaged_items(spark, sf), "image", "image_status")
    d = stats.step_counts(domain.scored_variations(spark, sf), "ratio", "ratio_status")
    return a.unionByName(b).unionByName(c).unionByName(d)


# -- totals (A-05, A-06, A-07) -------------------------------------------------

def q_nested_totals(spark, sf):
    r = domain.raw(spark, sf)
    return stats.nested_totals(r.brands, r.items, r.servings)


def q_brand_summary(spark, sf):
    return stats.brand_summary(domain.brands(spark, sf), domain.menu_items(spark, sf),
                               domain.variation_counts(spark, sf))


def q_fetch_log_stats(spark, sf):
    return stats.fetch_log_stats(B.fetch_log(B.read(spark, sf, "events")), by="source")


# -- filters and limits (P-01..P-04) -------------------------------------------

ONLY_BRANDS = ["Brand#1", "Brand#7", "Brand#13", "brand#2"]


def q_only_brands(spark, sf):
    items = domain.menu_items(spark, sf)
    return select.only_brands(items, ONLY_BRANDS, "brand_name").select("_id", "brand_name", "name")


def q_limit_brands(spark, sf):
    b = domain.brands(spark, sf)
    return select.limit_brands(b, 5).select("_id", "brand_name", "brand_pos")


def q_limit_items_per_brand(spark, sf):
    items = domain.menu_items(spark, sf)
    return select.limit_items_per_brand(items, 10).select("_id", "brand_name", "item_pos")


def customer_entries(spark, sf) -> DataFrame:
    """Brand-list entries from ``customer``: a negative balance means no link."""
    c = B.read(spark, sf, "customer")
    return c.select("c_custkey", F.col("c_name").alias("name"),
                    F.when(F.col("c_acctbal") < 0, F.lit(""))
                     .otherwise(F.concat(F.lit(B.BASE_URL + "/c/"), F.col("c_custkey").cast("string")))
                     .alias("url"))


def q_drop_incomplete(spark, sf):
    return select.drop_incomplete(customer_entries(spark, sf))


def work_state(spark, sf) -> DataFrame:
    """Items in mixed enrichment states: null, empty and filled fields from ``part``."""
    p = B.read(spark, sf, "part")
    k = F.col("p_size")
    return p.select(
        "p_partkey",
        F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("")).otherwise(F.col("p_name"))
         .alias("description"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(B.price_text(F.col("p_retailprice")))
         .alias("estimated_price"),
        F.when(k % 5 == 0, F.lit(None).cast("array<string>"))
         .when(k % 5 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("American")))
         .alias("cuisine_types"),
        F.when(k % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Low Fat")))
         .alias("macronutrient_profile"),
        F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit(None).cast("string"))
         .otherwise(B.item_url(F.col("p_partkey"))).alias("menu_item_image_url"),
        F.when(k % 3 == 0, F.lit(0.0)).when(k % 3 == 1, F.lit(None).cast("double")).otherwise(F.lit(0.5))
         .alias("golden_ratio"))


def q_needs_work(spark, sf):
    w = work_state(spark, sf)
    return w.select("p_partkey", select.needs_item_text().alias("needs_text"),
                    select.needs_profile().alias("needs_profile"), select.needs_ratio().alias("needs_ratio"),
                    select.needs_image().alias("needs_image"))


# -- dedup, resume, merge (D-02, D-03, J-04, J-05, J-06, S-03) ------------------

def _orders(spark, sf):
    return B.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        _date_text("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def q_dedup_last(spark, sf):
    return select.dedup_last(_orders(spark, sf), "o_custkey", "o_orderkey")


def q_dedup_first(spark, sf):
    return select.dedup_first(_orders(spark, sf), "o_custkey", "o_orderkey")


def q_skip_done(spark, sf):
    c = B.read(spark, sf, "customer").select("c_custkey", "c_name")
    # "done" = customers already ingested by a run from 1998 on
    o = (B.read(spark, sf, "orders")
         .filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
         .select(F.col("o_custkey").alias("c_custkey")))
    return skip_done(c, o, "c_custkey")


def q_merge_resume(spark, sf):
    c = B.read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    done = c.filter(F.col("c_nationkey") < 15)
    fresh = c.filter(F.col("c_nationkey") >= 10).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return merge_resume(done, fresh, "c_custkey")


def q_merge_partials(spark, sf):
    o = B.read(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    parts = []
    for lo, hi in ((None, 1995), (1995, 1998), (1998, None)):
        p = o
        if lo is not None:
            p = p.filter(F.col("y") >= lo)
        if hi is not None:
            p = p.filter(F.col("y") < hi)
        parts.append(select.dedup_last(p.drop("y"), "o_custkey", "o_orderkey"))
    return merge_partials(parts, "o_custkey")


def q_latest_per_key(spark, sf):
    o = B.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.date_trunc("month", "o_orderdate").alias("month"))
    return latest_per_key(o, "o_custkey", "month").select(
        "o_orderkey", "o_custkey", _date_text("month").alias("month"))


# -- pages (S-08, V-08) and long text (V-02) ----------------------------------

def q_read_pages(spark, sf):
    return first_page_keys(read_pages(spark, f"{sf}/pages.parquet")).select("url", "page_id", "html_len")


def q_check_url(spark, sf):
    p = B.read(spark, sf, "pages")
    return p.select("page_id", "url", check_url("url").alias("url_ok"))


def q_cap_description(spark, sf):
    d = B.read(spark, sf, "documents")
    return d.select("doc_id", quality.cap_description("text").alias("description"))


# -- validation (V-01, V-03..V-07) and upsert (U-01) ---------------------------

def item_candidates(spark, sf) -> DataFrame:
    """Menu items ready to publish, with blanks, long text and odd prices from ``part``."""
    p = B.read(spark, sf, "part")
    iid = stable_id(stable_id("p_brand"), F.col("p_name"), B.item_url(F.col("p_partkey")))
    price = B.price_text(F.col("p_retailprice"))
    k = F.col("p_size") % 6
    return p.select(
        F.when(F.col("p_size") == 1, F.lit("  ")).otherwise(iid).alias("_id"),
        stable_id("p_brand").alias("restaurant_brand_id"),
        F.when(F.col("p_size") == 2, F.lit("\t")).otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") % 3 == 0, F.repeat(F.concat(F.col("p_name"), F.lit(" ")), 40))
         .otherwise(F.col("p_name")).alias("description"),
        F.when(k == 0, F.concat(F.lit("$"), price))
         .when(k == 1, F.concat(price, F.lit("d")))
         .when(k == 2, F.lit("market price"))
         .when(k == 3, F.concat(F.lit("$1,"), price))
         .when(k == 4, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), price, F.lit(" "))).alias("estimated_price"))


def q_validate_items(spark, sf):
    c = quality.with_errors(item_candidates(spark, sf), "menu_items")
    return c.select("_id", (F.size("errors") == 0).alias("valid"),
                    F.array_join("errors", ";").alias("errors"),
                    F.length("description").alias("description_len"), "estimated_price")


def variation_candidates(spark, sf) -> DataFrame:
    """Scored variations as published, with negative nutrients, big ratios and odd classes."""
    li = B.read(spark, sf, "lineitem")
    classes = F.array(*[F.lit(x) for x in ("Excellent", "Good", "Poor", "Fair")])
    nut = F.struct(
        (F.col("l_quantity") * 18).alias("calories"),
        (F.round(F.col("l_discount") * 600) - 30).alias("protein_g"),
        (F.col("l_tax") * 100 - 4).alias("carbs_g"),
        F.when(F.col("l_linenumber") == 1, F.lit(-1.0)).otherwise(F.lit(0.5)).alias("trans_fat_g"))
    return li.select(
        F.when(F.col("l_orderkey") % 101 == 0, F.lit("")).otherwise(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                        F.col("l_partkey").cast("string"))).alias("_id"),
        F.col("l_partkey").cast("string").alias("menu_item_id"),
        nut.alias("nutrition"),
        (F.col("l_extendedprice") / 1000).alias("golden_ratio"),
        F.element_at(classes, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("golden_ratio_category"))


def q_validate_variations(spark, sf):
    c = quality.with_errors(variation_candidates(spark, sf), "variations")
    return c.select("_id", (F.size("errors") == 0).alias("valid"),
                    F.array_join("errors", ";").alias("errors"),
                    F.col("nutrition.protein_g").alias("protein_g"),
                    F.col("nutrition.carbs_g").alias("carbs_g"),
                    F.col("nutrition.trans_fat_g").alias("trans_fat_g"),
                    "golden_ratio", "golden_ratio_category")


def q_reject_counts(spark, sf):
    i = quality.split_valid(item_candidates(spark, sf), "menu_items")
    v = quality.split_valid(variation_candidates(spark, sf), "variations")
    a = i.invalid.groupBy("collection").agg(F.count(F.lit(1)).cast("long").alias("rejected"))
    b = v.invalid.groupBy("collection").agg(F.count(F.lit(1)).cast("long").alias("rejected"))
    return a.unionByName(b)


def order_rows(o: DataFrame) -> DataFrame:
    return o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("_id"),
                    "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")


def fresh_orders(o: DataFrame) -> DataFrame:
    """The fresh side of the upsert: orders from 1995 on, some changed, some nulled."""
    o = order_rows(o)
    k = F.regexp_extract("_id", "([0-9]+)", 1).try_cast("long")
    return (o.filter(F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
            .select("_id",
                    F.when(k % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
                     .alias("o_totalprice"),
                    "o_orderstatus",
                    F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
                     .alias("o_orderpriority")))


def upsert_inputs(spark, sf):
    o = B.read(spark, sf, "orders")
    base = (order_rows(o).filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
            .drop("o_orderdate"))
    return base, fresh_orders(o)


def q_upsert_orders(spark, sf):
    base, fresh = upsert_inputs(spark, sf)
    return upsert(base, fresh, "_id", "o_totalprice").table


def q_upsert_counts(spark, sf):
    base, fresh = upsert_inputs(spark, sf)
    return upsert(base, fresh, "_id", "o_totalprice").counts


# -- stored pages through the extraction pass (H-08, H-11) ---------------------

def q_page_titles(spark, sf):
    from menulake.operators.extract import page_titles, parse_pages
    return page_titles(parse_pages(B.read(spark, sf, "pages")))


def q_page_links(spark, sf):
    from menulake.operators.extract import page_links, parse_pages
    links = page_links(parse_pages(B.read(spark, sf, "pages")))
    return links.select("url", F.col("pos").cast("long").alias("pos"), "href", "text", "link")


# -- streams (T-01, T-02) -------------------------------------------------------

def _stream_root(spark) -> str:
    import uuid
    from menulake.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"


def table_files(sf: str, table: str) -> str:
    """The files of a driver table as a stream's source: of one file or of a folder of them.

    A stream takes a single file only by a pattern, and matches a name pattern with
    the files inside a folder, not with the folder.
    """
    return f"{sf}/{table}.parque[t]"


def q_stream_page_titles(spark, sf):
    """T-01: stored pages streamed once through the extraction pass."""
    from menulake.operators.extract import page_titles, parse_pages
    from menulake.streaming.ingest import stream_ingest
    root = _stream_root(spark)
    stream_ingest(spark, table_files(sf, "pages"), f"{root}/out", f"{root}/ckpt",
                  transform=lambda b: page_titles(parse_pages(b)))
    return spark.read.parquet(f"{root}/out").select("url", "title")


def q_stream_upsert_orders(spark, sf):
    """T-02: orders streamed as fresh rows onto the pre-1996 snapshot."""
    from menulake.streaming.ingest import latest_stream_snapshot, stream_upsert
    root = _stream_root(spark)
    base, _ = upsert_inputs(spark, sf)
    schema = B.read(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).parquet(table_files(sf, "orders"))
    stream_upsert(spark, stream, f"{root}/out", f"{root}/ckpt", "_id", "o_totalprice", base=base, prepare=fresh_orders)
    return latest_stream_snapshot(spark, f"{root}/out").select(
        "_id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def q_merged_orders(spark, sf):
    """U-01 in buckets: the pre-1996 orders, then the fresh ones, merged into a keyed table; its rows and both counts."""
    from menulake.sources import lake
    root = _stream_root(spark).replace("/streams/", "/tables/")
    base, fresh = upsert_inputs(spark, sf)
    counts = []
    for run, rows in (("r1", base), ("r2", fresh)):
        entry, n = lake.merge(rows, root, "orders", run, "_id", "o_totalprice")
        lake.commit(spark, root, run, {"orders": entry})
        counts.append(n)
    return lake.read_table(spark, root, lake.newest(spark, root, "orders")).withColumns(
        {"first": F.lit(counts[0]["inserted"]).cast("long")} | {k: F.lit(counts[1][k]).cast("long") for k in ("inserted", "matched", "modified")})


def q_layered_orders(spark, sf):
    """T-02's storage: the fresh orders in five batches, each a layer over the keyed table before it."""
    from menulake.sources import lake
    root = _stream_root(spark).replace("/streams/", "/tables/")
    base, fresh = upsert_inputs(spark, sf)
    part = F.pmod(F.regexp_extract("_id", "([0-9]+)", 1).try_cast("long"), F.lit(5))
    for k in range(5):
        run = f"b{k}"
        rows = fresh.where(F.coalesce(part, F.lit(0)) == k)
        lake.commit(spark, root, run, {"orders": lake.append(rows, root, "orders", run, "_id", "o_totalprice", base=base)})
    return lake.read_table(spark, root, lake.newest(spark, root, "orders"))


def q_page_facts(spark, sf):
    """H-01..H-10 over every stored page: the sizes of what each rule found."""
    from menulake.operators.extract import allergens_struct, nutrition_map, parse_pages
    p = parse_pages(B.read(spark, sf, "pages"))
    a = allergens_struct("allergen_cols", "allergen_paras")
    return p.select(
        "url", "title",
        F.size("cards").cast("long").alias("cards"),
        F.size("menu").cast("long").alias("menu_items"),
        "logo", "image_src", "description",
        F.size(nutrition_map("nutrition")).cast("long").alias("nutrients"),
        F.size(a["contains"]).cast("long").alias("allergens"),
        a["allergy_information"].alias("allergy_information"),
        F.size("options").cast("long").alias("options"),
        "ingredients",
        F.size("links").cast("long").alias("links"))


def q_snapshot_roundtrip(spark, sf):
    """S-04 then S-03: orders written as two runs; the newest run is read back."""
    from menulake.sources.io import latest_snapshot, write_snapshot
    root = _stream_root(spark).replace("/streams/", "/snapshots/")
    o = B.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    write_snapshot({"orders": o.filter(F.col("o_orderdate") < cut)}, root, "2024-01-01")
    write_snapshot({"orders": o.filter(F.col("o_orderdate") >= cut)}, root, "2024-02-01")
    return latest_snapshot(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", _date_text("o_orderdate").alias("o_orderdate"), "run_ts")


def q_snapshot_new_column(spark, sf):
    """S-03: the newest run keeps a column that the run before it lacks."""
    from menulake.sources.io import latest_snapshot, write_snapshot
    root = _stream_root(spark).replace("/streams/", "/snapshots/")
    o = B.read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_snapshot({"orders": o.select("o_orderkey")}, root, "2024-01-01T00:00:00")
    write_snapshot({"orders": o.filter(F.col("o_orderstatus") != "F")}, root, "2024-02-01T00:00:00")
    return latest_snapshot(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "run_ts")


# -- jobs end to end (L-02, U-02) -----------------------------------------------

def q_published_menu_items(spark, sf):
    """Raw snapshot from the bindings -> enrich job -> publish job -> published items."""
    from menulake.plans.jobs import EnrichInputs, enrich, publish
    from menulake.sources.io import latest_snapshot, write_snapshot
    root = _stream_root(spark).replace("/streams/", "/jobs/")
    part = B.read(spark, sf, "part")
    write_snapshot({"brands": domain.brands(spark, sf),
                    "menu_items": domain.menu_items(spark, sf).drop("brand_name"),
                    "variations": domain.variations(spark, sf)}, f"{root}/raw", B.RUN_TS)
    inputs = EnrichInputs(B.category_lookup(part), B.brand_answers(part), B.item_answers(part), "lookup_pos")
    steps = enrich(spark, root, B.RUN_TS, inputs)
    failed = [s.name for s in steps if not s.ok]
    if failed:
        raise RuntimeError(f"enrichment steps failed: {failed}")
    publish(spark, root, B.RUN_TS)
    items = latest_snapshot(spark, f"{root}/published", "menu_items")
    return items.select("_id", "name", "description", "estimated_price",
                        F.array_join("cuisine_types", ",").alias("cuisine_types"),
                        _tags_text("macronutrient_profile").alias("tags"), "menu_item_image_url")


def q_published_variations(spark, sf):
    """U-02: all servings, whose ids repeat, published twice: one row an id, the last serving's."""
    from menulake.plans.jobs import publish
    from menulake.sources.io import latest_snapshot, write_snapshot
    root = _stream_root(spark).replace("/streams/", "/jobs/")
    write_snapshot({"variations": domain.scored_variations(spark, sf)}, f"{root}/enriched", B.RUN_TS)
    first = publish(spark, root, "2024-01-01T00:00:00")["variations"]
    second = publish(spark, root, "2024-01-02T00:00:00")["variations"]
    v = latest_snapshot(spark, f"{root}/published", "variations")
    n = v.select("_id", "label", F.col("nutrition.calories").alias("calories"), F.col("nutrition.protein_g").alias("protein_g"),
                 F.col("nutrition.sugars_g").alias("sugars_g"), "golden_ratio", "ingredients")
    return n.withColumns({"inserted": F.lit(first["inserted"]).cast("long"), "matched": F.lit(second["matched"]).cast("long"),
                          "modified": F.lit(second["modified"]).cast("long")})


QUERIES: dict[str, Query] = {
    "brand_protein_report": brand_protein_report,
    "to_brands": q_to_brands,
    "to_menu_items": q_to_menu_items,
    "kept_ids": q_kept_ids,
    "to_variations": q_to_variations,
    "nutrient_text": q_nutrient_text,
    "snake_keys": q_snake_keys,
    "variation_tags": q_variation_tags,
    "variation_ratios": q_variation_ratios,
    "ratio_counts": q_ratio_counts,
    "ratio_distribution": q_ratio_distribution,
    "written_report": q_written_report,
    "enrich_servings": q_enrich_servings,
    "first_variation": q_first_variation,
    "first_image": q_first_image,
    "item_profiles": q_item_profiles,
    "item_images": q_item_images,
    "enriched_brands": q_enriched_brands,
    "brand_step_counts": q_brand_step_counts,
    "brand_requests": q_brand_requests,
    "item_text": q_item_text,
    "item_requests": q_item_requests,
    "step_counts": q_step_counts,
    "nested_totals": q_nested_totals,
    "brand_summary": q_brand_summary,
    "fetch_log_stats": q_fetch_log_stats,
    "only_brands": q_only_brands,
    "limit_brands": q_limit_brands,
    "limit_items_per_brand": q_limit_items_per_brand,
    "drop_incomplete": q_drop_incomplete,
    "needs_work": q_needs_work,
    "dedup_last": q_dedup_last,
    "dedup_first": q_dedup_first,
    "skip_done": q_skip_done,
    "merge_resume": q_merge_resume,
    "merge_partials": q_merge_partials,
    "latest_per_key": q_latest_per_key,
    "read_pages": q_read_pages,
    "check_url": q_check_url,
    "cap_description": q_cap_description,
    "validate_items": q_validate_items,
    "validate_variations": q_validate_variations,
    "reject_counts": q_reject_counts,
    "upsert_orders": q_upsert_orders,
    "upsert_counts": q_upsert_counts,
    "page_titles": q_page_titles,
    "page_links": q_page_links,
    "stream_page_titles": q_stream_page_titles,
    "stream_upsert_orders": q_stream_upsert_orders,
    "published_menu_items": q_published_menu_items,
    "page_facts": q_page_facts,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "snapshot_new_column": q_snapshot_new_column,
    "published_variations": q_published_variations,
    "merged_orders": q_merged_orders,
    "layered_orders": q_layered_orders,
}
