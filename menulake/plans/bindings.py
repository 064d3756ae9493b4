"""Bindings of the driver tables to the menu domain.

``part`` gives brands (``p_brand``) and menu items, ``lineitem`` gives one
serving per row with nutrition written out as scraped text (units, thousands
separators, ``<`` signs) so that the text parsers do real work. A category
lookup and the answer tables are derived from the same rows, so every query
grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menulake.functions.ids import stable_id
from menulake.session import spread

BASE_URL = "https://menus.example.com"
RUN_TS = "2024-01-01T00:00:00"

# Derived lookup and answer values (test bindings, not reference data).
LOOKUP_CATEGORIES = ["Fast Food", "Fast Casual", "Casual Dining", "Coffee Shop"]
LOOKUP_CUISINES = ["American", "Mexican", "Italian", "Chinese", "Japanese", "Korean", "Thai",
                   "Vietnamese", "Indian", "Mediterranean", "Greek", "French", "Middle Eastern",
                   "Caribbean", "Latin American", "Southern", "Fusion"]
LOOKUP_HIT_MAX = 20        # brands numbered up to this are in the lookup
LOOKUP_REPEAT_MAX = 3      # these appear twice; the later entry must win


# The tables whose rows carry per-row text work; they are dealt out only where they are small.
ROW_HEAVY = {"lineitem", "pages"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread(df) if table in ROW_HEAVY else df


def brand_number(c="p_brand") -> Column:
    return F.regexp_extract(F.col(c) if isinstance(c, str) else c, r"([0-9]+)", 1).try_cast("int")


def brand_url(c: Column) -> Column:
    return F.concat(F.lit(BASE_URL + "/restaurants/"), F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"))


def item_url(partkey: Column) -> Column:
    return F.concat(F.lit(BASE_URL + "/items/"), partkey.cast("string"))


def raw_brands(part: DataFrame) -> DataFrame:
    """One raw brand per distinct ``p_brand``; input order = first part key."""
    b = part.groupBy("p_brand").agg(F.min("p_partkey").alias("brand_pos"))
    url = brand_url(F.col("p_brand"))
    logo = F.when(brand_number() > 22, F.lit("")).otherwise(F.concat(url, F.lit("/logo.png")))
    return b.select(F.col("brand_pos").cast("long"), F.col("p_brand").alias("name"),
                    url.alias("url"), logo.alias("restaurant_logo"))


def _ingredients(p: DataFrame) -> Column:
    return F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("ingredients of "), F.col("p_name")))


def raw_items(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_brand").alias("brand_name"), F.col("p_partkey").cast("long").alias("item_pos"),
        F.col("p_name").alias("name"), item_url(F.col("p_partkey")).alias("url"),
        F.col("p_type").alias("category"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("struct<contains:array<string>,does_not_contain:array<string>,"
                         "unknown:array<string>,allergy_information:string>").alias("allergens"),
        _ingredients(part).alias("ingredients"))


def _int_text(c: Column) -> Column:
    return c.cast("long").cast("string")


def nutrition_parts() -> dict[str, Column]:
    """Scraped-style nutrition texts of one lineitem row, in their order on the page."""
    carbs = F.round(F.col("l_tax") * 1000)
    return {
        "serving_size": F.concat(_int_text(F.col("l_quantity") * 10), F.lit(" g")),
        "calories": _int_text(F.col("l_quantity") * 18),
        "protein": F.concat(_int_text(F.round(F.col("l_discount") * 600)), F.lit("g")),
        "total_carbohydrates": F.when(carbs == 0, F.lit("<1g")).otherwise(F.concat(_int_text(carbs), F.lit("g"))),
        "total_fat": F.concat(_int_text(F.col("l_partkey") % 45), F.lit("g")),
        # open orders also state fat under the alternate key (null elsewhere)
        "fat": F.when(F.col("l_linestatus") == "O",
                      F.concat(_int_text(F.col("l_partkey") % 45 + 2), F.lit(" g"))),
        "sodium": F.concat(F.format_number((F.col("l_orderkey") * 7) % 1500, 0), F.lit(" mg")),
        "sugars": F.concat(_int_text((F.col("l_suppkey") * 3) % 40), F.lit("g")),
    }


def text_map(parts: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in parts.items() for x in (F.lit(k), v)])


def nutrition_text() -> Column:
    """Scraped-style nutrition map for one lineitem row."""
    return text_map(nutrition_parts())


SERVING_COLUMNS = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def serving_order() -> Column:
    """Total order of lineitem rows within one part (all columns)."""
    return F.struct(*[F.col(c) for c in SERVING_COLUMNS])


def item_ids(part: DataFrame) -> DataFrame:
    """The ids of each part's item and brand, hashed once an item, with the fields its servings bear."""
    bid = stable_id("p_brand")
    return part.select("p_partkey", "p_brand", "p_name", "p_size", bid.alias("restaurant_brand_id"),
                       stable_id(bid, F.col("p_name"), item_url(F.col("p_partkey"))).alias("menu_item_id"))


def raw_servings(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One raw serving per lineitem row, with its item's fields copied down."""
    p = item_ids(part)
    return _servings(lineitem.join(p, lineitem["l_partkey"] == p["p_partkey"], "inner"))


def own_servings(lineitem: DataFrame) -> DataFrame:
    """``raw_servings`` that have not met their item: its ids and name are null, its ingredients empty; ``item_pos`` tells it.

    Rows of one item come together, so that what is summed up by item is one row of few
    behind the task. They are dealt by a hash of the item and not by the item itself: Spark
    may then split a hot one over tasks. Only the columns of a serving travel.
    """
    none = F.lit(None).cast("string")
    rows = lineitem.select("l_partkey", *SERVING_COLUMNS, F.hash("l_partkey").alias("_cell")).hint("rebalance", "_cell")
    return _servings(rows.drop("_cell").withColumns({c: none for c in ("restaurant_brand_id", "menu_item_id", "p_brand", "p_name")} | {"p_size": F.lit(None).cast("int")}))


def _servings(j: DataFrame) -> DataFrame:
    lin = F.col("l_linenumber")
    image = (F.when(lin % 3 == 0, F.lit(None).cast("string"))
              .when(lin % 3 == 1, F.lit(""))
              .otherwise(F.concat(F.lit(BASE_URL + "/item-photos/"), F.col("l_partkey").cast("string"),
                                  F.lit("-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                  lin.cast("string"), F.lit(".jpg"))))
    return j.select(
        "restaurant_brand_id", "menu_item_id",
        F.col("p_brand").alias("brand_name"), F.col("l_partkey").cast("long").alias("item_pos"),
        F.col("p_name").alias("item_name"), item_url(F.col("l_partkey")).alias("item_url"),
        serving_order().alias("serving_pos"),
        F.concat(F.lit("Size "), lin.cast("string"), F.lit(" / order "),
                 F.col("l_orderkey").cast("string")).alias("size_label"),
        nutrition_text().alias("nutrition"),
        image.alias("image_url"),
        F.lit(None).cast("struct<contains:array<string>,does_not_contain:array<string>,"
                         "unknown:array<string>,allergy_information:string>").alias("allergens"),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("ingredients of "), F.col("p_name")))
         .otherwise(F.lit("")).alias("ingredients"),
    )


def category_lookup(part: DataFrame, brands: DataFrame | None = None) -> DataFrame:
    """Derived lookup: brands numbered <= 20, names upper-cased and padded.

    Brands numbered <= 3 appear a second time, later, with another category.
    """
    b = (brands if brands is not None else raw_brands(part)).select("name", brand_number("name").alias("n"))
    cats = F.array(*[F.lit(c) for c in LOOKUP_CATEGORIES])
    cuis = F.array(*[F.lit(c) for c in LOOKUP_CUISINES])

    def entry(shift: int, pos_base: int) -> DataFrame:
        return b.filter(F.col("n") <= (LOOKUP_HIT_MAX if shift == 0 else LOOKUP_REPEAT_MAX)).select(
            F.concat(F.lit("  "), F.upper("name"), F.lit(" ")).alias("name"),
            F.element_at(cats, (F.col("n") + shift) % len(LOOKUP_CATEGORIES) + 1).alias("restaurant_category"),
            F.element_at(cuis, (F.col("n") + shift) % len(LOOKUP_CUISINES) + 1)
             .alias("restaurant_cultural_cuisine"),
            brand_url(F.col("name")).alias("url"),
            (F.col("n") + pos_base).cast("long").alias("lookup_pos"))
    return entry(0, 0).unionByName(entry(1, 1000))


def brand_answers(part: DataFrame, brands: DataFrame | None = None) -> DataFrame:
    """Derived answers for brands that miss the lookup; some malformed, one retried."""
    b = (brands if brands is not None else raw_brands(part)).select(stable_id("name").alias("key"), brand_number("name").alias("n")) \
        .filter(F.col("n") > LOOKUP_HIT_MAX)
    cats = F.array(*[F.lit(c) for c in LOOKUP_CATEGORIES])
    cuis = F.array(*[F.lit(c) for c in LOOKUP_CUISINES])
    good = F.to_json(F.struct(F.element_at(cats, F.col("n") % 4 + 1).alias("restaurant_category"),
                              F.element_at(cuis, F.col("n") % 17 + 1).alias("restaurant_cultural_cuisine")))
    first = (F.when(F.col("n") % 4 == 1, F.lit("Sorry, I cannot help with that."))
              .when(F.col("n") % 4 == 2, F.lit('{"restaurant_category": "Bakery"}'))
              .otherwise(good))
    a1 = b.select("key", F.lit(1).alias("attempt"), first.alias("answer"))
    a2 = b.filter(F.col("n") % 4 == 1).select("key", F.lit(2).alias("attempt"), good.alias("answer"))
    return a1.unionByName(a2)


def price_text(c: Column) -> Column:
    cents = F.round(c * 100).cast("long")
    return F.concat(F.floor(cents / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def item_answers(part: DataFrame) -> DataFrame:
    """Derived item answers keyed by item id: valid, malformed, and two-cuisine ones."""
    bid = stable_id("p_brand")
    iid = stable_id(bid, F.col("p_name"), item_url(F.col("p_partkey")))
    k = F.col("p_partkey") % 5
    good = F.to_json(F.struct(
        F.concat(F.lit("House "), F.col("p_name"), F.lit(", made to order.")).alias("description"),
        price_text(F.col("p_retailprice")).alias("estimated_price"),
        F.array(F.lit("American"), F.col("p_type"), F.lit("International")).alias("cuisine_types")))
    two = F.to_json(F.struct(
        F.concat(F.lit("House "), F.col("p_name")).alias("description"),
        price_text(F.col("p_retailprice")).alias("estimated_price"),
        F.array(F.lit("American"), F.col("p_type")).alias("cuisine_types")))
    # some items got no answer back at all (null), some a malformed or partial one
    ans = (F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("string"))
            .when(k == 0, F.lit("not json {")).when(k == 1, two).otherwise(good))
    return part.select(iid.alias("key"), F.lit(1).alias("attempt"), ans.alias("answer"))


def fetch_log(events: DataFrame) -> DataFrame:
    """Fetch log from ``events``: ``error`` = failed, ``user_id`` = source."""
    return events.select(
        F.col("user_id").alias("source"),
        F.concat(F.lit(BASE_URL + "/fetch/"), F.col("event_id").cast("string")).alias("url"),
        (F.col("event_type") != "error").alias("ok"),
        ((F.col("value").cast("long") % 3) + 1).cast("int").alias("attempts"),
        F.col("ts"))
