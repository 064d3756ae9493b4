"""Enrichment from stored answers (E-01..E-03).

The remote model call is not part of this library. A request table lists the
rows that need an answer; answers come back as a keyed table of JSON text,
which is joined, parsed with ``from_json`` (permissive) and checked, with the
fixed fallbacks applied where an answer is missing or malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.operators.select import needs_item_text

# Fallbacks used when no usable answer exists.
FALLBACK_CATEGORY = "Fast Food"
FALLBACK_CUISINE = "American"
FALLBACK_PRICE = "9.99"
FALLBACK_CUISINES = ["American", "International", "Casual"]
FALLBACK_DESCRIPTION = "A delicious %s item from %s."
FALLBACK_RESTAURANT = "Restaurant"
SOURCE_AI = "ai_generated"

BRAND_ANSWER_SCHEMA = "restaurant_category string, restaurant_cultural_cuisine string"
ITEM_ANSWER_SCHEMA = "description string, estimated_price string, cuisine_types array<string>"


def _best_answer(answers: DataFrame, schema: str, valid) -> DataFrame:
    """Per key, the first valid answer by attempt (answers may hold retries)."""
    parsed = answers.select("key", F.coalesce(F.col("attempt"), F.lit(0)).alias("attempt"),
                            F.from_json("answer", schema, {"mode": "PERMISSIVE"}).alias("a"))
    ok = parsed.filter(valid(F.col("a")))
    return ok.groupBy("key").agg(F.min_by("a", "attempt").alias("a"))


def classify_missed(brands: DataFrame, answers: DataFrame, run_ts: str) -> DataFrame:
    """E-01: brands flagged ``needs_answer`` take the answer or the defaults.

    An answer counts only when it is JSON holding both fields.
    """
    best = _best_answer(answers, BRAND_ANSWER_SCHEMA,
                        lambda a: a["restaurant_category"].isNotNull()
                        & a["restaurant_cultural_cuisine"].isNotNull())
    j = brands.join(best, brands["_id"] == best["key"], "left").drop("key")
    need = F.col("needs_answer")
    return (j.withColumns({
        "restaurant_category": F.when(need, F.coalesce(F.col("a.restaurant_category"), F.lit(FALLBACK_CATEGORY)))
                                .otherwise(F.col("restaurant_category")),
        "restaurant_cultural_cuisine": F.when(need, F.coalesce(F.col("a.restaurant_cultural_cuisine"),
                                                               F.lit(FALLBACK_CUISINE)))
                                        .otherwise(F.col("restaurant_cultural_cuisine")),
        "category_source": F.when(need, F.lit(SOURCE_AI)).otherwise(F.col("category_source")),
        "last_updated": F.when(need, F.lit(run_ts)).otherwise(F.col("last_updated")),
    }).drop("a"))


def enrich_brands(brands: DataFrame, lookup: DataFrame, answers: DataFrame, run_ts: str,
                  lookup_pos: str | None = None) -> DataFrame:
    """Step 1: lookup first (J-01), answers for the misses (E-01)."""
    from menulake.operators.joins import lookup_brand
    return classify_missed(lookup_brand(brands, lookup, run_ts, lookup_pos), answers, run_ts)


def brand_requests(brands: DataFrame) -> DataFrame:
    """E-03 for brands: one request per named brand that missed the lookup."""
    return brands.filter("needs_answer").select(F.col("_id").alias("key"), "brand_name")


def _with_brand_name(items: DataFrame, brands: DataFrame) -> DataFrame:
    names = brands.select(F.col("_id").alias("_bid"), F.col("brand_name").alias("restaurant_name"))
    return items.join(names, items["restaurant_brand_id"] == names["_bid"], "left").drop("_bid")


def item_requests(items: DataFrame, brands: DataFrame, force: bool = False) -> DataFrame:
    """E-03: one request per item still needing text, with its real brand name."""
    need = items.filter(needs_item_text(force))
    j = _with_brand_name(need, brands)
    rn = F.coalesce(F.col("restaurant_name"), F.lit(FALLBACK_RESTAURANT))
    return j.select(
        F.col("_id").alias("key"), "name", "category", rn.alias("restaurant_name"),
        F.format_string("Item: %s | Category: %s | Restaurant: %s",
                        F.col("name"), F.col("category"), rn).alias("request"))


def enrich_items(items: DataFrame, brands: DataFrame, answers: DataFrame,
                 force: bool = False) -> DataFrame:
    """E-02: description, price and exactly three cuisines from the answer, else fallbacks.

    A numeric price in an answer is kept as its text. Adds ``text_status``.
    """
    best = _best_answer(answers, ITEM_ANSWER_SCHEMA,
                        lambda a: a["description"].isNotNull() & a["estimated_price"].isNotNull()
                        & a["cuisine_types"].isNotNull() & (F.size(a["cuisine_types"]) == 3))
    j = _with_brand_name(items, brands)
    j = j.join(best, j["_id"] == best["key"], "left").drop("key")
    need = needs_item_text(force)
    has = F.col("a").isNotNull()
    rn = F.coalesce(F.col("restaurant_name"), F.lit(FALLBACK_RESTAURANT))
    cat = F.lower(F.coalesce(F.col("category"), F.lit("Food")))
    fallback_desc = F.format_string(FALLBACK_DESCRIPTION, cat, rn)
    fallback_cuisines = F.array(*[F.lit(c) for c in FALLBACK_CUISINES])
    return (j.withColumns({
        "text_status": F.when(need, F.lit("processed")).otherwise(F.lit("skipped")),
        "description": F.when(need, F.when(has, F.col("a.description")).otherwise(fallback_desc))
                        .otherwise(F.col("description")),
        "estimated_price": F.when(need, F.when(has, F.col("a.estimated_price")).otherwise(F.lit(FALLBACK_PRICE)))
                            .otherwise(F.col("estimated_price")),
        "cuisine_types": F.when(need, F.when(has, F.col("a.cuisine_types")).otherwise(fallback_cuisines))
                          .otherwise(F.col("cuisine_types")),
    }).drop("a", "restaurant_name"))
