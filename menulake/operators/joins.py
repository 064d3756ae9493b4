"""Lookup joins and incremental merges (J-01..J-06).

No side is broadcast by hint: the optimizer does so by its byte statistics, and
a shuffle join may still be converted (by the sizes AQE measures) or split for
skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.functions.text import strip_ws
from menulake.operators.select import dedup_last, first_image, first_variation, needs_image, needs_profile

def lookup_keys(lookup: DataFrame, pos: str | None = None) -> DataFrame:
    """Category lookup keyed by lowered, trimmed name; a repeated key: last wins."""
    keyed = lookup.withColumn("lookup_key", F.lower(strip_ws(F.col("name"))))
    if pos is None:
        keyed = keyed.withColumn("_lpos", F.monotonically_increasing_id())
        pos = "_lpos"
    keyed = keyed.select("lookup_key", pos,
                         F.col("restaurant_category").alias("lk_category"),
                         F.col("restaurant_cultural_cuisine").alias("lk_cuisine"))
    return dedup_last(keyed, "lookup_key", pos).drop(pos)


def lookup_brand(brands: DataFrame, lookup: DataFrame, run_ts: str,
                 lookup_pos: str | None = None) -> DataFrame:
    """J-01: fill category and cuisine from the lookup.

    Adds ``lookup_hit`` and ``needs_answer`` (a named brand that missed).
    Brands with an empty name pass unchanged.
    """
    lk = lookup_keys(lookup, lookup_pos)
    named = F.col("brand_name").isNotNull() & (F.col("brand_name") != "")
    j = (brands.withColumn("lookup_key", F.lower(strip_ws(F.col("brand_name"))))
         .join(lk, "lookup_key", "left"))
    hit = named & F.col("lk_category").isNotNull()
    return (j.withColumns({
        "lookup_hit": hit,
        "needs_answer": named & ~hit,
        "restaurant_category": F.when(hit, F.col("lk_category")).otherwise(F.col("restaurant_category")),
        "restaurant_cultural_cuisine": F.when(hit, F.col("lk_cuisine"))
                                        .otherwise(F.col("restaurant_cultural_cuisine")),
        "category_source": F.when(hit, F.lit("lookup")).otherwise(F.col("category_source")),
        "last_updated": F.when(hit, F.lit(run_ts)).otherwise(F.col("last_updated")),
    }).drop("lookup_key", "lk_category", "lk_cuisine"))


def attach_nutrition(items: DataFrame, variations: DataFrame | None, first: DataFrame | None = None) -> DataFrame:
    """J-02: each item gets the nutrition of its first variation (D-04).

    ``first`` may hold a precomputed (menu_item_id, nutrition) frame. Items
    that already carry a ``nutrition`` column keep it when unmatched;
    otherwise an unmatched item has no data.
    """
    if variations is None and first is None:
        return items  # nutrition already attached by the caller
    fv = first if first is not None else first_variation(variations)
    fv = fv.select("menu_item_id", F.col("nutrition").alias("_fv_nutrition"))
    j = items.join(fv, items["_id"] == fv["menu_item_id"], "left").drop("menu_item_id")
    if "nutrition" in items.columns:
        return j.withColumn("nutrition", F.coalesce("_fv_nutrition", "nutrition")).drop("_fv_nutrition")
    return j.withColumnRenamed("_fv_nutrition", "nutrition")


def profile_items(items: DataFrame, variations: DataFrame | None, force: bool = False,
                  first: DataFrame | None = None) -> DataFrame:
    """Step 3: item tags from the first variation's nutrition (J-02 + F-09).

    Adds ``profile_status`` in (processed, skipped, no_data); drops the
    working nutrition copy (P-06).
    """
    from menulake.functions.nutrition import profile_tags
    j = attach_nutrition(items, variations, first)
    n = F.col("nutrition")

    def num(field):
        # the reference passes typed numbers through text and reads them back
        # with F-03, so null becomes 0 and the sign is dropped
        return F.abs(F.coalesce(n[field], F.lit(0.0)))

    tags = profile_tags(num("calories"), num("protein_g"), num("carbs_g"), num("fat_g"),
                        num("sodium_mg"), num("sugars_g"))
    processed = n.isNotNull() & needs_profile(force)
    status = (F.when(n.isNull(), F.lit("no_data"))
               .when(processed, F.lit("processed"))
               .otherwise(F.lit("skipped")))
    return (j.withColumns({
        "profile_status": status,
        "macronutrient_profile": F.when(processed, tags).otherwise(F.col("macronutrient_profile")),
    }).drop("nutrition"))


def attach_images(items: DataFrame, variations: DataFrame, force: bool = False) -> DataFrame:
    """J-03: items get the first image of their variations (D-05).

    Adds ``image_status`` in (mapped, had_image, no_image, no_id).
    """
    fi = first_image(variations).withColumnRenamed("image_url", "_img")
    j = items.join(fi, items["_id"] == fi["menu_item_id"], "left").drop("menu_item_id")
    if "menu_item_image_url" not in items.columns:
        j = j.withColumn("menu_item_image_url", F.lit(None).cast("string"))
    no_id = F.col("_id").isNull() | (F.col("_id") == "")
    mapped = ~no_id & needs_image(force) & F.col("_img").isNotNull()
    status = (F.when(no_id, F.lit("no_id"))
               .when(~needs_image(force), F.lit("had_image"))
               .when(F.col("_img").isNotNull(), F.lit("mapped"))
               .otherwise(F.lit("no_image")))
    return (j.withColumns({
        "image_status": status,
        "menu_item_image_url": F.when(mapped, F.col("_img")).otherwise(F.col("menu_item_image_url")),
    }).drop("_img"))


def skip_done(work: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """J-04: drop work whose key was already ingested."""
    keys = [key] if isinstance(key, str) else list(key)
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def merge_resume(done: DataFrame, fresh: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """J-05: saved rows plus fresh rows; the fresh row wins on its key."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = done.join(fresh.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def merge_partials(parts: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """J-06: combine saved parts in order; for a repeated key the later part wins."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    allp = tagged[0]
    for p in tagged[1:]:
        allp = allp.unionByName(p, allowMissingColumns=True)
    return dedup_last(allp, key, "_part").drop("_part")
