"""N-01..N-04: flat raw frames -> brands, menu items, variations.

Ids are recomputed from their parts on every row (D-01), so the three tables
are built independently from their own raw frame, with no join between them.
Ids that a raw frame already has are kept: its own in ``_id``, those of the
brand and the item in ``restaurant_brand_id`` and ``menu_item_id``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.functions.ids import kept_id
from menulake.functions.nutrition import (
    DEFAULT_CATEGORY, DEFAULT_ITEM_NAME, NUTRITION_FIELDS, default_size_label, serving_struct, typed_nutrition,
)
from menulake.schemas import ALLERGENS_TYPE

def empty_allergens():
    """Allergens of an item that states none."""
    return F.struct(
        F.array().cast("array<string>").alias("contains"),
        F.array().cast("array<string>").alias("does_not_contain"),
        F.array().cast("array<string>").alias("unknown"),
        F.lit(None).cast("string").alias("allergy_information"),
    )


def _stamp(run_ts: str):
    return F.lit(run_ts).cast("string")


def to_brands(raw_brands: DataFrame, run_ts: str) -> DataFrame:
    """N-01: one brand row per raw brand, id from the name."""
    return raw_brands.select(
        kept_id(raw_brands, "_id", "name").alias("_id"),
        F.col("name").alias("brand_name"),
        F.nullif(F.col("restaurant_logo"), F.lit("")).alias("brand_image_url"),
        F.col("url").alias("source_url"),
        F.lit(None).cast("string").alias("restaurant_category"),
        F.lit(None).cast("string").alias("restaurant_cultural_cuisine"),
        F.lit(None).cast("string").alias("category_source"),
        F.lit(False).alias("eatery_full_verification_status"),
        _stamp(run_ts).alias("creation_date"),
        _stamp(run_ts).alias("last_updated"),
        F.col("brand_pos"),
    )


def _item_name():
    return F.coalesce(F.col("name"), F.lit(DEFAULT_ITEM_NAME))


def to_menu_items(raw_items: DataFrame) -> DataFrame:
    """N-02: one item row per raw item, active, defaults applied (F-13)."""
    bid = kept_id(raw_items, "restaurant_brand_id", "brand_name")
    name = _item_name()
    return raw_items.select(
        kept_id(raw_items, "_id", bid, name, F.col("url")).alias("_id"),
        bid.alias("restaurant_brand_id"),
        name.alias("name"),
        F.col("description"),
        F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.lit(None).cast("string").alias("estimated_price"),
        F.lit(None).cast("array<string>").alias("cuisine_types"),
        F.lit(None).cast("array<string>").alias("macronutrient_profile"),
        F.lit(True).alias("is_active"),
        F.col("url").alias("source_url"),
        F.col("brand_name"),
        F.col("item_pos"),
    )


def to_variations(raw_servings: DataFrame, run_ts: str) -> DataFrame:
    """N-03: one variation per raw serving.

    Item-level allergens and ingredients are already copied down to each serving
    row; the serving image wins over no image; ingredients that aren't text are null.
    """
    # By stages: an expression that is read several times is a column of its own. The
    # numbers come first, each a column, so that those nobody reads are never parsed. A null
    # map gives null fields, as an empty one does; read bare, no map has to be built for them.
    typed, text = typed_nutrition("nutrition"), serving_struct("nutrition")
    nutrients = {f"_n_{f}": typed[f] for f in NUTRITION_FIELDS} | {"_serving_text": text["serving_text"]}
    raw = raw_servings.withColumns(nutrients).drop("nutrition").withColumns({
        "label": default_size_label(F.col("size_label")),
        "item_name": F.coalesce(F.col("item_name"), F.lit(DEFAULT_ITEM_NAME)),
        "allergens": F.coalesce(F.col("allergens").cast(ALLERGENS_TYPE), empty_allergens())})
    # a source that has the item's ids passes them down, one hash an item instead of two a serving
    raw = raw.withColumn("restaurant_brand_id", kept_id(raw, "restaurant_brand_id", "brand_name"))
    raw = raw.withColumn("menu_item_id", kept_id(raw, "menu_item_id", "restaurant_brand_id", "item_name", "item_url"))
    return raw.select(
        kept_id(raw, "_id", "menu_item_id", "label").alias("_id"),
        "menu_item_id",
        "restaurant_brand_id",
        "label",
        F.struct(F.col("_serving_text").alias("serving_text")).alias("serving"),
        F.struct(*[F.col(f"_n_{f}").alias(f) for f in NUTRITION_FIELDS]).alias("nutrition"),
        "allergens",
        F.col("ingredients"),
        F.nullif(F.col("image_url"), F.lit("")).alias("image_url"),
        F.lit(True).alias("is_active"),
        _stamp(run_ts).alias("created_at"),
        _stamp(run_ts).alias("updated_at"),
        F.lit(None).cast("double").alias("golden_ratio"),
        F.lit(None).cast("string").alias("golden_ratio_category"),
        F.col("item_pos"),
        F.col("serving_pos"),
    )


class Normalized(NamedTuple):
    brands: DataFrame
    menu_items: DataFrame
    variations: DataFrame


def normalize(raw_brands: DataFrame, raw_items: DataFrame, raw_servings: DataFrame,
              run_ts: str) -> Normalized:
    """N-04: the three keyed tables from the three raw frames."""
    return Normalized(to_brands(raw_brands, run_ts), to_menu_items(raw_items),
                      to_variations(raw_servings, run_ts))


#: Positions within a document that one long has room for; beyond, a run fails rather than mixes positions up.
POSITIONS = 1 << 20


def _ordinal(base, pos):
    """One long that orders by ``base``, then ``pos``."""
    room = F.raise_error(F.lit("a document holds too many entries for its positions")).cast("long")
    return F.when(pos < POSITIONS, base * F.lit(POSITIONS).cast("long") + pos).otherwise(room)


def _ingredients(c):
    """Ingredients as stated: text stays, a missing value is empty, any other JSON value is null."""
    v = F.col(c)
    return F.when(v.isNull(), F.lit("")).when(F.schema_of_variant(v) == "STRING", v.cast("string"))


def nested_to_flat(keyed: DataFrame, doc_col: str = "doc"):
    """Explode a keyed brand document column into the three flat raw frames.

    ``keyed`` holds one row per input document with ``doc_col`` of type
    ``map<brand, struct<url, restaurant_logo, items[]>>`` and ``doc_pos``.
    """
    brands = (keyed.select("doc_pos", F.posexplode(doc_col).alias("b_pos", "name", "b"))
              .select(F.col("doc_pos"), F.col("b_pos"), "name", "b"))
    raw_brands = brands.select(
        _ordinal(F.col("doc_pos").cast("long"), F.col("b_pos")).alias("brand_pos"),
        "name", F.col("b.url").alias("url"), F.col("b.restaurant_logo").alias("restaurant_logo"))
    items = brands.select(
        F.col("name").alias("brand_name"),
        _ordinal(F.col("doc_pos").cast("long"), F.col("b_pos")).alias("base"),
        F.posexplode(F.coalesce(F.col("b.items"), F.array())).alias("i_pos", "it"))
    raw_items = items.select(
        "brand_name", _ordinal(F.col("base"), F.col("i_pos")).alias("item_pos"),
        F.col("it.name").alias("name"), F.col("it.url").alias("url"),
        F.col("it.category").alias("category"), F.col("it.description").alias("description"),
        F.col("it.allergens").alias("allergens"), _ingredients("it.ingredients").alias("ingredients"))
    servings = items.select(
        "brand_name", _ordinal(F.col("base"), F.col("i_pos")).alias("item_pos"),
        F.col("it.name").alias("item_name"), F.col("it.url").alias("item_url"),
        F.col("it.allergens").alias("allergens"), _ingredients("it.ingredients").alias("ingredients"),
        F.posexplode(F.coalesce(F.col("it.nutritional_values.serving_sizes"), F.array()))
         .alias("serving_pos", "s"))
    raw_servings = servings.select(
        "brand_name", "item_pos", "item_name", "item_url",
        F.col("serving_pos").cast("long").alias("serving_pos"),
        F.col("s.size_label").alias("size_label"), F.col("s.nutrition").alias("nutrition"),
        F.col("s.image_url").alias("image_url"), "allergens", "ingredients")
    return raw_brands, raw_items, raw_servings
