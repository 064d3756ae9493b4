"""The domain tables built from the driver tables through the bindings.

Each function returns a lazy DataFrame; Catalyst prunes the unused columns of
the parquet scans and pushes filters into them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from menulake.functions.ids import stable_id
from menulake.operators.enrich import enrich_brands, enrich_items
from menulake.operators.joins import attach_images, profile_items
from menulake.operators.normalize import to_brands, to_menu_items, to_variations
from menulake.operators.score import score_variations
from menulake.plans import bindings as B


class Raw(NamedTuple):
    brands: DataFrame
    items: DataFrame
    servings: DataFrame


def raw(spark: SparkSession, sf_dir: str) -> Raw:
    part = B.read(spark, sf_dir, "part")
    li = B.read(spark, sf_dir, "lineitem")
    return Raw(B.raw_brands(part), B.raw_items(part), B.raw_servings(li, part))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_brands(B.raw_brands(B.read(spark, sf_dir, "part")), B.RUN_TS)


def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_menu_items(B.raw_items(B.read(spark, sf_dir, "part")))


def variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = B.read(spark, sf_dir, "part")
    li = B.read(spark, sf_dir, "lineitem")
    return to_variations(B.raw_servings(li, part), B.RUN_TS)


def own_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variations of all servings by ``item_pos``, before they meet their items; no ids are made of them."""
    return to_variations(B.own_servings(B.read(spark, sf_dir, "lineitem")), B.RUN_TS)


def variation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servings per brand: counted by part key before the join, so one row a part and task is shuffled."""
    part = B.read(spark, sf_dir, "part").select("p_partkey", stable_id("p_brand").alias("restaurant_brand_id"))
    n = B.read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("variations"))
    return n.join(part, F.col("l_partkey") == F.col("p_partkey")).select("restaurant_brand_id", "variations")


def enriched_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = B.read(spark, sf_dir, "part")
    rb = B.raw_brands(part)
    return enrich_brands(to_brands(rb, B.RUN_TS), B.category_lookup(part, rb),
                         B.brand_answers(part, rb), B.RUN_TS, lookup_pos="lookup_pos")


def scored_variations(spark: SparkSession, sf_dir: str, force: bool = False) -> DataFrame:
    return score_variations(variations(spark, sf_dir), force)


def profiled_items(spark: SparkSession, sf_dir: str, force: bool = False) -> DataFrame:
    return profile_items(menu_items(spark, sf_dir), variations(spark, sf_dir), force)


def text_items(spark: SparkSession, sf_dir: str, force: bool = False) -> DataFrame:
    part = B.read(spark, sf_dir, "part")
    return enrich_items(menu_items(spark, sf_dir), brands(spark, sf_dir), B.item_answers(part), force)


def imaged_items(spark: SparkSession, sf_dir: str, force: bool = False) -> DataFrame:
    return attach_images(menu_items(spark, sf_dir), variations(spark, sf_dir), force)
