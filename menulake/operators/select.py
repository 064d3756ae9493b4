"""Filters, limits and keyed dedup (P-01..P-06, D-02..D-05).

"First" and "last" always follow an explicit ordinal column, never row order.
Dedup and first-of-group use ``min_by`` / ``max_by`` aggregates: they combine
map-side, so a key holding a third of all rows shuffles one partial row per
task instead of all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menulake.functions._util import blank, col_of

# Lists longer than this become a semi join instead of an IN list.
INLINE_LIST_MAX = 1000


def only_brands(df: DataFrame, names: Sequence[str] | DataFrame, col: str = "name") -> DataFrame:
    """P-01: keep rows whose exact, case-sensitive name is in ``names``."""
    if isinstance(names, DataFrame):
        return df.join(names.select(F.col(names.columns[0]).alias(col)), col, "left_semi")
    names = list(names)
    if len(names) <= INLINE_LIST_MAX:
        return df.filter(F.col(col).isin(names))
    keys = df.sparkSession.createDataFrame([(n,) for n in names], f"{col} string")
    return df.join(keys, col, "left_semi")


def limit_brands(df: DataFrame, n: int | None, order: str = "brand_pos") -> DataFrame:
    """P-02: first ``n`` rows by ``order``; null or 0 means no limit."""
    if not n:
        return df
    return df.orderBy(order).limit(n)


def limit_per_group(df: DataFrame, n: int | None, group: str | Sequence[str],
                    order: str | Sequence[str]) -> DataFrame:
    """P-03: first ``n`` rows of each group by ``order``.

    ``row_number() <= n`` is planned with a partial window group limit before
    the shuffle, so a hot group ships only ``n`` rows per map task.
    """
    if not n:
        return df
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def limit_items_per_brand(items: DataFrame, n: int | None) -> DataFrame:
    return limit_per_group(items, n, "brand_name", "item_pos")


def drop_incomplete(df: DataFrame, cols: Sequence[str] = ("name", "url")) -> DataFrame:
    """P-04: drop entries lacking any of ``cols`` (null or empty text)."""
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.col(c) != "")
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def missing_text(c) -> Column:
    """P-05 helper: null and '' count as missing (steps 2, 3 and 5)."""
    c = col_of(c)
    return c.isNull() | (c == "")


def missing_list(c) -> Column:
    c = col_of(c)
    return c.isNull() | (F.size(c) == 0)


def needs_item_text(force: bool = False) -> Column:
    """P-05, step 2: work unless description, price and cuisines are all present."""
    if force:
        return F.lit(True)
    return missing_text("description") | missing_text("estimated_price") | missing_list("cuisine_types")


def needs_profile(force: bool = False) -> Column:
    """P-05, step 3: an empty tag list counts as missing."""
    return F.lit(True) if force else missing_list("macronutrient_profile")


def needs_ratio(force: bool = False) -> Column:
    """P-05, ratio step: only null is missing, so 0.0 counts as done."""
    return F.lit(True) if force else F.col("golden_ratio").isNull()


def needs_image(force: bool = False) -> Column:
    """P-05, step 5."""
    return F.lit(True) if force else missing_text("menu_item_image_url")


def drop_working_columns(df: DataFrame, cols: Sequence[str] = ("nutrition", "nutritional_values")) -> DataFrame:
    """P-06: working copies that are not stored on items."""
    return df.drop(*[c for c in cols if c in df.columns])


def _row_struct(df: DataFrame, exclude: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


def dedup_last(df: DataFrame, key: str | Sequence[str], pos: str) -> DataFrame:
    """D-02: per key, values of the last row by ``pos``, position of the first."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = _row_struct(df, keys + [pos])
    out = df.groupBy(*keys).agg(F.max_by(payload, F.col(pos)).alias("_v"), F.min(pos).alias(pos))
    return out.select(*keys, pos, "_v.*")


def dedup_first(df: DataFrame, key: str | Sequence[str], pos: str) -> DataFrame:
    """D-03: per key, the first row by ``pos``."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = _row_struct(df, keys + [pos])
    out = df.groupBy(*keys).agg(F.min_by(payload, F.col(pos)).alias("_v"), F.min(pos).alias(pos))
    return out.select(*keys, pos, "_v.*")


def variation_order() -> Column:
    """Input order of variations within an item."""
    return F.struct(F.col("item_pos"), F.col("serving_pos"))


def first_variation(variations: DataFrame) -> DataFrame:
    """D-04: per item, the nutrition of its first variation that has nutrition."""
    has = variations.filter(F.col("nutrition").isNotNull() & F.col("menu_item_id").isNotNull()
                            & (F.col("menu_item_id") != ""))
    return has.groupBy("menu_item_id").agg(
        F.min_by(F.col("nutrition"), variation_order()).alias("nutrition"))


def first_image(variations: DataFrame) -> DataFrame:
    """D-05: per item, the first non-empty image url."""
    has = variations.filter(F.col("image_url").isNotNull() & (F.col("image_url") != "")
                            & F.col("menu_item_id").isNotNull() & (F.col("menu_item_id") != ""))
    return has.groupBy("menu_item_id").agg(
        F.min_by(F.col("image_url"), variation_order()).alias("image_url"))


__all__ = [
    "only_brands", "limit_brands", "limit_per_group", "limit_items_per_brand", "drop_incomplete",
    "needs_item_text", "needs_profile", "needs_ratio", "needs_image", "drop_working_columns",
    "dedup_last", "dedup_first", "first_variation", "first_image", "blank",
]
