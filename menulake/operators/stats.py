"""Run statistics (A-01..A-07): single-pass aggregates, partial-aggregated map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from menulake.functions.nutrition import RATIO_EXCELLENT, RATIO_GOOD


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def ratio_counts(scored: DataFrame) -> DataFrame:
    """A-01: total, processed, skipped, no-data, errors; classes over processed rows."""
    st = F.col("ratio_status")
    done = st == "processed"
    cat = F.col("golden_ratio_category")
    return scored.agg(
        F.count(F.lit(1)).cast("long").alias("total_items"),
        _count_if(done).alias("processed"),
        _count_if(st == "skipped").alias("skipped"),
        _count_if(st == "no_data").alias("no_nutrition_data"),
        F.lit(0).cast("long").alias("errors"),
        _count_if(done & (cat == RATIO_EXCELLENT)).alias("excellent"),
        _count_if(done & (cat == RATIO_GOOD)).alias("good"),
        _count_if(done & (cat != RATIO_EXCELLENT) & (cat != RATIO_GOOD)).alias("poor"),
    )


def _milli(c: Column) -> Column:
    # ratios carry 3 decimals, so the sum of thousandths is exact in any order
    return F.round(c * 1000).cast("long")


def _bucket(r: Column) -> Column:
    # 1,024 steps to a power of two of the thousandths, in the order of the ratios: some 130,000 for all doubles
    return (F.signum(r) * F.floor(F.log2(F.abs(r) * 1000 + 1) * 1024)).cast("int")


def with_upper_half(counted: DataFrame, value: str, n: str = "n") -> DataFrame:
    """Counted values with ``in_upper``: half of all rows, or more, have this value or a larger one.

    The least value that is in the upper half is the upper median (``sorted[n // 2]``).
    Two passes: the running counts of a bounded number of buckets tell the bucket of
    the median, and a second one ranks the values within each bucket. Null values are
    not counted, and are in no half.
    """
    held = counted.withColumn("_bucket", _bucket(F.col(value)))
    buckets = held.filter(F.col(value).isNotNull()).groupBy("_bucket").agg(F.sum(n).alias("_in"))
    down = Window.orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = buckets.withColumns({"_upto": F.sum("_in").over(down), "_all": F.sum("_in").over(Window.partitionBy())})
    middle = (ranked.filter((F.col("_upto") * 2 >= F.col("_all")) & ((F.col("_upto") - F.col("_in")) * 2 < F.col("_all")))
              .select("_bucket", (F.col("_upto") - F.col("_in")).alias("_above"), "_all"))
    inside = Window.partitionBy("_bucket").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranks = held.join(middle, "_bucket", "left").withColumn("_rank", F.sum(n).over(inside) + F.col("_above"))
    return (ranks.withColumn("in_upper", F.coalesce(F.col("_rank") * 2 >= F.col("_all"), F.lit(False)))
            .drop("_bucket", "_above", "_all", "_rank"))


def _spread_of(r: Column) -> list[Column]:
    # min, max, mean and upper median of counted ratios
    return [
        F.bround(F.min(r), 3).alias("min"),
        F.bround(F.max(r), 3).alias("max"),
        F.bround(F.try_divide(F.sum(_milli(r) * F.col("n")), F.sum(F.when(r.isNotNull(), F.col("n")))) / 1000, 3).alias("average"),
        F.bround(F.min(F.when(F.col("in_upper"), r)), 3).alias("median"),
    ]


def ratio_distribution(scored: DataFrame) -> DataFrame:
    """A-02: min, max, mean and upper median (``sorted[n // 2]``) of new ratios.

    Rows are counted by value first, map-side. All four are null when no row was scored.
    """
    r = F.col("golden_ratio")
    counted = (scored.filter(F.col("ratio_status") == "processed").filter(r.isNotNull())
               .groupBy(r).agg(F.count(F.lit(1)).alias("n")))
    return with_upper_half(counted, "golden_ratio").agg(*_spread_of(r))


def ratio_report(scored: DataFrame) -> DataFrame:
    """A-01 + A-02 as the one-row run report (nested like the stats file).

    One pass over the rows counts them by status, class and new ratio; counts and
    median are read off those.
    """
    st, cat, r = F.col("ratio_status"), F.col("golden_ratio_category"), F.col("ratio")
    done = st == "processed"
    counted = (scored.groupBy(st, cat, F.when(done, F.col("golden_ratio")).alias("ratio"))
               .agg(F.count(F.lit(1)).alias("n")))

    def rows(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")

    agg = with_upper_half(counted, "ratio").agg(
        rows(F.lit(True)).alias("total_items"),
        rows(done).alias("processed"),
        rows(st == "skipped").alias("skipped"),
        rows(st == "no_data").alias("no_nutrition_data"),
        F.lit(0).cast("long").alias("errors"),
        rows(done & (cat == RATIO_EXCELLENT)).alias("excellent"),
        rows(done & (cat == RATIO_GOOD)).alias("good"),
        rows(done & (cat != RATIO_EXCELLENT) & (cat != RATIO_GOOD)).alias("poor"),
        *_spread_of(r),
    )
    return agg.select(
        "total_items", "processed", "skipped", "no_nutrition_data", "errors",
        F.struct("excellent", "good", "poor").alias("ratio_stats"),
        F.when(F.col("processed") > 0, F.struct("min", "max", "average", "median"))
         .alias("ratio_distribution"))


def brand_step_counts(enriched_brands: DataFrame) -> DataFrame:
    """A-03: total, lookup hits, generated answers."""
    src = F.col("category_source")
    return enriched_brands.agg(
        F.count(F.lit(1)).cast("long").alias("total"),
        _count_if(src == "lookup").alias("lookup_matches"),
        _count_if(src == "ai_generated").alias("ai_generated"),
        F.lit(0).cast("long").alias("errors"),
    )


def step_counts(df: DataFrame, step: str, status_col: str) -> DataFrame:
    """A-04: rows per status of one enrichment step."""
    return (df.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).cast("long").alias("n"))
              .select(F.lit(step).alias("step"), "status", "n"))


#: What each enrichment step says of a row.
STATUSES = {
    "text_status": ("processed", "skipped"),
    "profile_status": ("processed", "skipped", "no_data"),
    "ratio_status": ("processed", "skipped", "no_data"),
    "image_status": ("mapped", "had_image", "no_image", "no_id"),
}


def observe_steps(df: DataFrame, status_col: str) -> tuple[DataFrame, Observation]:
    """A-04 without a pass of its own: ``df`` counts its rows by status while it is written."""
    seen = Observation()
    return df.observe(seen, *[_count_if(F.col(status_col) == s).alias(s) for s in STATUSES[status_col]]), seen


def observed_steps(seen: Observation, step: str) -> list[dict]:
    """The rows of ``step_counts`` from a frame of ``observe_steps`` that was written."""
    return [{"step": step, "status": s, "n": n} for s, n in seen.get.items() if n]


def nested_totals(raw_brands: DataFrame, raw_items: DataFrame, raw_servings: DataFrame) -> DataFrame:
    """A-05: brands, items and servings over the raw input, as one row."""
    parts = [raw_brands.agg(F.lit("brands").alias("k"), F.count(F.lit(1)).alias("n")),
             raw_items.agg(F.lit("items").alias("k"), F.count(F.lit(1)).alias("n")),
             raw_servings.agg(F.lit("servings").alias("k"), F.count(F.lit(1)).alias("n"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.agg(*[F.sum(F.when(F.col("k") == k, F.col("n"))).cast("long").alias(k)
                   for k in ("brands", "items", "servings")])


def brand_summary(brands: DataFrame, items: DataFrame, variations: DataFrame) -> DataFrame:
    """A-06: items and variations per brand, plus a grand-total row (brand null).

    Both sides are aggregated per brand before the join, so the join moves one
    row per brand whatever the skew. ``variations`` may come counted, as
    (restaurant_brand_id, variations), where a source can count by a key of its
    own before it makes ids.
    """
    counted = "variations" in variations.columns  # (restaurant_brand_id, variations), counted by the source
    ic = items.groupBy("restaurant_brand_id").agg(F.count(F.lit(1)).cast("long").alias("items"))
    n = F.sum("variations") if counted else F.count(F.lit(1))
    vc = variations.groupBy("restaurant_brand_id").agg(n.cast("long").alias("variations"))
    per = (brands.select(F.col("_id").alias("restaurant_brand_id"), "brand_name")
           .join(ic, "restaurant_brand_id", "left").join(vc, "restaurant_brand_id", "left")
           .select("brand_name", F.coalesce("items", F.lit(0)).alias("items"),
                   F.coalesce("variations", F.lit(0)).alias("variations")))
    return per.rollup("brand_name").agg(F.sum("items").cast("long").alias("items"),
                                        F.sum("variations").cast("long").alias("variations"))


def fetch_log_stats(log: DataFrame, by: str | None = None) -> DataFrame:
    """A-07: requests, successes, failures, retries, success % and duration.

    ``log`` has one row per fetch: ``ok`` boolean, ``attempts`` int, ``ts``.
    """
    aggs = [
        F.count(F.lit(1)).cast("long").alias("total_requests"),
        _count_if(F.col("ok")).alias("successful"),
        _count_if(~F.col("ok")).alias("failed"),
        F.sum(F.col("attempts") - 1).cast("long").alias("retries"),
        # 0 when there were no requests (no division by zero under ANSI mode)
        F.when(F.count(F.lit(1)) > 0, _count_if(F.col("ok")) / F.count(F.lit(1)) * 100)
         .otherwise(F.lit(0.0)).alias("success_pct"),
        # difference of the wall-clock stamps, no time zone involved
        (F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 1_000_000).alias("duration_s"),
    ]
    return log.groupBy(by).agg(*aggs) if by else log.agg(*aggs)
