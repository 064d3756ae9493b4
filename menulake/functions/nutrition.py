"""Nutrition columns: typed facts, macro shares, profile tags, protein ratio.

Covers F-04, F-06, F-07, F-08, F-09, F-10, F-11, F-12, F-13. Everything is a
native expression (``when`` chains, ``greatest``, ``transform``): no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from menulake.functions._util import col_of
from menulake.functions.text import amount_or_zero, parse_amount

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's rules).
# kcal per gram of protein, carbohydrate and fat
KCAL_PER_G_PROTEIN = 4
KCAL_PER_G_CARBS = 4
KCAL_PER_G_FAT = 9
# daily sodium value in mg used for the sodium tags
SODIUM_DAILY_MG = 2300
# typed nutrition field <- scraped key; a second key is an alternate that wins when it parses
NUTRITION_KEYS = [
    ("calories", "calories", None),
    ("protein_g", "protein", None),
    ("carbs_g", "total_carbohydrates", "carbohydrates"),
    ("fat_g", "total_fat", "fat"),
    ("saturated_fat_g", "saturated_fat", None),
    ("trans_fat_g", "trans_fat", None),
    ("cholesterol_mg", "cholesterol", None),
    ("sodium_mg", "sodium", None),
    ("fiber_g", "dietary_fiber", "fiber"),
    ("sugars_g", "sugars", "total_sugars"),
    ("added_sugars_g", "added_sugars", None),
    ("vitamin_d_mcg", "vitamin_d", None),
    ("calcium_mg", "calcium", None),
    ("iron_mg", "iron", None),
    ("potassium_mg", "potassium", None),
]
# profile tags in output order
TAG_HIGH_PROTEIN = "High Protein"
TAG_LOW_PROTEIN = "Low Protein"
TAG_LOW_CARB = "Low Carb"
TAG_HIGH_CARB = "High Carb"
TAG_LOW_FAT = "Low Fat"
TAG_HIGH_FAT = "High Fat"
TAG_LOW_CALORIE = "Low Calorie"
TAG_HIGH_CALORIE = "High Calorie"
TAG_LOW_SODIUM = "Low Sodium"
TAG_HIGH_SODIUM = "High Sodium"
TAG_LOW_SUGAR = "Low Sugar"
TAG_HIGH_SUGAR = "High Sugar"
TAG_KETO = "Keto Friendly"
TAG_BALANCED = "Balanced"
# ratio classes and their lower bounds on the rounded ratio
RATIO_EXCELLENT = "Excellent"   # >= 1.0
RATIO_GOOD = "Good"             # >= 0.5
RATIO_POOR = "Poor"             # otherwise
RATIO_CLASSES = [RATIO_EXCELLENT, RATIO_GOOD, RATIO_POOR]
# defaults for absent fields
DEFAULT_ITEM_NAME = "Unknown Item"
DEFAULT_CATEGORY = "Uncategorized"
DEFAULT_SIZE_LABEL = "1 serving"
# ---------------------------------------------------------------------------

NUTRITION_FIELDS = [k for k, _, _ in NUTRITION_KEYS]
NUTRITION_TYPE = T.StructType([T.StructField(k, T.DoubleType()) for k in NUTRITION_FIELDS])


def typed_nutrition(m) -> Column:
    """F-06: scraped ``map<string,string>`` -> struct of 15 doubles (F-02 dialect)."""
    m = col_of(m)
    fields = []
    for name, main, alt in NUTRITION_KEYS:
        if alt is None:
            v = parse_amount(m.getItem(main))
        else:
            # by a lambda: Spark splits the code of such a projection into methods small enough for the JIT
            v = F.get(F.filter(F.transform(F.array(m.getItem(alt), m.getItem(main)), parse_amount), lambda x: x.isNotNull()), F.lit(0))
        fields.append(v.alias(name))
    return F.struct(*fields)


def serving_struct(m) -> Column:
    """F-07: the raw serving text, kept as text."""
    return F.struct(col_of(m).getItem("serving_size").alias("serving_text"))


def number_or_text(c, dtype: T.DataType | None) -> Column:
    """F-04: numeric columns pass through with their sign; text goes through F-03."""
    c = col_of(c)
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    return amount_or_zero(c)


def macro_shares(cal, p, c, f) -> Column:
    """F-08: struct(protein_pct, carbs_pct, fat_pct, total_kcal).

    Total is the largest of the reported kcal, the kcal from macros, and 1.
    """
    cal, p, c, f = (col_of(x) for x in (cal, p, c, f))
    p_k = p * KCAL_PER_G_PROTEIN
    c_k = c * KCAL_PER_G_CARBS
    f_k = f * KCAL_PER_G_FAT
    total = F.greatest(cal, p_k + c_k + f_k, F.lit(1.0))
    return F.struct(
        ((p_k / total) * 100).alias("protein_pct"),
        ((c_k / total) * 100).alias("carbs_pct"),
        ((f_k / total) * 100).alias("fat_pct"),
        total.alias("total_kcal"),
    )


def profile_tags(cal, p, c, f, sodium, sugar, shares: Column | None = None) -> Column:
    """F-09: ordered profile tags; empty when kcal and all three macros are 0.

    Inputs are numbers (already read with F-03, so null counts as 0).
    ``shares`` may carry a precomputed ``macro_shares`` struct (used inside
    array lambdas, which Spark evaluates without common-subexpression reuse).
    """
    cal, p, c, f, na, su = (col_of(x) for x in (cal, p, c, f, sodium, sugar))
    s = shares if shares is not None else macro_shares(cal, p, c, f)
    pp, cp, fp, t = s["protein_pct"], s["carbs_pct"], s["fat_pct"], s["total_kcal"]
    na_pct = (na / SODIUM_DAILY_MG) * 100
    tags = F.array_compact(F.array(
        F.when((p >= 25) | ((pp >= 30) & (p >= 15)), TAG_HIGH_PROTEIN)
         .when((p < 10) & (t > 250), TAG_LOW_PROTEIN),
        F.when((c < 20) | ((cp <= 20) & (t > 250)), TAG_LOW_CARB)
         .when(cp >= 60, TAG_HIGH_CARB),
        F.when((fp <= 20) & (t > 200), TAG_LOW_FAT)
         .when(fp >= 50, TAG_HIGH_FAT),
        F.when(t <= 350, TAG_LOW_CALORIE)
         .when(t >= 700, TAG_HIGH_CALORIE),
        F.when(na_pct <= 10, TAG_LOW_SODIUM)
         .when(na_pct >= 20, TAG_HIGH_SODIUM),
        F.when(su <= 8, TAG_LOW_SUGAR)
         .when(su >= 20, TAG_HIGH_SUGAR),
        F.when((c <= 15) & (fp >= 60) & (cp <= 10), TAG_KETO),
        F.when(cp.between(30, 50) & pp.between(20, 40) & fp.between(20, 40) & (t >= 300),
               TAG_BALANCED),
    ))
    no_data = (cal == 0) & (p == 0) & (c == 0) & (f == 0)
    return F.when(no_data, F.array().cast("array<string>")).otherwise(tags)


def golden_ratio(protein, calories) -> Column:
    """F-11: protein / kcal x 10, 3 decimals, half-even; 0.0 when kcal is 0."""
    p, cal = col_of(protein), col_of(calories)
    return F.when(cal == 0, F.lit(0.0)).otherwise(F.bround((p / cal) * 10, 3))


def ratio_class(ratio) -> Column:
    """F-12: class of the rounded ratio."""
    r = col_of(ratio)
    return (F.when(r >= 1.0, RATIO_EXCELLENT)
             .when(r >= 0.5, RATIO_GOOD)
             .otherwise(RATIO_POOR))


def with_item_defaults(df: DataFrame) -> DataFrame:
    """F-13: defaults for absent item name and category."""
    return (df.withColumn("name", F.coalesce(F.col("name"), F.lit(DEFAULT_ITEM_NAME)))
              .withColumn("category", F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY))))


def default_size_label(c) -> Column:
    """F-13: a serving with no label is the single default serving."""
    return F.coalesce(col_of(c), F.lit(DEFAULT_SIZE_LABEL))


def _serving_numbers(n: Column) -> Column:
    """The six numbers the tag and ratio rules read from a text nutrition map."""
    sugar = F.coalesce(n.getItem("sugars"), n.getItem("sugar"))
    return F.struct(
        amount_or_zero(n.getItem("calories")).alias("cal"),
        amount_or_zero(n.getItem("protein")).alias("p"),
        amount_or_zero(n.getItem("total_carbohydrates")).alias("c"),
        amount_or_zero(n.getItem("total_fat")).alias("f"),
        amount_or_zero(n.getItem("sodium")).alias("na"),
        amount_or_zero(sugar).alias("su"),
    )


NUMBERS = ("cal", "p", "c", "f", "na", "su")


def _found(has: Column, numbers, shares: Column, new_ratio: Column, s: Column, fields, force: bool) -> dict[str, Column]:
    """What F-10 adds to a serving ``s``: its tags, its ratio and its class."""
    new_ratio = F.when(has, new_ratio)
    new_class = F.when(has, ratio_class(new_ratio))
    ratio, cls = new_ratio, new_class
    if not force and "golden_ratio" in fields:
        kept = s["golden_ratio"].isNotNull()
        old_class = (s["golden_ratio_category"] if "golden_ratio_category" in fields
                     else F.lit(None).cast("string"))
        ratio = F.when(kept, s["golden_ratio"]).otherwise(new_ratio)
        cls = F.when(kept, old_class).otherwise(new_class)
    return {"macronutrient_profile": F.when(has, profile_tags(*numbers, shares)),
            "golden_ratio": ratio, "golden_ratio_category": cls}


def enrich_servings(servings, force: bool = False, element_type: T.StructType | None = None) -> Column:
    """F-10: tag and score each element of a nested serving array.

    Elements are ``struct<size_label, nutrition map<string,string>, ...>``.
    Adds ``macronutrient_profile``, ``golden_ratio`` and ``golden_ratio_category``
    to each element. A serving that already has a ratio keeps it, and keeps its
    class as it is, unless ``force``. Elements without nutrition get neither.
    Pass ``element_type`` (the array's element struct) so fields the input lacks
    are treated as absent.

    Array lambdas run without common-subexpression reuse, so the work is staged:
    parse the six numbers once, then the shares, then tags and ratio.
    """
    fields = set(element_type.fieldNames()) if element_type is not None else {
        "golden_ratio", "golden_ratio_category"}

    def parse(s: Column) -> Column:
        return s.withField("_num", F.when(s["nutrition"].isNotNull(), _serving_numbers(s["nutrition"])))

    def share(s: Column) -> Column:
        x = s["_num"]
        return s.withField("_shares", F.when(x.isNotNull(), macro_shares(x["cal"], x["p"], x["c"], x["f"])))

    def finish(s: Column) -> Column:
        x = s["_num"]
        found = _found(x.isNotNull(), [x[k] for k in NUMBERS], s["_shares"], golden_ratio(x["p"], x["cal"]), s, fields, force)
        for name, c in found.items():
            s = s.withField(name, c)
        return s.dropFields("_num", "_shares")

    return F.transform(F.transform(F.transform(col_of(servings), parse), share), finish)


def enrich_serving_rows(df: DataFrame, servings: str = "servings", force: bool = False) -> DataFrame:
    """F-10 by rows: ``enrich_servings`` of the array column, one row an element.

    The row holds the other columns of ``df``, the element's position ``pos`` and its
    fields. Spark interprets the lambdas over an array; columns of a row are compiled,
    and an element's numbers, shares and ratio are made once. The elements are taken by
    an outer explode, as for an inner one Spark derives a filter on the array, which
    builds it a second time; the rows of null and empty arrays are dropped behind it.
    """
    fields = df.schema[servings].dataType.elementType.fieldNames()
    rows = df.select(*[c for c in df.columns if c != servings], F.posexplode_outer(servings).alias("pos", "_serving"))
    s = F.col("_serving")
    has, num = F.col("_has"), _serving_numbers(s["nutrition"])
    rows = rows.filter(F.col("pos").isNotNull()).withColumn("_has", s["nutrition"].isNotNull())
    rows = rows.withColumns({f"_{k}": F.when(has, num[k]) for k in NUMBERS})
    rows = rows.withColumns({"_shares": macro_shares("_cal", "_p", "_c", "_f"), "_ratio": golden_ratio("_p", "_cal")})
    found = _found(has, [F.col(f"_{k}") for k in NUMBERS], F.col("_shares"), F.col("_ratio"), s, fields, force)
    return rows.select(*[c for c in df.columns if c != servings], "pos", *[s[f].alias(f) for f in fields if f not in found],
                       *[c.alias(name) for name, c in found.items()])
