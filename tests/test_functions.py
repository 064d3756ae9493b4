from pyspark.sql import functions as F

from menulake.functions import (
    amount_or_zero, golden_ratio, parse_amount, parse_unit, profile_tags, ratio_class,
    snake_case, stable_id, typed_nutrition,
)


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_parse_amount_edges(spark):
    got = _one(spark, ["1,200 mg", "<1g", ".5g", "12.", "-5g", "1 1/2 cup", "", "abc", None],
               parse_amount)
    assert got == [1200.0, 1.0, 5.0, 12.0, 5.0, 1.0, None, None, None]


def test_amount_or_zero_edges(spark):
    assert _one(spark, ["1,200 mg", None, "abc", "25g", "0"], amount_or_zero) == [1.0, 0.0, 0.0, 25.0, 0.0]


def test_parse_unit(spark):
    assert _one(spark, ["250 mg", "12", "10G"], parse_unit) == ["mg", None, "g"]


def test_snake_case(spark):
    got = _one(spark, ["Total Fat", "% Daily", "Éclair Açaí-Bowl", "__x__", "\t Sodium \n"], snake_case)
    assert got == ["total_fat", "daily", "éclair_açaí_bowl", "x", "sodium"]


def test_stable_id_golden(spark):
    df = spark.createDataFrame([("McDonald's",), ("Applebee's",)], "n string")
    got = [r[0] for r in df.select(stable_id("n")).collect()]
    assert got == ["1081fdaaeceae9d9b76c9d3931d85438", "e8436b101c560fa673302fc623f04ced"]


def test_stable_id_skips_empty_parts(spark):
    df = spark.createDataFrame([("a", "", "b"), ("a", None, "b")], "x string, y string, z string")
    got = {r[0] for r in df.select(stable_id("x", "y", "z")).collect()}
    assert len(got) == 1


def test_typed_nutrition_alternates(spark):
    df = spark.createDataFrame(
        [({"total_fat": "10g", "fat": "12g"},), ({"total_fat": "10g", "fat": "abc"},)],
        "m map<string,string>")
    got = [r[0] for r in df.select(typed_nutrition("m")["fat_g"]).collect()]
    assert got == [12.0, 10.0]


def test_golden_ratio_and_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (40.0, 400.0), (2.0, 64.0)], "p double, cal double")
    rows = df.select(golden_ratio("p", "cal").alias("r")).select("r", ratio_class("r")).collect()
    assert [tuple(r) for r in rows] == [(0.0, "Poor"), (1.0, "Excellent"), (0.312, "Poor")]


def _tags(spark, rows):
    df = spark.createDataFrame(rows, "cal double, p double, c double, f double, na double, su double")
    return [r[0] for r in df.select(profile_tags("cal", "p", "c", "f", "na", "su")).collect()]


def test_profile_tags_golden(spark):
    got = _tags(spark, [(319.0, 1.5, 58.0, 5.0, 205.0, 45.0),
                        (289.0, 1.0, 48.0, 7.0, 92.0, 46.0),
                        (300.0, 3.0, 32.0, 18.0, 330.0, 19.0)])
    assert got[0] == ["Low Protein", "High Carb", "Low Fat", "Low Calorie", "Low Sodium", "High Sugar"]
    assert got[1] == ["Low Protein", "High Carb", "Low Calorie", "Low Sodium", "High Sugar"]
    assert got[2] == ["Low Protein", "High Fat", "Low Calorie"]


def test_profile_tags_edges(spark):
    got = _tags(spark, [(0.0, 0.0, 0.0, 0.0, 500.0, 50.0),
                        (266.0, 20.0, 30.0, 2.0, 230.0, 0.0),
                        (100.0, 1.0, 1.0, 1.0, 460.0, 0.0)])
    assert got[0] == []
    assert "High Protein" in got[1] and "Low Sodium" in got[1]
    assert "High Sodium" in got[2]


def test_servings_by_rows_are_those_of_the_array(spark):
    from menulake.functions import enrich_serving_rows, enrich_servings

    n, none = "map('calories', '1,200', 'protein', '40g', 'total_carbohydrates', '<1g', 'total_fat', '3', 'sodium', 'x', 'sugar', '9g')", "CAST(NULL AS map<string,string>)"
    zero = "map('calories', '0', 'protein', '0')"

    def serving(label, nutrition, ratio="CAST(NULL AS double)", cls="CAST(NULL AS string)"):
        return f"named_struct('size_label', {label}, 'nutrition', {nutrition}, 'golden_ratio', {ratio}, 'golden_ratio_category', {cls})"

    odd = [serving("'a'", n), serving("'b'", n, "0.0D", "'Odd'"), "NULL", serving("NULL", none), serving("'c'", none, "2.0D"), serving("'d'", zero), serving("'e'", "map()")]
    whole = spark.sql(f"SELECT 1 AS id, array({', '.join(odd)}) AS servings")
    empty = whole.selectExpr("2 AS id", "slice(servings, 1, 0) AS servings")
    df = whole.unionByName(empty).unionByName(whole.selectExpr("3 AS id", "if(id = 1, NULL, servings) AS servings"))
    cols = ("size_label", "golden_ratio", "golden_ratio_category", "macronutrient_profile")
    etype = df.schema["servings"].dataType.elementType
    for force in (False, True):
        nested = df.select("id", F.posexplode(enrich_servings("servings", force, etype)).alias("pos", "s")).select("id", "pos", *[F.col("s")[c] for c in cols])
        rows = enrich_serving_rows(df, "servings", force).select("id", "pos", *cols)
        assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, nested.collect()), key=repr)
        assert rows.count() == len(odd)


def test_the_servings_query_makes_an_array_once_and_explodes_it_bare(spark):
    from menulake.plans.catalog import q_enrich_servings

    from conftest import SF_SMALL
    plan = q_enrich_servings(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode(servings" in plan and "transform(" not in plan
    assert plan.count("Family") == 1
