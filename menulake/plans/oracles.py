"""DuckDB oracle SQL for the registered queries.

The oracle recomputes each binding straight from the base columns (no text
round trip), so it checks the Spark text parsers, ids, tags and ratios
independently. Every computed column is aliased to the Spark column name.
"""

from __future__ import annotations

from menulake.plans.bindings import BASE_URL, LOOKUP_CATEGORIES, LOOKUP_CUISINES, RUN_TS


def sid(*parts: str) -> str:
    """SQL form of D-01."""
    kept = ", ".join(f"NULLIF(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"substr(sha256(concat_ws('|', {kept})), 1, 32)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CATS = sql_list(LOOKUP_CATEGORIES)
CUIS = sql_list(LOOKUP_CUISINES)
ITEM_URL = f"'{BASE_URL}/items/' || CAST(p_partkey AS VARCHAR)"
BRAND_NUM = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)"


def tags_sql(cal: str, p: str, c: str, f: str, na: str, su: str) -> str:
    """F-08 + F-09 as comma-joined text."""
    tot = f"greatest({cal}, {p} * 4 + {c} * 4 + {f} * 9, 1.0)"
    pp = f"(({p} * 4) / {tot}) * 100"
    cp = f"(({c} * 4) / {tot}) * 100"
    fp = f"(({f} * 9) / {tot}) * 100"
    nap = f"({na} / 2300) * 100"
    return f"""CASE WHEN {cal} = 0 AND {p} = 0 AND {c} = 0 AND {f} = 0 THEN '' ELSE concat_ws(',',
      CASE WHEN {p} >= 25 OR ({pp} >= 30 AND {p} >= 15) THEN 'High Protein'
           WHEN {p} < 10 AND {tot} > 250 THEN 'Low Protein' END,
      CASE WHEN {c} < 20 OR ({cp} <= 20 AND {tot} > 250) THEN 'Low Carb'
           WHEN {cp} >= 60 THEN 'High Carb' END,
      CASE WHEN {fp} <= 20 AND {tot} > 200 THEN 'Low Fat' WHEN {fp} >= 50 THEN 'High Fat' END,
      CASE WHEN {tot} <= 350 THEN 'Low Calorie' WHEN {tot} >= 700 THEN 'High Calorie' END,
      CASE WHEN {nap} <= 10 THEN 'Low Sodium' WHEN {nap} >= 20 THEN 'High Sodium' END,
      CASE WHEN {su} <= 8 THEN 'Low Sugar' WHEN {su} >= 20 THEN 'High Sugar' END,
      CASE WHEN {c} <= 15 AND {fp} >= 60 AND {cp} <= 10 THEN 'Keto Friendly' END,
      CASE WHEN {cp} BETWEEN 30 AND 50 AND {pp} BETWEEN 20 AND 40 AND {fp} BETWEEN 20 AND 40
                AND {tot} >= 300 THEN 'Balanced' END) END"""


def ratio_sql(p: str, cal: str) -> str:
    return f"CASE WHEN {cal} = 0 THEN 0.0 ELSE round_even(({p} / {cal}) * 10, 3) END"


def class_sql(r: str) -> str:
    return f"CASE WHEN {r} >= 1.0 THEN 'Excellent' WHEN {r} >= 0.5 THEN 'Good' ELSE 'Poor' END"


LI_ORDER = ("l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")

# Shared CTEs --------------------------------------------------------------

CTE_BRANDS = f"""
b_raw AS (
  SELECT p_brand AS name, min(p_partkey) AS brand_pos, {BRAND_NUM} AS n
  FROM part GROUP BY p_brand),
b AS (
  SELECT {sid('name')} AS _id, name AS brand_name, n, brand_pos,
         '{BASE_URL}/restaurants/' || regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') AS url
  FROM b_raw)"""

CTE_ENRICHED_BRANDS = CTE_BRANDS + f""",
eb AS (
  SELECT _id, brand_name, n,
    CASE WHEN n <= 20 THEN {CATS}[(CASE WHEN n <= 3 THEN n + 1 ELSE n END) % 4 + 1]
         WHEN n % 4 = 2 THEN 'Fast Food' ELSE {CATS}[n % 4 + 1] END AS restaurant_category,
    CASE WHEN n <= 20 THEN {CUIS}[(CASE WHEN n <= 3 THEN n + 1 ELSE n END) % 17 + 1]
         WHEN n % 4 = 2 THEN 'American' ELSE {CUIS}[n % 17 + 1] END AS restaurant_cultural_cuisine,
    CASE WHEN n <= 20 THEN 'lookup' ELSE 'ai_generated' END AS category_source
  FROM b)"""

CTE_ITEMS = f"""
it AS (
  SELECT {sid(sid('p_brand'), 'p_name', ITEM_URL)} AS _id, {sid('p_brand')} AS restaurant_brand_id,
         p_name AS name, p_type AS category, {ITEM_URL} AS source_url, p_partkey, p_brand, p_size,
         p_name, p_type,
         p_retailprice
  FROM part)"""

CTE_VARIATIONS = f"""
vx AS (
  SELECT l.*, p.p_brand, p.p_name, p.p_size,
    {sid('p.p_brand')} AS restaurant_brand_id,
    {sid(sid('p.p_brand'), 'p.p_name', "'" + BASE_URL + "/items/' || CAST(l.l_partkey AS VARCHAR)")} AS menu_item_id,
    'Size ' || CAST(l_linenumber AS VARCHAR) || ' / order ' || CAST(l_orderkey AS VARCHAR) AS label,
    CAST(CAST(l_quantity * 18 AS BIGINT) AS DOUBLE) AS calories,
    CAST(CAST(round(l_discount * 600) AS BIGINT) AS DOUBLE) AS protein_g,
    CASE WHEN round(l_tax * 1000) = 0 THEN 1.0 ELSE CAST(CAST(round(l_tax * 1000) AS BIGINT) AS DOUBLE) END AS carbs_g,
    CAST(CASE WHEN l_linestatus = 'O' THEN l_partkey % 45 + 2 ELSE l_partkey % 45 END AS DOUBLE) AS fat_g,
    CAST((l_orderkey * 7) % 1500 AS DOUBLE) AS sodium_mg,
    CAST((l_suppkey * 3) % 40 AS DOUBLE) AS sugars_g,
    CAST(CAST(l_quantity * 10 AS BIGINT) AS VARCHAR) || ' g' AS serving_text,
    CASE WHEN l_linenumber % 3 = 2 THEN '{BASE_URL}/item-photos/' || CAST(l_partkey AS VARCHAR) || '-'
         || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '.jpg' END AS image_url,
    CASE WHEN p.p_size % 5 = 0 THEN 'ingredients of ' || p.p_name ELSE '' END AS ingredients
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
v AS (
  SELECT *, {sid('menu_item_id', 'label')} AS _id,
    {ratio_sql('protein_g', 'calories')} AS golden_ratio
  FROM vx),
vs AS (SELECT *, {class_sql('golden_ratio')} AS golden_ratio_category FROM v),
fv AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY menu_item_id ORDER BY {LI_ORDER}) AS rn FROM v)
  WHERE rn = 1),
fi AS (
  SELECT * FROM (
    SELECT menu_item_id, image_url,
           row_number() OVER (PARTITION BY menu_item_id ORDER BY {LI_ORDER}) AS rn
    FROM v WHERE image_url IS NOT NULL AND image_url <> '')
  WHERE rn = 1)"""

CTE_PROFILES = f""",
prof AS (
  SELECT it._id, it.restaurant_brand_id,
    CASE WHEN fv.menu_item_id IS NULL THEN 'no_data' ELSE 'processed' END AS profile_status,
    CASE WHEN fv.menu_item_id IS NOT NULL THEN
      {tags_sql('fv.calories', 'fv.protein_g', 'fv.carbs_g', 'fv.fat_g', 'fv.sodium_mg', 'fv.sugars_g')}
    END AS tags
  FROM it LEFT JOIN fv ON it._id = fv.menu_item_id)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


ORACLES: dict[str, str] = {}

ORACLES["brand_protein_report"] = with_ctes(
    CTE_ENRICHED_BRANDS, CTE_ITEMS, CTE_VARIATIONS + CTE_PROFILES, body="""
, va AS (
  SELECT restaurant_brand_id, CAST(count(*) AS BIGINT) AS variations,
    CAST(count_if(golden_ratio_category = 'Excellent') AS BIGINT) AS excellent,
    CAST(count_if(golden_ratio_category = 'Good') AS BIGINT) AS good,
    CAST(count_if(golden_ratio_category = 'Poor') AS BIGINT) AS poor,
    CAST(sum(CAST(round(golden_ratio * 1000) AS BIGINT)) AS BIGINT) AS milli
  FROM vs GROUP BY restaurant_brand_id),
ia AS (
  SELECT restaurant_brand_id, CAST(count(*) AS BIGINT) AS items,
    CAST(count_if(list_contains(string_split(tags, ','), 'High Protein')) AS BIGINT) AS high_protein_items,
    CAST(count_if(list_contains(string_split(tags, ','), 'Low Carb')) AS BIGINT) AS low_carb_items,
    CAST(count_if(list_contains(string_split(tags, ','), 'Keto Friendly')) AS BIGINT) AS keto_items,
    CAST(count_if(list_contains(string_split(tags, ','), 'Balanced')) AS BIGINT) AS balanced_items
  FROM prof GROUP BY restaurant_brand_id)
SELECT eb.brand_name, eb.restaurant_category, eb.restaurant_cultural_cuisine, eb.category_source,
  coalesce(ia.items, 0) AS items, coalesce(va.variations, 0) AS variations,
  coalesce(va.excellent, 0) AS excellent, coalesce(va.good, 0) AS good, coalesce(va.poor, 0) AS poor,
  va.milli / va.variations / 1000 AS avg_ratio,
  coalesce(ia.high_protein_items, 0) AS high_protein_items,
  coalesce(ia.low_carb_items, 0) AS low_carb_items,
  coalesce(ia.keto_items, 0) AS keto_items,
  coalesce(ia.balanced_items, 0) AS balanced_items
FROM eb LEFT JOIN ia ON eb._id = ia.restaurant_brand_id
        LEFT JOIN va ON eb._id = va.restaurant_brand_id""")

# Text parsers in SQL -------------------------------------------------------

NUM_RE = r"([0-9]+\.?[0-9]*)"


def f02(t: str) -> str:
    return (f"TRY_CAST(NULLIF(regexp_extract(regexp_replace({t}, '[,<>]', '', 'g'), '{NUM_RE}', 1), '') "
            f"AS DOUBLE)")


def f03(t: str) -> str:
    return f"coalesce(TRY_CAST(NULLIF(regexp_extract({t}, '{NUM_RE}', 1), '') AS DOUBLE), 0.0)"


def f05(t: str) -> str:
    return f"NULLIF(lower(regexp_extract({t}, '([a-zA-Z]+)', 1)), '')"


def snake(t: str) -> str:
    return rf"trim(regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '_')"


SODIUM_TXT = "format('{:,}', (l_orderkey * 7) % 1500) || ' mg'"
CARBS_TXT = ("CASE WHEN round(l_tax * 1000) = 0 THEN '<1g' "
             "ELSE CAST(CAST(round(l_tax * 1000) AS BIGINT) AS VARCHAR) || 'g' END")
FAT_ALT_TXT = "CASE WHEN l_linestatus = 'O' THEN CAST(l_partkey % 45 + 2 AS VARCHAR) || ' g' END"
PRICE_TXT = ("CAST(floor(CAST(round(p_retailprice * 100) AS BIGINT) / 100) AS BIGINT) || '.' || "
             "lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')")

ORACLES["to_brands"] = with_ctes(CTE_BRANDS, body=f"""
SELECT _id, brand_name, CASE WHEN n > 22 THEN NULL ELSE url || '/logo.png' END AS brand_image_url,
  url AS source_url, false AS eatery_full_verification_status, '{RUN_TS}' AS creation_date,
  '{RUN_TS}' AS last_updated, CAST(brand_pos AS BIGINT) AS brand_pos
FROM b""")

ORACLES["to_menu_items"] = with_ctes(CTE_ITEMS, body="""
SELECT _id, restaurant_brand_id, name, category, source_url, true AS is_active,
  CAST(p_partkey AS BIGINT) AS item_pos
FROM it""")

ORACLES["kept_ids"] = with_ctes(CTE_ITEMS, body="""
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'item-' || CAST(p_partkey AS VARCHAR) ELSE _id END AS _id,
  restaurant_brand_id, CAST(p_partkey AS BIGINT) AS item_pos
FROM it""")

ORACLES["to_variations"] = with_ctes(CTE_VARIATIONS, body="""
SELECT _id, menu_item_id, restaurant_brand_id, label, serving_text, calories, protein_g, carbs_g,
  fat_g, CAST(NULL AS DOUBLE) AS saturated_fat_g, CAST(NULL AS DOUBLE) AS trans_fat_g,
  CAST(NULL AS DOUBLE) AS cholesterol_mg, sodium_mg, CAST(NULL AS DOUBLE) AS fiber_g, sugars_g,
  CAST(NULL AS DOUBLE) AS added_sugars_g, CAST(NULL AS DOUBLE) AS vitamin_d_mcg,
  CAST(NULL AS DOUBLE) AS calcium_mg, CAST(NULL AS DOUBLE) AS iron_mg,
  CAST(NULL AS DOUBLE) AS potassium_mg, ingredients, image_url, true AS is_active
FROM v""")

ORACLES["nutrient_text"] = f"""
WITH t AS (
  SELECT {SODIUM_TXT} AS sodium_text, {CARBS_TXT} AS carbs_text, {FAT_ALT_TXT} AS fat_text FROM lineitem)
SELECT sodium_text, {f02('sodium_text')} AS sodium_amount, {f03('sodium_text')} AS sodium_or_zero,
  {f05('sodium_text')} AS sodium_unit, carbs_text, {f02('carbs_text')} AS carbs_amount,
  {f05('carbs_text')} AS carbs_unit, {f02('fat_text')} AS fat_alt_amount,
  {f03('fat_text')} AS fat_alt_or_zero
FROM t"""

ORACLES["snake_keys"] = f"""
SELECT doc_id AS id, 'doc' AS kind, {snake('source')} AS key_a, {snake('text')} AS key_b FROM documents
UNION ALL
SELECT p_partkey AS id, 'part' AS kind, {snake('p_name')} AS key_a,
  {snake("concat_ws(' - ', p_type, p_brand)")} AS key_b FROM part"""

_TOT = "greatest(calories, protein_g * 4 + carbs_g * 4 + fat_g * 9, 1.0)"
ORACLES["variation_tags"] = with_ctes(CTE_VARIATIONS, body=f"""
SELECT _id, ((protein_g * 4) / {_TOT}) * 100 AS protein_pct, ((carbs_g * 4) / {_TOT}) * 100 AS carbs_pct,
  ((fat_g * 9) / {_TOT}) * 100 AS fat_pct, {_TOT} AS total_kcal,
  {tags_sql('calories', 'protein_g', 'carbs_g', 'fat_g', 'sodium_mg', 'sugars_g')} AS tags
FROM v""")

ORACLES["variation_ratios"] = with_ctes(CTE_VARIATIONS, body="""
SELECT _id, menu_item_id, golden_ratio, golden_ratio_category, 'processed' AS ratio_status FROM vs""")

ORACLES["ratio_counts"] = with_ctes(CTE_VARIATIONS, body="""
SELECT CAST(count(*) AS BIGINT) AS total_items, CAST(count(*) AS BIGINT) AS processed,
  CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS no_nutrition_data, CAST(0 AS BIGINT) AS errors,
  CAST(count_if(golden_ratio_category = 'Excellent') AS BIGINT) AS excellent,
  CAST(count_if(golden_ratio_category = 'Good') AS BIGINT) AS good,
  CAST(count_if(golden_ratio_category = 'Poor') AS BIGINT) AS poor
FROM vs""")

ORACLES["ratio_distribution"] = with_ctes(CTE_VARIATIONS, body="""
SELECT round_even(min(golden_ratio), 3) AS min, round_even(max(golden_ratio), 3) AS max,
  round_even(sum(CAST(round(golden_ratio * 1000) AS BIGINT)) / count(golden_ratio) / 1000, 3) AS average,
  round_even(percentile_disc(0.5) WITHIN GROUP (ORDER BY golden_ratio DESC), 3) AS median
FROM vs""")

ORACLES["written_report"] = with_ctes(CTE_VARIATIONS, body="""
SELECT CAST(count(*) AS BIGINT) AS total_items, CAST(count(*) AS BIGINT) AS processed,
  CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS no_nutrition_data, CAST(0 AS BIGINT) AS errors,
  CAST(count_if(golden_ratio_category = 'Excellent') AS BIGINT) AS excellent,
  CAST(count_if(golden_ratio_category = 'Good') AS BIGINT) AS good,
  CAST(count_if(golden_ratio_category = 'Poor') AS BIGINT) AS poor,
  round_even(min(golden_ratio), 3) AS min, round_even(max(golden_ratio), 3) AS max,
  round_even(sum(CAST(round(golden_ratio * 1000) AS BIGINT)) / count(golden_ratio) / 1000, 3) AS average,
  round_even(percentile_disc(0.5) WITHIN GROUP (ORDER BY golden_ratio DESC), 3) AS median
FROM vs""")

_NUT = {
    "cal": "CAST(CAST(l_quantity * 18 AS BIGINT) AS VARCHAR)",
    "cal_big": "format('{:,}', CAST(l_quantity * 180 AS BIGINT))",
    "p": "CAST(CAST(round(l_discount * 600) AS BIGINT) AS VARCHAR) || 'g'",
    "c": CARBS_TXT,
    "f": "CAST(l_partkey % 45 AS VARCHAR) || 'g'",
    "na": SODIUM_TXT,
    "su": "CAST((l_suppkey * 3) % 40 AS VARCHAR) || 'g'",
}


def _serving_sql(pos: int, label: str, cal_txt: str, keep_zero: bool) -> str:
    cal, p = f03(cal_txt), f03(_NUT["p"])
    c, f, na, su = f03(_NUT["c"]), f03(_NUT["f"]), f03(_NUT["na"]), f03(_NUT["su"])
    r = ratio_sql(p, cal)
    ratio = f"CASE WHEN l_linenumber = 1 THEN 0.0 ELSE {r} END" if keep_zero else r
    cls = f"CASE WHEN l_linenumber = 1 THEN NULL ELSE {class_sql(r)} END" if keep_zero else class_sql(r)
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, {pos} AS pos, '{label}' AS size_label,
  {tags_sql(cal, p, c, f, na, su)} AS tags, {ratio} AS golden_ratio, {cls} AS golden_ratio_category
FROM lineitem"""


ORACLES["enrich_servings"] = (_serving_sql(0, "Regular", _NUT["cal"], True) + "\nUNION ALL\n"
                              + _serving_sql(1, "Family", _NUT["cal_big"], False))

ORACLES["first_variation"] = with_ctes(CTE_VARIATIONS, body="""
SELECT menu_item_id, calories, protein_g, carbs_g, fat_g, sodium_mg, sugars_g FROM fv""")

ORACLES["first_image"] = with_ctes(CTE_VARIATIONS, body="SELECT menu_item_id, image_url FROM fi")

ORACLES["item_profiles"] = with_ctes(CTE_ITEMS, CTE_VARIATIONS + CTE_PROFILES, body="""
SELECT _id, profile_status, tags FROM prof""")

ORACLES["item_images"] = with_ctes(CTE_ITEMS, CTE_VARIATIONS, body="""
SELECT it._id, CASE WHEN fi.menu_item_id IS NULL THEN 'no_image' ELSE 'mapped' END AS image_status,
  fi.image_url AS menu_item_image_url
FROM it LEFT JOIN fi ON it._id = fi.menu_item_id""")

ORACLES["enriched_brands"] = with_ctes(CTE_ENRICHED_BRANDS, body=f"""
SELECT _id, brand_name, restaurant_category, restaurant_cultural_cuisine, category_source,
  n <= 20 AS lookup_hit, '{RUN_TS}' AS last_updated
FROM eb""")

ORACLES["brand_step_counts"] = with_ctes(CTE_ENRICHED_BRANDS, body="""
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(category_source = 'lookup') AS BIGINT) AS lookup_matches,
  CAST(count_if(category_source = 'ai_generated') AS BIGINT) AS ai_generated,
  CAST(0 AS BIGINT) AS errors
FROM eb""")

ORACLES["brand_requests"] = with_ctes(CTE_BRANDS, body="""
SELECT _id AS key, brand_name FROM b WHERE n > 20""")

ORACLES["item_text"] = with_ctes(CTE_ITEMS, body=f"""
, a AS (
  SELECT _id, p_size % 7 <> 0 AND p_partkey % 5 >= 2 AS ok, p_name, p_type, p_brand, {PRICE_TXT} AS price
  FROM it)
SELECT _id, 'processed' AS text_status,
  CASE WHEN ok THEN 'House ' || p_name || ', made to order.'
       ELSE 'A delicious ' || lower(p_type) || ' item from ' || p_brand || '.' END AS description,
  CASE WHEN ok THEN price ELSE '9.99' END AS estimated_price,
  CASE WHEN ok THEN 'American,' || p_type || ',International'
       ELSE 'American,International,Casual' END AS cuisine_types
FROM a""")

ORACLES["item_requests"] = with_ctes(CTE_ITEMS, body="""
SELECT _id AS key, name, category, p_brand AS restaurant_name,
  'Item: ' || name || ' | Category: ' || category || ' | Restaurant: ' || p_brand AS request
FROM it""")

ORACLES["step_counts"] = with_ctes(CTE_ITEMS, CTE_VARIATIONS + CTE_PROFILES, body="""
SELECT 'profile' AS step, profile_status AS status, CAST(count(*) AS BIGINT) AS n FROM prof GROUP BY 2
UNION ALL
SELECT 'item_text', 'processed', CAST(count(*) AS BIGINT) FROM it
UNION ALL
SELECT 'image', CASE WHEN fi.menu_item_id IS NULL THEN 'no_image' ELSE 'mapped' END, CAST(count(*) AS BIGINT)
FROM it LEFT JOIN fi ON it._id = fi.menu_item_id GROUP BY 2
UNION ALL
SELECT 'ratio', 'processed', CAST(count(*) AS BIGINT) FROM v""")

ORACLES["nested_totals"] = """
SELECT (SELECT CAST(count(DISTINCT p_brand) AS BIGINT) FROM part) AS brands,
  (SELECT CAST(count(*) AS BIGINT) FROM part) AS items,
  (SELECT CAST(count(*) AS BIGINT) FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) AS servings"""

ORACLES["brand_summary"] = """
WITH per AS (
  SELECT p_brand AS brand_name, CAST(count(*) AS BIGINT) AS items,
    CAST(coalesce(sum(nv), 0) AS BIGINT) AS variations
  FROM part LEFT JOIN (SELECT l_partkey, count(*) AS nv FROM lineitem GROUP BY l_partkey) l
    ON part.p_partkey = l.l_partkey
  GROUP BY p_brand)
SELECT brand_name, CAST(sum(items) AS BIGINT) AS items, CAST(sum(variations) AS BIGINT) AS variations
FROM per GROUP BY ROLLUP (brand_name)"""

ORACLES["fetch_log_stats"] = """
SELECT user_id AS source, CAST(count(*) AS BIGINT) AS total_requests,
  CAST(count_if(event_type <> 'error') AS BIGINT) AS successful,
  CAST(count_if(event_type = 'error') AS BIGINT) AS failed,
  CAST(sum(CAST(trunc(value) AS BIGINT) % 3) AS BIGINT) AS retries,
  count_if(event_type <> 'error') / count(*) * 100 AS success_pct,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS duration_s
FROM events GROUP BY user_id"""

ORACLES["only_brands"] = with_ctes(CTE_ITEMS, body="""
SELECT _id, p_brand AS brand_name, name FROM it
WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#13', 'brand#2')""")

ORACLES["limit_brands"] = with_ctes(CTE_BRANDS, body="""
SELECT _id, brand_name, CAST(brand_pos AS BIGINT) AS brand_pos FROM b ORDER BY brand_pos LIMIT 5""")

ORACLES["limit_items_per_brand"] = with_ctes(CTE_ITEMS, body="""
SELECT _id, p_brand AS brand_name, CAST(p_partkey AS BIGINT) AS item_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM it)
WHERE rn <= 10""")

ORACLES["drop_incomplete"] = f"""
SELECT c_custkey, c_name AS name, '{BASE_URL}/c/' || CAST(c_custkey AS VARCHAR) AS url
FROM customer WHERE c_acctbal >= 0 AND c_name IS NOT NULL AND c_name <> ''"""

_ORD = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders)"""

ORACLES["dedup_last"] = f"""
SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus,
  arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_orderdate, o_orderkey) AS o_orderdate,
  arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
FROM {_ORD} GROUP BY o_custkey"""

ORACLES["dedup_first"] = f"""
SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus,
  arg_min(o_totalprice, o_orderkey) AS o_totalprice, arg_min(o_orderdate, o_orderkey) AS o_orderdate,
  arg_min(o_orderpriority, o_orderkey) AS o_orderpriority
FROM {_ORD} GROUP BY o_custkey"""

ORACLES["skip_done"] = """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders
                        WHERE o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '1998-01-01')"""

ORACLES["merge_resume"] = """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey >= 10 THEN c_acctbal + 1 ELSE c_acctbal END
  AS c_acctbal
FROM customer WHERE c_nationkey < 15 OR c_nationkey >= 10"""

ORACLES["merge_partials"] = """
WITH o AS (
  SELECT o_custkey, o_orderkey, o_totalprice,
    CASE WHEN year(o_orderdate) < 1995 THEN 0 WHEN year(o_orderdate) < 1998 THEN 1 ELSE 2 END AS part
  FROM orders),
p AS (
  SELECT o_custkey, part, min(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM o GROUP BY o_custkey, part)
SELECT o_custkey, arg_max(o_orderkey, part) AS o_orderkey, arg_max(o_totalprice, part) AS o_totalprice
FROM p GROUP BY o_custkey"""

ORACLES["latest_per_key"] = """
WITH o AS (SELECT o_orderkey, o_custkey, date_trunc('month', o_orderdate) AS month FROM orders)
SELECT o_orderkey, o_custkey, CAST(CAST(month AS DATE) AS VARCHAR) AS month FROM o
WHERE (o_custkey, month) IN (SELECT (o_custkey, max(month)) FROM o GROUP BY o_custkey)"""

ORACLES["read_pages"] = """
SELECT url, min(page_id) AS page_id, CAST(arg_min(length(html), page_id) AS INTEGER) AS html_len
FROM pages GROUP BY url"""

ORACLES["check_url"] = r"""
SELECT page_id, url, url IS NULL OR regexp_matches(url, '^https?://[^\s/]+') AS url_ok FROM pages"""

ORACLES["cap_description"] = """
SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) ELSE text END AS description
FROM documents"""

_BLANK = r"regexp_replace({x}, '^\s+|\s+$', '', 'g') = ''"
_ITEM_CAND = f"""
it2 AS (
  SELECT CASE WHEN p_size = 1 THEN '  ' ELSE _id END AS _id, restaurant_brand_id,
    CASE WHEN p_size = 2 THEN chr(9) ELSE p_name END AS name,
    CASE WHEN p_size % 3 = 0 THEN repeat(p_name || ' ', 40) ELSE p_name END AS description,
    p_size % 6 AS k, {PRICE_TXT} AS price
  FROM it)"""

ORACLES["validate_items"] = with_ctes(CTE_ITEMS, _ITEM_CAND, body=f"""
, e AS (
  SELECT *, concat_ws(';',
      CASE WHEN {_BLANK.format(x='_id')} THEN '_id: cannot be empty' END,
      CASE WHEN {_BLANK.format(x='restaurant_brand_id')} THEN 'restaurant_brand_id: cannot be empty' END,
      CASE WHEN {_BLANK.format(x='name')} THEN 'name: cannot be empty' END) AS errors
  FROM it2)
SELECT _id, errors = '' AS valid, errors, CAST(least(length(description), 500) AS INTEGER) AS description_len,
  CASE k WHEN 0 THEN '$' || price WHEN 3 THEN '$1,' || price WHEN 5 THEN ' ' || price || ' ' END
    AS estimated_price
FROM e""")

ORACLES["validate_variations"] = """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN ''
            ELSE concat_ws('-', l_orderkey, l_linenumber, l_partkey) END AS _id,
  l_orderkey % 101 <> 0 AS valid,
  CASE WHEN l_orderkey % 101 = 0 THEN '_id: cannot be empty' ELSE '' END AS errors,
  CASE WHEN round(l_discount * 600) - 30 < 0 THEN NULL ELSE round(l_discount * 600) - 30 END AS protein_g,
  CASE WHEN l_tax * 100 - 4 < 0 THEN NULL ELSE l_tax * 100 - 4 END AS carbs_g,
  CAST(CASE WHEN l_linenumber = 1 THEN -1.0 ELSE 0.5 END AS DOUBLE) AS trans_fat_g,
  CASE WHEN l_extendedprice / 1000 < 0 OR l_extendedprice / 1000 > 100 THEN NULL
       ELSE l_extendedprice / 1000 END AS golden_ratio,
  CASE l_linenumber % 4 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' WHEN 2 THEN 'Poor' END
    AS golden_ratio_category
FROM lineitem"""

ORACLES["reject_counts"] = with_ctes(CTE_ITEMS, _ITEM_CAND, body=f"""
SELECT 'menu_items' AS collection, CAST(count(*) AS BIGINT) AS rejected FROM it2
WHERE {_BLANK.format(x='_id')} OR {_BLANK.format(x='name')}
UNION ALL
SELECT 'variations', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_orderkey % 101 = 0""")

_UPSERT = """
base AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS _id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
fresh AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS _id,
    CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'),
j AS (
  SELECT coalesce(b._id, f._id) AS _id, b._id IS NOT NULL AS in_b, f._id IS NOT NULL AS in_f,
    b.o_custkey, b.o_orderstatus AS b_st, f.o_orderstatus AS f_st, b.o_totalprice AS b_tp,
    f.o_totalprice AS f_tp, b.o_orderpriority AS b_pr, f.o_orderpriority AS f_pr
  FROM base b FULL OUTER JOIN fresh f ON b._id = f._id)"""

ORACLES["upsert_orders"] = with_ctes(_UPSERT, body="""
SELECT _id, o_custkey, CASE WHEN in_f THEN f_st ELSE b_st END AS o_orderstatus,
  CASE WHEN in_f THEN f_tp ELSE b_tp END AS o_totalprice,
  CASE WHEN in_f THEN f_pr ELSE b_pr END AS o_orderpriority
FROM j""")

ORACLES["upsert_counts"] = with_ctes(_UPSERT, body="""
SELECT CAST(count_if(in_f AND NOT in_b) AS BIGINT) AS inserted,
  CAST(count_if(in_f AND in_b) AS BIGINT) AS matched,
  CAST(count_if(in_f AND in_b AND (f_st IS DISTINCT FROM b_st OR f_tp IS DISTINCT FROM b_tp
                                   OR f_pr IS DISTINCT FROM b_pr)) AS BIGINT) AS modified,
  CAST(0 AS BIGINT) AS errors
FROM j""")

_DECODE = "replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"

ORACLES["page_titles"] = f"""
SELECT url, {_STRIP.format(x=_DECODE.format(x="regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)"))} AS title
FROM pages"""

ORACLES["page_links"] = rf"""
WITH l AS (
  SELECT url, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS hrefs,
    regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS texts,
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)', 1) AS origin
  FROM pages),
u AS (
  SELECT url, origin, unnest(generate_series(0, len(hrefs) - 1)) AS pos, unnest(hrefs) AS href,
    unnest(texts) AS text
  FROM l)
SELECT url, CAST(pos AS BIGINT) AS pos, {_DECODE.format(x='href')} AS href,
  {_STRIP.format(x=_DECODE.format(x='text'))} AS text, origin || {_DECODE.format(x='href')} AS link
FROM u"""

ORACLES["stream_page_titles"] = ORACLES["page_titles"]
ORACLES["stream_upsert_orders"] = ORACLES["upsert_orders"]

ORACLES["needs_work"] = """
SELECT p_partkey, (p_size % 3 IN (0, 1)) OR (p_size % 4 = 0) OR (p_size % 5 IN (0, 1)) AS needs_text,
  p_size % 2 = 0 AS needs_profile, p_size % 3 = 1 AS needs_ratio, p_size % 7 IN (0, 1) AS needs_image
FROM part"""

ORACLES["published_menu_items"] = with_ctes(CTE_ITEMS, CTE_VARIATIONS + CTE_PROFILES, body=f"""
, a AS (
  SELECT _id, p_size % 7 <> 0 AND p_partkey % 5 >= 2 AS ok, p_name, p_type, p_brand, {PRICE_TXT} AS price
  FROM it)
SELECT a._id, a.p_name AS name,
  CASE WHEN ok THEN 'House ' || p_name || ', made to order.'
       ELSE 'A delicious ' || lower(p_type) || ' item from ' || p_brand || '.' END AS description,
  CASE WHEN ok THEN price ELSE '9.99' END AS estimated_price,
  CASE WHEN ok THEN 'American,' || p_type || ',International'
       ELSE 'American,International,Casual' END AS cuisine_types,
  prof.tags AS tags, fi.image_url AS menu_item_image_url
FROM a JOIN prof ON a._id = prof._id LEFT JOIN fi ON a._id = fi.menu_item_id""")

# The stored pages hold no listing cards, menu blocks, logos, item images,
# description elements, nutrition tables, allergen sections, size menus or
# ingredient blocks, so each rule must find nothing on every page.
ORACLES["page_facts"] = f"""
SELECT url, {_STRIP.format(x=_DECODE.format(x="regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1)"))} AS title,
  CAST(0 AS BIGINT) AS cards, CAST(0 AS BIGINT) AS menu_items, CAST(NULL AS VARCHAR) AS logo,
  CAST(NULL AS VARCHAR) AS image_src, CAST(NULL AS VARCHAR) AS description,
  CAST(0 AS BIGINT) AS nutrients, CAST(0 AS BIGINT) AS allergens, '' AS allergy_information,
  CAST(0 AS BIGINT) AS options, '' AS ingredients,
  CAST(len(regexp_extract_all(html, '<a href="[^"]*"')) AS BIGINT) AS links
FROM pages"""

ORACLES["snapshot_roundtrip"] = """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  '2024-02-01' AS run_ts
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"""

ORACLES["snapshot_new_column"] = """
SELECT o_orderkey, o_totalprice, o_orderstatus, '2024-02-01T00:00:00' AS run_ts
FROM orders WHERE o_orderstatus <> 'F'"""

_LAST = ", ".join(f"{c.strip()} DESC" for c in LI_ORDER.split(","))
ORACLES["published_variations"] = with_ctes(CTE_VARIATIONS, body=f"""
, l AS (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY {_LAST}) AS back FROM v)
SELECT _id, label, calories, protein_g, sugars_g, golden_ratio, ingredients,
  count(*) OVER () AS inserted, count(*) OVER () AS matched, CAST(0 AS BIGINT) AS modified
FROM l WHERE back = 1""")

ORACLES["layered_orders"] = ORACLES["upsert_orders"]

ORACLES["merged_orders"] = with_ctes(_UPSERT, body="""
SELECT _id, o_custkey, CASE WHEN in_f THEN f_st ELSE b_st END AS o_orderstatus,
  CASE WHEN in_f THEN f_tp ELSE b_tp END AS o_totalprice,
  CASE WHEN in_f THEN f_pr ELSE b_pr END AS o_orderpriority,
  CAST(count_if(in_b) OVER () AS BIGINT) AS first,
  CAST(count_if(in_f AND NOT in_b) OVER () AS BIGINT) AS inserted,
  CAST(count_if(in_f AND in_b) OVER () AS BIGINT) AS matched,
  CAST(count_if(in_f AND in_b AND (f_st IS DISTINCT FROM b_st OR f_tp IS DISTINCT FROM b_tp
                                   OR f_pr IS DISTINCT FROM b_pr)) OVER () AS BIGINT) AS modified
FROM j""")
