"""Extraction rules on small authored pages (the stored driver pages have no
tables, images, ids or meta names, so each selector gets its own fixture)."""

from pyspark.sql import functions as F

from menulake.operators import extract as H

BASE = "https://food.example.org"

LISTING = """<html><body><div class="rest_item_list category">
<div class="filter_target"><a href="/a-burger"><div class="logo_box_text">A Burger</div></a></div>
<div class="filter_target"><div class="logo_box_text">No Link</div></div>
<div class="filter_target"><a href="/b-taco"><div class="logo_box_text"><span>B Taco Nutrition</span></div></a></div>
<div class="filter_target"><a href="/a-burger"><div class="logo_box_text">A Burger Two</div></a></div>
<div class="filter_target"><a href="https://other.example.org/c"><div class="logo_box_text">C Pie &amp; Co</div></a></div>
</div></body></html>"""

MENU = """<html><body><img class="logo_float" src="/logos/a.png">
<div class="category"><a class="toggle_category topround nomobileround toggle_div"><h2>Burgers <b>Big</b></h2></a>
<ul class="list rest_item_list ab1"><li><a href="/a-burger/classic">Classic <span>new</span></a></li>
<li><a href="/a-burger/double"><span>Double</span></a></li></ul></div>
<div class="category"><ul class="list rest_item_list ab1"><li><a href="/a-burger/classic">Classic again</a></li>
<li><a href="fries">Fries</a></li></ul></div>
</body></html>"""

ITEM_TH = """<html><head><title>Classic | Site</title>
<meta name="description" content="Nutrition facts for the classic"></head><body>
<h1>Classic   Burger</h1><div class="item_info"><p>A juicy classic.</p></div>
<img src="/item-photos/classic.jpg">
<table class="item_nutrition"><tr><th>Amount Per Serving</th><td>1</td></tr>
<tr><th>Calories</th><td>540</td></tr><tr><th>Total Fat</th><td>28g</td><td>36%</td></tr>
<tr><th>Sodium</th><td>1,010mg</td></tr><tr><th>Total  Fat</th><td>29g</td></tr>
<tr><th>Protein</th><td>?</td></tr></table>
<div id="allergens"><div class="col-12"><strong>Contains</strong><span class="dot">Wheat</span><span class="dot">Milk</span></div>
<div class="col-12"><strong>May contain</strong><span class="dot">Fish</span></div>
<div class="col-12"><strong>Does not contain</strong><span class="dot">Peanuts</span></div>
<div class="col-12"><strong>We aren't sure about</strong><span class="dot">Sesame</span></div>
<p>Allergy info: ask staff.</p><p>Allergen data updated yearly.</p><p>Other text.</p></div>
<div id="ingredients2"> Beef, bun,  <b>cheese</b> </div></body></html>"""

ITEM_TD = """<html><head><meta name="description" content="A big shake, cold and thick. Nutrition facts inside"></head>
<body><div class="col-md-6"><img src="/icons/x.png"><img src="/photos/shake.png"></div>
<table class="nutrition"><tr><td>% Daily Value</td><td>x</td><td>y</td></tr>
<tr><td>Calories</td><td>300</td><td>15%</td></tr><tr><td>Sugars</td><td>-</td><td>0%</td></tr>
<tr><td>Total Carbohydrates</td><td>45g</td><td>16%</td></tr></table></body></html>"""

SIZES = """<html><body><h1>Soda</h1><div class="dropdown-menu">
<a href="/soda/small">Small</a><a href="/soda/large">Large</a><a href="/soda/small">Small again</a>
<a href="/soda/kids"></a></div></body></html>"""

SMALL = """<html><body><h1>Soda Small</h1><table id="item_nutrition"><tr><th>Calories</th><td>150</td></tr>
<tr><th>Protein</th><td>0g</td></tr></table>
<div id="allergens"><div class="col-12"><strong>Contains</strong><span class="dot">Caffeine</span></div></div>
<img src="/item-photos/small.jpg"></body></html>"""

LARGE = """<html><body><h1>Soda Large</h1><table id="item_nutrition"><tr><th>Calories</th><td>300</td></tr></table>
<div id="ingredients2">Water, sugar</div></body></html>"""

KIDS = """<html><head><title>Kids Soda</title></head><body><table id="item_nutrition">
<tr><th>Calories</th><td>90</td></tr></table></body></html>"""

NO_TABLE = """<html><body><img src="/logos/only.png"><div class="col-12"><img src="/logos/two.png"></div></body></html>"""


def _pages(spark, pages):
    rows = [(i, f"{BASE}{u}", h) for i, (u, h) in enumerate(pages)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_dom_text_and_title():
    p = H.parse_page("u", ITEM_TH)
    assert p["title"] == "Classic   Burger"
    assert H.parse_page("u", KIDS)["title"] == "Kids Soda"
    assert H.parse_page("u", "<p>no title")["title"] == ""
    assert H.parse_page("u", ITEM_TH)["ingredients"] == "Beef, bun, cheese"
    assert H.parse_page("u", NO_TABLE)["ingredients"] == ""


def test_brand_cards_dedup_last_name_first_position(spark):
    parsed = H.parse_pages(_pages(spark, [("/", LISTING)]))
    rows = {r["url"]: (r["brand_pos"], r["name"]) for r in H.brand_cards(parsed, BASE).collect()}
    assert rows == {
        f"{BASE}/a-burger": (0, "A Burger Two"),
        f"{BASE}/b-taco": (1, "B Taco"),
        "https://other.example.org/c": (3, "C Pie & Co"),
    }


def test_menu_items_categories_and_first_url_wins(spark):
    parsed = H.parse_pages(_pages(spark, [("/a-burger", MENU)]))
    menu = sorted((r["item_pos"], r["category"], r["name"], r["url"])
                  for r in H.brand_menus(parsed, BASE).collect())
    assert menu == [
        (0, "BurgersBig", "Classic", f"{BASE}/a-burger/classic"),
        (1, "BurgersBig", "Double", f"{BASE}/a-burger/double"),
        (3, "Uncategorized", "Fries", f"{BASE}/fries"),
    ]
    logo = H.page_logos(parsed, BASE).first()["restaurant_logo"]
    assert logo == f"{BASE}/logos/a.png"


def test_item_facts_th_table(spark):
    parsed = H.parse_pages(_pages(spark, [("/classic", ITEM_TH)]))
    f = H.item_facts(parsed, BASE).first()
    # header row skipped, '?' dropped, a repeated key: the later row wins
    assert dict(f["nutrition"]) == {"calories": "540", "total_fat": "29g", "sodium": "1,010mg"}
    a = f["allergens"]
    assert a["contains"] == ["Wheat", "Milk"]
    assert a["does_not_contain"] == ["Peanuts"]
    assert a["unknown"] == ["Sesame"]
    assert a["allergy_information"] == "Allergen data updated yearly."
    assert f["image_url"] == f"{BASE}/item-photos/classic.jpg"
    # meta description starts with "nutrition", so the page element is used
    assert f["description"] == "A juicy classic."


def test_item_facts_td_table_and_content_image(spark):
    parsed = H.parse_pages(_pages(spark, [("/shake", ITEM_TD), ("/none", NO_TABLE)]))
    got = {r["page_url"]: r for r in H.item_facts(parsed, BASE).collect()}
    f = got[f"{BASE}/shake"]
    assert dict(f["nutrition"]) == {"calories": "300", "total_carbohydrates": "45g"}
    assert f["image_url"] == f"{BASE}/photos/shake.png"
    assert f["description"] == "A big shake, cold and thick. Nutrition facts inside"
    n = got[f"{BASE}/none"]
    assert dict(n["nutrition"]) == {} and n["image_url"] is None
    assert list(n["allergens"]["contains"]) == [] and n["allergens"]["allergy_information"] == ""


def test_size_options_first_per_url(spark):
    parsed = H.parse_pages(_pages(spark, [("/soda", SIZES)]))
    opts = sorted((r["pos"], r["title"], r["url"]) for r in H.size_options(parsed, BASE).collect())
    assert opts == [(0, "Small", f"{BASE}/soda/small"), (1, "Large", f"{BASE}/soda/large"),
                    (3, "", f"{BASE}/soda/kids")]


def test_assemble_servings_copies_item_facts(spark):
    pages = [("/soda", SIZES), ("/soda/small", SMALL), ("/soda/large", LARGE), ("/soda/kids", KIDS),
             ("/shake", ITEM_TD)]
    parsed = H.parse_pages(_pages(spark, pages))
    items = spark.createDataFrame(
        [("A", f"{BASE}/a", 0, "Soda", f"{BASE}/soda", "Drinks"), ("A", f"{BASE}/a", 1, "Shake", f"{BASE}/shake", "Drinks")],
        "brand_name string, page_url string, item_pos long, name string, url string, category string")
    raw_items, servings = H.assemble_servings(items, parsed, BASE)
    s = sorted((r["item_pos"], r["serving_pos"], r["size_label"], r["image_url"],
                tuple(r["allergens"]["contains"]), r["ingredients"]) for r in servings.collect())
    assert s == [
        (0, 0, "Small", f"{BASE}/item-photos/small.jpg", ("Caffeine",), "Water, sugar"),
        (0, 1, "Large", None, ("Caffeine",), "Water, sugar"),
        (0, 3, "Kids Soda", None, ("Caffeine",), "Water, sugar"),
        (1, 0, "1 serving", f"{BASE}/photos/shake.png", (), ""),
    ]
    it = {r["item_pos"]: r for r in raw_items.collect()}
    assert it[0]["ingredients"] == "Water, sugar" and it[1]["ingredients"] == ""


def test_resolve_url_forms(spark):
    from menulake.functions.text import resolve_url
    df = spark.createDataFrame([("/a",), ("b",), ("//cdn.x/y",), ("http://z/q",), ("",)], "h string")
    got = [r[0] for r in df.select(resolve_url(F.col("h"), "https://s.org/dir/page")).collect()]
    assert got == ["https://s.org/a", "https://s.org/dir/b", "https://cdn.x/y", "http://z/q",
                   "https://s.org/dir/page"]


def test_links_are_joined_as_by_the_url_rules(spark):
    from itertools import product
    from urllib.parse import urljoin
    from menulake.functions.text import resolve_url
    bases = ["https://s.org", "https://s.org/", "https://s.org/dir/page", "https://s.org/a/b/c/?q=/x/../y#f/..", "http://s.org/a//b"]
    links = ["../x", "../../../x/./y", "..", ".", "./", "../", "a/../b?u=/../v", "/a/./b/../c", "/..", "/../x", "x/..", "...", ".x/..y",
             "?q=1", "#part", "a//b", "/a//b", "b#../c", "//cdn.x/a/../b", "http://z/q/../r", "", "/", "mailto:a@b.c", "a/b/"]
    rows = list(product(links, bases))
    df = spark.createDataFrame(rows, "h string, b string")
    got = [r[0] for r in df.select(resolve_url(F.col("h"), F.col("b"))).collect()]
    assert list(zip(rows, got)) == [(row, urljoin(row[1], row[0])) for row in rows]


def test_brands_of_one_name_keep_their_own_facts(spark):
    parsed = H.parse_pages(_pages(spark, [("/shake", ITEM_TD), ("/soda", SIZES), ("/soda/small", SMALL), ("/soda/large", LARGE)]))
    items = spark.createDataFrame(
        [("A", f"{BASE}/a1", 0, "Shake", f"{BASE}/shake", "C"), ("A", f"{BASE}/a2", 0, "Soda", f"{BASE}/soda", "C")],
        "brand_name string, page_url string, item_pos long, name string, url string, category string")
    raw_items, servings = H.assemble_servings(items, parsed, BASE)
    assert {r["item_name"]: r["ingredients"] for r in servings.collect()} == {"Shake": "", "Soda": "Water, sugar"}
    assert raw_items.count() == 2


def test_pages_without_ids_keep_their_facts(spark):
    pages = spark.createDataFrame([("u", "<h1>Title</h1>"), ("u", "<h1>Title</h1>"), ("v", None)], "url string, html string")
    got = {r["url"]: r["title"] for r in H.first_page_per_url(H.parse_pages(pages)).collect()}
    assert got == {"u": "Title", "v": ""}


def test_deep_pages(spark):
    deep = "<p>" * 5000 + "<li>" * 5000 + "<a href='/x'>x</a>"
    rows = H.parse_pages(_pages(spark, [("/deep", deep), ("/ok", "<h1>T</h1>")])).collect()
    assert all(r["error"] is None for r in rows)
    assert [l["href"] for r in rows for l in r["links"]] == ["/x"]


def test_repeated_nutrient_rows_last_wins(spark):
    df = spark.createDataFrame([([("Total Fat", "1 g"), ("Salt", "2"), ("total fat", "3 g")],), ([],)], "p array<struct<key:string,value:string>>")
    assert [dict(r[0]) for r in df.select(H.nutrition_map("p")).collect()] == [{"salt": "2", "total_fat": "3 g"}, {}]


def test_unclosed_tags_take_linear_time_and_memory():
    import time
    from menulake.operators.extract import parse_page
    for tag in ("<p>x", "<a href=q>x", "<div class=category><a href=q>x", "<tr><td>a<td>b", "<div><p>a</q>", "<div class=filter_target>"):
        began = time.process_time()
        row = parse_page("u", tag * 50_000)
        assert time.process_time() - began < 20          # minutes and gigabytes where an element's text is built anew
        assert sum(len(x["text"]) for x in row["links"]) <= 64 * 50_000
        assert len(row["links"]) == (50_000 if "href" in tag else 0)


def test_nested_elements_hold_the_text_inside_them():
    from menulake.operators.extract import parse_page
    row = parse_page("u", "<h1> A <b>b</b><script>no</script> c</h1><a href=1>x<a href=2>y</a> z</a></q><div id=ingredients2>salt<br/>oil</div>")
    assert row["title"] == "A b c" and row["ingredients"] == "salt oil"
    assert row["links"] == [{"href": "1", "text": "x y z"}, {"href": "2", "text": "y"}]
    assert parse_page("u", None)["links"] == [] and parse_page("u", "")["title"] == ""
