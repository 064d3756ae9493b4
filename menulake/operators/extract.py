"""Page extraction (H-01..H-12) as one distributed pass over stored pages.

The only Python step is ``parse_pages``: a ``mapInArrow`` task parses each page
once with the standard-library HTML parser and emits raw arrays (cards, menu
links, table cells, allergen columns, size links). All rules that decide
*what* the arrays mean - snake-case keys, last-wins maps, allergen headings,
absolute links, dedup, defaults, copying item facts to servings - run
afterwards as DataFrame expressions. The parsed table holds no HTML, so the
costly text leaves the plan right after the scan.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from menulake.functions.text import resolve_url, snake_case
from menulake.operators.select import dedup_first, dedup_last

PARSED_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("links", T.ArrayType(T.StructType([
        T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))),
    T.StructField("cards", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("href", T.StringType())]))),
    T.StructField("logo", T.StringType()),
    T.StructField("menu", T.ArrayType(T.StructType([
        T.StructField("category", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("href", T.StringType())]))),
    T.StructField("image_src", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("nutrition", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))),
    T.StructField("allergen_cols", T.ArrayType(T.StructType([
        T.StructField("header", T.StringType()), T.StructField("dots", T.ArrayType(T.StringType()))]))),
    T.StructField("allergen_paras", T.ArrayType(T.StringType())),
    T.StructField("options", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()), T.StructField("href", T.StringType())]))),
    T.StructField("ingredients", T.StringType()),
    T.StructField("error", T.StringType()),   # why the page couldn't be parsed
])

# Fixed values (page structure the extraction rules look for).
NUTRITION_TABLES = [("class", "item_nutrition"), ("id", "item_nutrition"), ("class", "nutrition")]
NUTRITION_SKIP_PREFIXES = ("amount per serving", "% daily value", "percent daily")
NUTRITION_BLANK_VALUES = ("", "?", "&nbsp;", "-")
MENU_HEADING_CLASSES = {"toggle_category", "topround", "nomobileround", "toggle_div"}
MENU_LIST_CLASSES = {"list", "rest_item_list", "ab1"}
LISTING_CLASSES = {"rest_item_list", "category"}
ITEM_PHOTO_PREFIX = "/item-photos/"
CONTENT_IMAGE_DIVS = {"col-12", "col-md-6"}
EXCLUDED_IMAGE_PARTS = ("/logos/", "/icons/")
DESCRIPTION_CLASSES = {"item_description", "description"}
NO_NAME_SUFFIX = " Nutrition"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_RAW_TEXT = {"script", "style"}


#: Elements of a tag that may be open at once; a further one ends the innermost. Links and
#: paragraphs don't nest in HTML at all, so only pages of unclosed tags reach this.
_MOST_OPEN = {"a": 16, "p": 16}
_MOST_OPEN_ELSE = 128
_NO_CLASSES: frozenset[str] = frozenset()


# -- the page as intervals --------------------------------------------------

class _Node:
    """An element: its descendants are the nodes from ``at + 1`` to before ``end``, its text the pieces from ``t0`` to before ``t1``."""
    __slots__ = ("tag", "attrs", "classes", "at", "end", "t0", "t1", "own")

    def __init__(self, tag, attrs, at, t0):
        self.tag, self.attrs, self.at, self.t0 = tag, attrs, at, t0
        self.end, self.t1, self.own = at + 1, t0, None
        self.classes = frozenset(attrs["class"].split()) if attrs.get("class") else _NO_CLASSES


class _Page(HTMLParser):
    """One pass over the html: all elements in order of their start tags, all stripped pieces of text in order.

    "Is inside" is a test of intervals and an element's text a slice, so the work
    and the memory grow with the page, however deep its tags nest.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[_Node] = []
        self.pieces: list[str] = []
        self._open: list[_Node] = []
        self._count: dict[str, int] = {}
        self.feed(html or "")
        self.close()
        while self._open:
            self._pop()

    def _pop(self) -> _Node:
        n = self._open.pop()
        self._count[n.tag] -= 1
        n.end, n.t1 = len(self.nodes), len(self.pieces)
        return n

    def handle_starttag(self, tag, attrs):
        if self._count.get(tag, 0) >= _MOST_OPEN.get(tag, _MOST_OPEN_ELSE):
            self.handle_endtag(tag)
        self.handle_startendtag(tag, attrs)
        if tag not in _VOID:
            self._open.append(self.nodes[-1])
            self._count[tag] = self._count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        n = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, len(self.nodes), len(self.pieces))
        self.nodes.append(n)

    def handle_endtag(self, tag):
        if self._count.get(tag):
            while self._pop().tag != tag:
                pass

    def handle_data(self, data):
        if self._open:
            n = self._open[-1]
            if n.own is None:
                n.own = data
            if n.tag in _RAW_TEXT:
                return
        piece = data.strip()
        if piece:
            self.pieces.append(piece)

    def all(self, pred) -> list[_Node]:
        return [n for n in self.nodes if pred(n)]

    def first(self, pred) -> _Node | None:
        return next((n for n in self.nodes if pred(n)), None)

    def text(self, n: _Node, sep: str = "") -> str:
        return sep.join(self.pieces[n.t0:n.t1])

    def under(self, nodes: list[_Node], pred) -> list[_Node]:
        """Those of ``nodes`` (in order) that have an ancestor for which ``pred`` holds."""
        out, k, end = [], 0, 0
        over = self.all(pred)
        for n in nodes:
            while k < len(over) and over[k].at < n.at:
                end = max(end, over[k].end)
                k += 1
            if n.at < end:
                out.append(n)
        return out


def _inside(nodes: list[_Node], box: _Node, most: int | None = None) -> list[_Node]:
    """The first ``most`` of ``nodes`` (in order) that are descendants of ``box``."""
    begin = bisect_right(nodes, box.at, key=lambda n: n.at)
    end = bisect_left(nodes, box.end, begin, key=lambda n: n.at)
    return nodes[begin:end if most is None else min(end, begin + most)]


def _first_inside(nodes: list[_Node], box: _Node) -> _Node | None:
    return next(iter(_inside(nodes, box, 1)), None)


# -- per-page extraction (raw arrays only) ----------------------------------

def _links(page):
    return page.all(lambda n: n.tag == "a" and "href" in n.attrs)


def _cards(page, links):
    box = page.first(lambda n: LISTING_CLASSES <= n.classes)
    if box is None:
        return []
    labels = page.all(lambda n: n.tag == "div" and "logo_box_text" in n.classes)
    out = []
    for card in _inside(page.all(lambda n: "filter_target" in n.classes), box):
        a, label = _first_inside(links, card), _first_inside(labels, card)
        if a is None or label is None:
            continue
        if label.own:
            name = label.own.strip()
        else:
            name = page.text(label, " ").replace(NO_NAME_SUFFIX, "").strip()
        if name:
            out.append({"name": name, "href": a.attrs["href"]})
    return out


def _logo(page):
    img = page.first(lambda n: n.tag == "img" and "logo_float" in n.classes and "src" in n.attrs)
    return img.attrs["src"] if img is not None and img.attrs["src"] else None


def _menu(page, links):
    headings = page.under(page.all(lambda n: n.tag == "h2"), lambda a: a.tag == "a" and MENU_HEADING_CLASSES <= a.classes)
    listed = page.under(links, lambda u: u.tag == "ul" and MENU_LIST_CLASSES <= u.classes)
    out = []
    for block in page.all(lambda n: n.tag == "div" and "category" in n.classes):
        heading = _first_inside(headings, block)
        category = page.text(heading) if heading is not None else "Uncategorized"
        for a in _inside(listed, block):
            out.append({"category": category, "name": a.own.strip() if a.own else page.text(a, " "), "href": a.attrs["href"]})
    return out


def _image(page):
    images = page.all(lambda n: n.tag == "img")
    for n in images:
        if n.attrs.get("src", "").startswith(ITEM_PHOTO_PREFIX):
            return n.attrs["src"]
    for n in page.under(images, lambda d: d.tag == "div" and bool(CONTENT_IMAGE_DIVS & d.classes)):
        src = n.attrs.get("src", "")
        if src and not any(x in src for x in EXCLUDED_IMAGE_PARTS):
            return src
    return None


def _description(page):
    meta = page.first(lambda n: n.tag == "meta" and n.attrs.get("name") == "description")
    if meta is not None and meta.attrs.get("content"):
        content = meta.attrs["content"]
        if "nutrition" not in content.lower()[:30]:
            return content
    named = page.first(lambda n: bool(DESCRIPTION_CLASSES & n.classes))
    info = page.under(page.all(lambda n: n.tag == "p"), lambda a: "item_info" in a.classes)[:1]
    el = min([n for n in (named, *info) if n is not None], key=lambda n: n.at, default=None)
    return page.text(el, " ") if el is not None else None


def _nutrition(page):
    table = None
    for attr, value in NUTRITION_TABLES:
        table = page.first(lambda n: n.tag == "table" and (
            value in n.classes if attr == "class" else n.attrs.get("id") == value))
        if table is not None:
            break
    if table is None:
        return []
    heads, cells = page.all(lambda n: n.tag == "th"), page.all(lambda n: n.tag == "td")
    out = []
    for row in _inside(page.all(lambda n: n.tag == "tr"), table):
        th, tds = _first_inside(heads, row), _inside(cells, row, 2)
        key = value = None
        if th is not None and tds:
            key, value = page.text(th, " "), page.text(tds[0], " ")
        elif len(tds) == 2:
            key, value = page.text(tds[0], " "), page.text(tds[1], " ")
        if key and not key.lower().startswith(NUTRITION_SKIP_PREFIXES):
            if value and value.strip() not in NUTRITION_BLANK_VALUES:
                out.append({"key": key, "value": value.strip()})
    return out


def _allergens(page):
    sec = page.first(lambda n: n.attrs.get("id") == "allergens")
    if sec is None:
        return None, None
    strongs, dots = page.all(lambda n: n.tag == "strong"), page.all(lambda n: "dot" in n.classes)
    cols = []
    for col in _inside(page.all(lambda n: "col-12" in n.classes), sec):
        strong = _first_inside(strongs, col)
        if strong is not None:
            cols.append({"header": page.text(strong).lower(), "dots": [t for t in (page.text(d) for d in _inside(dots, col)) if t]})
    return cols, [page.text(p, " ") for p in _inside(page.all(lambda n: n.tag == "p"), sec)]


def _title(page):
    el = page.first(lambda n: n.tag == "h1") or page.first(lambda n: n.tag == "title")
    return page.text(el, " ") if el is not None else ""


def _options(page, links):
    menu = page.first(lambda n: n.tag == "div" and "dropdown-menu" in n.classes)
    return [] if menu is None else [{"title": page.text(a, " "), "href": a.attrs["href"]} for a in _inside(links, menu)]


def _ingredients(page):
    el = page.first(lambda n: n.attrs.get("id") == "ingredients2")
    return page.text(el, " ") if el is not None else ""


def parse_page(url: str, html: str, page_id: int | None = None) -> dict:
    """All raw fields of one page."""
    page = _Page(html)
    links = _links(page)
    cols, paras = _allergens(page)
    return {
        "page_id": page_id, "url": url, "title": _title(page),
        "links": [{"href": a.attrs["href"], "text": page.text(a, " ")} for a in links],
        "cards": _cards(page, links), "logo": _logo(page), "menu": _menu(page, links), "image_src": _image(page),
        "description": _description(page), "nutrition": _nutrition(page), "allergen_cols": cols,
        "allergen_paras": paras, "options": _options(page, links), "ingredients": _ingredients(page),
    }


# Parsed rows per output batch: pages can be large, so output is emitted in
# slices instead of one batch per input batch.
OUT_ROWS = 256


def _parse_batches(batches):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(PARSED_SCHEMA)
    for b in batches:
        rows = []
        for pid, u, h in zip(b.column("page_id"), b.column("url"), b.column("html"), strict=True):  # one page in Python at a time
            pid, u, h = pid.as_py(), u.as_py(), h.as_py()
            try:
                rows.append(parse_page(u, h, pid) | {"error": None})
            except Exception as e:  # noqa: BLE001 - a page that fails is reported, the job goes on
                rows.append({"page_id": pid, "url": u, "error": f"{type(e).__name__}: {e}"})
            if len(rows) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def parse_pages(pages: DataFrame) -> DataFrame:
    """The one Python pass: (page_id, url, html) -> raw extraction arrays, no html kept.

    Runs where the pages are read (no shuffle of html). Pages without a
    ``page_id`` column get a null id.
    """
    pid = F.col("page_id").cast("long") if "page_id" in pages.columns else F.lit(None).cast("long")
    return pages.select(pid.alias("page_id"), "url", "html").mapInArrow(_parse_batches, PARSED_SCHEMA)


def first_page_per_url(parsed: DataFrame) -> DataFrame:
    """S-08 dedup after the parse: the first stored page of each url by ``page_id``.

    Pages without an id come last, and those that tie are ordered by their
    parsed content, so one whole row is kept in any case. Deduplicating the
    compact parsed rows instead of the raw pages keeps the html out of every
    shuffle.
    """
    payload = [c for c in parsed.columns if c != "url"]
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.to_json(F.struct(*payload)))
    kept = parsed.groupBy("url").agg(F.min_by(F.struct(*payload), order).alias("_v"))
    return kept.select("url", "_v.*").select(*parsed.columns)


# -- DataFrame rules over the parsed table ---------------------------------

def origin_of(url) -> Column:
    """Scheme and host of a page url (the base its relative links resolve against)."""
    u = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)


def page_titles(parsed: DataFrame) -> DataFrame:
    """H-08: first h1 text, else the title, else ''."""
    return parsed.select("url", "title")


def page_links(parsed: DataFrame, base: str | None = None) -> DataFrame:
    """H-11: every link of every page, made absolute (against ``base`` or the page origin)."""
    e = parsed.select("url", F.posexplode("links").alias("pos", "l"))
    b = F.lit(base) if base else origin_of("url")
    return e.select("url", "pos", F.col("l.href").alias("href"), F.col("l.text").alias("text"),
                    resolve_url(F.col("l.href"), b).alias("link"))


def brand_cards(parsed: DataFrame, base: str) -> DataFrame:
    """H-01 + D-02: (brand_pos, name, url) of a listing page; a repeated url: last
    name wins, first position kept."""
    e = parsed.select(F.posexplode("cards").alias("brand_pos", "c"))
    e = e.select(F.col("brand_pos").cast("long"), F.col("c.name").alias("name"),
                 resolve_url(F.col("c.href"), base).alias("url"))
    return dedup_last(e, "url", "brand_pos")


def brand_menus(parsed: DataFrame, base: str) -> DataFrame:
    """H-02 + H-03 + D-03: per brand page, its logo and menu items, first per url."""
    e = parsed.select(F.col("url").alias("page_url"),
                      F.coalesce(resolve_url(F.col("logo"), base), F.lit("")).alias("restaurant_logo"),
                      F.posexplode("menu").alias("item_pos", "m"))
    e = e.select("page_url", "restaurant_logo", F.col("item_pos").cast("long"),
                 F.col("m.category").alias("category"), F.col("m.name").alias("name"),
                 resolve_url(F.col("m.href"), base).alias("url"))
    return dedup_first(e, ["page_url", "url"], "item_pos")


def page_logos(parsed: DataFrame, base: str) -> DataFrame:
    """H-02 alone: (page url, logo url or '')."""
    return parsed.select(F.col("url").alias("page_url"),
                         F.coalesce(resolve_url(F.col("logo"), base), F.lit("")).alias("restaurant_logo"))


def nutrition_map(pairs) -> Column:
    """H-06: ordered (key text, value) pairs -> map keyed by F-01; a repeated key:
    the later row wins."""
    p = F.col(pairs) if isinstance(pairs, str) else pairs
    keyed = F.transform(p, lambda e: F.struct(snake_case(e["key"]).alias("key"), e["value"].alias("value")))
    # one pass: a later entry of a key replaces the earlier one
    start = F.create_map().cast("map<string,string>")
    return F.aggregate(keyed, start, lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, _: ~k.eqNullSafe(e["key"])), F.create_map(e["key"], e["value"])))


def allergens_struct(cols, paras) -> Column:
    """H-07: the column heading decides the list; "may contain" is dropped; the
    last paragraph naming an allergy or allergen is kept."""
    c = F.col(cols) if isinstance(cols, str) else cols
    p = F.col(paras) if isinstance(paras, str) else paras
    h = lambda x: x["header"]
    is_contains = lambda x: h(x).contains("contains") & ~h(x).contains("not") & ~h(x).contains("may")
    is_not = lambda x: ~is_contains(x) & h(x).contains("does not contain")
    is_unknown = lambda x: (~is_contains(x) & ~is_not(x)
                            & (h(x).contains("unknown") | h(x).contains("aren't sure")))
    empty = F.array().cast("array<string>")

    def last_list(rule):
        picked = F.filter(c, rule)
        return F.when(F.size(picked) > 0, F.element_at(picked, -1)["dots"]).otherwise(empty)

    info = F.filter(p, lambda t: F.lower(t).contains("allergy") | F.lower(t).contains("allergen"))
    return F.when(c.isNull(), F.struct(empty.alias("contains"), empty.alias("does_not_contain"),
                                       empty.alias("unknown"), F.lit("").alias("allergy_information"))) \
        .otherwise(F.struct(
            last_list(is_contains).alias("contains"), last_list(is_not).alias("does_not_contain"),
            last_list(is_unknown).alias("unknown"),
            F.when(F.size(info) > 0, F.element_at(info, -1)).otherwise(F.lit("")).alias("allergy_information")))


def item_facts(parsed: DataFrame, base: str) -> DataFrame:
    """H-04, H-06, H-07, H-08, H-10 for item and size pages, keyed by page url."""
    return parsed.select(
        F.col("url").alias("page_url"), F.col("title"),
        nutrition_map("nutrition").alias("nutrition"),
        allergens_struct("allergen_cols", "allergen_paras").alias("allergens"),
        F.col("ingredients"),
        resolve_url(F.col("image_src"), base).alias("image_url"),
        F.col("description"))


def size_options(parsed: DataFrame, base: str) -> DataFrame:
    """H-09 + D-03: (page url, pos, title, url) of size links, first per url."""
    e = parsed.select(F.col("url").alias("page_url"), F.posexplode("options").alias("pos", "o"))
    e = e.select("page_url", F.col("pos").cast("long"), F.col("o.title").alias("title"),
                 resolve_url(F.col("o.href"), base).alias("url"))
    return dedup_first(e, ["page_url", "url"], "pos")


def _allergens_present(a: Column) -> Column:
    return (F.size(a["contains"]) > 0) | (F.size(a["does_not_contain"]) > 0) | (F.size(a["unknown"]) > 0)


def assemble_servings(items: DataFrame, parsed: DataFrame, base: str):
    """H-12: item rows -> (raw_items, raw_servings).

    ``items`` holds (brand_name, page_url, item_pos, name, url, category); an item
    is known by its brand's page and its own url. An item with
    size links gets one serving per link, read from the link's page; otherwise
    one "1 serving" row from its own page. The label falls back to the page
    title, then the item name. Allergens and ingredients of an item are the
    last non-empty ones over its servings, copied to every serving; images stay
    per serving. Items whose page is not stored produce no servings.
    """
    facts = item_facts(parsed, base).withColumnRenamed("title", "page_title")
    opts = size_options(parsed, base).withColumnRenamed("title", "opt_title")
    it = items.select("brand_name", F.col("page_url").alias("brand_page"), "item_pos", F.col("name").alias("item_name"),
                      F.col("url").alias("item_url"), "category")
    with_opts = it.join(opts, it["item_url"] == opts["page_url"], "inner").drop("page_url")
    sized = (with_opts.join(facts, with_opts["url"] == facts["page_url"], "inner")
             .select("brand_name", "brand_page", "item_pos", "item_name", "item_url",
                     F.col("pos").alias("serving_pos"),
                     F.coalesce(F.nullif(F.col("opt_title"), F.lit("")),
                                F.nullif(F.col("page_title"), F.lit("")), F.col("item_name")).alias("size_label"),
                     "nutrition", "image_url", "allergens", "ingredients"))
    has_opts = opts.select(F.col("page_url").alias("item_url")).distinct()
    single = (it.join(has_opts, "item_url", "left_anti")
              .join(facts, it["item_url"] == facts["page_url"], "inner")
              .select("brand_name", "brand_page", "item_pos", "item_name", "item_url",
                      F.lit(0).cast("long").alias("serving_pos"), F.lit("1 serving").alias("size_label"),
                      "nutrition", "image_url", "allergens", "ingredients"))
    servings = sized.unionByName(single)
    per_item = servings.groupBy("brand_page", "item_url").agg(
        F.max_by("allergens", F.when(_allergens_present(F.col("allergens")), F.col("serving_pos")))
         .alias("_allergens"),
        F.max_by("ingredients", F.when(F.col("ingredients") != "", F.col("serving_pos"))).alias("_ingredients"))
    empty = F.array().cast("array<string>")
    no_allergens = F.struct(empty.alias("contains"), empty.alias("does_not_contain"),
                            empty.alias("unknown"), F.lit("").alias("allergy_information"))
    servings = (servings.drop("allergens", "ingredients").join(per_item, ["brand_page", "item_url"], "left")
                .select("brand_name", "item_pos", "item_name", "item_url", "serving_pos", "size_label",
                        "nutrition", "image_url",
                        F.coalesce("_allergens", no_allergens).alias("allergens"),
                        F.coalesce("_ingredients", F.lit("")).alias("ingredients")))
    raw_items = (items.join(per_item, (items["page_url"] == per_item["brand_page"]) & (items["url"] == per_item["item_url"]), "left")
                 .select("brand_name", "item_pos", "name", "url", "category",
                         F.lit(None).cast("string").alias("description"),
                         F.coalesce("_allergens", no_allergens).alias("allergens"),
                         F.coalesce("_ingredients", F.lit("")).alias("ingredients")))
    return raw_items, servings
