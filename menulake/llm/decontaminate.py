"""Benchmark passages in documents, also with other numbers, names and units (operator 6).

A text becomes words; numbers, names and units among them are slots, and a
typed placeholder stands for each. Windows of five such words are hashed, and
the windows of documents are joined to those of benchmark items. Where a
window of an item meets one of a document, their slots pair up; along one
alignment (the same shift between item and document) every value of the item
must stand for one value of the document throughout. Alignments that break
this are no copies with other parameters; of them only the windows without
slots, which are verbatim, count.

A document holds an item if 0.8 of the item's windows are found in it that way,
or a passage of it: ``passage`` windows, by default nine, which thirteen words
in a row give, on alignments within ``NEAR`` words of each other. Alignments are
united from the one with the most windows on; of one that gives a value of the
item another value than those before, again only windows without slots count.

Everything is SQL functions. Words that begin a sentence are no names, so
prose doesn't turn into placeholders. Windows with more slots than plain words
(three of five) say little without the values of their slots: they are hashed
with these. With other values they count where other windows of the alignment
found hold all their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import text_of

WINDOW, SHARE, PASSAGE = 5, 0.8, 9
#: Words that may be put in or left out within a passage.
NEAR = 8
#: Item windows up to which the item side is broadcast (about 100 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 200_000
#: Marks the first word of a sentence.
START = "\x01"
UNITS = (
    "mm", "cm", "dm", "m", "km", "inch", "inches", "in", "ft", "foot", "feet", "yd", "yard", "yards", "mile", "miles", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres", "centimeter", "centimeters",
    "mg", "g", "kg", "t", "oz", "lb", "lbs", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "ton", "tons",
    "ml", "cl", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups",
    "ms", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "mph", "kmh", "hz", "khz", "mhz", "w", "kw", "v", "a", "kb", "mb", "gb", "tb",
    "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur", "gbp", "percent", "degree", "degrees",
)


def words(text: Column) -> Column:
    """The words of a text: runs of letters and digits, thousands and decimals joined, the first of a sentence marked."""
    t = F.concat(F.lit("\n"), text)
    digits = t
    for _ in range(2):
        digits = F.regexp_replace(digits, r"([0-9])[.,]([0-9])", "$1$2")
    digits = F.regexp_replace(digits, r"([0-9])(\p{L})", "$1 $2")
    t = F.when(t.rlike("[0-9]"), digits).otherwise(t)
    t = F.regexp_replace(t, r"""([.!?:\n][ \t\r\n"'(]*)(\p{Lu})""", "$1" + START + "$2")
    return F.filter(F.split(t, r"[^\p{L}\p{N}\x01]+"), lambda w: w != "")


def template(ws: Column, digits: Column) -> Column:
    """For each word its place in the template: the word in lower case, or the type of its slot.

    ``digits`` tells whether the text has any; words that begin in lower case,
    nearly all, are decided by their first letter then.
    """
    def one(w: Column, i: Column) -> Column:
        first = w.substr(1, 1)
        unit = digits & F.coalesce(F.get(ws, i - 1).substr(1, 1).between("0", "9"), F.lit(False)) & F.lower(w).isin(*UNITS)
        return (F.when(unit, F.lit("#unit")).when(first.between("a", "z"), F.lower(w)).when(first == START, F.lower(F.substring(w, F.lit(2), F.length(w))))
                .when(digits & first.between("0", "9"), F.lit("#number")).when(w.rlike(r"^\p{Lu}\p{Ll}"), F.lit("#name")).otherwise(F.lower(w)))
    return F.transform(ws, one)


def template_windows(df: DataFrame, key: str, text: Column, size: int = WINDOW) -> DataFrame:
    """``key, pos, hash, vals`` of each window; ``vals`` joins the values of its slots.

    The hash is that of the template, with the values where most of it are slots.
    """
    d = df.select(F.col(key), words(text).alias("w"), text.rlike("[0-9]").alias("digits"))
    d = d.select(key, "w", template(F.col("w"), F.col("digits")).alias("t"))
    d = d.select(key, "w", "t", F.exists("t", lambda x: x.startswith("#")).alias("slots"))
    def window(x: Column, i: Column) -> Column:
        at = [x, *[F.get(F.col("t"), i + k) for k in range(1, size)]]
        vals = F.concat_ws(START, *[F.when(a.startswith("#"), F.lower(F.get(F.col("w"), i + k))) for k, a in enumerate(at)])
        # most texts have no slots; the flag stands twice so that the optimizer computes it once a text, not once a window
        heavy = F.size(F.filter(F.array(*at), lambda a: a.startswith("#"))) > size // 2
        exact = F.xxhash64(*at, vals)
        return F.struct(i.alias("pos"), F.when(F.col("slots") & heavy, exact).otherwise(F.xxhash64(*at)).alias("hash"), F.when(~F.col("slots"), F.lit("")).when(F.col("slots"), vals).alias("vals"))
    d = d.select(key, F.explode(F.slice(F.transform("t", window), F.lit(1), F.greatest(F.size("t") - (size - 1), F.lit(0)))).alias("x"))
    return d.select(key, "x.pos", "x.hash", "x.vals")


def covered(found: Column, size: int = WINDOW) -> Column:
    """``found`` and the windows between them all of whose words lie in windows found: those that begin in a gap of fewer than ``size`` places."""
    at = F.array_sort(found)
    between = F.transform(at, lambda p, i: F.when(F.get(at, i + 1) - p <= size, F.sequence(p, F.get(at, i + 1) - 1)).otherwise(F.array(p)))
    return F.flatten(between)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW, share: float = SHARE, passage: int = PASSAGE) -> DataFrame:
    """``doc_id, item_id, n_windows, n_found, n_slots, same_values``: a row for each item that a document holds.

    ``n_found`` of the item's ``n_windows`` windows were found,
    with ``n_slots`` different slot values; ``same_values`` is true if none differs.
    Null texts, and texts of fewer than five words, hold nothing and aren't
    searched for; rows with a null id are left out; repeated rows of one id
    count as one document; empty tables give an empty result. Other columns are
    ignored.
    """
    items = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].alias("text")).where("item_id IS NOT NULL")
    iw = template_windows(items, "item_id", text_of(), size)
    iw = iw.distinct()
    total = iw.groupBy("item_id").agg(F.countDistinct("pos").alias("n_windows"))
    iw = iw.select("item_id", F.col("pos").alias("item_pos"), "hash", F.col("vals").alias("item_vals"))
    if iw.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        iw = F.broadcast(iw)
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("doc_id IS NOT NULL")
    hits = template_windows(d, "doc_id", text_of(), size).join(iw, "hash")
    hits = hits.select("doc_id", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "vals", "item_vals")

    # one row an alignment: the positions found and the pairs of slot values
    pairs = F.when(F.col("vals") == "", F.expr("array()").cast("array<struct<item:string,doc:string>>")).otherwise(F.arrays_zip(F.split("item_vals", START).alias("item"), F.split("vals", START).alias("doc")))
    lined = hits.select("doc_id", "item_id", "shift", "item_pos", "vals", pairs.alias("pairs"))
    lined = lined.groupBy("doc_id", "item_id", "shift").agg(F.collect_set("item_pos").alias("found"), F.collect_set(F.when(F.col("vals") == "", F.col("item_pos"))).alias("plain"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    consistent = _one_value(F.col("pairs"))
    lined = lined.withColumn("found", F.when(consistent, covered(F.col("found"), size)).otherwise(F.col("plain")))
    lined = lined.withColumn("pairs", F.when(consistent, F.col("pairs")).otherwise(F.filter("pairs", lambda p: F.lit(False)))).where(F.size("found") > 0)
    # passages: each alignment stands in two groups, so that those within NEAR words meet in one
    near = lined.withColumn("size", -F.size("found")).select("doc_id", "item_id", F.posexplode(F.array(F.floor(F.col("shift") / NEAR), F.floor(F.col("shift") / NEAR) + 1)).alias("again", "near"), F.struct("size", "shift", "found", "plain", "pairs").alias("one"))
    near = near.groupBy("doc_id", "item_id", "near").agg(F.collect_list("one").alias("all"), F.collect_list(F.when(F.col("again") == 0, F.col("one"))).alias("own"))
    near = near.select("doc_id", "item_id", F.size(_united("all")["found"]).alias("n_near"), "own")
    held = near.groupBy("doc_id", "item_id").agg(F.max("n_near").alias("n_near"), F.flatten(F.collect_list("own")).alias("own"))
    held = held.select("doc_id", "item_id", "n_near", _united("own").alias("all"))
    held = held.join(total, "item_id").select(
        "doc_id", "item_id", "n_windows", F.greatest(F.size("all.found"), "n_near").cast("long").alias("n_found"), F.size("all.pairs").cast("long").alias("n_slots"),
        F.forall("all.pairs", lambda p: p["item"] == p["doc"]).alias("same_values"), "n_near")
    return held.where((F.col("n_found") >= F.lit(share) * F.col("n_windows")) | (F.col("n_near") >= passage)).drop("n_near")


def _one_value(pairs: Column) -> Column:
    """Whether each value of the item stands for one value of the document."""
    return F.size(F.array_distinct(F.transform(pairs, lambda p: p["item"]))) == F.size(pairs)


def _united(alignments: str) -> Column:
    """``found, pairs`` of alignments, united from the one with the most windows on as long as the pairs agree."""
    start = F.expr("named_struct('found', cast(array() AS array<int>), 'pairs', cast(array() AS array<struct<item:string,doc:string>>))")

    def unite(acc: Column, a: Column) -> Column:
        pairs = F.array_union(acc["pairs"], a["pairs"])
        return F.when(_one_value(pairs), F.struct(F.array_union(acc["found"], a["found"]).alias("found"), pairs.alias("pairs"))).otherwise(F.struct(F.array_union(acc["found"], a["plain"]).alias("found"), acc["pairs"].alias("pairs")))
    return F.aggregate(F.array_sort(alignments), start, unite)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    bad = contaminated(docs, benchmark, id_col, **options).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(bad, docs[id_col] == bad["_id"], "left_anti")
