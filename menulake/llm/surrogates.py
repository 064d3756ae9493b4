"""Surrogates for personal data (operator 1).

Entities are found by pattern: e-mail addresses, phone numbers, IP addresses,
card, bank account and social security numbers, access keys and tokens, and
names behind a title. Each gets a replacement of its own kind: the same length,
punctuation, letter case and script, valid octets in IP addresses, a valid
check digit in card numbers that had one, names with an ending for the gender
that the title tells. It is drawn with a keyed hash of the entity, so every
mention of an entity gets one replacement, in whatever case or punctuation it
is written and in whatever document (given names and surnames are entities of
their own, so "Mr. John Smith" and "Mr. Smith" still agree).

Draws are checked against each other and against the entities themselves: of
two entities with one replacement the second draws again, as does one whose
replacement is a real entity, until none is left. So different entities stay
different and no real value comes up as a replacement.

Everything is SQL functions. Entities are made distinct before they are
shuffled; only documents with mentions are joined, and only to entities that
drew more than once. Without the key a replacement can't be computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import Tables, text_of

#: Titles of men, of women and of either, as written and in capitals.
MEN = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "г-н")
WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Г-жа", "г-жа")
TITLES = (*MEN, *WOMEN, "Dr", "Prof")
#: Entity patterns; the first that matches at a place wins. Runs are possessive, so long texts scan in one pass.
PATTERNS = {
    "email": r"(?<![._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "phone": r"(?<![0-9-])(?:[0-9]{3}-)?[0-9]{3}-[0-9]{4}(?![0-9-])|(?<![0-9.-])[0-9]{3}(?:\.[0-9]{3}\.| [0-9]{3} )[0-9]{4}(?![0-9]|[.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
    "secret": r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9]{20,}+)(?![\p{L}\p{N}])",
    "person": r"(?:" + "|".join(x for t in TITLES for x in dict.fromkeys((t, t.upper()))) + r")\.? \p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?",
}
#: Phone numbers with a country or an area in brackets.
LONG_PHONE = r"\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,5}(?![0-9])|(?:\+[0-9]{1,3}[^\p{L}\p{N}\n(]{0,6})?\([0-9]{2,4}\)[^\p{L}\p{N}\n]{0,6}[0-9]{3}[-. ][0-9]{4}(?![0-9])"
#: IPv6 addresses: eight groups, or fewer around a double colon, with a long first group and a digit (so no scope of a program); also right behind a word if they begin with a digit.
IPV6 = r"(?=[0-9A-Fa-f]{1,4}+:)(?:(?<![0-9A-Za-z:])|(?<=[A-Za-z])(?=[0-9]))(?=[A-Fa-f:]*+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z]|:[0-9A-Fa-f:]|\.[0-9])"
#: Kinds that also begin right behind a letter, in a script without spaces or in "ip10.20.30.40".
GLUED = ("ip", "phone", "ssn")
#: All of them: nearly every place in a text lies within a word, where one look back and one look at the next character decide.
ANY = (r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + r")|(?=[0-9])(?<=[\p{L}\p{N}])(?<![0-9])(?:" + "|".join(f"(?:{PATTERNS[k]})" for k in GLUED)
       + ")|(?=[+(])(?:" + LONG_PHONE + ")|" + IPV6)
#: What a text must have to hold any entity; a key may be all letters.
MAYBE = r"[@0-9]|AKIA|gh[pousr]_|sk-|(?:" + "|".join(x for t in TITLES for x in dict.fromkeys((t, t.upper()))) + r")\.? \p{Lu}|[a-fA-F]{32}"
MALE = r"^(?:" + "|".join((*MEN, *map(str.upper, MEN))) + r")[. ]"
FEMALE = r"^(?:" + "|".join((*WOMEN, *map(str.upper, WOMEN))) + r")[. ]"
#: Kinds of which only the digits count: mentions differ in punctuation.
DIGITS = ("phone", "ssn", "card")
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {
    "latin": (("b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v", "br", "kr", "st"), ("a", "e", "i", "o", "u", "ai", "ei", "ou")),
    "cyrillic": (("б", "в", "г", "д", "к", "л", "м", "н", "п", "р", "с", "т", "ф", "бр", "кр", "ст"), ("а", "е", "и", "о", "у", "я", "ю", "э")),
    "greek": (("β", "γ", "δ", "κ", "λ", "μ", "ν", "π", "ρ", "σ", "τ", "φ", "θ", "βρ", "κρ", "στ"), ("α", "ε", "ι", "ο", "υ", "αι", "ει", "ου")),
}
#: Endings of given names by gender, and of surnames.
ENDINGS = {
    "latin": {"m": ("n", "r", "s", "rd"), "f": ("na", "la", "ra", "ssa"), "x": ("l", "x", "k", "m"), "surname": ("son", "mann", "dale", "berg")},
    "cyrillic": {"m": ("н", "р", "с", "м"), "f": ("на", "ла", "ра", "са"), "x": ("ль", "к", "т", "ш"), "surname": ("ко", "ук", "ян", "ич")},
    "greek": {"m": ("νος", "ρος", "λος", "σης"), "f": ("να", "λα", "ρα", "σσα"), "x": ("ξ", "ν", "ς", "ρ"), "surname": ("ιδης", "ακης", "ογλου", "ατος")},
}


def _script(s: Column) -> Column:
    return F.when(s.rlike(r"\p{IsCyrillic}"), "cyrillic").when(s.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def kind_of(mention: Column) -> Column:
    c = F.when(mention.rlike(f"^(?:{LONG_PHONE})$"), "phone").when(mention.rlike(f"^(?:{IPV6})$"), "ipv6")
    for k, p in PATTERNS.items():
        own = mention.rlike(f"^(?:{p})$")
        c = c.when(own, k)
    return c.otherwise("secret")


def entities_of(mention: Column) -> Column:
    """The entities of a mention as ``kind, core``: the core is what all mentions of one entity share."""
    kind = kind_of(mention)
    digits = F.regexp_replace(mention, "[^0-9]", "")
    words = F.filter(F.split(F.regexp_replace(mention, r"^[\p{L}-]+\.? ", ""), " "), lambda w: w != "")
    gender = F.when(mention.rlike(MALE), "m").when(mention.rlike(FEMALE), "f").otherwise("x")
    def entity(k: Column, core: Column) -> Column:
        return F.struct(k.alias("kind"), core.alias("core"))
    return (F.when(kind == "phone", F.array(entity(kind, F.right(digits, F.lit(10)))))  # with or without the country
            .when(kind.isin(*DIGITS), F.array(entity(kind, digits)))
            .when((kind == "person") & (F.size(words) > 1), F.array(entity(F.concat(F.lit("given-"), gender), F.lower(F.get(words, F.lit(0)))), entity(F.lit("surname"), F.lower(F.get(words, F.lit(1))))))
            .when(kind == "person", F.array(entity(F.lit("surname"), F.lower(F.get(words, F.lit(0))))))
            .when(kind == "iban", F.array(entity(kind, F.lower(F.regexp_replace(mention, " ", "")))))
            .otherwise(F.array(entity(kind, F.lower(mention)))))


def _number(h: Column, i: Column, below: Column | int) -> Column:
    """A number from the i-th four hex digits of a hash that is long enough, or from its repeats."""
    at = F.pmod(i * 4, F.length(h) - 4).cast("int") + 1
    return F.pmod(F.conv(F.substring(h, at, F.lit(4)), 16, 10).cast("int") + i.cast("int") * 7, F.lit(below) if isinstance(below, int) else below)


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _pick(options: tuple[str, ...], n: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in options]), n)


def surrogate_core(kind: Column, core: Column, draw: Column, key: str) -> Column:
    """The replacement of an entity's core at its ``draw``-th draw."""
    seed = F.concat_ws("|", F.lit(key), kind, core, draw.cast("string"))
    h = F.concat(F.sha2(F.concat(F.lit("a"), seed), 512), F.sha2(F.concat(F.lit("b"), seed), 512))
    chars = F.filter(F.split(core, ""), lambda c: c != "")

    def other(c: Column, i: Column) -> Column:
        """A digit for a digit, a letter of its script for a letter, the rest as it is."""
        out = F.when((kind == "ipv6") & (c != ":"), F.substring(F.lit("0123456789abcdef"), _number(h, i, 16) + 1, F.lit(1)))
        out = out.when(c.between("0", "9"), _number(h, i, 10).cast("string"))
        out = out.when((kind == "secret") & c.between("a", "f") & ~core.rlike("^(akia|gh|sk-)"), F.substring(F.lit("abcdef"), _number(h, i, 6) + 1, F.lit(1)))
        for s in ("cyrillic", "greek"):
            letters = LETTERS[s]
            out = out.when(c.rlike(rf"\p{{Is{s.capitalize()}}}"), F.substring(F.lit(letters), _number(h, i, len(letters)) + 1, F.lit(1)))
        return out.when(c.rlike(r"\p{L}"), F.substring(F.lit(LETTERS["latin"]), _number(h, i, 26) + 1, F.lit(1))).otherwise(c)

    plain = F.array_join(F.transform(chars, other), "")
    # what tells the kind stays: a mail's top domain, a key's prefix, an account's country, a card's issuer, a phone's first digit
    top = F.regexp_extract(core, r"(\.[\p{L}\p{N}-]+)$", 1)
    email = F.concat(F.substring(plain, F.lit(1), F.length(core) - F.length(top)), top)
    prefix = F.regexp_extract(core, r"^(akia|gh[pousr]_|sk-)", 1)
    secret = F.concat(prefix, F.substring(plain, F.length(prefix) + 1, F.length(core)))
    iban = F.concat(F.substring(core, 1, 2), F.substring(plain, F.lit(3), F.length(core)))
    octets = F.split(core, r"\.")
    ip = F.array_join(F.transform(octets, lambda o, i: F.when(F.length(o) == 1, _number(h, i, 10)).when(F.length(o) == 2, _number(h, i, 90) + 10).otherwise(_number(h, i, 156) + 100).cast("string")), ".")
    numbers = F.concat(F.substring(core, 1, 1), F.substring(plain, F.lit(2), F.length(core)))
    body = F.substring(numbers, F.lit(1), F.length(numbers) - 1)
    checked = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(body, d.cast("string"))), _luhn), 1)
    card = F.when(_luhn(core), checked).otherwise(numbers)

    def name(ending: Column | str) -> Column:
        out = None
        script = _script(core)
        for s, (onsets, vowels) in SYLLABLES.items():
            # two syllables, and another one for every second further draw
            parts = F.transform(F.sequence(F.lit(0), F.lit(1) + F.floor(draw / 2).cast("int")), lambda i: F.concat(_pick(onsets, _number(h, i * 2 + 3, len(onsets))), _pick(vowels, _number(h, i * 2 + 4, len(vowels)))))
            end = None
            for e, options in ENDINGS[s].items():
                own = _pick(options, _number(h, F.lit(1), len(options)))
                match = kind == ("surname" if e == "surname" else f"given-{e}")
                end = F.when(match, own) if end is None else end.when(match, own)
            own = F.concat(F.array_join(parts, ""), end)
            out = F.when(script == s, own) if out is None else out.when(script == s, own)
        return out

    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "secret", secret)
            .when(kind == "iban", iban).when(kind.isin("phone", "ssn"), numbers).when(kind == "ipv6", plain).otherwise(name("")))


def apply_core(mention: Column, kind: Column, core: Column) -> Column:
    """The mention with its core's characters replaced in order; punctuation and letter case stay.

    Digits in front of the core, a phone number's country, stay as well.
    """
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    counts = lambda c: F.when(kind.isin(*DIGITS), c.between("0", "9")).when(kind == "iban", c != " ").otherwise(F.lit(True))
    extra = F.when(kind == "phone", F.length(F.regexp_replace(mention, "[^0-9]", "")) - F.length(core)).otherwise(F.lit(0))
    start = F.struct(F.lit("").alias("out"), (F.lit(1) - extra).alias("at"))
    def step(acc: Column, c: Column) -> Column:
        new = F.substring(core, acc["at"], F.lit(1))
        cased = F.when((F.upper(c) == c) & (F.lower(c) != c), F.upper(new)).otherwise(new)
        return F.struct(F.concat(acc["out"], F.when(counts(c) & (acc["at"] > 0), cased).otherwise(c)).alias("out"), (acc["at"] + F.when(counts(c), 1).otherwise(0)).alias("at"))
    return F.aggregate(chars, start, step, lambda acc: acc["out"])


def _named(mention: Column, cores: Column) -> Column:
    """A person's mention with its words replaced: the title stays, the case of each word's letters too."""
    title = F.regexp_extract(mention, r"^([\p{L}-]+\.? )", 1)
    loud = F.upper(F.regexp_replace(mention, r"^[\p{L}-]+\.? ", "")) == F.regexp_replace(mention, r"^[\p{L}-]+\.? ", "")
    return F.concat(title, F.array_join(F.transform(cores, lambda c: F.when(loud, F.upper(c)).otherwise(F.initcap(c))), " "))


def _draws(t: Tables, entities: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kind, core, draw, surrogate) of all entities, and of those that drew more than once."""
    kind, core, draw = F.col("kind"), F.col("core"), F.col("draw")
    drawn = entities.select("kind", "core", F.lit(0).alias("draw"))
    drawn = t.cut(drawn.withColumn("surrogate", surrogate_core(kind, core, draw, key)), "drawn")
    space = F.regexp_replace("kind", "^given-[mfx]$", "given")
    real = t.cut(drawn.select(space.alias("space"), F.col("core").alias("surrogate")).distinct(), "real")
    while True:
        # the earlier draw keeps a replacement that two entities drew, then the lesser entity
        spaced = drawn.withColumn("space", space)
        taken = spaced.groupBy("space", "surrogate").agg(F.min(F.struct("draw", "kind", "core")).alias("first"), F.count("*").alias("n")).where("n > 1")
        second = spaced.join(taken, ["space", "surrogate"]).where("NOT (first.kind = kind AND first.core = core)").select("kind", "core")
        known = spaced.join(real, ["space", "surrogate"], "left_semi").select("kind", "core")
        again = t.cut(second.union(known).distinct().withColumn("again", F.lit(1)), "again")
        if not again.limit(1).count():
            return drawn, drawn.where("draw > 0")
        after = drawn.join(again, ["kind", "core"], "left").withColumn("draw", draw + F.coalesce("again", F.lit(0)))
        after = after.withColumn("surrogate", F.when(F.col("again").isNull(), F.col("surrogate")).otherwise(surrogate_core(kind, core, draw, key)))
        after = t.cut(after.drop("again"), "drawn")
        t.drop(drawn, again)
        drawn = after


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_replaced``, the number of mentions replaced.

    All rows and columns stay; ``text_col`` alone changes. A null text stays
    null and an empty one empty; texts without entities are unchanged, byte for
    byte; rows with one id may have different texts, and repeated rows each get
    their row; an empty table gives none. ``key`` is secret: the same key gives
    the same replacements as long as the set of entities is the same.
    """
    t = Tables(docs.sparkSession, "surrogates")
    text = F.col(text_col)
    # documents with mentions, by text: equal texts have equal results
    some = docs.select(text_of(docs[text_col]).alias("text")).where(F.col("text").rlike(MAYBE))
    found = some.select(F.md5("text").alias("_md5"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("mentions"))
    found = t.cut(found.where(F.size("mentions") > 0), "mentions").dropDuplicates(["_md5"])
    said = found.select("_md5", F.posexplode("mentions").alias("at", "mention"))
    distinct = t.cut(said.select("mention").distinct().withColumn("entities", entities_of(F.col("mention"))), "distinct")
    entities = distinct.select(F.explode("entities").alias("e")).select("e.kind", "e.core").distinct()
    _, redrawn = _draws(t, entities, key)

    # what each mention becomes
    parts = distinct.select("mention", F.posexplode("entities").alias("part", "e")).select("mention", "part", "e.kind", "e.core")
    parts = parts.join(redrawn.select("kind", "core", F.col("surrogate").alias("later")), ["kind", "core"], "left")
    parts = parts.withColumn("core", F.coalesce("later", surrogate_core(F.col("kind"), F.col("core"), F.lit(0), key)))
    whole = parts.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("part", "kind", "core"))).alias("parts"))
    kind, first = F.col("parts")[0]["kind"], F.col("parts")[0]["core"]
    person = kind.startswith("given") | (kind == "surname")
    becomes = F.when(person, _named(F.col("mention"), F.transform("parts", lambda p: p["core"]))).otherwise(apply_core(F.col("mention"), kind, first))
    new = t.cut(whole.select("mention", becomes.alias("new")), "new")

    lists = said.join(new, "mention").groupBy("_md5").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("news"))
    lists = t.cut(lists.select("_md5", F.transform("news", lambda x: x["new"]).alias("_news")), "lists")
    has = text_of(docs[text_col]).rlike(MAYBE) & text_of(docs[text_col]).rlike(ANY)
    pieces = F.split(text, ANY, -1)
    filled = F.flatten(F.zip_with(pieces, F.col("_news"), lambda p, n: F.array(p, F.coalesce(n, F.lit("")))))
    some = docs.where(has).withColumn("_md5", F.md5(text)).join(lists, "_md5")
    some = some.withColumn(text_col, F.array_join(filled, "")).withColumn("n_replaced", F.size("_news"))
    rest = docs.where(~has).withColumn("n_replaced", F.lit(0))
    columns = [c for c in docs.columns if c != "n_replaced"]
    return some.select(*columns, "n_replaced").union(rest.select(*columns, "n_replaced"))
