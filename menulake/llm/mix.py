"""Mixing sources to target weights by Sainte-Lague apportionment (operator 7).

Sources in code point order, null last, weigh ``weights`` in turn and share the
words of all documents; a target stops at ``most`` times its source's words and
the excess goes to the others by weight (water filling).

The words of a source are laid out in shards (by hash of the document, so that
a hot source has many) and each shard in blocks of equal size, about one
``blocks``-th of all words. Sainte-Lague gives the blocks first to the sources
and then, within a source, to its shards: seats go one by one to the highest
quotients votes / (2 k + 1). A shard's quota takes every one of its blocks as
often as it can and the rest of the blocks in a seeded order. A document takes
the words of its part of those blocks.

Where texts themselves are taken (``mixed_documents``), they stay whole: a
source's blocks give its number of words, and its documents are taken in a
seeded order while they fit into it, so it ends less than a document below.

Everything is SQL functions. The number of shards, and so of apportionment
rows, is bounded by ``shards`` plus the number of sources; documents move once,
as (id, source, words).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menulake.llm.common import WORD, Tables, columns, free, text_of

BLOCKS, SHARDS = 65_536, 2_048
#: A prime above any number of blocks: multiples of it step through all blocks of a shard once.
STRIDE = 2_147_483_629


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size``: the words of each text (null: none)."""
    d = columns(docs, doc_id=id_col, text=text_col, source=source_col)
    return d.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))


def targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """Adds ``rank, weight, target`` to ``source, source_size``: one row a source.

    Sources whose cap is lowest for their weight fill up first. With the first
    j of them at their caps the others stand at the level (total - caps) /
    weights; source j + 1 is at its cap as well if that level reaches it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    total = F.sum("source_size").over(Window.partitionBy())
    s = sources.withColumn("rank", F.row_number().over(by_name))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.greatest(heavy, F.lit(1e-9))).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    # the level of the first source below its cap holds for all behind it
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(Window.partitionBy())["level"]
    return s.withColumn("target", F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))).drop("cap", "level", "full")


def sainte_lague(parties: DataFrame, group: list[str], key: list[str], votes: str, seats: str, most: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group dealt to its parties by the highest quotients.

    No party takes more than ``most`` seats. With P parties and S seats, the
    divisor lies within P / (2 S - P) of total votes / S, so only the quotients
    between those bounds compete; all seats above them are certain. That leaves
    about 2 P rows to rank.
    """
    over = Window.partitionBy(*group)
    p = parties.withColumn("_n", F.count("*").over(over)).withColumn("_all", F.sum(F.col(votes).cast("decimal(38,9)")).over(over).cast("double"))
    slack = F.when(2 * F.col(seats) > F.col("_n"), F.col("_n") / (2 * F.col(seats) - F.col("_n")))
    fair = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all") * F.col(seats)).otherwise(F.lit(0.0))
    cap = F.col(most).cast("long")
    low = F.when(slack.isNull(), F.lit(0)).otherwise(F.floor(fair / (1 + slack) - 0.5))
    high = F.when(slack.isNull(), F.least(F.col(seats), F.ceil(fair * 2) + 1)).when(slack >= 1, F.col(seats)).otherwise(F.ceil(fair / (1 - slack) + 0.5) + 1)
    p = p.withColumn("_low", F.least(cap, F.greatest(F.lit(0).cast("long"), low.cast("long"))))
    p = p.withColumn("_high", F.least(cap, F.greatest(F.col("_low"), high.cast("long"))))
    open_ = F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))
    q = p.withColumn("_left", F.col(seats) - F.sum("_low").over(over)).where(F.col(votes) > 0)
    q = q.select(*group, *key, votes, "_left", F.explode(open_).alias("_k"))
    by = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), *[F.xxhash64(F.lit(11), k) for k in key], *key)
    won = q.withColumn("_place", F.row_number().over(by)).where(F.col("_place") <= F.col("_left"))
    won = won.groupBy(*[F.col(c).alias(f"won_{c}") for c in group + key]).agg(F.count("*").alias("_won"))
    same = [F.col(c).eqNullSafe(F.col(f"won_{c}")) for c in group + key]
    return (p.join(won, same, "left").withColumn("quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
            .select(*parties.columns, "quota"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, blocks: int = BLOCKS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, repeats
    counted; it never passes ``ceil(most)`` times its size. A null text has no
    words; null sources form one source; repeated rows are rows of their own; an
    empty table, or one without words, takes nothing. Other columns are
    ignored. The same rows give the same result, in whatever order they come.
    """
    d, quotas = _dealt(docs, id_col, text_col, source_col, weights, most, blocks, shards, seed)
    d = d.join(quotas, ["rank", "shard"])
    return d.select("doc_id", "source", "size", "source_size", "target", _taken(seed).alias("taken"))


def _dealt(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], most: float, blocks: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their places in the shards (``end`` is where their words end), and a row for each shard with its blocks and quota."""
    t = Tables(docs.sparkSession, "mix")
    d = t.cut(sized(docs, id_col, text_col, source_col), "sized")
    sources = t.cut(targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")

    total = F.sum("source_size").over(Window.partitionBy())
    spread = sources.select(F.col("source").alias("s"), "source_size", "target", "rank",
                            F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.greatest(total, F.lit(1)) * shards)).cast("long").alias("n_shards"),
                            F.greatest(F.lit(1.0), total / blocks).alias("block"))
    d = d.join(spread, d["source"].eqNullSafe(spread["s"])).drop("s")
    d = d.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("n_shards")))
    laid = Window.partitionBy("rank", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("end", F.sum("size").over(laid))

    # blocks of equal size within a shard
    h = d.groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.first("block").alias("block"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    h = t.cut(h.withColumn("n_blocks", F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / F.col("block")))).otherwise(F.lit(0)).cast("long")), "shards")
    s = h.groupBy("rank").agg(F.sum("n_blocks").alias("n_blocks"), F.max(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).alias("ratio"))
    s = s.withColumn("votes", F.col("n_blocks") * F.col("ratio")).withColumn("seats", F.round(F.sum(F.col("votes").cast("decimal(38,9)")).over(Window.partitionBy())).cast("long"))
    s = s.withColumn("most", F.floor(F.col("n_blocks") * F.lit(float(most)))).withColumn("all", F.lit(1))
    s = sainte_lague(s, ["all"], ["rank"], "votes", "seats", "most").select("rank", F.col("quota").alias("seats"))
    h = h.withColumn("votes", F.col("words").cast("double")).withColumn("most", F.floor(F.col("n_blocks") * F.lit(float(most))))
    h = sainte_lague(h.join(s, "rank"), ["rank"], ["shard"], "votes", "seats", "most")
    return d, t.cut(h.select("rank", "shard", "words", "n_blocks", "quota"), "quotas")


def _taken(seed: int) -> Column:
    """Words of [end - size, end) in the blocks that the quota takes.

    Block b holds the words from floor(b words / n) to floor((b + 1) words / n).
    """
    n, words, begin = F.col("n_blocks"), F.col("words"), F.col("end") - F.col("size")
    rounds, rest = F.floor(F.col("quota") / n), F.pmod(F.col("quota"), n)
    shift = F.pmod(F.xxhash64(F.lit(seed + 2), "rank", "shard"), n)

    def edge(b: Column) -> Column:
        return F.expr("0L") + (b * words - F.pmod(b * words, n)) / n

    def overlap(b: Column) -> Column:
        own = F.least(F.col("end"), edge(b + 1)) - F.greatest(begin, edge(b))
        picked = F.pmod(b * F.lit(STRIDE) + shift, n) < rest
        return F.when(picked & (own > 0), own.cast("long")).otherwise(F.lit(0).cast("long"))

    def block(word: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(n - 1, F.floor(word * n / words)))

    extra = F.aggregate(F.sequence(F.greatest(F.lit(0).cast("long"), block(begin) - 1), F.least(n - 1, block(F.col("end")) + 1)), F.lit(0).cast("long"), lambda acc, b: acc + overlap(b))
    return F.when(F.col("size") > 0, F.col("size") * rounds + extra).otherwise(F.lit(0)).cast("long")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, blocks: int = BLOCKS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that a mix holds, with the columns of ``docs``.

    A document stands as often as it is taken, its text whole each time;
    documents that aren't taken are left out. A source has at most the words of
    its blocks, and less than a document fewer. Only where they are fewer than
    those of the source's first document, a part of this one stands, from a
    seeded place. ``n_chars``, where there is one, follows the text.
    """
    d, quotas = _dealt(docs, id_col, text_col, source_col, weights, most, blocks, shards, seed)
    # the shards of a source in a row, in a seeded order; there are few
    own = Window.partitionBy("rank")
    laid = own.orderBy(F.xxhash64(F.lit(seed + 2), "rank", "shard"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum(F.when(F.col("n_blocks") > 0, F.col("quota") * F.col("words") / F.col("n_blocks"))).over(own)).cast("long")
    q = quotas.select("rank", "shard", F.coalesce(F.sum("words").over(laid), F.lit(0)).alias("before"), F.sum("words").over(own).alias("all"), quota.alias("quota"))
    end, size = F.col("before") + F.col("end"), F.col("size")
    rest = F.pmod(F.col("quota"), F.col("all"))
    d = d.where(size > 0).join(q, ["rank", "shard"]).withColumn("whole", F.floor(F.col("quota") / F.col("all")) + F.when(end <= rest, 1).otherwise(0))
    d = d.withColumn("part", F.when((F.col("quota") < size) & (end == size), F.col("quota")).otherwise(0))
    i, n, whole, part, copy = (free(docs, x) for x in ("mix_id", "mix_size", "mix_whole", "mix_part", "mix_copy"))
    taken = d.where("whole + part > 0").groupBy(F.col("doc_id").alias(i), size.alias(n)).agg(F.max("whole").alias(whole), F.max("part").alias(part))

    d = docs.join(taken, docs[id_col].eqNullSafe(taken[i]))
    d = d.where(F.regexp_count(text_of(text_col), F.lit(WORD)) == F.col(n))
    d = d.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1).cast("long"), F.col(whole)))))
    pieces = F.split(F.col(text_col), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # a word each, with the white space before it
    begin = F.pmod(F.xxhash64(F.lit(seed + 3), i), F.col(n) - F.col(part) + 1) + 1
    cut = F.array_join(F.slice(pieces, begin.cast("int"), F.col(part).cast("int")), "")
    d = d.withColumn(text_col, F.when(F.col(whole) > 0, F.col(text_col)).otherwise(cut))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return d.select(*docs.columns)
