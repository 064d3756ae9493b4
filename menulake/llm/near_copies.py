"""Near copies by BagMinHash signatures of word windows (operator 5).

A text is the multiset of its five-word windows (words in lower case, without
punctuation); texts of one to four words have one window. Two texts are near
copies if the weighted Jaccard similarity of their multisets is 0.8 or more.
Classes are the connected components of near copies.

*Signatures.* Every window owns Poisson processes over the levels of its weight,
cut at powers of two: [0, 1), [1, 2), [2, 4) and so on. A text takes those that
its count reaches; of the last one it takes only the points whose level lies
below the count. Each point falls into one of the signature's components, which
keeps the earliest point. Components of two texts agree with a probability
equal to the weighted Jaccard similarity. Points come in time order, and a
process ends once it is later than all components of its text.

*Candidates.* Bands of ``rows`` components; texts that share a band are
candidates, and the components of that relation the groups to look into.

*Verifying.* A group whose texts fit into a task is resolved there, over all
windows. A larger one, which chance may have chained together, is looked at band
by band. Where the texts of one band are still more, every text is compared with the
group's smallest text, the hub h. If a text x of the group isn't near h, it may still be near
another text y of the group. As h is no larger than y, such a pair shares
windows that h lacks: |x & y| <= min(|x & h|, |y & h|) + |x-h & y-h|, so at
least 4/9 (|x| + |h|) - |x & h| of them. By the prefix principle x and y then
share one of the first |x-h| - needed + 1 windows, in any fixed order, that each
has beyond h. Nor is a window of y of use where fewer than the needed windows of y
are left from there on, for any x of the window's group that isn't near h: so the texts
near h, which need few, leave most groups again. The order puts the windows that are frequent in the large groups
last: what many texts share (a licence, a menu) gathers no texts again, and most
first windows belong to one text, so the groups of a round are small. These
windows (and the size class, as sizes differ by a fifth at most) make the groups
of the next round. So no link between texts that share a band is lost, no large
group is expanded into pairs, and a round's work is one comparison for each text
of a group. The list of frequent windows has a bound; it changes the work only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import Tables, free, text_of
from menulake.llm.components import components

WINDOW, NEAR = 5, 0.8
BANDS, ROWS = 28, 5
#: Groups up to so many texts, of so many windows together, are resolved in one task; larger ones go by rounds.
GROUP, ROOM = 4_096, 1_000_000
#: So many windows at most are put last for being frequent in the large groups.
FREQUENT = 65_536
#: Bits of the map that keeps most unwanted texts out of a shuffle, and of one of its rows (Spark's bitmaps).
BITS, ROW_BITS = 1 << 25, 1 << 15
#: Texts and characters to a step of signing.
STEP, CHARS = 1_000, 4_000_000
_WORD = re.compile(r"\w+")
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


#: Hashes of the words that a Python worker has met; begun anew when there are many.
_known = _Hashes()


def windows(texts: list[str], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, window hash, count) of each distinct window, in order of text and hash."""
    if len(_known) > 200_000:
        _known.clear()
    words = [_WORD.findall(t.lower()) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *(np.fromiter(map(_known.__getitem__, w), np.uint64, len(w)) for w in words)])
    at = np.cumsum(n) - n
    of = np.repeat(np.arange(len(n)), n)
    begin = np.flatnonzero((np.arange(len(flat)) - at[of] + size <= n[of]) | ((n[of] < size) & (np.arange(len(flat)) == at[of])))
    doc = of[begin]
    h = np.zeros(len(begin), np.uint64)
    for k in range(size):
        inside = k < n[doc]
        h = h * _P + np.where(inside, flat[np.minimum(begin + k, max(len(flat) - 1, 0))], np.uint64(1)) if len(flat) else h
    h = _mix(h)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.append(new, len(h)))


def signatures(doc: np.ndarray, h: np.ndarray, count: np.ndarray, n_docs: int, parts: int) -> np.ndarray:
    """BagMinHash: the earliest point of each component, n_docs x parts."""
    least = np.full((n_docs, parts), np.inf)
    latest = np.full(n_docs, np.inf)
    # one process for each power of two that the count passes
    many = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    d, e, w = (np.repeat(x, many) for x in (doc, h, count))
    level = np.arange(len(d)) - np.repeat(np.cumsum(many) - many, many)
    width = np.where(level < 2, 1, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    low = np.where(level == 0, 0, width)
    seed = _mix(e + _P * (level + 1).astype(np.uint64))
    time = np.zeros(len(d))
    flat = least.reshape(-1)
    rounds = 0
    while len(d):
        rounds += 1
        seed = _mix(seed + _P)
        u = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(u) / width
        go = time < latest[d]
        d, w, width, low, seed, time = (x[go] for x in (d, w, width, low, seed, time))
        place = _mix(seed ^ _P)
        inside = low + np.floor((place >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 * width) < w
        slot = d * parts + ((place & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64)
        np.minimum.at(flat, slot[inside], time[inside])
        if rounds % 2 == 0 or rounds < 4:
            left = np.unique(d)
            latest[left] = least[left].max(1)
    return least


def _steps(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose third column's texts are few and, but for a single text, not long together."""
    begin = chars = 0
    for k, n in enumerate(pc.utf8_length(b.column(2)).to_pylist()):
        if k > begin and (k - begin >= STEP or chars + n > CHARS):
            yield b.slice(begin, k - begin)
            begin, chars = k, 0
        chars += n
    if begin < b.num_rows:
        yield b.slice(begin)


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _steps(b):
                doc, h, count = windows(c.column(2).to_pylist())
                s = signatures(doc, h, count, c.num_rows, bands * rows).view(np.uint64).reshape(-1, bands, rows)
                key = np.zeros(s.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    key = _mix(key * _P + s[:, :, r])
                size = np.bincount(doc, count, c.num_rows).astype(np.int64)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, bands * len(s) + 1, bands), pa.int32()), pa.array(key.astype(np.int64).reshape(-1)))
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array(size), keys], ["doc_id", "node", "size", "bands"])
    return run


def _needed(x: float, y: float, near: float) -> float:
    return near / (1 + near) * (x + y)


Counted = tuple[np.ndarray, np.ndarray]


def counted(text: str) -> Counted:
    """The distinct windows of a text in order of their hashes, and their counts."""
    _, w, n = windows([text])
    return w, n


def compare(tx: str, th: str, near: float = NEAR, frequent: Counted | None = None) -> tuple[bool, np.ndarray, np.ndarray, int]:
    """``beyond`` of two texts."""
    return beyond(counted(tx), counted(th), near, frequent)


def beyond(x: Counted, h: Counted, near: float = NEAR, frequent: Counted | None = None) -> tuple[bool, np.ndarray, np.ndarray, int]:
    """Whether two texts are near copies, and x's windows beyond h that a partner of x must share one of.

    Then how many windows beyond h are left from each of these on, and how many a partner
    must share. A partner is no smaller than h, nor than 0.8 of x. ``frequent`` windows (in order of their hashes, with their frequencies) come last.
    """
    (wx, nx), (wh, nh) = x, h
    _, i, j = np.intersect1d(wx, wh, assume_unique=True, return_indices=True)
    common = np.minimum(nx[i], nh[j])
    both = int(common.sum())
    size, hub = int(nx.sum()), int(nh.sum())
    linked = both >= near * (size + hub - both) - 1e-9
    rest = nx.copy()
    rest[i] -= common
    need = max(1, math.ceil(_needed(size, max(near * size, hub), near) - both - 1e-9))
    at = np.flatnonzero(rest)
    if frequent is not None and len(frequent[0]):
        place = np.minimum(np.searchsorted(frequent[0], wx[at]), len(frequent[0]) - 1)
        at = at[np.lexsort((wx[at], np.where(frequent[0][place] == wx[at], frequent[1][place], 0)))]
    # the prefix counts repeats: it ends once the windows left are fewer than those needed
    left = rest[at].sum() - (np.cumsum(rest[at]) - rest[at])
    return linked, wx[at[left >= need]], left[left >= need], need


def _compare(near: float, frequent: Counted):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, h = None, None
        for b in batches:
            got = []
            for x, name, th in zip(b["text"], b["hub"], b["hub_text"], strict=True):
                if name != hub:  # rows come by hub
                    hub, h = name, counted(th)
                got.append(beyond(counted(x), h, near, frequent))
            yield pd.DataFrame({"node": b["node"], "size": b["size"], "hub": b["hub"], "linked": [g[0] for g in got], "beyond": [g[1].astype(np.int64) for g in got], "left": [g[2] for g in got], "need": [g[3] for g in got]})
    return run


def _window_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each step hold a window."""
    for b in batches:
        for c in _steps(b):
            _, h, _ = windows(c.column(2).to_pylist())
            w, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int64)), pa.array(n, pa.int64())], ["window", "n"])


def frequent_windows(texts: DataFrame) -> Counted:
    """The most frequent windows of ``texts`` (node, size, text), by hash, and their frequencies: ``FREQUENT`` at most."""
    n = texts.select("node", "size", "text").mapInArrow(_window_counts, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))
    rows = n.orderBy(F.col("n").desc(), "window").limit(FREQUENT).toPandas()
    w = rows["window"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(w)
    return w[order], rows["n"].to_numpy(np.int64)[order]


def resolve(texts: list[str], near: float = NEAR) -> list[tuple[int, int]]:
    """Links that hold the components of a group together, found over all windows of its texts.

    The group's windows are listed with the texts that hold them; a text's lists,
    summed up, give what it has in common with each other text. The texts that
    share most with others come first, so a class is soon one and the texts left
    are those outside the largest.
    """
    parts = [windows(texts[k:k + STEP]) for k in range(0, len(texts), STEP)]
    doc = np.concatenate([np.zeros(0, np.int64), *(p[0] + k * STEP for k, p in enumerate(parts))])
    w, n = (np.concatenate([np.zeros(0, t), *(p[c] for p in parts)]) for c, t in ((1, np.uint64), (2, np.int64)))
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    size = np.bincount(doc, n, len(texts))
    _, name, held = np.unique(w, return_inverse=True, return_counts=True)
    if not len(w):
        return []
    by = np.argsort(name, kind="stable")
    listed, counts, begin = doc[by], n[by], np.cumsum(held) - held
    # a text that shares too few windows with all others together is near none of them
    shared = np.bincount(doc, np.where(held[name] > 1, n, 0), len(texts))
    left = (size > 0) & (shared >= _needed(size, np.maximum(near * size, size[size > 0].min()), near) - 1e-9)
    central = np.bincount(doc, held[name] * n, len(texts))
    label, out = np.arange(len(texts)), []
    while left.any():
        # texts of one class need no look at each other: all but the largest are compared with all others
        of = np.bincount(label[left], minlength=len(texts))
        most = int(of.argmax())
        if of[most] == left.sum() > 1:
            break
        i = int(np.where(left & ((label != most) | (of[most] == 1)), central, -1).argmax())
        left[i] = False
        own = name[at[i]:at[i + 1]]
        many = held[own]
        places = np.repeat(begin[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(listed[places], np.minimum(counts[places], np.repeat(n[at[i]:at[i + 1]], many)), len(texts))
        linked = np.flatnonzero((common > 0) & (common >= near * (size[i] + size - common) - 1e-9))
        others, first = np.unique(label[linked], return_index=True)
        out += [(i, int(j)) for o, j in zip(others, linked[first], strict=True) if o != label[i]]
        label[np.isin(label, others)] = label[i]
    return out


def _resolve(near: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].tolist()
        return pd.DataFrame([(node[i], node[j]) for i, j in resolve(pdf["text"].tolist(), near)], columns=["a", "b"])
    return run


def _likely(d: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``d`` whose doc_id has the bit of one of ``wanted``: all that are wanted, and few others.

    The map is of 4 MB at most, so it is sent to every task whatever the size of the
    tables. Rows with the bit of another id only cost a shuffle.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    map_ = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / ROW_BITS).alias("_row")).agg(F.bitmap_construct_agg(F.col("bit") % ROW_BITS).alias("_map"))
    row, at = F.floor(bit / ROW_BITS), (bit % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return d.withColumn("_row", row).join(F.broadcast(map_), "_row").where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_row", "_map")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near: float = NEAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id, kept`` for each row of ``docs``; the class is named by its least doc_id.

    One row of each class is kept. Equal texts are one class; a text that is
    null or has no words is a class of its own, named by its doc_id; of
    repeated rows (one id and text) one is kept; a null id names a class only
    where all its ids are null. An empty table gives none. Other columns are
    ignored.
    """
    t = Tables(docs.sparkSession, "near-copies")
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text"))
    d = d.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")
    signed = t.cut(d.mapInArrow(_sign(bands, rows), "doc_id long, node binary, size long, bands array<long>"), "signed")
    texts = signed.where("size > 0")
    names = t.cut(texts.groupBy("node").agg(F.min("doc_id").alias("name")), "names")

    # candidate groups: components of the texts that share a band
    nodes = texts.select("node", "size", "bands").distinct()
    band = nodes.select("node", F.explode("bands").alias("key"))
    shared = t.cut(band.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last").select("key", "first"), "shared")
    links = band.join(shared, "key").where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    groups = components(t, links).withColumnRenamed("root", "key")
    sizes = t.cut(nodes.select("node", "size").join(groups, "node"), "groups")
    wanted = t.cut(sizes.select("node").distinct().join(names, "node").select("node", F.col("name").alias("doc_id")), "wanted")
    same = [F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")), F.col("d.node") == F.col("w.node")]
    # an inner join, as Spark would move a semi join below the filter; a node has one wanted id
    text = _likely(d, wanted).alias("d").join(wanted.alias("w"), same).select("d.node", "text").dropDuplicates(["node"])
    text = t.cut(text, "texts")

    # small groups in one task each, large ones against their smallest text
    members = sizes.select("key", "node", "size")
    edges, frequent = None, None
    while True:
        many = t.cut(members.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("room")).where("n > 1").select("key", ((F.col("n") <= GROUP) & (F.col("room") <= ROOM)).alias("fits")), "counted")
        members = t.cut(members.join(many, "key"), "members")
        # many small groups of a round have the same texts; each is resolved once
        sets = members.where("fits").groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("nodes")).select("nodes").distinct()
        small = sets.select(F.xxhash64("nodes").alias("key"), F.explode("nodes").alias("node")).join(text, "node")
        found = small.groupBy("key").applyInPandas(_resolve(near), "a binary, b binary")
        was, edges = edges, t.cut(found if edges is None else edges.union(found), "links")
        t.drop(was, many)
        large = members.where("NOT fits")
        if not large.limit(1).count():
            break
        if frequent is None:
            wide = large.select("node", "size").distinct()
            frequent = frequent_windows(wide.join(text, "node"))
            members = t.cut(band.join(large.select("node", "size").distinct(), "node").select("key", "node", "size"), "bands")
            continue
        hubs = t.cut(large.groupBy("key").agg(F.min(F.struct("size", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub")), "hubs")
        pairs = large.join(hubs, "key").where("node != hub").select("node", "size", "hub").distinct()
        pairs = pairs.join(text, "node").join(text.select(F.col("node").alias("hub"), F.col("text").alias("hub_text")), "hub")
        pairs = pairs.select("node", "size", "hub", "text", "hub_text")
        done = t.cut(pairs.sortWithinPartitions("hub").mapInPandas(_compare(near, frequent), "node binary, size long, hub binary, linked boolean, beyond array<long>, left array<long>, need long"), "compared")
        was, edges = edges, t.cut(edges.union(done.where("linked").select(F.col("node").alias("a"), F.col("hub").alias("b"))), "links")
        t.drop(was, members)
        # the next round's groups: texts with a window in common that the hub lacks, of like sizes, not all of them near the hub
        step = F.floor(F.log("size") / F.log(F.lit(1 / near)))
        keyed = done.select("hub", "node", "size", "linked", "need", F.explode(F.arrays_zip("beyond", "left")).alias("at"))
        keyed = keyed.select(F.explode(F.array(step, step + 1)).alias("class"), "hub", "at.beyond", "at.left", "node", "size", "linked", "need")
        keyed = keyed.select(F.xxhash64("hub", "beyond", "class").alias("key"), "node", "size", "linked", "left", "need")
        open_ = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("linked").alias("all_linked"), F.min(F.when(~F.col("linked"), F.col("need"))).alias("wanted"))
        open_ = t.cut(open_.where("n > 1 AND NOT all_linked").select("key", "wanted"), "open")
        members = t.cut(keyed.join(open_, "key").where("left >= wanted").select("key", "node", "size").distinct(), "members")
        t.drop(hubs, done, open_)
    roots = components(t, edges)

    # a class is named by the least id of its texts
    named = names.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = t.cut(named.groupBy("root").agg(F.min("name").alias("class_id")), "least")
    classes = t.cut(named.join(least, "root").select("node", "class_id"), "classes")
    rows_ = signed.groupBy("doc_id", "node", F.col("size") > 0).count().toDF("doc_id", "node", "worded", "times")
    out = rows_.join(classes, "node", "left").withColumn("class_id", F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")))
    # ids may repeat with other texts: of the rows that bear the class's name one is kept
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select("doc_id", "class_id", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("copy") == 1)).alias("kept"), "node")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that near_copies keeps, with all their columns."""
    def key(id_: Column, md5: Column) -> Column:
        return F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(" "), md5)

    name = free(docs, "key")
    kept = near_copies(docs, id_col, text_col, **options).where("kept")
    kept = kept.select(key(F.col("doc_id"), F.lower(F.hex("node"))).alias(name)).distinct()
    # joined and made distinct by one key, so the texts are shuffled once
    d = docs.withColumn(name, key(docs[id_col], F.md5(text_of(docs[text_col])))).join(kept, name)
    return d.dropDuplicates([name]).select(*docs.columns)
