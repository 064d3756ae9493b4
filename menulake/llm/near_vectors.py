"""Near vectors by a robust-pruned flat graph (operator 4).

Vectors link if their cosine is at least ``near``. The search goes over a graph
that is built in overlapping shards:

1. *Balls.* Vectors within half the angle of a link around a leader all link to
   each other, whatever their number. Rounds over salted shards gather them, so
   a vector with very many near copies becomes one weighted leader, and no task
   sees more rows than a salted shard has.
2. *Shards.* Leaders go to the ``overlap`` nearest of the cluster centres, which
   are fitted on a bounded sample; a shard that is too large is clustered again.
3. *Graph.* In each shard a leader's nearest leaders are pruned: a neighbour goes
   if a kept one is closer to it by the factor ``ALPHA``. The adjacency lists of
   all shards are united.
4. *Search.* In each shard every leader is a query: a beam goes greedily from the
   shard's medoid towards it, and then expands through all leaders within range,
   which is the angle of a link and both balls' radii.
5. *Verify.* Pairs of balls that link as a whole, or not at all, are known by
   the triangle inequality; the others are compared vector by vector, in double
   precision.
6. *Audit.* The links that a sample of vectors, each of another ball, has outside
   its ball are counted by brute force against all vectors. If less than
   ``recall`` of them were found, as the mean over these vectors, the overlap and
   the beam double and the graph is built again. If the last graph misses the
   bound too, all pairs of leaders are compared, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import Tables
from menulake.llm.components import components

NEAR, ALPHA = 0.9, 1.2
DEGREE, POOL = 24, 64
SHARD = 1000
#: Bounds of what the driver fits: centres, and sampled vectors for each.
CENTRES, SAMPLE = 2048, 16
AUDIT = 256


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


def centres(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k-means on the sphere, begun from k rows spread over x."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.linalg.norm(sums, axis=1)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray, m: int) -> np.ndarray:
    s = x @ c.T
    m = min(m, len(c))
    return np.argpartition(-s, m - 1, axis=1)[:, :m]


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unit vectors in double precision; null where a vector can't link."""
    for b in batches:
        out = []
        for v in b["embedding"]:
            x = None if v is None else np.array([np.nan if e is None else e for e in v], np.float64)
            if x is not None and len(x) and np.isfinite(x).all():
                top = np.abs(x).max()
                x = x / top if top > 0 else x  # neither squares nor sums over- or underflow
                n = np.sqrt(x @ x)
                out.append((x / n).tobytes() if n > 0 else None)
            else:
                out.append(None)
        yield pd.DataFrame({"id": b["id"], "unit": out})


def _sampled(df: DataFrame, n: int, most: int) -> np.ndarray:
    """At most ``most`` of the n units, those with the lowest hashes, in that order."""
    share = 1.0 if n <= most else 1.5 * most / n
    some = df.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    rows = some.select("unit").orderBy(F.xxhash64(F.lit(6), "id"), "id").limit(most).collect()
    return np.stack([np.frombuffer(r["unit"], np.float64) for r in rows])


def _sharded(t: Tables, df: DataFrame, n: int, overlap: int) -> DataFrame:
    """``df`` (id, unit, ...) with a row for each of its shards, none much larger than SHARD."""
    k = max(1, min(CENTRES, math.ceil(n * overlap / SHARD)))
    c = centres(_sampled(df, n, SAMPLE * k), k)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                near = _nearest(_matrix(b["unit"]), c, overlap)
                yield b.loc[b.index.repeat(near.shape[1])].assign(shard=near.ravel().astype(np.int64))

    out = t.cut(df.mapInPandas(assign, fields + ", shard long"), "shards")
    while True:
        large = t.cut(out.groupBy("shard").count().where(F.col("count") > 4 * SHARD), "large")
        if not large.limit(1).count():
            return out
        # cluster a large shard again, on a sample of its own
        own = out.join(large, "shard").where(F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1_000_000)) < F.ceil(F.lit(4e9) / F.col("count")))

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            got = centres(_matrix(pdf["unit"]), max(2, min(64, math.ceil(2 * pdf["count"].iloc[0] / SHARD))))
            return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "centres": [got.tobytes()]})

        fitted = own.select("shard", "unit", "count").groupBy("shard").applyInPandas(fit, "shard long, centres binary")

        def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for (shard, cs), g in b.groupby(["shard", "centres"]):
                    x = _matrix(g["unit"])
                    near = _nearest(x, np.frombuffer(cs, np.float64).reshape(-1, x.shape[1]), min(2, overlap))
                    new = (np.int64(shard) + 1) * 64 * 31 + near.ravel() + (1 << 40)
                    yield g.drop(columns=["shard", "centres"]).loc[g.index.repeat(near.shape[1])].assign(shard=new)

        split = out.join(fitted, "shard").select(*df.columns, "shard", "centres").mapInPandas(again, fields + ", shard long")
        after = t.cut(out.join(large, "shard", "left_anti").select(*df.columns, "shard").union(split.select(*df.columns, "shard")).distinct(), "shards")
        if after.groupBy("shard").count().agg(F.max("count")).first()[0] >= large.agg(F.max("count")).first()[0]:
            return after  # it can't be split further
        out = after


# ---------------------------------------------------------------- balls

def _gather(near: float):
    """Greedy balls among the rows of a salted shard: a row joins the first leader that its whole ball fits."""
    most = math.acos(near) / 2 - 1e-7

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        x, r = _matrix(pdf["unit"]), pdf["radius"].to_numpy()
        a = _angle(x @ x.T)
        lead, reach = np.full(len(x), -1), np.zeros(len(x))
        for i in range(len(x)):
            if lead[i] < 0:
                own = (lead < 0) & (a[i] + r <= most)
                own[i] = True
                lead[own], reach[own] = i, (a[i] + r)[own]
                reach[i] = r[i]
        return pd.DataFrame({"id": pdf["id"], "leader": pdf["id"].to_numpy()[lead], "reach": reach})
    return run


def _balls(t: Tables, units: DataFrame, n: int, near: float) -> tuple[DataFrame, DataFrame, int]:
    """Members (id, unit, leader) and leaders (id, unit, weight, radius) of the balls, and the number of leaders."""
    leaders = units.select("id", "unit", F.lit(1).cast("long").alias("weight"), F.lit(0.0).alias("radius"))
    members = units.select("id", F.col("id").alias("leader"))
    while True:
        k = max(1, min(CENTRES, n // SHARD))
        c = centres(_sampled(leaders, n, SAMPLE * k), k)

        def assign(batches: Iterator[pd.DataFrame], c: np.ndarray = c) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield b.assign(shard=_nearest(_matrix(b["unit"]), c, 1)[:, 0].astype(np.int64))

        at = t.cut(leaders.mapInPandas(assign, "id long, unit binary, weight long, radius double, shard long"), "at")
        sizes = at.groupBy("shard").count()
        # sizes has as many rows as there are centres
        salted = at.join(F.broadcast(sizes), "shard").withColumn("salt", F.pmod(F.xxhash64(F.lit(9), "id"), F.ceil(F.col("count") / SHARD)))
        one = not sizes.where(F.col("count") > SHARD).limit(1).count()
        joined = t.cut(salted.select("shard", "salt", "id", "unit", "radius").groupBy("shard", "salt").applyInPandas(_gather(near), "id long, leader long, reach double"), "joined")
        moved = joined.join(at.select("id", "weight"), "id").groupBy("leader").agg(F.sum("weight").alias("weight"), F.max("reach").alias("radius"))
        after = t.cut(moved.withColumnRenamed("leader", "id").join(at.select("id", "unit"), "id").select("id", "unit", "weight", "radius"), "leaders")
        members = t.cut(members.withColumnRenamed("leader", "was").join(joined.select(F.col("id").alias("was"), "leader"), "was").select("id", "leader"), "members")
        left = after.count()
        shrunk, n, leaders = left < 0.95 * n, left, after
        if one or not shrunk:
            return members.join(units, "id").select("id", "unit", "leader"), leaders, n


# ---------------------------------------------------------------- graph

def _pruned(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pruned neighbours of each leader of a shard."""
    ids, x = pdf["id"].to_numpy(), _matrix(pdf["unit"])
    n = len(ids)
    d = 1 - x @ x.T
    np.fill_diagonal(d, np.inf)
    pool = min(POOL, n - 1)
    out = []
    if pool > 0:
        first = np.argpartition(d, pool - 1, axis=1)[:, :pool]
        first = np.take_along_axis(first, np.argsort(np.take_along_axis(d, first, 1), axis=1, kind="stable"), 1)
    for i in range(n):
        kept: list[int] = []
        left = first[i] if pool > 0 else np.zeros(0, int)
        while len(left) and len(kept) < DEGREE:
            p, left = left[0], left[1:]
            kept.append(p)
            left = left[ALPHA * d[p, left] > d[i, left]]
        out.append(ids[kept])
    return pd.DataFrame({"id": ids, "next": out})


def _search(near: float, beam: int):
    """Pairs of leaders of one shard that the search finds within range of each other."""
    theta = math.acos(near)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x, r = pdf["id"].to_numpy(), _matrix(pdf["unit"]), pdf["radius"].to_numpy()
        n = len(ids)
        order = np.argsort(ids)
        cos = x @ x.T
        # the united lists, as far as the neighbours are in this shard
        lists = [np.asarray(v, np.int64) for v in pdf["next"]]
        many = np.array([len(v) for v in lists])
        to = np.concatenate(lists) if many.sum() else np.zeros(0, np.int64)
        own = np.repeat(np.arange(n), many)
        at = np.minimum(np.searchsorted(ids[order], to), n - 1)
        here = ids[order][at] == to
        # reached both ways
        a, b = own[here], order[at[here]]
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        pairs = np.unique(a * n + b)
        a, b = pairs // n, pairs % n
        degree = np.bincount(a, minlength=n)
        width = max(1, int(degree.max(initial=0)))
        table = np.full((n, width), -1)
        table[a, np.arange(len(a)) - np.repeat(np.cumsum(degree) - degree, degree)] = b
        medoid = int((x @ x.mean(0)).argmax())

        found = []
        for k in range(0, n, 256):
            q = np.arange(k, min(n, k + 256))
            seen = np.zeros((len(q), n), bool)  # in the beam once
            done = np.zeros((len(q), n), bool)  # expanded
            held = np.full((len(q), beam), -1)
            held[:, 0] = medoid
            seen[:, medoid] = True
            active = np.arange(len(q))
            while len(active):
                h = held[active]
                c = np.where(h >= 0, cos[q[active, None], h], -2.0)
                open_ = (h >= 0) & ~done[active[:, None], h]
                best = np.where(open_, c, -3.0).argmax(1)
                some = open_[np.arange(len(active)), best]
                active, h, c, best = active[some], h[some], c[some], best[some]
                if not len(active):
                    break
                node = h[np.arange(len(active)), best]
                done[active, node] = True
                new = table[node]
                fresh = (new >= 0) & ~seen[active[:, None], new]
                rows, cols = np.nonzero(fresh)
                seen[active[rows], new[rows, cols]] = True
                all_ = np.concatenate([h, np.where(fresh, new, -1)], 1)
                value = np.concatenate([c, np.where(fresh, cos[q[active, None], new], -2.0)], 1)
                top = np.argpartition(-value, beam - 1, axis=1)[:, :beam] if all_.shape[1] > beam else np.arange(all_.shape[1])[None, :].repeat(len(all_), 0)
                held[active] = np.take_along_axis(all_, top, 1)
            # range expansion: through everything within range
            limit = np.cos(np.minimum(theta + r[q][:, None] + r[None, :] + 1e-9, math.pi))
            within = cos[q] >= limit
            got = seen & within
            rows, cols = np.nonzero(got)
            while len(rows):
                new = table[cols]
                rows, new = np.repeat(rows, new.shape[1]), new.ravel()
                ok = new >= 0
                rows, new = rows[ok], new[ok]
                ok = within[rows, new] & ~got[rows, new]
                key = np.unique(rows[ok] * n + new[ok])
                rows, cols = key // n, key % n
                got[rows, cols] = True
            rows, cols = np.nonzero(got)
            ok = ids[q[rows]] != ids[cols]
            found.append(np.stack([ids[q[rows[ok]]], ids[cols[ok]]], 1))
        both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        both.sort(axis=1)
        both = np.unique(both, axis=0)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})
    return run


# ---------------------------------------------------------------- links

def _cos(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in pairs:
        if len(b):
            c = np.einsum("ij,ij->i", _matrix(b["unit_a"]), _matrix(b["unit_b"]))
            yield b.drop(columns=["unit_a", "unit_b"]).assign(cos=c)


def _linked(t: Tables, pairs: DataFrame, members: DataFrame, leaders: DataFrame, near: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) of leaders whose balls link, and (id, links) that vectors have outside their balls."""
    theta = math.acos(near)
    la = leaders.select(F.col("id").alias("a"), F.col("unit").alias("unit_a"), F.col("weight").alias("weight_a"), F.col("radius").alias("radius_a"))
    lb = leaders.select(F.col("id").alias("b"), F.col("unit").alias("unit_b"), F.col("weight").alias("weight_b"), F.col("radius").alias("radius_b"))
    known = pairs.join(la, "a").join(lb, "b").select("a", "b", "weight_a", "weight_b", "radius_a", "radius_b", "unit_a", "unit_b")
    known = known.mapInPandas(_cos, "a long, b long, weight_a long, weight_b long, radius_a double, radius_b double, cos double")
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos"))))
    spread = F.col("radius_a") + F.col("radius_b")
    known = known.withColumn("kind", F.when((spread == 0) & (F.col("cos") >= near), "whole").when(spread == 0, "none")
                             .when(angle + spread <= theta - 1e-9, "whole").when(angle - spread > theta + 1e-9, "none").otherwise("some"))
    known = t.cut(known, "known")
    whole = known.where("kind = 'whole'").select("a", "b", "weight_a", "weight_b")
    some = known.where("kind = 'some'").select("a", "b")
    # the others vector by vector: first the vectors of one ball against the other's leader
    both = some.union(some.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("a", "b")
    ma = members.select(F.col("leader").alias("a"), F.col("id").alias("x"), F.col("unit").alias("unit_a"))
    near_ball = both.join(ma, "a").join(lb, "b").select("a", "b", "x", "weight_b", "radius_b", "unit_a", "unit_b", F.col("unit_a").alias("unit"))
    near_ball = near_ball.mapInPandas(_cos, "a long, b long, x long, weight_b long, radius_b double, unit binary, cos double")
    near_ball = t.cut(near_ball.where(angle - F.col("radius_b") <= theta + 1e-9).withColumn("all", (F.col("radius_b") > 0) & (angle + F.col("radius_b") <= theta - 1e-9)), "against")
    mb = members.select(F.col("leader").alias("b"), F.col("id").alias("y"), F.col("unit").alias("unit_b"))
    one = near_ball.where("NOT all").select("a", "b", "x", F.col("unit").alias("unit_a")).join(mb, "b")
    one = one.select("a", "b", "x", "y", "unit_a", "unit_b").mapInPandas(_cos, "a long, b long, x long, y long, cos double").where(F.col("cos") >= near)
    each = t.cut(near_ball.where("all").select("a", "b", F.col("x").alias("id"), F.col("weight_b").alias("links"))
                 .union(one.groupBy("a", "b", "x").agg(F.count("*").alias("links")).toDF("a", "b", "id", "links")), "each")
    edges = whole.select("a", "b").union(each.select("a", "b")).distinct()
    by_ball = whole.select("a", F.col("weight_b").alias("n")).union(whole.select("b", "weight_a")).groupBy("a").agg(F.sum("n").alias("n"))
    outside = members.select("id", "leader").join(by_ball, F.col("leader") == F.col("a")).select("id", F.col("n").alias("links"))
    links = outside.union(each.select("id", "links")).groupBy("id").agg(F.sum("links").alias("links"))
    return edges, links


def _audited(members: DataFrame, leaders: DataFrame, outside: DataFrame, n_leaders: int, near: float) -> float:
    """The mean share of a vector's links outside its ball, counted by brute force for a vector of each sampled ball, that was found."""
    sample = leaders.where(F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(1_000_000)) < math.ceil(min(1.0, 2 * AUDIT / n_leaders) * 1_000_000))
    sample = sample.select(F.col("id").alias("leader")).orderBy(F.xxhash64(F.lit(13), "leader"), "leader").limit(AUDIT)
    one = members.join(F.broadcast(sample), "leader").groupBy("leader").agg(F.min(F.struct(F.xxhash64(F.lit(14), "id"), "id", "unit")).alias("one"))
    rows = one.select("leader", "one.id", "one.unit").collect()
    if not rows:
        return 1.0
    ids, own = np.array([r["id"] for r in rows], np.int64), np.array([r["leader"] for r in rows], np.int64)
    q = np.stack([np.frombuffer(r["unit"], np.float64) for r in rows])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            for k in range(0, len(b), 2000):
                c = b.iloc[k:k + 2000]
                total += ((q @ _matrix(c["unit"]).T >= near) & (own[:, None] != c["leader"].to_numpy()[None, :])).sum(1)
        yield pd.DataFrame({"id": ids, "n": total})

    true = members.select("leader", "unit").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("true")).where(F.col("true") > 0)
    found = true.join(outside, "id", "left").agg(F.avg(F.least("true", F.coalesce("links", F.lit(0))) / F.col("true"))).first()[0]
    return 1.0 if found is None else found


def _all_pairs(leaders: DataFrame, n: int, near: float) -> DataFrame:
    """(a, b) of all leaders within range of each other: every block of leaders against every block."""
    theta, blocks = math.acos(near), max(1, math.ceil(n / SHARD))
    block = F.pmod(F.xxhash64(F.lit(15), "id"), F.lit(blocks))
    d = leaders.select("id", "unit", "radius", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("other"))
    d = d.select("id", "unit", "radius", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["block"] == pdf["i"]], pdf[pdf["block"] == pdf["j"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        limit = np.cos(np.minimum(theta + left["radius"].to_numpy()[:, None] + right["radius"].to_numpy()[None, :] + 1e-9, math.pi))
        rows, cols = np.nonzero(_matrix(left["unit"]) @ _matrix(right["unit"]).T >= limit)
        a, b = left["id"].to_numpy()[rows], right["id"].to_numpy()[cols]
        both = np.sort(np.stack([a, b], 1)[a != b], axis=1)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})
    return d.groupBy("i", "j").applyInPandas(run, "a long, b long").distinct()


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", near: float = NEAR, overlap: int = 4, beam: int = 16, recall: float = 0.99) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audit_recall`` for each row of ``embeddings``.

    Null, zero and empty vectors, vectors with null or non-finite components,
    vectors of another length than most and rows with a null id link with
    nothing. Rows with one id are one vector (of different ones the least) and
    all get its result, none of them counting as another. An empty table gives
    none. Other columns are ignored.
    """
    t = Tables(embeddings.sparkSession, "near-vectors")
    e = embeddings.select(embeddings[id_col].cast("long").alias("id"), embeddings[vector_col].cast("array<double>").alias("embedding"))
    rows = t.cut(e.mapInPandas(_unit, "id long, unit binary"), "rows")
    one = rows.where("id IS NOT NULL AND unit IS NOT NULL").groupBy("id").agg(F.min("unit").alias("unit"))
    length = one.groupBy(F.length("unit").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if length is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"), F.lit(1.0).alias("audit_recall"))
    units = t.cut(one.where(F.length("unit") == length["length"]), "units")
    n = units.count()
    members, leaders, n_leaders = _balls(t, units, n, near)
    members = t.cut(members, "members")
    inside = members.join(leaders.select(F.col("id").alias("leader"), "weight"), "leader").select("id", "leader", (F.col("weight") - 1).alias("inside"))
    exact = False
    while True:
        if exact:
            pairs = _all_pairs(leaders, n_leaders, near)
        else:
            shards = _sharded(t, leaders, n_leaders, overlap)
            graph = shards.select("shard", "id", "unit").groupBy("shard").applyInPandas(_pruned, "id long, next array<long>")
            graph = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next"))
            searched = shards.join(graph, "id").select("shard", "id", "unit", "radius", "next")
            pairs = searched.groupBy("shard").applyInPandas(_search(near, beam), "a long, b long").distinct()
        edges, outside = _linked(t, t.cut(pairs, "pairs"), members, leaders, near)
        outside = t.cut(outside, "outside")
        share = _audited(members, leaders, outside, n_leaders, near)
        if share >= recall or exact:
            break
        exact = overlap >= CENTRES
        overlap, beam = 2 * overlap, 2 * beam
    links = t.cut(inside.join(outside, "id", "left").select("id", "leader", (F.col("inside") + F.coalesce("links", F.lit(0))).alias("links")), "links")
    roots = components(t, edges)
    named = links.join(roots, links["leader"] == roots["node"], "left").select("id", "links", F.coalesce("root", "leader").alias("root"))
    least = t.cut(named.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    result = named.join(least, "root").select("id", "links", "component_id")
    out = rows.select("id").join(result, "id", "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"), F.lit(float(share)).alias("audit_recall"))
