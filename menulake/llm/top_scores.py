"""Exact top-k search by inner product with a three-phase uniform threshold (operator 11).

Vectors become integers, floor(scale * x), and are cut into ``LISTS`` runs of
components. The score of a query and a vector is the sum of their scores in the
lists, and a list is only known piece by piece: a task holds one list of one
block of vectors.

1. Every list gives each query its ``DEPTH`` best entries. The vectors seen are scored
   in full; the k-th best of them, tau, is a lower bound of the k-th best score.
2. A vector whose score in each of m lists is below tau / m can't reach tau. This
   cutoff goes to all lists, and each sends its entries that are not below it. It
   is raised for a list where even the best scores in all others would not lift an
   entry to tau.
3. What a vector's other lists may add is bounded by their cutoffs. Vectors whose
   upper bound is below the k-th best lower bound go; the rest is scored in
   full, and the k best are the result.

Of vectors equal in all components only the k + 1 with the least ids can be among
the k best of a query (one may be the query itself), so a vector with very many
copies stands k + 1 times among the candidates. Queries and candidates meet block
by block: the queries of a list are sent to groups of its blocks, whose number
grows with the square root of the table, so that what is sent grows more slowly
than the products that are due. No frame pairs single rows before the cutoff.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from menulake.llm.common import Tables

SCALE, TOP, EVERY = 256, 5, 50
LISTS, DEPTH = 2, 32
#: Vectors to a block of candidates, and queries to a block.
BLOCK, QUERY_BLOCK = 4_096, 512
#: Components and scores in a list are held within these bounds, so that sums fit into a long.
_WIDE, _HELD = 2 ** 62, 2 ** 60

VECTOR = "vec_id long, vec binary, dims int"


def _quantized(scale: int):
    """The vectors that take part, as a byte that tells the width and little-endian integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            x = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            finite = np.isfinite(x)
            n = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(n)
            bad = np.concatenate([[0], np.cumsum(~finite)])
            ok = col.is_valid().to_numpy(zero_copy_only=False) & (bad[end] == bad[end - n])
            with np.errstate(over="ignore"):
                q = np.floor(np.clip(np.where(finite, x, 0) * scale, -float(_WIDE), float(_WIDE))).astype(np.int64)
            vec = []
            for i in np.flatnonzero(ok):
                v = q[end[i] - n[i]:end[i]]
                small = not len(v) or (v.min() >= -32768 and v.max() <= 32767)
                vec.append(b"\x02" + v.astype("<i2").tobytes() if small else b"\x08" + v.astype("<i8").tobytes())
            kept = b.column(0).filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept, pa.array(vec, pa.binary()), pa.array(n[ok], pa.int32())], ["vec_id", "vec", "dims"])
    return run


def _integers(vec: bytes) -> np.ndarray:
    return np.frombuffer(vec, "<i2" if vec[0] == 2 else "<i8", offset=1)


def _matrix(vecs: list[bytes], dims: int) -> np.ndarray:
    """Rows of integers, shorter vectors filled up with zeros."""
    rows = [_integers(v) for v in vecs]
    out = np.zeros((len(rows), dims), np.int64)
    for r, v in zip(out, rows, strict=True):
        r[:len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exact: in doubles where all sums are below 2**53, else in Python's integers, held within bounds."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -_HELD, _HELD).astype(np.int64)


def _bounds(dims: int, lists: int) -> list[tuple[int, int]]:
    cuts = [dims * k // lists for k in range(lists + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _blocks(bounds: list[tuple[int, int]], size: int, cut: bool):
    """Rows (list, block, rows, matrix): blocks of vectors cut into lists; with ``cut``, their cutoffs by list too."""
    dims = bounds[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for b in batches:
            for k in range(0, b.num_rows, size):
                c = b.slice(k, size)
                m = _matrix(c.column(1).to_pylist(), dims)
                rows = c.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                narrow = np.abs(m).max(initial=0) <= 32767
                parts = [m[:, lo:hi].astype("<i2" if narrow else "<i8").tobytes() for lo, hi in bounds]
                n = len(bounds)
                cols = [pa.array(range(n), pa.int32()), pa.array([block] * n, pa.int64()), pa.array([rows] * n, pa.binary()), pa.array(parts, pa.binary())]
                if cut:
                    cuts = np.stack(c.column(2).to_pylist()).astype("<i8")
                    cols.append(pa.array([cuts[:, j].tobytes() for j in range(n)], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["list", "block", "rows", "matrix", "cuts"][:len(cols)])
                block += 1
    return run


def _unpacked(rows: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(rows, "<i8")
    return at, np.frombuffer(matrix, "<i2" if len(matrix) == 2 * width * len(at) else "<i8").reshape(len(at), width)


def _pairs(b: pa.RecordBatch, bounds: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(list, query rows, candidate rows, scores, row of the batch) of each pair of blocks."""
    for i in range(b.num_rows):
        j, q_rows, q_matrix, c_rows, c_matrix = (b.column(k)[i].as_py() for k in ("list", "q_rows", "q_matrix", "c_rows", "c_matrix"))
        width = bounds[j][1] - bounds[j][0]
        q, qm = _unpacked(q_rows, q_matrix, width)
        c, cm = _unpacked(c_rows, c_matrix, width)
        s = _products(qm.astype(np.int64), cm.astype(np.int64))
        yield j, q, c, s, i


ENTRIES = "query long, list int, row array<long>, score array<long>, low long, high long"


def _lists_of(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values]), pa.int64()))


def _entries(q, j, rows, scores, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(j, pa.int32()), _lists_of(rows), _lists_of(scores), pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["query", "list", "row", "score", "low", "high"])


def _best(bounds: list[tuple[int, int]], depth: int):
    """Each query's best entries of a list, without its own row, and its least and greatest score there; merged while a block of queries goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # list, queries, rows, scores, low, high

        def told() -> pa.RecordBatch:
            j, q, rows, scores, low, high = held
            real = [r >= 0 for r in rows]
            return _entries(q, [j] * len(q), [r[x] for r, x in zip(rows, real, strict=True)], [s[x] for s, x in zip(scores, real, strict=True)], low, high)

        for b in batches:
            for j, q, c, s, _ in _pairs(b, bounds):
                own = q[:, None] == c[None, :]
                low = np.where(own, _HELD, s).min(1, initial=_HELD)
                s = np.where(own, -_HELD - 1, s)
                high = s.max(1, initial=-_HELD - 1)
                top = np.argpartition(-s, depth - 1, axis=1)[:, :depth] if s.shape[1] > depth else np.broadcast_to(np.arange(s.shape[1]), s.shape)
                score = np.take_along_axis(s, top, 1)
                rows = np.where(score > -_HELD - 1, c[top], -1)
                if held is not None and held[0] == j and np.array_equal(held[1], q):
                    rows, score = np.concatenate([held[2], rows], 1), np.concatenate([held[3], score], 1)
                    keep = np.argsort(-score, axis=1, kind="stable")[:, :depth]
                    rows, score = np.take_along_axis(rows, keep, 1), np.take_along_axis(score, keep, 1)
                    low, high = np.minimum(low, held[4]), np.maximum(high, held[5])
                elif held is not None:
                    yield told()
                held = j, q, rows, score, low, high
        if held is not None:
            yield told()
    return run


def _above(bounds: list[tuple[int, int]]):
    """Each query's entries of a list that are not below its cutoff there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j, q, c, s, i in _pairs(b, bounds):
                cuts = np.frombuffer(b.column("cuts")[i].as_py(), "<i8")
                hit = (s >= cuts[:, None]) & (q[:, None] != c[None, :])
                at, of = np.nonzero(hit)
                ends = np.searchsorted(at, np.arange(len(q) + 1))
                some = np.flatnonzero(np.diff(ends))
                score = s[at, of]
                row = c[of]
                yield _entries(q[some], [j] * len(some), [row[ends[k]:ends[k + 1]] for k in some], [score[ends[k]:ends[k + 1]] for k in some], [0] * len(some), [0] * len(some))
    return run


def _resolve(bounds: list[tuple[int, int]]):
    """The whole score of each pair: what is known, and the products of the lists that aren't."""
    dims = bounds[-1][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 4_096):
                c = b.slice(k, 4_096)
                x, y = _matrix(c.column("x").to_pylist(), dims), _matrix(c.column("y").to_pylist(), dims)
                known = c.column("lists").to_numpy(zero_copy_only=False)
                total = c.column("known").to_numpy(zero_copy_only=False).astype(np.int64)
                for j, (lo, hi) in enumerate(bounds):
                    at = np.flatnonzero(known & (1 << j) == 0)
                    u, v = x[at, lo:hi], y[at, lo:hi]
                    if float(np.abs(u).max(initial=0)) * float(np.abs(v).max(initial=0)) * (hi - lo) < 2 ** 62:
                        total[at] += (u * v).sum(1)
                    else:
                        total[at] += np.clip((u.astype(object) * v.astype(object)).sum(1), -_HELD, _HELD).astype(np.int64)
                yield pa.RecordBatch.from_arrays([c.column("query"), c.column("row"), pa.array(total)], ["query", "row", "score"])
    return run


def top_scores(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, every: int = EVERY, scale: int = SCALE, lists: int = LISTS, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best inner products of each query row with all other rows.

    Queries are the rows whose id is divisible by ``every``. Ties go to the smaller id, a
    null id last. Vectors that are null or hold null or non-finite components
    take no part; shorter vectors count as filled up with zeros, so an empty one
    scores 0. A null id is no query. Repeated rows are rows of their own: each is
    a query, and a candidate of the others. Fewer candidates give fewer ranks;
    an empty table gives none. Components are held within 2**62, and scores of a list
    that could pass 2**53 within 2**60. Other columns are ignored.
    """
    if depth < top:
        raise ValueError("depth must be top or more")
    spark = embeddings.sparkSession
    t = Tables(spark, "top-scores")
    v = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), embeddings[vec_col].alias("embedding")).mapInArrow(_quantized(scale), VECTOR)
    v = t.cut(v.withColumn("row", F.monotonically_increasing_id()), "vectors")
    dims = v.agg(F.max("dims")).first()[0]
    bounds = _bounds(dims or 0, lists)
    first = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    candidates = t.cut(v.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= top + 1).select("row", "vec_id", "vec"), "candidates")
    queries = t.cut(v.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vec"), "queries")

    columns = "list int, block long, rows binary, matrix binary"
    held = t.cut(candidates.select("row", "vec").mapInArrow(_blocks(bounds, block, False), columns), "lists")
    n_blocks = held.where("list = 0").count()
    groups = max(1, math.ceil(2 * math.sqrt(n_blocks)))
    tasks = 2 * groups * lists
    held = held.select("list", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"), F.col("rows").alias("c_rows"), F.col("matrix").alias("c_matrix")).repartition(tasks, "list", "group")

    def met(packed: DataFrame) -> DataFrame:
        """All blocks of queries with all blocks of candidates, list by list and group by group."""
        sent = packed.withColumnsRenamed({"rows": "q_rows", "matrix": "q_matrix"}).drop("block").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        return sent.repartition(tasks, "list", "group").hint("merge").join(held, ["list", "group"])

    # phase 1: the best entries of each list, and the k-th best of their whole scores
    packed = queries.select("row", "vec").mapInArrow(_blocks(bounds, QUERY_BLOCK, False), columns)
    local = t.cut(met(packed).mapInArrow(_best(bounds, depth), ENTRIES), "local")
    ends = local.groupBy("query", "list").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ends = ends.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("list", F.struct("low", "high")))).alias("ends"))  # a row a list
    each = Window.partitionBy("query", "list").orderBy(F.col("score").desc(), "row")
    seen = local.select("query", "list", F.explode(F.arrays_zip("row", "score")).alias("e")).select("query", "list", "e.row", "e.score")
    seen = seen.withColumn("at", F.row_number().over(each)).where(F.col("at") <= depth)

    def known(entries: DataFrame) -> DataFrame:
        """A row a pair: the sum of its known lists, and which they are."""
        return entries.groupBy("query", "row").agg(F.sum("score").alias("known"), F.expr("bit_or(shiftleft(1, list))").alias("lists"))

    def resolved(pairs: DataFrame) -> DataFrame:
        both = pairs.join(queries.select(F.col("row").alias("query"), F.col("vec").alias("x")), "query").join(candidates.select("row", F.col("vec").alias("y")), "row")
        return both.select("query", "row", "known", F.col("lists").cast("long").alias("lists"), "x", "y").mapInArrow(_resolve(bounds), "query long, row long, score long")

    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "row")

    def kth(scores: DataFrame, name: str) -> DataFrame:
        """The k-th best score of each query; queries with fewer have none."""
        best = scores.withColumn("at", F.row_number().over(by_score)).where(F.col("at") <= top)
        return best.groupBy("query").agg(F.min("score").alias(name), F.count("*").alias("n")).where(F.col("n") >= top).drop("n")

    tau = kth(resolved(known(seen)), "tau")

    # phase 2: every entry that is not below the uniform cutoff; its list's best partners may not suffice
    share = F.expr(f"(tau + pmod(-tau, {lists}L)) div {lists}L")  # rounded up

    def end(j: int, what: str) -> Column:
        return F.col("ends")[j][what]
    limits = ends.join(tau, "query", "left")
    for j in range(lists):
        others = sum((end(i, "high") for i in range(lists) if i != j), F.lit(0).cast("long"))
        limits = limits.withColumn(f"cut{j}", F.coalesce(F.greatest(share, F.col("tau") - others), F.lit(-_HELD - 1)))
    limits = t.cut(limits.select("query", "tau", F.array(*(F.col(f"cut{j}") for j in range(lists))).alias("cuts"),
                                 F.array(*(end(j, "low") for j in range(lists))).alias("lows"), F.array(*(end(j, "high") for j in range(lists))).alias("highs")), "limits")
    packed = queries.join(limits, queries["row"] == limits["query"]).select("row", "vec", "cuts").mapInArrow(_blocks(bounds, QUERY_BLOCK, True), columns + ", cuts binary")
    sent = met(packed).mapInArrow(_above(bounds), ENTRIES).select("query", "list", F.explode(F.arrays_zip("row", "score")).alias("e")).select("query", "list", "e.row", "e.score")
    sent = known(sent).join(limits, "query")

    # phase 3: bounds of what is unknown, then whole scores of the rest
    def plus(values: list) -> Column:
        missing = (F.when(F.col("lists").bitwiseAND(F.lit(1 << j)) == 0, x).otherwise(F.lit(0)) for j, x in enumerate(values))
        return sum(missing, F.col("known"))
    sent = t.cut(sent.select("query", "row", "known", "lists", "tau", plus([F.col("lows")[j] for j in range(lists)]).alias("score"),
                             plus([F.least(F.col("highs")[j], F.col("cuts")[j] - 1) for j in range(lists)]).alias("upper")), "sent")
    left = sent.join(kth(sent.select("query", "row", "score"), "raised"), "query", "left")
    left = left.where(F.col("upper") >= F.coalesce(F.greatest("tau", "raised"), F.lit(-2 * _HELD * lists)))
    scores = resolved(left.select("query", "row", "known", "lists"))
    named = scores.join(candidates.select("row", "vec_id"), "row").join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query")
    ranks = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return named.withColumn("rank", F.row_number().over(ranks).cast("int")).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
