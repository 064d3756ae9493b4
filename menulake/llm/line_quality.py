"""Document quality from a linear-chain conditional random field over lines (operator 2).

Every line is good or bad. Its features are those of the line and of the lines
before and behind it; neighbouring labels are tied by learned transitions.
Forward-backward gives each line's probability of being good, and the mean of
those, weighted by line length, is the document's score.

The field is fitted on the driver on a bounded sample: ``max_docs`` labelled
documents (those with the lowest hash of their id) and of each at most
``max_lines`` lines. Their features are computed on the executors. Scoring reads
every line of every text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import columns, text_of

MAX_DOCS, MAX_LINES = 4000, 64
OWN = 13
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _BAR, _OTHER = range(7)
_classes: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    """The kind of each code point of the basic plane."""
    if not _classes:
        kinds = np.full(65_536, _OTHER, np.uint8)
        for i in range(65_536):
            c = chr(i)
            if c.isalpha():
                kinds[i] = _UPPER if c.isupper() else _LOWER
            elif c.isdigit():
                kinds[i] = _DIGIT
            elif c.isspace():
                kinds[i] = _SPACE
        kinds[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
        kinds[ord("|")] = _BAR
        _classes.append(kinds)
    return _classes[0]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line that has text (lines x 3 OWN + 2) and the lines' lengths."""
    ls = [x for x in text.split("\n") if x and not x.isspace()]
    if not ls:
        return np.zeros((0, 3 * OWN + 2), np.float32), np.zeros(0)
    n = np.array([len(x) for x in ls])
    points = np.frombuffer("".join(ls).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _class_of()[np.minimum(points, 65_535)]
    starts = np.cumsum(n) - n
    share = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in (_UPPER, _DIGIT, _STOP, _BAR, _OTHER)], 1) / n[:, None]
    often = Counter(ls)
    own = np.empty((len(ls), OWN), np.float32)
    own[:, :5] = share
    for i, x in enumerate(ls):
        w = x.split()
        k = len(w)
        own[i, 5:] = (
            math.log1p(k), len(x) / k, len(set(w)) / k, sum(map(eq, w, w[1:])) / k,
            often[x] > 1, k < 4, x[-1] in ".!?", x[0].isupper(),
        )
    own[:, 6] = np.minimum(own[:, 6], 40) / 10
    out = np.zeros((len(ls), 3 * OWN + 2), np.float32)
    out[:, :OWN] = own
    out[1:, OWN:2 * OWN] = own[:-1]
    out[:-1, 2 * OWN:3 * OWN] = own[1:]
    out[0, -2] = out[-1, -1] = 1
    return out, n.astype(np.float64)


class Field(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # log odds of good: features, then the constant
    ties: np.ndarray  # 2 x 2, from a line's label to the next one's
    prior: float  # for texts without lines


def _passed(odds, ties):
    """Log odds of the next label, given the log odds of this one."""
    return np.logaddexp(odds + ties[1, 1], ties[0, 1]) - np.logaddexp(odds + ties[1, 0], ties[0, 0])


def marginals(unary: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """The probability of good for each line of one text (forward-backward on log odds)."""
    t00, t01, t10, t11 = (float(x) for x in ties.ravel())
    e, log = math.exp, math.log

    def step(x: float, to: tuple[float, float, float, float]) -> float:
        a, b, c, d = to  # bad-bad, bad-good, good-bad, good-good
        if x > 0:
            return log((e(d) + e(b - x)) / (e(c) + e(a - x)))
        return log((e(d + x) + e(b)) / (e(c + x) + e(a)))

    n, u = len(unary), unary.tolist()
    ahead, back = [0.0] * n, 0.0
    ahead[0] = u[0]
    for i in range(1, n):
        ahead[i] = u[i] + step(ahead[i - 1], (t00, t01, t10, t11))
    for i in range(n - 2, -1, -1):
        back = step(back + u[i + 1], (t00, t10, t01, t11))
        ahead[i] += back
    return 1 / (1 + np.exp(-np.clip(ahead, -60, 60)))


def fit(texts: list[tuple[np.ndarray, int]], rounds: int = 150, ridge: float = 1e-3) -> Field:
    """The field for (features of a text's lines, its label) by gradient ascent on the likelihood."""
    labels = [y for _, y in texts]
    prior = (sum(labels) + 1) / (len(labels) + 2)
    texts = sorted((t for t in texts if len(t[0])), key=lambda t: -len(t[0]))
    width = 3 * OWN + 2
    if len({y for _, y in texts}) < 2:
        return Field(np.zeros(width), np.ones(width), np.append(np.zeros(width), math.log(prior / (1 - prior))), np.zeros((2, 2)), prior)
    sizes = np.array([len(x) for x, _ in texts])
    all_ = np.concatenate([x for x, _ in texts]).astype(np.float64)
    mean, scale = all_.mean(0), np.maximum(all_.std(0), 1e-6)
    all_ = np.hstack([(all_ - mean) / scale, np.ones((len(all_), 1))])
    y = np.array([y for _, y in texts], np.float64)
    # line i of text d is row at[d] + i; the longest texts come first
    at, longest = np.cumsum(sizes) - sizes, int(sizes[0])
    with_line = [int((sizes > i).sum()) for i in range(longest)]
    rows = [at[:k] + i for i, k in enumerate(with_line)]
    target = np.repeat(y, sizes)
    params = np.zeros(width + 1 + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    want = np.array([[(1 - y) @ (sizes - 1), 0], [0, y @ (sizes - 1)]])
    for t in range(1, rounds + 1):
        w, ties = params[:-4], params[-4:].reshape(2, 2)
        u = all_ @ w
        ahead, back = u.copy(), np.zeros_like(u)
        for i in range(1, longest):
            ahead[rows[i]] += _passed(ahead[rows[i - 1][:with_line[i]]], ties)
        for i in range(longest - 2, -1, -1):
            k = with_line[i + 1]
            back[rows[i][:k]] = _passed(back[rows[i + 1]] + u[rows[i + 1]], ties.T)
        good = 1 / (1 + np.exp(-np.clip(ahead + back, -60, 60)))
        first = np.concatenate([rows[i - 1][:with_line[i]] for i in range(1, longest)]) if longest > 1 else np.zeros(0, int)
        a, b = ahead[first], back[first + 1] + u[first + 1]
        pair = np.stack([ties[0, 0] + 0 * a, ties[0, 1] + b, ties[1, 0] + a, ties[1, 1] + a + b], 1)
        pair = np.exp(pair - pair.max(1, keepdims=True)) if len(pair) else pair
        seen = (pair / pair.sum(1, keepdims=True)).sum(0).reshape(2, 2) if len(pair) else np.zeros((2, 2))
        grad = np.concatenate([all_.T @ (target - good), (want - seen).ravel()]) / len(all_) - ridge * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return Field(mean, scale, params[:-4], params[-4:].reshape(2, 2), prior)


def score(text: str, field: Field) -> float:
    x, n = features(text)
    if not len(n):
        return field.prior
    unary = ((x - field.mean) / field.scale) @ field.weights[:-1] + field.weights[-1]
    return float(n @ marginals(unary, field.ties) / n.sum())


def _sample(max_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py())[0][:max_lines].tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], ["label", "features"])
    return run


def _scores(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([score(t.as_py(), field) for t in b.columns[-1]], pa.float64())], [*b.schema.names[:-1], "score"])
    return run


def held_out(id_col: str = "doc_id"):
    """True for the third of the ids that no fit may see; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Field:
    """The field fitted on labelled documents that are not held out.

    A document whose labels differ, or whose label is null, isn't used. Without
    documents of both kinds the field gives every text the share of good ones.
    """
    known = columns(labels, doc_id=id_col, label=label_col).where(~held_out() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most AND label IN (0, 1)")
    known = known.select("doc_id", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    d = columns(docs, doc_id=id_col, text=text_col)
    d = d.join(F.broadcast(known), "doc_id")  # max_docs rows at most
    rows = d.select("label", text_of().alias("text")).mapInArrow(_sample(max_lines), "label int, features binary").collect()
    rows = sorted((int(r["label"]), bytes(r["features"])) for r in rows)  # the order of the rows doesn't matter
    return fit([(np.frombuffer(x, np.float32).reshape(-1, 3 * OWN + 2), y) for y, x in rows])


def line_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **bounds: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    A text that is null or has no lines scores the share of good documents in
    the sample; repeated rows each get a row; an empty table gives none. Other
    columns are ignored.
    """
    field = fit_quality(docs, labels, id_col, text_col, label_col, **bounds)
    d = columns(docs, doc_id=id_col, text=text_col)
    d = d.select("doc_id", held_out().alias("held_out"), text_of().alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    out = d.mapInArrow(_scores(field), f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **bounds: int) -> DataFrame:
    """The rows of ``docs`` that the field calls good, with all their columns."""
    field = fit_quality(docs, labels, id_col, text_col, label_col, **bounds)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [score(t.as_py() or "", field) >= 0.5 for t in b.column(at)]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
