"""Token counts per document from counts per distinct pre-token (operator 3).

The tokenizer merges symbols only inside a run of spaces with the word behind
it, and a line feed always stands alone, so the count of a text is the sum over
its pre-tokens. Each distinct pre-token is tokenized once; its count is joined
to the per-document frequencies and summed. No ids are kept.

Frequencies travel by block: a task gathers the documents it reads into blocks
of at most ``block_chars`` characters and sends one row for each distinct
pre-token of the block, with the block's documents and frequencies packed into
it. A pre-token found in every document therefore has one row a block, and the
join splits it like any skewed key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import columns, text_of

MODEL = "piece_bpe_32k.model"
#: Stands for "the documents of this block"; no pre-token has two line feeds.
DOCS = "\n\n"
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("bytes", "<i8")])
_SUM = np.dtype([("doc", "<u2"), ("sum", "<u4")])
_SLOW = re.compile(r"\n[^ \n]*| +[^ \n]*")
_models: dict = {}


def model(path: str | None):
    """The sentencepiece model, loaded once a Python worker."""
    if path not in _models:
        import sentencepiece
        if path is None:
            import public_tokenizers
            file = public_tokenizers.path(MODEL)
        else:
            file = path
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=file)
    return _models[path]


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text; the space in front of each is left out, a line feed in front stays.

    >>> pretokens("a  b\\nc")
    ['a', ' b', '\\nc']
    """
    if not text:
        return []
    t = text.replace("▁", " ")
    toks = t.replace("\n", " \n").split(" ")
    if "" not in toks:
        return toks
    return [p if p[0] == "\n" else p[1:] for p in _SLOW.findall(" " + t)]


def piece_counts(pieces: list[str], path: str | None = None) -> list[int]:
    """Tokens of each pre-token within a text."""
    ids = model(path).encode(pieces, num_threads=1)
    return [1 if not p else len(x) - (p[0] == "\n") for p, x in zip(pieces, ids, strict=True)]


class _Vocab(dict):
    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple]:
    """(vocabulary, triples of (piece, doc, freq), documents) of each block."""
    vocab, parts, docs, chars = _Vocab(), [], [], 0
    for b in batches:
        for i, size, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            text = text.as_py()
            toks = pretokens(text)
            if toks:
                ids = np.fromiter(map(vocab.__getitem__, toks), np.int32, len(toks))
                u, n = np.unique(ids, return_counts=True)
                parts.append((u, np.full(len(u), len(docs), np.int32), n.astype(np.int32)))
            docs.append((0 if i is None else i, i is None, size))
            chars += len(text)
            if chars >= block_chars or len(docs) == 65_000:
                yield vocab, parts, docs
                vocab, parts, docs, chars = _Vocab(), [], [], 0
    if docs:
        yield vocab, parts, docs


def _places(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries of lists of so many pairs lie: a list has all its documents, two bytes each, then all frequencies."""
    begin = np.repeat(3 * (np.cumsum(many) - many), many)
    j = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return begin + 2 * j, begin + 2 * np.repeat(many, many) + j


def _frequencies(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (vocab, parts, docs) in enumerate(_blocks(batches, block_chars)):
            block = task * 2**32 + k
            listed = np.array(docs, dtype=_DOC).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([DOCS]), pa.array([block]), pa.array([listed], pa.binary())], ["piece", "block", "docs"])
            if not vocab:
                continue
            piece, doc, freq = (np.concatenate(x) for x in zip(*parts, strict=True))
            # a frequency takes one byte; larger ones take several entries
            again = (freq + 254) // 255
            piece, doc = np.repeat(piece, again), np.repeat(doc, again)
            rest = np.full(len(piece), 255, np.int64)
            rest[np.cumsum(again) - 1] = freq - (again - 1) * 255
            # pieces in code point order: neighbours share beginnings, which the shuffle's compression finds
            names = sorted(vocab)
            rank = np.empty(len(names), np.int64)
            rank[[vocab[x] for x in names]] = np.arange(len(names))
            piece = rank[piece]
            order = np.argsort(piece, kind="stable")
            many = np.bincount(piece, minlength=len(names))
            ends = np.cumsum(many) * 3
            flat = np.empty(3 * len(order), np.uint8)
            at, freqs_at = _places(many)
            flat[at], flat[at + 1] = doc[order] & 255, doc[order] >> 8
            flat[freqs_at] = rest[order]
            flat = flat.tobytes()
            for a in range(0, len(names), 50_000):
                b = min(a + 50_000, len(names))
                start = int(ends[a - 1]) if a else 0
                offsets = np.concatenate([[0], ends[a:b] - start]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(flat[start:int(ends[b - 1])])])
                yield pa.RecordBatch.from_arrays([pa.array(names[a:b], pa.string()), pa.array(np.full(b - a, block)), packed], ["piece", "block", "docs"])
    return run


def _distinct(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([DOCS])], ["piece"])
        for vocab, _, _ in _blocks(batches, block_chars):
            names = sorted(vocab)
            for a in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(names[a:a + 50_000], pa.string())], ["piece"])
    return run


def _count(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces = b.column(0).to_pylist()
            counts = [0 if p == DOCS else None for p in pieces]
            real = [p for p in pieces if p != DOCS]
            rest = iter(piece_counts(real, path) if real else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([next(rest) if c is None else c for c in counts], pa.int64())], ["piece", "n"])
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the pieces a task sees, a row for each block; documents of a block pass through."""
    keys, sums, held = [], [], 0

    def packed():
        k, inv = np.unique(np.concatenate(keys), return_inverse=True)
        return k, np.bincount(inv, np.concatenate(sums)).astype(np.int64)

    def rows():
        k, s = packed()
        at = np.flatnonzero(np.diff(k >> 16, prepend=-1))
        out = np.empty(len(k), _SUM)
        if s.max(initial=0) >= 2 ** 32:
            raise ValueError("a text of a block has more tokens than 32 bits count: lower block_chars")
        out["doc"], out["sum"] = k & 0xFFFF, s
        blocks = k[at] >> 16
        parts = [x.tobytes() for x in np.split(out, at[1:])]
        return pa.RecordBatch.from_arrays([pa.array(blocks), pa.nulls(len(blocks), pa.binary()), pa.array(parts, pa.binary())], ["slot", "docs", "sums"])

    slots: dict[int, int] = {}
    names: list[int] = []

    def flush():
        b = rows()
        return pa.RecordBatch.from_arrays([pa.array([names[i] for i in b.column(0).to_pylist()], pa.int64()), b.column(1), b.column(2)], ["block", "docs", "sums"])

    for b in batches:
        pieces, blocks, docs, n = (b.column(b.schema.get_field_index(c)) for c in ("piece", "block", "docs", "n"))
        own = np.array([p == DOCS for p in pieces.to_pylist()], bool)
        if own.any():
            at = pa.array(np.flatnonzero(own))
            yield pa.RecordBatch.from_arrays([blocks.take(at), docs.take(at), pa.nulls(int(own.sum()), pa.binary())], ["block", "docs", "sums"])
        if own.all():
            continue
        at = pa.array(np.flatnonzero(~own))
        lists = docs.take(at)
        offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1]
        flat = np.frombuffer(lists.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        many = np.diff(offsets) // 3
        docs_at, freqs_at = _places(many)
        doc, freq = flat[docs_at] + flat[docs_at + 1].astype(np.int64) * 256, flat[freqs_at].astype(np.float64)
        block, inv = np.unique(blocks.take(at).to_numpy(), return_inverse=True)
        for x in block.tolist():
            if x not in slots:
                slots[x] = len(names)
                names.append(x)
        slot = np.array([slots[x] for x in block.tolist()], np.int64)[inv]
        keys.append((np.repeat(slot, many) << 16) | doc)
        sums.append(np.repeat(n.take(at).to_numpy(), many) * freq)
        held += len(doc)
        if held > 4_000_000:
            k, s = packed()
            keys, sums, held = [k], [s.astype(np.float64)], len(k)
            if held > 2_000_000:
                yield flush()
                keys, sums, held = [], [], 0
                slots.clear()
                names.clear()
    if keys:
        yield flush()


def _documents(batches):
    """The documents of one block with their sums."""
    docs, total = None, None
    waiting = []
    for b in batches:
        for listed, sums in zip(b.column("docs").to_pylist(), b.column("sums").to_pylist(), strict=True):
            if listed is not None:
                docs = np.frombuffer(listed, _DOC)
            else:
                waiting.append(sums)
                if len(waiting) > 64:
                    total = _added(total, waiting)
                    waiting = []
    total = _added(total, waiting)[:len(docs)]
    ids = pa.array(docs["id"], mask=docs["null"].astype(bool))
    yield pa.RecordBatch.from_arrays([ids, pa.array(docs["bytes"]), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])


def _added(total, parts: list[bytes]):
    total = np.zeros(65_536, np.int64) if total is None else total
    for p in parts:
        x = np.frombuffer(p, _SUM)
        total[x["doc"]] += x["sum"]
    return total


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, limit: int = 4096, block_chars: int = 32_000_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    A null text counts as empty and has no tokens; a null id stays null;
    repeated rows each get a row; an empty table gives an empty result. Other
    columns of ``docs`` are ignored. ``model_path`` names the sentencepiece
    model (default: the public one, found on each worker).
    """
    d = columns(docs, doc_id=id_col, text=text_col)
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_of()).cast("long").alias("bytes"), text_of().alias("text"))
    # a task reads four splits and makes their pieces distinct before the shuffle
    some = d.coalesce(max(1, d.rdd.getNumPartitions() // 4))
    counts = (some.mapInArrow(_distinct(block_chars), "piece string").distinct()
              .mapInArrow(_count(model_path), "piece string, n long"))
    freqs = d.mapInArrow(_frequencies(block_chars), "piece string, block long, docs binary")
    summed = freqs.join(counts, "piece").mapInArrow(_sums, "block long, docs binary, sums binary")
    out = summed.groupBy("block").applyInArrow(_group, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _group(t: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(_documents(t.to_batches())))
