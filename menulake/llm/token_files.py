"""Token ids in Huffman-coded files (operator 8).

A token folder holds two tables. ``codes`` has the code length of every id that
occurs; code words follow from the lengths (canonical order: by length, then
id) and are at most ``max(16, bits of the vocabulary + 1)`` bits long.
``blocks`` has a number for each range of doc_id, the file, and one row a block of it: whole documents in ascending doc_id order, at least ``block_tokens``
tokens unless the file ends. A row holds the documents (id, tokens), the coded
bits (first bit highest) and the bit offset of every 128th token, so blocks
decode on their own, and a block's checkpoints decode side by side through one
lookup table.

Texts are tokenized once: the ids, two bytes each, stand in a table between
counting and coding, which is dropped afterwards. The driver sees the counts of
the vocabulary only.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from menulake.llm.common import Tables, columns, text_of

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
STEP = 128
#: Words and parts of words kept a Python worker, about 200 bytes each; beyond it the store is thinned, which changes no result.
MAX_WORDS = 400_000
#: So many of them, the ones met first, outlive a task: other steps' tasks run in the same workers.
IDLE_WORDS = 50_000
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("tokens", "<i8")])

# ---------------------------------------------------------------- tokens

#: Text for which lower case and composition are plain: printable ASCII without the apostrophe, and Latin-1 letters.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+\Z")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class _Words(dict):
    """Ids of each blank-delimited word, by the tokenizers library; the value is the word's number."""

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        self.whole = Tokenizer.from_file(path)
        self.part = self.whole.model.tokenize
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.bytes = [chr(b) if b in keep else chr(next(other)) for b in range(256)]
        self.parts: dict[str, int] = {}
        self.flat, self.sizes, self.begins = array("i"), array("i"), array("i")
        self[""] = self.add([])
        self.end = self.add([END_ID])

    def thin(self, most: int) -> None:
        """Keeps the words and parts that were met first, as the frequent ones are; numbers are given in that order."""
        most = max(self.end + 1, most)
        if most >= len(self.sizes):
            return
        kept = {w: n for w, n in self.items() if n < most}
        self.clear()
        self.update(kept)
        self.parts = {p: n for p, n in self.parts.items() if n < most}
        self.flat, self.sizes, self.begins = self.flat[:self.begins[most]], self.sizes[:most], self.begins[:most]

    def add(self, ids: list[int]) -> int:
        self.begins.append(len(self.flat))
        self.flat.extend(ids)
        self.sizes.append(len(ids))
        return len(self.sizes) - 1

    def number(self, part: str) -> int:
        n = self.parts.get(part)
        if n is None:
            n = self.parts[part] = self.add([t.id for t in self.part(part if part.isascii() else "".join([self.bytes[b] for b in part.encode()]))])
        return n

    def __missing__(self, word: str) -> int:
        if word.isascii() and word.isalpha():  # one part, of letters that stand for themselves
            n = self.number(word if word.islower() else word.lower())
        elif _PLAIN.match(word) and "<|" not in word:
            many = [self.number(p) for p in _PARTS.findall(word.lower())]
            n = many[0] if len(many) == 1 else self.add([i for k in many for i in self.flat[self.begins[k]:self.begins[k] + self.sizes[k]]])
        else:
            n = self.add(self.whole.encode(word, add_special_tokens=False).ids)
        self[word] = n
        return n


_words: dict[str | None, _Words] = {}


def _looked_up(texts: pa.Array, path: str | None) -> tuple[_Words, np.ndarray, np.ndarray, np.ndarray]:
    """The word store; the numbers of the distinct words; for each word its place among those; words of each text."""
    words = _words.get(path) or _words.setdefault(path, _Words(path))
    if len(words) + len(words.parts) > MAX_WORDS:
        words.thin(len(words.sizes) // 2)
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    numbers = np.fromiter(map(words.__getitem__, distinct), np.int32, len(distinct))
    return words, numbers, coded.indices.to_numpy(), pc.list_value_length(split).to_numpy()


def _tokens(texts: pa.Array, path: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the end id, and the number of each."""
    words, numbers, places, n = _looked_up(texts, path)
    flat, sizes, begins = (np.array(x, np.int32) for x in (words.flat, words.sizes, words.begins))
    numbers = np.append(numbers, words.end).astype(np.int32)
    # the end id is one more word of each text
    last = np.cumsum(n + 1) - 1
    picked = np.empty(len(places) + len(n), np.int32)
    is_end = np.zeros(len(picked), bool)
    is_end[last] = True
    picked[is_end], picked[~is_end] = len(numbers) - 1, places
    begins, sizes = begins[numbers], sizes[numbers]
    out = []
    for k in range(0, len(picked), 100_000):  # arrays of a size that caches hold
        some = picked[k:k + 100_000]
        many = sizes[some]
        before = np.cumsum(many, dtype=np.int32) - many
        at = np.repeat(begins[some] - before, many)
        at += np.arange(len(at), dtype=np.int32)
        out.append(flat[at])
    many = np.add.reduceat(sizes[picked], last - n, dtype=np.int64) if len(n) else np.zeros(0, np.int64)
    return np.concatenate(out) if out else np.zeros(0, np.int32), many


def _some(batches: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts of a few MB at a time."""
    for b in batches:
        ids, texts = b.column(0), b.column(1)
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        a = 0
        while a < len(ends):
            done = ends[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(ends, done + most, "right")))
            yield ids[a:z].to_pylist(), texts[a:z]
            a = z


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id, or four if one needs them; the number of ids tells which."""
    return ids.astype("<u2" if ids.max(initial=0) < 65_536 else "<u4").tobytes()


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype(np.int32)


RAW = "file int, block int, first long, n_tokens long, docs binary, ids binary"


def _blocks(path: str | None, block_tokens: int):
    """Blocks of uncoded ids, in the order of the documents that the task reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, first = TaskContext.get().partitionId(), 0, 0
        held, docs, n = [], [], 0

        def row():
            listed = np.array(docs, dtype=_DOC).tobytes()
            return pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "block": pa.array([block], pa.int32()), "first": pa.array([first], pa.int64()), "n_tokens": pa.array([n], pa.int64()), "docs": pa.array([listed], pa.binary()), "ids": pa.array([_narrow(np.concatenate(held))], pa.binary())})

        for names, texts in _some(batches):
            ids, many = _tokens(texts, path)
            for name, own in zip(names, np.split(ids, np.cumsum(many)[:-1]), strict=True):
                held.append(own)
                docs.append((0 if name is None else name, name is None, len(own)))
                n += len(own)
                if n >= block_tokens:
                    yield row()
                    block, first, held, docs, n = block + 1, first + n, [], [], 0
        if held:
            yield row()
            held = []
        for words in _words.values():
            words.thin(IDLE_WORDS)
        pa.default_memory_pool().release_unused()
    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for b in batches:
        for ids, n in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            own = np.bincount(_wide(ids.as_py(), n)).astype(np.int64)
            if len(own) > len(total):
                own, total = total, own
            total[:len(own)] += own
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["id", "n"])


# ---------------------------------------------------------------- code

def code_lengths(counts: np.ndarray, most: int | None = None) -> np.ndarray:
    """Lengths of the best prefix code with words of at most ``most`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    most = most or max(16, (n - 1).bit_length() + 1)
    if n < 2:
        lengths[used] = 1
        return lengths
    if 2 ** most < n:
        raise ValueError(f"{n} ids need longer words than {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64) if counts.sum() > 2 ** 53 else counts[order].astype(np.int64)
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(most - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        merged = both[by]
        is_leaf.append(by < n)
    take = 2 * n - 2
    for level in reversed(is_leaf):
        k = int(level[:take].sum())
        lengths[order[:k]] += 1
        take = 2 * (take - k)
    return lengths


def code_words(lengths: np.ndarray) -> np.ndarray:
    """The canonical word of each id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    words = np.zeros(len(lengths), np.uint64)
    if len(order):
        n = lengths[order].astype(np.int64)
        # each word is the sum of the shares 2^-length before it
        share = 1 << (int(n[-1]) - n)
        words[order] = (np.cumsum(share) - share) >> (int(n[-1]) - n)
    return words


def _pack(ids: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[bytes, bytes, int]:
    """The coded bits, the bit offset of every STEP-th token, and the number of bits."""
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    code = words[ids]
    place = at >> 6
    shift = 64 - (at & 63) - n
    over = shift < 0
    high = np.where(over, code >> np.maximum(-shift, 0).astype(np.uint64), code << np.maximum(shift, 0).astype(np.uint64))
    bits = int(end[-1]) if len(end) else 0
    out = np.zeros(bits // 64 + 2, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out[place[first]] = np.add.reduceat(high, first)  # the bits don't overlap
        k = np.flatnonzero(over)
        out[place[k] + 1] |= code[k] << (64 + shift[k]).astype(np.uint64)
    return out.astype(">u8").tobytes()[:(bits + 7) // 8], at[::STEP].astype("<u4" if bits < 2 ** 32 else "<u8").tobytes(), bits


class Decoder:
    """Table-driven decoding: the next ``most`` bits index a table of (id, length)."""

    def __init__(self, lengths: np.ndarray):
        self.most = int(lengths.max(initial=1))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        n = lengths[order].astype(np.int64)
        self.table = np.zeros(1 << self.most, np.int64)
        full = np.repeat((order << 6) | n, 1 << (self.most - n))
        self.table[:len(full)] = full

    def decode(self, payload: bytes, checkpoints: bytes, n_tokens: int, n_bits: int) -> np.ndarray:
        pos = np.frombuffer(checkpoints, "<u4" if n_bits < 2 ** 32 else "<u8").astype(np.int64)
        b = np.frombuffer(payload + bytes(16 + STEP * 8), np.uint8).astype(np.uint64)
        window = (b[:-4] << 32) | (b[1:-3] << 24) | (b[2:-2] << 16) | (b[3:-1] << 8) | b[4:]  # 40 bits from each byte on
        window = window.astype(np.int64)
        mask, free = (1 << self.most) - 1, 40 - self.most
        out = np.empty((len(pos), STEP), np.int32)
        last = len(window) - 1
        for k in range(STEP):
            got = self.table[(window[np.minimum(pos >> 3, last)] >> (free - (pos & 7))) & mask]
            out[:, k] = got >> 6
            pos += got & 63
        return out.reshape(-1)[:n_tokens]


_decoders: dict[bytes, Decoder] = {}


def _encode(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = code_words(lengths)
        for b in batches:
            for k in range(b.num_rows):
                c = b.slice(k, 1)
                payload, checkpoints, bits = _pack(_wide(c.column(5)[0].as_py(), c.column(3)[0].as_py()), lengths, words)
                yield pa.RecordBatch.from_arrays([*c.columns[:4], pa.array([bits], pa.int64()), c.column(4), pa.array([checkpoints], pa.binary()), pa.array([payload], pa.binary())], _NAMES)
    return run


BLOCKS = "file int, block int, first long, n_tokens long, n_bits long, docs binary, checkpoints binary, payload binary"
_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, block_tokens: int = 262_144) -> None:
    """Encode every text and write the token folder ``path``.

    A null text counts as empty (the end id alone); rows with one id stand in
    the order of their texts; a null id comes first; an empty table writes
    empty tables. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    t = Tables(spark, "ids")
    raw = t.cut(d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(_blocks(tokenizer_path, block_tokens), RAW), "raw")
    counts = raw.select("ids", "n_tokens").mapInArrow(_counts, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(int(counts["id"].max()) + 1 if len(counts) else END_ID + 1, np.int64)
    n[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(n)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int").coalesce(1).write.parquet(f"{path}/codes")
    raw.mapInArrow(_encode(lengths), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    t.drop(raw)


def _decode(lengths: np.ndarray, digest: bool):
    key = lengths.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoders.get(key)
        if decoder is None:
            _decoders.clear()
            decoder = _decoders[key] = Decoder(lengths)
        for b in batches:
            for file, first, n, bits, docs, checkpoints, payload in zip(*(b.column(b.schema.get_field_index(c)) for c in ("file", "first", "n_tokens", "n_bits", "docs", "checkpoints", "payload")), strict=True):
                ids = decoder.decode(payload.as_py(), checkpoints.as_py(), n.as_py(), bits.as_py())
                listed = np.frombuffer(docs.as_py(), _DOC)
                ends = np.cumsum(listed["tokens"])
                if digest:
                    own = [zlib.crc32(x) for x in np.split(ids.astype("<u4"), ends[:-1])]
                    own = pa.array(own, pa.int64())
                else:
                    own = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(listed), file.as_py(), np.int32)),
                    pa.array(listed["id"], mask=listed["null"].astype(bool)),
                    pa.array(first.as_py() + ends - listed["tokens"]), pa.array(listed["tokens"]), own,
                ], ["file", "doc_id", "start", "n_tokens", "own"])
    return run


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a token folder, decoded block by block.

    ``start`` counts the ids of all documents before. With ``digest``, the
    column ``ids_crc32`` (unsigned crc32 of the ids as little-endian unsigned
    32-bit integers) stands in place of ``ids``.
    """
    codes = spark.read.parquet(f"{path}/codes").toPandas()  # as many rows as the vocabulary has ids at most
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 1, np.uint8)
    lengths[codes["id"].to_numpy(np.int64)] = codes["length"].to_numpy(np.uint8)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # one row a file
    files = blocks.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = "long" if digest else "array<int>"
    docs = blocks.mapInArrow(_decode(lengths, digest), f"file int, doc_id long, start long, n_tokens long, own {own}")
    return docs.join(files, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", F.col("own").alias("ids_crc32" if digest else "ids"))
