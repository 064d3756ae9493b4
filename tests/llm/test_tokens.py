"""Token counts and token files against the tokenizer libraries on whole texts."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from menulake.llm import token_files as tf
from menulake.llm.common import Tables, table
from menulake.llm.queries import QUERIES
from menulake.llm.token_counts import piece_counts, pretokens, token_counts

SF = "/root/testdata/sf0.01"
TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "  a \n b\n\n▁c  "), (6, "x" * 70_000 + " y" * 300 + " é　\r\n\t"),
    (None, "a b"), (5, "  a \n b\n\n▁c  "), (7, "\n a"), (8, "a" * 300 + " <s></s> <unk> <0x0A> <|endoftext|>x<|startoftext|>"),
    (9, "w " * 70_000), (10, "中文 字\x00 ﬁ é ½ ² ª º µ × ÿ ẞ ǅ 😀"), (11, "It's they'll I'd 'S é É İ Σίσυφος ς"), (5, "again"),
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def frame(spark):
    # extra columns with names that the operators use themselves
    return spark.createDataFrame([(i, t, 7, "x") for i, t in TEXTS], "doc_id long, text string, piece int, ids string")


def test_pretokens_cover_the_text(pieces):
    for _, t in TEXTS:
        p = pretokens(t or "")
        assert sum(piece_counts(p)) == len(pieces.encode(t or ""))
    assert pretokens("a  b\nc") == ["a", " b", "\nc"]


def test_counts_edge_rows(spark, pieces):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(frame(spark), block_chars=500).collect()), key=str)
    want = []
    for i, t in TEXTS:
        n = len(pieces.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)
    assert token_counts(frame(spark).limit(0)).count() == 0


def test_many_repeats_of_one_word(spark, pieces):
    text = "the " * 1000 + "end"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert token_counts(d).first().n_tokens == len(pieces.encode(text))


def test_counts_whole_table(spark, pieces):
    docs = table(spark, SF, "documents").collect()
    got = {r.doc_id: r.n_tokens for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got == {d.doc_id: len(pieces.encode(d.text or "")) for d in docs}


def expected_files(words, rows):
    out, at = [], 0
    for i, t in rows:
        ids = words.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_edge_rows(spark, words):
    path = Tables(spark, "test").root
    tf.write_tokens(frame(spark), path, block_tokens=50)
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tf.read_tokens(spark, path, digest=True).collect()), key=lambda r: r[1])
    assert got == expected_files(words, rows)
    ids = {r.start: list(r.ids) for r in tf.read_tokens(spark, path).collect()}
    assert ids[0] == words.encode("a b", add_special_tokens=False).ids + [2]
    empty = Tables(spark, "test").root
    tf.write_tokens(frame(spark).limit(0), empty)
    assert tf.read_tokens(spark, empty).count() == 0


def test_files_whole_table(spark, words):
    rows = sorted((d.doc_id, d.text) for d in table(spark, SF, "documents").collect())
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_files"](spark, SF).collect())
    assert got == expected_files(words, rows)


@pytest.mark.parametrize("seed", range(4))
def test_code_is_prefix_free_bounded_and_reversible(seed):
    rng = np.random.default_rng(seed)
    counts = np.floor(np.exp(rng.uniform(0, 20, 300))).astype(np.int64) * (rng.random(300) < 0.7)
    counts[7] = 1
    most = 9 + seed
    lengths = tf.code_lengths(counts, most)
    assert (lengths[counts > 0] > 0).all() and (lengths[counts == 0] == 0).all() and lengths.max() <= most
    assert sum(2.0 ** -int(n) for n in lengths[lengths > 0]) <= 1
    ids = rng.choice(np.flatnonzero(counts), 3001).astype(np.int32)
    payload, checkpoints, bits = tf._pack(ids, lengths, tf.code_words(lengths))
    assert (tf.Decoder(lengths).decode(payload, checkpoints, len(ids), bits) == ids).all()


def test_code_is_the_best_of_its_bound():
    # by brute force over all length vectors of four symbols
    import itertools
    counts = np.array([1, 1, 5, 20])
    for most in (2, 3):
        best = min(sum(c * n for c, n in zip(counts, ls)) for ls in itertools.product(range(1, most + 1), repeat=4) if sum(2.0 ** -n for n in ls) <= 1)
        assert int((counts * tf.code_lengths(counts, most)).sum()) == best


def test_one_id_alone():
    lengths = tf.code_lengths(np.array([0, 0, 9]))
    payload, checkpoints, bits = tf._pack(np.full(9, 2), lengths, tf.code_words(lengths))
    assert bits == 9 and (tf.Decoder(lengths).decode(payload, checkpoints, 9, bits) == 2).all()


def test_word_store_stays_bounded(words, monkeypatch):
    # parts count as well as words, and thinning changes no ids
    monkeypatch.setattr(tf, "MAX_WORDS", 1000)
    monkeypatch.setattr(tf, "_words", {})
    for k in range(12):
        texts = [" ".join(f"Word{'abcdefghijklmnop'[i % 16]}{'qrstuvwxyz'[i // 16]}{'abcdefghijkl'[k]}, the İ" for i in range(100)), "the end"]
        ids, many = tf._tokens(pa.array(texts), None)
        assert [own.tolist() for own in np.split(ids, np.cumsum(many)[:-1])] == [[*words.encode(t, add_special_tokens=False).ids, tf.END_ID] for t in texts]
        assert len(tf._words[None]) + len(tf._words[None].parts) <= 1000 + 250
