import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from recsieve.llm import byte_bpe, queries
from recsieve.llm.byte_bpe import LONG, Encoder, Vocabulary, decode, encode, encode_one, read_vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_whole_table(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_byte_bpe(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode()))


def odd_texts():
    rng = random.Random(1)
    out = ["", "a" * 5000, "ab" * 3000, "é" * 2000, " " * 3000, "\x1c\x1d a\x85b c　", " \n\n  x", "x" * (LONG - 1), "x" * LONG, "y" * (LONG + 1), "​́a", "9" * 700, "'s'S 'll'LL", "<|endoftext|>", "\U0001f600‍\U0001f600 �\0"]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0x10000, 0x110000)])) for _ in range(rng.randrange(60))) for _ in range(500)]
    return out + ["".join(rng.choice("ehinrst") for _ in range(rng.randrange(3 * LONG))) for _ in range(60)]


@pytest.mark.parametrize("known, at_once", [(byte_bpe.KNOWN, byte_bpe.AT_ONCE), (0, 50)])
def test_odd_texts_as_the_library_does(vocabulary, library, monkeypatch, known, at_once):
    """Long pieces and short ones; with nothing remembered and few trees at once too."""
    monkeypatch.setattr(byte_bpe, "KNOWN", known)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", at_once)
    encoder, texts = Encoder(vocabulary), odd_texts()
    for first in range(0, len(texts), 100):
        some = texts[first : first + 100]
        ids, at = encoder.encode(some)
        for k, t in enumerate(some):
            assert list(ids[at[k] : at[k + 1]]) == library.encode_ordinary(t)


def test_each_character(vocabulary, library):
    """All up to the first ideographs, and some of the others."""
    texts = [f"a{c}a{c}{c}1 {c}{c}b" for c in map(chr, [*range(0x3400), *range(0x3400, 0x110000, 97)]) if not "\ud800" <= c <= "\udfff"]
    ids, at = Encoder(vocabulary).encode(texts)
    for k, want in enumerate(library.encode_ordinary_batch(texts)):
        assert list(ids[at[k] : at[k + 1]]) == want


def test_leftmost_of_equal_ranks():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"aaaa": 300, b"ba": 301}
    v = Vocabulary(ranks, r"\w+")
    own = tiktoken.Encoding("tiny", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    assert own.encode_ordinary("aaaaa") == [256, 257]
    for piece in ("aaaaa", "aaa", "baaa", "aaaaaab", "abaaaba", "aaaaaaaaaaaaa"):
        ids = own.encode_ordinary(piece)
        assert encode_one(piece.encode(), ranks) == ids
        assert list(Encoder(v).encode([piece])[0]) == ids


def test_edges(spark, vocabulary, library):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "né <|endoftext|>"), (5, "word " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as ids", "'x' as value", "null as row", "1 as c0", "2 as decoded")
    coded = encode(df, vocabulary)
    assert coded.columns == ["doc_id", "value", "row", "c0", "decoded", "ids"]
    out = decode(coded, vocabulary)
    assert out.columns == ["doc_id", "value", "row", "c0", "ids", "decoded"]
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded).decode(), r.value, r.c0) for r in out.collect()), key=str)
    assert got == sorted(((d, library.encode_ordinary(t or ""), t or "", "x", 1) for d, t in rows), key=str)
    assert encode(df.where("false"), vocabulary).count() == 0 and decode(coded.where("false"), vocabulary).count() == 0
    assert decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), vocabulary).selectExpr("decoded = cast('' as binary) as x").collect() == [(True,)] * 2
    with pytest.raises(Exception, match="vocabulary"):
        decode(spark.createDataFrame([([60_000],)], "ids array<int>"), vocabulary).collect()
