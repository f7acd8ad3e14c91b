"""Operator 2 against the tokenizers library, and round trips."""

import random
from hashlib import sha256

import duckdb
import pytest
from tokenizers import Tokenizer

from parcelflow.llm import bpe
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCUMENTS, LONG, documents, empty


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def ids_of(codec, texts):
    ids, counts = codec.encode(texts)
    out, at = [], 0
    for n in counts:
        out.append(ids[at:at + n].tolist())
        at += n
    return out, codec.decode(ids, counts)


def test_same_ids_as_the_library(library):
    given = duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    texts = [t for (t,) in given if t] + [
        LONG, "", "a" * 5000, "aaa aaaa ababab", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
        "it's we'll I'd THEY'RE", "\x00\x1c\x85\xa0 x", " " * 300 + "x", "日本語テキスト🙂🙂 é́",
        "՘ x՘y \U000323b0\U000323b1a Ᲊ", "a\r\n\r\n  b \t c"]
    rnd = random.Random(4)
    alphabet = "ab'stre 1\n\t.é🙂՘<|endoftext|>"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(500)]
    ids, decoded = ids_of(bpe.Codec(bpe.vocabulary_path()), texts)
    for text, got, back, want in zip(texts, ids, decoded, library.encode_batch(
            texts, add_special_tokens=False), strict=True):
        assert got == want.ids, text[:60]
        assert back == text == library.decode(want.ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7}" for i in range(300)]
    whole = ids_of(bpe.Codec(bpe.vocabulary_path()), texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    codec = bpe.Codec(bpe.vocabulary_path())
    pieces = [ids_of(codec, texts[i:i + 10]) for i in range(0, 300, 10)]
    assert [x for p in pieces for x in p[0]] == whole[0]


def test_invalid_bytes_decode_to_replacement(library):
    codec = bpe.Codec(bpe.vocabulary_path())
    ids = library.encode("🙂", add_special_tokens=False).ids
    assert codec.decode(bpe.np.array(ids[:1]), bpe.np.array([1])) == [library.decode(ids[:1])]


def test_digests(spark, library):
    got = [tuple(r) for r in bpe.round_trip_digests(documents(spark)).collect()]
    want = []
    for i, text, *_ in DOCUMENTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), sha256(raw).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert bpe.round_trip_digests(empty(spark)).count() == 0


def test_encode_and_decode_tables(spark):
    back = bpe.decode(bpe.encode(documents(spark))).collect()
    assert sorted(map(repr, back)) == sorted(repr(spark.createDataFrame(
        [(i, t or "")], "doc_id long, text string").first()) for i, t, *_ in DOCUMENTS)
