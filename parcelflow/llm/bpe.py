"""Operator 2: byte-level BPE encoding and decoding by a pair occurrence index.

A task gives each pre-token of its documents a number, so that a distinct
pre-token is merged once, however often it occurs.  All new pre-tokens of an
Arrow batch are merged together: the index maps each rank (a mergeable pair) to
every position where that pair stands.  The active ranks are taken in ascending
order from a heap; all positions of a rank are merged in one vectorised step,
and only the lists of the pairs to the left and right of a merge are updated.

Merge rules of a byte-level vocabulary build each token once, so a pair that a
merge creates always has a higher rank than the merge itself; taking the ranks
in ascending order over all words at once is then the same as merging each word
on its own.

Defined results: a NULL or empty text has no tokens and decodes to the empty
text; a text of any length is encoded whole; repeated rows give repeated rows;
an empty table gives an empty table; only the id and text columns are read, so
other columns may have any name.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections import defaultdict
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parcelflow.llm.common import arrow_batch, on_executors, table, text_slices

VOCABULARY = "byte_bpe_50k.json"
#: Distinct pre-tokens a Python worker remembers between batches.
REMEMBERED = 300_000
#: Text whose pre-tokens a step holds at once, as Python strings.
STEP_BYTES = 2 << 20
NEVER = np.int64(2**62)

# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")

# Code points that became letters or numbers after Unicode 16,
# the version the vocabulary's library classifies by.
LATER_LETTERS = """
0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d
107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f
12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda
18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24
1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed
1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
""".split()
UNASSIGNED = "͸"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file:
    visible Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on in ascending order."""
    spare = itertools.count(256)
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes of one vocabulary file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        as_byte = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([ids[c] for c in letters], dtype=np.int64)
        left, right, merged = (np.array([ids[x] for x in col], dtype=np.int64) for col in zip(
            *((a, b, a + b) for a, b in spec["model"]["merges"]), strict=True))
        keys = left << 32 | right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.merged = merged
        self.self_pair = left == right
        content = {i: bytes(as_byte[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        content |= {i: t.encode() for t, i in self.special.items()}
        size = max(content) + 1
        self.bytes_of = np.frombuffer(b"".join(content.get(i, b"") for i in range(size)), np.uint8)
        self.length_of = np.array([len(content.get(i, b"")) for i in range(size)], np.int64)
        self.start_of = np.cumsum(self.length_of) - self.length_of

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NEVER)


def merge_words(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words one after another, and the number of each word's."""
    length = np.array([len(w) for w in words], np.int64)
    n = int(length.sum())
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    symbol = vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), length)
    following = np.arange(1, n + 1)
    preceding = np.arange(-1, n - 1)
    ends = np.cumsum(length[length > 0])
    following[ends - 1] = -1
    preceding[np.r_[0, ends[:-1]]] = -1
    alive = np.ones(n, bool)
    rank = np.full(n, NEVER)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(at: np.ndarray) -> None:
        """(Re)rank the pairs that begin at these positions and list them."""
        at = at[following[at] >= 0]
        found = vocab.ranks(symbol[at], symbol[following[at]])
        rank[at] = found
        some = found < NEVER
        at, found = at[some], found[some]
        if not len(at):
            return
        order = np.argsort(found, kind="stable")
        at, found = at[order], found[order]
        cut = np.flatnonzero(np.diff(found)) + 1
        for r, block in zip(found[np.r_[0, cut]].tolist(), np.split(at, cut), strict=True):
            if r in index:
                index[r].append(block)
            else:
                index[r] = [block]
                heapq.heappush(active, r)

    enter(np.arange(n))
    while active:
        r = heapq.heappop(active)
        blocks = index.pop(r)
        at = blocks[0] if len(blocks) == 1 else np.unique(np.concatenate(blocks))
        at = at[rank[at] == r]
        if vocab.self_pair[r] and len(at) > 1:
            # In a run a-a-a the pairs overlap: take every other one from the left.
            at = np.sort(at)
            fresh = np.r_[True, following[at[:-1]] != at[1:]]
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        if not len(at):
            continue
        gone = following[at]
        after = following[gone]
        symbol[at] = vocab.merged[r]
        following[at] = after
        joined = after >= 0
        preceding[after[joined]] = at[joined]
        alive[gone] = False
        rank[gone] = rank[at] = NEVER
        before = preceding[at]
        touched = np.concatenate([before[before >= 0], at])
        if len(at) > 1:
            touched = np.unique(touched)
        rank[touched] = NEVER
        enter(touched)
    return symbol[alive], np.bincount(word[alive], minlength=len(words))


def spread_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] of them), start[1], ..."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return np.arange(total) + np.repeat(start - end + length, length)


class Codec:
    """Encodes and decodes batches of texts with one vocabulary."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.pattern = regex.compile(PATTERN)
        later = "".join("-".join(rf"\U{int(x, 16):08x}" for x in r.split("-"))
                        for r in LATER_LETTERS)
        self.later = re.compile(f"[{later}]")
        self.specials = re.compile("(" + "|".join(
            re.escape(t) for t in sorted(self.vocab.special, key=len, reverse=True)) + ")"
        ) if self.vocab.special else None
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        for t in self.vocab.special:
            self.number["\0special", t]  # a key no pre-token can be
        self._learn(0)

    def _learn(self, known: int) -> None:
        """Merge the pre-tokens that were numbered from ``known`` on."""
        new = list(itertools.islice(self.number, known, None))
        ids, length = merge_words(self.vocab, [
            b"" if isinstance(w, tuple) else w.encode("utf-8", "surrogatepass") for w in new])
        if not known:
            special = [self.vocab.special[w[1]] for w in new if isinstance(w, tuple)]
            length[:len(special)] = 1
            ids = np.r_[special, ids]
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(length) - length]
        self.length = np.r_[self.length, length]
        self.ids = np.r_[self.ids, ids.astype(np.int32)]

    def words(self, text: str) -> list[str]:
        if not text.isascii() and self.later.search(text):
            plain = self.later.sub(UNASSIGNED, text)
            return [text[slice(*m.span())] for m in self.pattern.finditer(plain)]
        return self.pattern.findall(text)

    def numbers(self, text: str) -> np.ndarray:
        number = self.number.__getitem__
        if self.specials is None or not self.specials.search(text):
            w = self.words(text)
        else:
            w = []
            for k, part in enumerate(self.specials.split(text)):
                w += [("\0special", part)] if k % 2 else self.words(part)
        return np.fromiter(map(number, w), np.int64, len(w))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids, and the number of each text's (NULL: none)."""
        if len(self.number) > REMEMBERED:
            self._forget()
        known = len(self.number)
        each = [self.numbers(t or "") for t in texts]
        if len(self.number) > known:
            self._learn(known)
        coded = np.concatenate([np.zeros(0, np.int64), *each])
        length = self.length[coded]
        ids = self.ids[spread_ranges(self.start[coded], length)]
        total = np.r_[0, np.cumsum(length)]
        ends = np.cumsum([len(e) for e in each]).astype(np.int64) if each else np.zeros(0, np.int64)
        upto = total[ends]
        return ids, np.diff(np.r_[0, upto])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ``counts`` ids; byte sequences that are not
        UTF-8 become U+FFFD."""
        v = self.vocab
        size = v.length_of[ids]
        raw = v.bytes_of[spread_ranges(v.start_of[ids], size)].tobytes()
        upto = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts)]].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(upto)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec a Python worker; the file is part of the installed package."""
    return Codec(path)


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return batch.column("text").to_pylist()


def encode(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, ids array<int>: the token ids of every whole text."""
    path = path or vocabulary_path()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        c = codec(path)
        for b in text_slices(batches, limit=STEP_BYTES):
            ids, counts = c.encode(_texts(b))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()),
                                             pa.array(ids, pa.int32()))
            yield arrow_batch(schema, doc_id=b.column("doc_id"), ids=lists)

    return on_executors(_pair(docs, doc_id, text)).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text: back from :func:`encode`'s ids (NULL ids: empty text)."""
    path = path or vocabulary_path()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        c = codec(path)
        for b in batches:
            lists = b.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            yield arrow_batch(schema, doc_id=b.column("doc_id"), text=c.decode(ids, counts))

    return on_executors(encoded.select("doc_id", "ids")).mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Encode and decode every whole text; per document the number of tokens,
    the digest of its ids and the digest of the decoded text."""
    path = path or vocabulary_path()
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        c = codec(path)
        for b in text_slices(batches, limit=STEP_BYTES):
            ids, counts = c.encode(_texts(b))
            raw = ids.astype("<u4").tobytes()
            upto = (4 * np.r_[0, np.cumsum(counts)]).tolist()
            yield arrow_batch(
                schema, doc_id=b.column("doc_id"), n_tokens=counts,
                ids_sha256=[sha256(raw[x:y]).hexdigest() for x, y in itertools.pairwise(upto)],
                decoded_sha256=[sha256(t.encode()).hexdigest() for t in c.decode(ids, counts)])

    return on_executors(_pair(docs, doc_id, text)).mapInArrow(run, out)


def _pair(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast(T.LongType()).alias("doc_id"),
                       docs[text].cast(T.StringType()).alias("text"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))
