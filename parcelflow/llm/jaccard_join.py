"""Operator 5: near-duplicate join on word n-grams by MinHash banding.

1. One pass over the texts gives each document a 128-bit digest of its word
   sequence and its MinHashes.  Band and row counts follow from the target
   recall at the threshold (:func:`choose_bands`).
2. Documents with one digest form a class; its smallest id stands for it, so
   thousands of copies cost one candidate.
3. The representatives are shuffled on (band, band hash).  In a bucket of two or
   more, in blocks, the MinHashes of its members are compared: a pair is a candidate
   when so many are equal that a pair at the threshold has fewer only with
   probability LOST (:func:`least_equal`).  So documents that share a template, whose
   bands collide by the thousand, end here and move no text.  A block pair returns a
   forest of its candidate pairs, not the pairs; its components hold all of them.
4. Each component is dealt into blocks of a fixed size, and every pair of blocks
   is a task of its own: it rebuilds the full n-gram sets from the texts, takes
   the pairs that share a band, and verifies the Jaccard similarity exactly.  It
   returns a link count for each representative and a forest of its links, not
   the pairs, so a group of near copies returns rows in proportion to its size.
5. The components of the forests are the near-duplicate classes.

Result, one row per row of the input: ``doc_id``, ``class_id`` (the smallest id
its links reach), ``copy_of`` (the smallest id with the same word sequence),
``n_links`` (other documents with similarity of the threshold or more).

Defined results: words are compared in lower case, split at white space.  A text
of fewer words than n has one gram, all its words.  A NULL text or one without a
word links with nothing.  A row with a NULL id is returned with NULL class and no
link.  Repeated rows are documents of their own that link with each other; rows
with one id and different texts share their class.  Only the id and text columns
are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import arrow_batch, on_executors, table, text_slices
from parcelflow.llm.graph import connected_components
from parcelflow.llm.shingles import gram_values, mixed, sequence_digest
from parcelflow.session import stored

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Representatives in one block of a component, and n-grams at most on average.
BLOCK = 128
BLOCK_GRAMS = 500_000
#: Probability that a pair at the threshold is no candidate though it shares a band.
LOST = 1e-6
#: Members of a bucket in one block of signatures, and of small buckets in one task.
BUCKET_BLOCK, BUCKET_ROWS = 1024, 5_000
#: Text that one MinHash step holds: its arrays stay in the processor's cache.
SIGN_BYTES = 1 << 20


def choose_bands(threshold: float, recall: float, most_hashes: int = 96) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which bands x rows stays within
    ``most_hashes`` while a pair at the threshold shares a band with
    probability ``recall``: 1 - (1 - t^rows)^bands >= recall."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-p))
        if bands * rows > most_hashes:  # and so it is with more rows
            break
        best = (bands, rows)
    return best


def least_equal(threshold: float, hashes: int, lost: float = LOST) -> int:
    """The most equal MinHashes to ask of a pair, of ``hashes``, so that one at the
    threshold has fewer with probability ``lost`` at most."""
    below, p = 0.0, threshold
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * p ** k * (1 - p) ** (hashes - k)
        if below > lost:
            return k
    return hashes


class Signer:
    def __init__(self, words: int, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.words, self.bands, self.rows = words, bands, rows
        self.times = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
        self.salt = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)

    def signatures(self, gram: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A row for each text that has grams, a column for each MinHash."""
        start = (np.cumsum(size) - size)[size > 0]
        x = (gram >> np.uint64(32)).astype(np.uint32)
        y = np.empty_like(x)
        out = np.zeros((len(start), self.bands * self.rows), np.uint32)
        if len(start):
            with np.errstate(over="ignore"):
                for j in range(self.bands * self.rows):
                    np.multiply(x, self.times[j], out=y)
                    np.add(y, self.plus[j], out=y)
                    out[:, j] = np.minimum.reduceat(y, start)
        return out

    def bands_of(self, signatures: np.ndarray) -> np.ndarray:
        """A row for each signature, a column for each band."""
        out = np.zeros((len(signatures), self.bands), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(self.bands * self.rows):
                band = out[:, j // self.rows]
                band[:] = mixed(band + (signatures[:, j].astype(np.uint64) + np.uint64(1))
                                * self.salt[j])
        return out.view(np.int64)

    def band_hashes(self, gram: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A row for each text that has grams, a column for each band."""
        return self.bands_of(self.signatures(gram, size))


def sign(docs: DataFrame, signer: Signer) -> DataFrame:
    """doc_id, h1, h2 (digest), grams (their number), bands array<long>, hashes (MinHashes,
    4 bytes each)."""
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("grams", pa.int64()), ("bands", pa.list_(pa.int64())),
                        ("hashes", pa.binary())])

    def run(batches):
        for b in text_slices(batches, limit=SIGN_BYTES):
            gram, size = gram_values(b.column("text"), signer.words)
            h1, h2 = sequence_digest(gram, size)
            found = signer.signatures(gram, size)
            offsets = np.r_[0, np.cumsum(np.where(size > 0, signer.bands, 0))]
            each = iter(found)
            yield arrow_batch(schema, doc_id=b.column("doc_id"), h1=h1, h2=h2, grams=size,
                              bands=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                             pa.array(signer.bands_of(found).ravel())),
                              hashes=[next(each).tobytes() if n else None for n in size])

    return on_executors(docs).mapInArrow(
        run, "doc_id long, h1 long, h2 long, grams long, bands array<long>, hashes binary")


def similar_signatures(least: int):
    """The task over small buckets, or over one pair of blocks of a large one: a forest of
    the pairs of a bucket with ``least`` equal MinHashes."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lo, hi = key[3].as_py(), key[4].as_py()
        rows = rows.sort_by([("band", "ascending"), ("value", "ascending"), ("node", "ascending")])
        band, value, node, block = (rows.column(c).to_numpy() for c in
                                    ("band", "value", "node", "block"))
        hashes = np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint32)
        hashes = hashes.reshape(len(node), -1)
        nodes, at = np.unique(node, return_inverse=True)
        left, right = [], []
        if lo == hi:
            for step in range(1, len(node)):  # pairs that stand `step` apart in a bucket
                i = np.flatnonzero((band[step:] == band[:-step]) & (value[step:] == value[:-step]))
                if not len(i):
                    break
                i = i[(hashes[i] == hashes[i + step]).sum(axis=1) >= least]
                left += at[i].tolist()
                right += at[i + step].tolist()
        else:
            first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            for i in first:
                j = second[(hashes[second] == hashes[i]).sum(axis=1) >= least]
                left += [int(at[i])] * len(j)
                right += at[j].tolist()
        roots = _roots(len(nodes), left, right)
        out = roots != np.arange(len(nodes))
        return pa.Table.from_batches([arrow_batch(schema, src=nodes[out], dst=nodes[roots[out]])])

    return run


def candidate_components(reps: DataFrame, least: int) -> DataFrame:
    """node, component over the representatives (node, h1, h2, bands, hashes) that share a
    band bucket and have ``least`` equal MinHashes."""
    dealt = reps.select("node", "h1", "h2", F.posexplode("bands").alias("band", "value"))
    buckets = stored(dealt.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
                     .select("band", "value", F.ceil(F.col("n") / F.lit(BUCKET_BLOCK)).cast("int")
                             .alias("blocks")), "buckets")
    members = stored(dealt.join(buckets, ["band", "value"]), "bucket-members")
    tasks = max(1, members.count() // BUCKET_ROWS)
    small = F.col("blocks") == 1
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = (members.join(reps.select("node", "h1", "h2", "hashes"), ["node", "h1", "h2"])
              .withColumn("block", F.pmod(F.xxhash64("node", "h1"), "blocks").cast("int"))
              .select("*", other.alias("other"))
              .select("band", "value", "node", "block", "hashes",
                      F.when(small, F.pmod(F.xxhash64("band", "value"), F.lit(tasks)))
                      .otherwise(-1).alias("task"),
                      F.when(small, 0).otherwise(F.col("band")).alias("b"),
                      F.when(small, 0).otherwise(F.col("value")).alias("v"),
                      F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    return connected_components(blocks.groupBy("task", "b", "v", "lo", "hi").applyInArrow(
        similar_signatures(least), "src long, dst long"))


def _roots(n: int, left: list[int], right: list[int]) -> np.ndarray:
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in zip(left, right, strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], np.int64)


def verify_blocks(signer: Signer, threshold: float):
    """The task over one pair of blocks: exact similarities of the pairs that
    share a band, as link counts and a forest."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lo, hi = key[1].as_py(), key[2].as_py()
        rows = rows.combine_chunks()
        gram, size = gram_values(rows.column("text").combine_chunks(), signer.words)
        h1, h2 = sequence_digest(gram, size)
        node, block, w1, w2, copies = (rows.column(c).to_numpy() for c in
                                       ("node", "block", "h1", "h2", "copies"))
        ends = np.cumsum(size)
        kept, seen = [], set()
        for i in np.flatnonzero((h1 == w1) & (h2 == w2) & (size > 0)):
            if (k := (int(node[i]), int(h1[i]), int(h2[i]))) not in seen:
                seen.add(k)
                kept.append(i)
        kept = np.array(sorted(kept, key=lambda i: (node[i], h1[i])), dtype=np.int64)
        sets = [np.unique(gram[ends[i] - size[i]:ends[i]]) for i in kept]
        n, each = len(kept), np.array([len(s) for s in sets], np.int64)
        _, code = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
        begin = np.cumsum(each) - each
        bands = signer.band_hashes(np.concatenate([np.zeros(0, np.uint64), *sets]), each)
        node, block, copies = node[kept], block[kept], copies[kept]
        links, left, right = np.zeros(n, np.int64), [], []
        mark = np.zeros(int(code.max()) + 1 if len(code) else 0, bool)
        for i in range(n):
            with_whom = np.arange(i + 1, n)
            if lo != hi:
                with_whom = with_whom[block[with_whom] != block[i]]
            with_whom = with_whom[(bands[with_whom] == bands[i]).any(axis=1)]
            if not len(with_whom):
                continue
            own = code[begin[i]:begin[i] + each[i]]
            mark[own] = True
            took = np.concatenate([code[begin[j]:begin[j] + each[j]] for j in with_whom])
            sizes = each[with_whom]
            both = np.add.reduceat(mark[took].astype(np.int64), np.cumsum(sizes) - sizes)
            mark[own] = False
            # |A and B| / |A or B| >= t, without a rounded quotient
            linked = with_whom[both >= threshold * (each[i] + sizes - both) - 1e-9]
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            left += [i] * len(linked)
            right += linked.tolist()
        roots = _roots(n, left, right)
        out = links > 0
        return pa.Table.from_batches([arrow_batch(
            schema, node=node[out], links=links[out], root=node[roots[out]])])

    return run


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                    recall: float = RECALL, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, class_id, copy_of, n_links for every row of ``docs``."""
    signer = Signer(words, *choose_bands(threshold, recall))
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text"))
    signed = stored(sign(docs, signer), "signed")
    classes = stored(signed.filter("doc_id is not null and grams > 0").groupBy("h1", "h2")
                     .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"),
                          F.max("grams").alias("grams"), F.first("bands").alias("bands"),
                          F.first("hashes").alias("hashes")), "classes")
    within = candidate_components(classes, least_equal(threshold, signer.bands * signer.rows))
    members = classes.drop("bands", "hashes").join(within, "node")
    sizes = stored(members.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("grams") / F.lit(BLOCK_GRAMS)))
        .cast("int").alias("blocks")), "sizes")
    members = stored(members.join(sizes, "component").select(
        "node", "component", "h1", "h2", "copies", "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block")), "members")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # always by shuffle: the members grow with the documents
    dealt = (docs.withColumnRenamed("doc_id", "node").join(members.hint("merge"), "node")
             .select("*", other.alias("other"))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .select("component", "lo", "hi", "node", "block", "h1", "h2", "copies", "text"))
    found = stored(dealt.groupBy("component", "lo", "hi").applyInArrow(
        verify_blocks(signer, threshold), "node long, links long, root long"), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("node").alias("src"),
                                               F.col("root").alias("dst")))
    result = stored(classes.select("h1", "h2", "node", "copies")
                    .join(linked, "node", "left").join(joined, "node", "left")
                    .select("h1", "h2", F.col("node").alias("copy_of"),
                            F.coalesce("component", "node").alias("class_id"),
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                            .alias("n_links")), "near")
    known = F.col("doc_id").isNotNull()
    return (signed.select("doc_id", "h1", "h2", "grams").join(result, ["h1", "h2"], "left")
            .select("doc_id", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
                    F.when(known, F.coalesce("copy_of", "doc_id")).alias("copy_of"),
                    F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0)
                    .cast("long").alias("n_links")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'),
                             lambda w: w <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g
  FROM worded WHERE len(w) > 0),
sized AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sized x ON x.doc_id = s.a JOIN sized y ON y.doc_id = s.b
  WHERE 5 * s.n >= 4 * (x.n + y.n - s.n)),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY w) AS copy_of FROM worded
           WHERE len(w) > 0)
SELECT d.doc_id, least(d.doc_id, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id)) AS class_id,
       coalesce(c.copy_of, d.doc_id) AS copy_of,
       (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN copies c USING (doc_id)
"""
