"""The pipeline stage by stage, the registry, and the SQL of the queries."""

import os
import random
import subprocess
import sys
from collections import Counter
from hashlib import md5, sha256

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from parcelflow.llm import mixing as M
from parcelflow.llm import registry
from parcelflow.llm.bpe import vocabulary_path
from parcelflow.session import scratch_path, stored
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.cases import DOCUMENTS, documents, empty
from tests.llm.test_jaccard_join import brute as near_brute
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_mixing import brute as mix_brute


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    out.append(docs)
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "t")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, steps):
    given, spoken, lines, single, mixed, coded = steps
    assert all(s.columns == given.columns for s in (spoken, lines, single, mixed))
    # 1: only documents without a letter go
    with_letters = [r for r in rows_of(given) if any(c.isalpha() for c in r[1] or "")]
    assert sorted(rows_of(spoken)) == sorted(with_letters)
    # 2: the texts without the lines of ten and more sources
    want = {r[0]: r[3] for r in line_brute(rows_of(spoken), 10)}
    assert {r[0]: r[1] for r in rows_of(lines)} == want
    # 3: the smallest id of each group
    kept = {r[0] for r in near_brute(rows_of(lines)) if r[0] == r[1]}
    assert Counter(r[0] for r in rows_of(single)) == Counter(kept)
    # 4: rows of the single documents, unchanged, as often as the mix holds them
    rows = rows_of(single)
    domain = {s or "": f"web{int(md5((s or '').encode()).hexdigest()[:8], 16) % M.DOMAINS}"
              for *_, s in rows}
    held = mix_brute(rows, domain, M.TARGETS, M.BUDGET_SHARE, M.MAX_EPOCHS, M.SEED)
    copies = {r[0]: r[-1] for r in held}
    assert Counter(rows_of(mixed)) == Counter({r: copies[r[0]] for r in rows if r[0] in copies})
    # 5: one row each, tokenised like the library
    library = Tokenizer.from_file(vocabulary_path())
    got = Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in coded.collect())
    assert got == Counter((i, len(library.encode(t, add_special_tokens=False).ids),
                           sha256(t.encode()).hexdigest()) for i, t, *_ in rows_of(mixed))


def test_awkward_rows_pass_every_stage(spark):
    for name, stage in C.STAGES:
        for docs in (documents(spark), empty(spark)):
            out = stage(spark, docs, SF_SMALL)
            n = out.count()
            if name != "bpe":
                assert out.columns == docs.columns
            assert n == 0 if docs.isEmpty() else n > 0
    kept = rows_of(C.near_duplicate_stage(spark, documents(spark), SF_SMALL))
    assert Counter(r[0] for r in kept) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1,
                                                   None: 1})


WORDS = [f"w{k}" for k in range(400)]
A, B, D = (" ".join(random.Random(k).choices(WORDS, k=60)) for k in (1, 2, 3))
NEAR_A = A.rsplit(" ", 1)[0] + " other"


@pytest.mark.parametrize("rows,kept", [
    ([(5, B), (5, D), (6, A)], [(5, B), (5, D), (6, A)]),  # one id, two texts
    ([(1, A), (2, A), (2, B)], [(1, A), (2, B)]),  # the copy goes, the other text of its id stays
    ([(None, A), (None, A), (1, A)], [(1, A)]),
    ([(None, A), (None, A), (None, B)], [(None, A), (None, B)]),
    ([(3, A), (3, A), (3, NEAR_A), (7, B)], [(3, None), (7, B)]),
    ([(2, NEAR_A), (None, A), (9, A)], [(2, NEAR_A)]),
    ([(4, ""), (4, ""), (5, ""), (None, None), (None, None), (6, " ")],
     [(4, ""), (5, ""), (None, None), (6, " ")]),
])
def test_near_duplicates_are_told_by_text_not_by_id(spark, rows, kept):
    given = documents(spark, [(i, t, "en", "a") for i, t in rows])
    found = [(r[0], r[1]) for r in rows_of(C.near_duplicate_stage(spark, given, SF_SMALL))]
    loose = {i for i, t in kept if t is None and i is not None}  # either of two near copies
    assert sorted(((i, None if i in loose else t) for i, t in found), key=repr) == sorted(
        kept, key=repr)
    again = [(r[0], r[1]) for r in rows_of(C.near_duplicate_stage(
        spark, given.repartition(7), SF_SMALL))]
    assert sorted(again, key=repr) == sorted(found, key=repr)


def test_every_text_is_kept_or_near_a_kept_one(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randint(3, 40))) for _ in range(40)]
    texts += [t.rsplit(" ", 1)[0] + " x" for t in texts if len(t.split()) > 30]
    rows = [(rnd.choice([None, *range(12)]), rnd.choice(texts), "en", "a") for _ in range(150)]
    kept = rows_of(C.near_duplicate_stage(spark, documents(spark, rows), SF_SMALL))
    # the brute force on one id a distinct text
    number = {t: i for i, t in enumerate(dict.fromkeys(t for _, t, *_ in rows))}
    group = {r[0]: r[1] for r in near_brute([(i, t, "en", "a") for t, i in number.items()])}
    assert Counter(group[number[t]] for _, t, *_ in kept) == Counter(set(group.values()))


def test_run_returns_the_last_stage_and_leaves_nothing_else(spark, steps):
    folder = scratch_path(spark).rstrip("/").removeprefix("file:")
    before = set(os.listdir(folder))
    got = C.run(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("stage-bpe")


def test_registry():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_ORACLE}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF_ORACLE)
    found = con.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(columns).collect()))) == \
        sorted(map(repr, found.fetchall()))


def test_clean_documents_stay(steps):
    given, spoken = steps[0], steps[1]
    ids = {r[0] for r in rows_of(given) if len([c for c in r[1] or "" if c.isalpha()]) > 20}
    assert ids <= {r[0] for r in rows_of(spoken)}
    assert len(DOCUMENTS) == 10


def test_gibberish_and_unlearned_scripts_go(spark):
    given = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    clean = given.filter("length(text) > 100").count()
    rnd = random.Random(6)
    random_words = lambda letters: " ".join(
        "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(80))
    planted = [(10**9 + i, random_words(letters), "en", "a") for i, letters in enumerate(
        ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω",
         "的一是不了人我在有他这为之大来以个中上们"] * 3)]
    docs = given.select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame(planted, "doc_id long, text string, lang string, source string"))
    kept = C.language_stage(spark, docs.withColumn("lang", F.expr(
        "if(doc_id < 1000000000, lang, null)")), SF_ORACLE)
    assert kept.filter("doc_id >= 1000000000").count() == 0
    letters = given.filter("length(text) > 100 and text rlike '\\\\p{L}'")
    assert kept.filter("doc_id < 1000000000 and length(text) > 100").count() == letters.count()
    assert clean > 100


def test_documents_stay_where_no_row_has_a_language(spark):
    rows = [(i, t, None, s) for i, t, _, s in DOCUMENTS]
    kept = rows_of(C.language_stage(spark, documents(spark, rows), SF_SMALL))
    want = [(i, t, "und", s) for i, t, _, s in rows if any(c.isalpha() for c in t or "")]
    assert sorted(map(repr, kept)) == sorted(map(repr, want))


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Only the driver's Python finds the package; the workers get it shipped."""
    root = os.path.dirname(os.path.abspath(C.__file__))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
from parcelflow.llm.registry import QUERIES
print("rows", QUERIES["op2_bpe"](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=300,
                          capture_output=True, text=True)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
