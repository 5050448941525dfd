"""The pipeline on the smallest table, stage by stage against plain versions."""

import re

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from gridloom.llm import quality, secrets
from gridloom.llm._util import staged
from gridloom.llm.queries import QUERIES, tokenizer_file

from .test_minhash import brute as components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = quality.judge_documents(docs, labels=quality.labels_of(spark.read.parquet(f"{SF}/labels.parquet")))
    rows = {r.doc_id: r for r in docs.collect()}
    left = sorted(r.doc_id for r in judged.where("kept").collect())

    found = [eval(x) for x in components([(i, rows[i].text) for i in left])]
    left = sorted(i for i, _, _, kept in found if kept)

    words = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [i for i in left if not any(f" {t} " in f" {words(rows[i].text)} " for t in items)]

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = {}
    for i in left:
        ids = library.encode(secrets.redact(rows[i].text), add_special_tokens=False).ids
        want[i] = (rows[i].lang, rows[i].source, ids, len(ids), library.decode(ids, skip_special_tokens=False))
    got = {r.doc_id: (r.lang, r.source, r.ids, r.n_tokens, r.decoded) for r in P.run(spark, SF).collect()}
    assert got == want


def test_all_but_the_last_return_the_columns_of_documents(spark, docs, nothing):
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (table, nothing.select(*table.columns)):
        for name, stage in P.STAGES[:-1]:
            frame = staged(stage(spark, frame, SF), "test-stage")
            assert frame.dtypes == table.dtypes, name
        assert P.STAGES[-1][1](spark, frame, SF).count() == frame.count()


def test_near_duplicate_stage_keeps_rows_without_an_id(spark, docs):
    kept = P.keep_one_of_near_duplicates(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SF)
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(15) == 1 and 1 not in ids and 0 in ids
    assert kept.where(F.col("doc_id") == 10).count() == 1 and kept.where(F.col("doc_id") == 11).count() == 0


def test_near_duplicate_stage_goes_by_text_where_ids_repeat(spark):
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(80)) for x in "abcde")
    rows = [(7, a), (7, b), (7, a), (3, a + " more"), (9, c), (9, c + " more"), (None, d), (None, d), (None, d + " more"), (None, e), (4, e), (5, ""), (5, ""), (5, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in P.keep_one_of_near_duplicates(spark, docs.repartition(3), SF).collect()]
    last = [x for x in got if x[0] is None and x[1] or x[0] == 9]
    assert sorted(str(x) for x in got if x not in last) == sorted(str(x) for x in [(7, b), (3, a + " more"), (4, e), (5, ""), (5, None), (None, "")])
    assert sorted(str(i) for i, _ in last) == ["9", "None"] and {t[:2] for _, t in last} == {"c0", "d0"}


def test_queries_read_whole_tables(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, make in QUERIES.items():
        frame = make(spark, SF)
        if name not in ("op9_benchmark_leaks", "op11_top_scores"):
            assert frame.count() == n["pages" if name in ("op5_main_text", "op7_archives") else "documents"], name
