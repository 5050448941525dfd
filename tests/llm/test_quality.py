"""Quality: base measures against plain counting, held-out labels, odd rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

from gridloom.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    n = len(words)
    count = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    twice = {k for i in range(n - 7) if count[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(twice), n < 20 or 100 * len(twice) > 30 * n


def test_base_measures(docs, sample, nothing):
    for frame in (docs, sample):
        got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in Q.judge_documents(frame).collect())
        assert got == sorted(str((r.doc_id, *brute(r.text))) for r in frame.collect())
        assert Q.judge_documents(frame).where("kept AND base_failed").count() == 0
        assert Q.judge_documents(frame).where("kept IS NULL").count() == 0
    assert Q.judge_documents(nothing).count() == 0 and Q.keep_good_documents(nothing).count() == 0


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = Q.labels_of(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    shown, hidden = labels.where("id % 2 = 0"), labels.where("id % 2 = 1")
    judged = Q.judge_documents(docs, labels=shown).where("NOT base_failed").select(F.col("doc_id").alias("id"), "kept").join(hidden, "id")
    right, n = judged.agg(F.sum((F.col("kept") == F.col("good")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.96 * n


def test_kept_rows_are_whole(docs):
    judged = Q.judge_documents(docs)
    kept = Q.keep_good_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in judged.where("kept").collect())


def test_estimate_finds_two_kinds():
    patterns = [("gggggggg", 900, 0, 0), ("bbbbgggg", 100, 0, 0), ("bbb?gggg", 30, 0, 0), ("ggg?gggg", 80, 0, 0)]
    found = Q.fit(patterns)
    assert found["gggggggg"] > 0.9 > 0.1 > found["bbbbgggg"] and Q.fit([]) == {}
    known = Q.fit([("gggggggg", 900, 50, 0), ("ggbggggg", 100, 0, 40)])
    assert known["ggbggggg"] < 0.5 < known["gggggggg"]
