"""String tiling against a plain greedy one; leaks planted in known places."""

import random
import re

from gridloom.llm import decontam as D


def plain_tiles(doc, item, least):
    """Greedy string tiling as first published: scan all pairs of places for the longest unmarked match."""
    in_doc, in_item, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and not in_doc[d + k] and not in_item[i + k]:
                    k += 1
                best = max(best, (k, -d, -i))
        n, d, i = best[0], -best[1], -best[2]
        if n < least:
            return tiles
        tiles.append((d, i, n))
        for k in range(n):
            in_doc[d + k] = in_item[i + k] = True


def test_tiles_against_plain_ones():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.choice("abc") for _ in range(rng.randrange(3, 25))]
        doc = [rng.choice("abcd") for _ in range(rng.randrange(0, 40))]
        at = rng.randrange(0, len(item))
        doc += item[at:] + ["z"] + item[:at] + item[at // 2 :]
        bench = D.Benchmark([(7, " ".join(item))], least=3)
        got = bench.leaks(" ".join(doc), coverage=0.0)
        want = plain_tiles(doc, item, 3)
        covered = sum(t[2] for t in want)
        assert [(g[1], g[2], g[3], g[4]) for g in got] == ([(len(want), max(t[2] for t in want), covered, len(item))] if want else [])


def test_planted(spark, docs, nothing):
    item = " ".join(f"b{i}" for i in range(40))
    w = item.split()
    rows = [
        (1, "before " * 30 + item + " after" * 30), (2, " ".join(w[20:] + ["gap"] + w[:20])), (3, " ".join(w[:19])), (4, " ".join(sorted(w, reverse=True))),
        (5, item.upper().replace(" ", ", ")), (6, None), (7, ""), (1, item), (None, item),
    ]
    planted = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, coverage double")
    bench = spark.createDataFrame([(100, item), (101, "too short"), (102, None), (103, " ".join(f"c{i}" for i in range(9)))], "item_id int, text string")
    got = sorted((str(r.doc_id), r.item_id, r.covered_words) for r in D.find_leaks(planted, bench).collect())
    assert got == sorted([("1", 100, 40), ("2", 100, 40), ("5", 100, 40), ("1", 100, 40), ("None", 100, 40)])
    again = sorted((str(r.doc_id), r.item_id, r.covered_words) for r in D.find_leaks(planted, bench, block_bytes=50).collect())
    assert again == got
    left = D.drop_leaking(planted, bench, block_bytes=50)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 7] and left.columns == planted.columns
    assert D.find_leaks(docs, bench).count() == 0 and D.drop_leaking(docs, bench).count() == docs.count()
    assert D.find_leaks(nothing, bench).count() == 0 and D.find_leaks(planted, bench.where("item_id < 0")).count() == 0


def test_generated_leaks(spark, sample):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in bench.collect()}
    whole = {(r.doc_id, i) for r in sample.collect() for i, t in items.items() if f" {t} " in f" {' '.join(words(r.text))} "}
    assert whole and {(r.doc_id, r.item_id) for r in D.find_leaks(sample, bench).collect()} == whole


def test_items_shorter_than_the_least_match(spark):
    bench = spark.createDataFrame([(1, "Abc def"), (2, "one, two; three four"), (3, "solo"), (4, " . "), (5, None), (6, "abc DEF")], "item_id long, text string")
    rows = [(1, "xx abc def yy"), (2, "abc xx def"), (3, "one two three"), (4, "One two three FOUR"), (5, "solo"), (6, "solos"), (7, ""), (8, "def abc abc def abc def")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_tiles, r.longest_tile, r.covered_words, r.item_words, r.coverage) for r in D.find_leaks(docs, bench).collect())
    want = [(1, 1, 2), (1, 6, 2), (4, 2, 4), (5, 3, 1), (8, 1, 2), (8, 6, 2)]
    assert got == [(d, i, 1, n, n, n, 1.0) for d, i, n in want]
    assert sorted(r.doc_id for r in D.drop_leaking(docs, bench).collect()) == [2, 3, 6, 7]
