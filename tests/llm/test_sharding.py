"""Shards: whole groups, even loads, gapless slots."""

import zlib
from collections import defaultdict

from gridloom.llm import sharding as S


def test_longest_first_is_the_textbook_schedule():
    sizes = [(chr(97 + i), n) for i, n in enumerate([7, 7, 6, 6, 5, 5, 4, 4, 4])]
    placed, loads = S.longest_first(sizes, 3), [0, 0, 0]
    for k, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        assert loads[placed[k]] == min(loads)
        loads[placed[k]] += n
    assert S.longest_first([], 3) == {}


def check(frame, docs):
    rows = frame.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    slots, loads = defaultdict(list), defaultdict(int)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, loads


def test_odd_rows(docs, nothing):
    rows, _ = check(S.shard_documents(docs), docs)
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert S.shard_documents(nothing).count() == 0


def test_even_loads_and_hot_group(spark, sample):
    rows, loads = check(S.shard_documents(sample), sample)
    assert max(loads.values()) <= 1.02 * sum(loads.values()) / 16 or max(loads.values()) == max(r.size for r in rows)
    hot = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'copy', concat('text number ', id)) AS text")
    rows, loads = check(S.shard_documents(hot), hot)
    whole = 1000 * 5
    others = sorted(v for v in loads.values())
    assert len({r.shard for r in rows if r.size == 5}) == 1 and others[-2] - others[0] <= 64 and whole > 0


def test_slots_in_several_runs(spark):
    frame = spark.range(5000).selectExpr("id", "cast(id % 3 AS int) AS shard")
    got = S.number_slots(frame, [frame["id"]], rows_a_run=100)
    for shard in range(3):
        n = sorted(r.slot for r in got.where(f"shard = {shard}").collect())
        assert n == list(range(len(n)))
