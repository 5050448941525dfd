"""Merkle manifest: against a tree built in Python, and changed documents found."""

import hashlib
import zlib

import pytest

from gridloom.llm import merkle as M
from gridloom.llm import ordering as O


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes, arity):
    """Root of a list of digests, and for each of them its siblings (before, after) level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, a in enumerate(at):
            run, slot = a // arity * arity, a % arity
            members = level[run : run + arity]
            paths[i].append(("".join(members[:slot]), "".join(members[slot + 1 :])))
        level = [h("".join(level[k : k + arity])) for k in range(0, len(level), arity)]
        at = [a // arity for a in at]
    return level[0], paths


def brute(rows, arity=16):
    by_source = {}
    for r in rows:
        head = "".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars)))
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        leaf = h(head + field(r.text))
        by_source.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf, h(head + field(lowered(r.text))) if changed else leaf, r.doc_id))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort()
        trees[s] = climb([x[2] for x in by_source[s]], arity)
    root, tops = climb([trees[s][0] for s in order], arity)
    for s, top in zip(order, tops):
        for (_, _, leaf, start, doc_id), path in zip(by_source[s], trees[s][1]):
            whole, node = path + top, start
            for a, b in whole:
                node = h(a + node + b)
            yield doc_id, leaf, trees[s][0], root, h("".join(a + b for a, b in whole)), node, node == root


def same(got, want):
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_odd_rows(docs, nothing):
    same(M.manifest(docs), brute(docs.collect()))
    assert M.manifest(nothing).count() == 0


def test_sample(sample):
    same(M.manifest(sample), brute(sample.collect()))


@pytest.mark.parametrize("rows", [1, 2, 3, 9, 10, 28])
def test_uneven_trees(spark, rows):
    """A source with most rows, lone rows, and last runs of one node at several levels."""
    docs = spark.range(rows).selectExpr(
        "id AS doc_id", "IF(id % 4 = 3, concat('S', id), 'hot') AS source", "'en' AS lang", "id AS n_chars", "concat('Text ', id, ' É') AS text", "1 AS pos",
    )
    same(M.manifest(docs, arity=3), brute(docs.collect(), arity=3))


def test_what_tampering_shows(sample):
    rows = M.manifest(sample).join(sample, "doc_id").collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and lowered(r.text) != r.text
        assert r.verified == (not changed)
    assert {r.verified for r in rows} == {True, False}


def test_positions_in_several_partitions(spark):
    """A hot group and repeated rows lie in several partitions, and places have no gap."""
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, concat('g', id % 7), 'hot') AS g", "IF(id % 2 = 0, 5L, id) AS k", "id AS _at")
    got = O.numbered(rows, "g", [rows["k"]], "test").collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.pos, r.k, r.n))
    for found in by_group.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found))) and {n for _, _, n in found} == {len(found)}
        assert [k for _, k, _ in found] == sorted(k for _, k, _ in found)
    assert sum(map(len, by_group.values())) == 5000
