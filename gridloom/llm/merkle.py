"""A Merkle manifest of a dataset: a tree over each source's documents and one over the sources.

Each level is one pass of windows. Nodes of a group are numbered; ``ARITY`` consecutive ones are a run. Columns at the
fixed offsets 1 to ARITY - 1 before and after a node (``lag`` and ``lead``), masked by the node's slot in its run and by
the run's length, are its siblings, and the first child of each run hashes the parent. Digests are 32 bytes inside and
hexadecimal text where they are hashed.

Nothing holds a group: windows are dealt by run, numbers come from :func:`gridloom.llm.ordering.numbered`. Proofs go
down by a join of each level with its parents, in which a key has at most ARITY rows, however many documents a
source has; the tree over the sources hangs on the roots of theirs.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import ready, staged
from gridloom.llm.ordering import numbered

ARITY = 16
#: Documents whose checksum of the id this divides are checked with a text in lower case.
TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row: each field is ``-`` if null, else its UTF-8 length, a colon and itself."""
    each = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in fields]
    return digest_of(F.concat(*each))


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes (grp, pos, n, digest, ...) with ``run`` and the joined digests of their siblings ``before`` and ``after``."""
    slot, length = f"pos % {arity}", f"least({arity}, n - run * {arity})"
    window = "OVER (PARTITION BY grp, run ORDER BY pos)"
    left = [f"IF({slot} >= {k}, lag(digest, {k}) {window}, X'')" for k in range(arity - 1, 0, -1)]
    right = [f"IF({slot} + {k} < {length}, lead(digest, {k}) {window}, X'')" for k in range(1, arity)]
    siblings = [f"concat({', '.join(c)}) AS {name}" for c, name in ((left, "before"), (right, "after"))]
    dealt = nodes if "run" in nodes.columns else nodes.withColumn("run", F.floor(F.col("pos") / arity))
    return dealt.selectExpr("*", *siblings)


def _parents(wide: DataFrame, arity: int) -> DataFrame:
    first = wide.where((F.col("n") > 1) & (F.col("pos") % arity == 0))
    return first.select(
        "grp", F.col("run").alias("pos"), F.ceil(F.col("n") / arity).alias("n"), digest_of(hex_of(F.concat("digest", "after"))).alias("digest")
    )


def tree(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The levels above leaves (grp, pos, n, digest), each with siblings and written once, and the roots (grp, digest)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, below = [], with_siblings(leaves, arity)
    while most > 1:
        most = -(-most // arity)
        below = staged(with_siblings(_parents(below, arity), arity), "merkle-level")
        levels.append(below)
    roots = leaves.where("n = 1").select("grp", "digest")
    for level in levels:
        roots = roots.unionByName(level.where("n = 1").select("grp", "digest"))
    return levels, roots


def with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """The leaves with ``path``, the siblings (before, after) of each level from theirs up, and ``top``.

    ``tops`` (grp, top, path) has a row for each group: a digest that is handed down, and what its path goes on with.
    """
    above = None
    for nodes in [*reversed(levels), leaves]:
        own = [c for c in nodes.columns if c not in ("run", "before", "after")]
        reached = nodes.where("n = 1").select(*own).join(tops, "grp").select(*own, "top", "path")
        if above is not None:
            parents = above.select("grp", F.col("pos").alias("run"), "top", F.col("path").alias("rest"))
            below = nodes.where("n > 1").withColumn("run", F.floor(F.col("pos") / arity)).join(parents, ["grp", "run"])
            # The windows take the join's partitioning by (grp, run); levels above the leaves have their siblings already.
            below = below if "before" in nodes.columns else with_siblings(below, arity)
            step = F.array(F.struct("before", "after"))
            reached = reached.unionByName(below.select(*own, "top", F.concat(step, "rest").alias("path")))
        above = reached
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest_of(hex_of(F.concat(s["before"], node, s["after"]))))


def manifest(docs: DataFrame, arity: int = ARITY, tampered: int = TAMPERED) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and the whole text, of any length; nulls are part of it. Each
    source's leaves in the order of doc_id (null first, ties by digest) are a tree, and so are the sources' roots (null
    first, then bytewise; an empty source is not a null one). ``proof_sha256`` is the digest of all siblings on the way up. Where
    ``tampered`` divides the checksum of the id, the leaf folded up is that of the text with A-Z lowered; ``verified`` says that the root
    is met again. A row without an id is not tampered with. Repeated rows are leaves each. Further columns are not
    read. An empty table gives no rows.
    """
    ready(docs)
    source = [F.col(c).cast("string") for c in FIELDS]
    lowered = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % tampered == 0, F.lit(False))
    leaf = leaf_of(source)
    rows = docs.select(
        "doc_id", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias("grp"), leaf.alias("digest"),
        F.when(hit, leaf_of([*source[:-1], lowered])).alias("changed"),
    )
    rows = staged(rows, "merkle-leaves")
    leaves = staged(numbered(rows, "grp", [F.col("doc_id"), F.col("digest")], "merkle-ordered"), "merkle-numbered")
    levels, subroots = tree(leaves, arity)

    sources = staged(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("source"), "digest"), "merkle-subroots")
    sources = staged(numbered(sources, "grp", [F.col("source")], "merkle-ordered"), "merkle-sources")
    upper, root = tree(sources, arity)
    root = staged(root, "merkle-root")
    end = root.select("grp", F.col("digest").alias("top"), F.expr("CAST(array() AS array<struct<before: binary, after: binary>>)").alias("path"))
    tops = with_paths(sources, upper, end, arity).select(F.col("source").alias("grp"), F.col("digest").alias("top"), "path")

    out = with_paths(leaves, levels, tops, arity)
    # There is one root, and no row without it.
    root_hex = hex_of(F.lit(next((bytes(r["digest"]) for r in root.select("digest").take(1)), None)).cast("binary"))
    siblings = F.aggregate("path", F.lit("").cast("binary"), lambda all_, s: F.concat(all_, s["before"], s["after"]))
    up = hex_of(folded(F.coalesce("changed", "digest"), F.col("path")))
    return out.select(
        "doc_id", hex_of(F.col("digest")).alias("leaf"), hex_of(F.col("top")).alias("subroot"), root_hex.alias("root"),
        F.sha2(hex_of(siblings), 256).alias("proof_sha256"), up.alias("folded_root"), (up == root_hex).alias("verified"),
    )
