"""Near-duplicates by an inverted join on MinHash signature coordinates.

A document's set is its distinct 5-word shingles; equal sets form a class, worked on once. A class has ``COORDINATES``
MinHash values and is posted under each of them. Two sets of similarity s agree in a coordinate with probability s, so
pairs are sought that agree in ``MATCHES`` or more, a threshold that a pair at the link level misses with a probability
of about 3e-5.

*Prefix*: values met in one class alone cannot collide; a class with fewer than ``MATCHES`` shared values is out, and of
its q shared values only the q - MATCHES + 1 rarest are posted, since two classes with MATCHES common values must meet
in those. *Skip*: the common values are skipped in the lists; the collisions there are counted on the signatures of the
pairs that met.

A list of k classes is not spread into its k^2 pairs. First every class is checked against the list's pivot, its class
with the most shared values, which is the original where copies were made from one text. Then only lists that still
hold several components are left. Their pairs are looked at in squares of about ``SIDE`` by ``SIDE`` classes, each pair in one
list. Signatures alone go to all squares; a pair is wanted if it lies in different components, agrees in enough
coordinates, and may reach the level at all: the common part is at most what either shares with any class left. Only
classes with a wanted pair send their full sets, to the squares of those pairs, and a square is smaller where sets are
large (``SQUARE_BYTES``). A square gives no more links than join its components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import Scratch, free_name, hashed_words, lowered_chunks, mixed, ready, small_batches

SHINGLE = 5
COORDINATES = 48
MATCHES = 30
#: Linked if 100 * common >= LEVEL * union.
LEVEL = 85
SIDE = 256
#: Bytes of full sets on one side of a square, save that a set is never split.
SQUARE_BYTES = 16_000_000

_WEIGHTS = mixed(np.arange(1, 64, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_FACTORS = mixed(np.arange(1, 512, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_SHIFTS = mixed(np.arange(1, 512, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def shingle_sets(texts, size: int = SHINGLE):
    """For each Arrow string its sorted distinct shingle hashes; the whole of a text with fewer words is one shingle."""
    for some in lowered_chunks(texts):
        _, _, _, _, of_word, word = hashed_words(some)
        ends = np.searchsorted(of_word, np.arange(len(some)), "right")
        start = 0
        for end in ends:
            words, start = word[start:end], end
            n = min(size, len(words))
            if n == 0:
                yield np.zeros(0, np.uint64)
                continue
            with np.errstate(over="ignore"):
                total = np.full(len(words) - n + 1, n, np.uint64)
                for j in range(n):
                    total += words[j : len(words) - n + 1 + j] * _WEIGHTS[j]
            yield np.unique(mixed(total))


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    best = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 20_000):
            part = shingles[None, at : at + 20_000] ^ _SHIFTS[:coordinates, None]
            best = np.minimum(best, (part * _FACTORS[:coordinates, None]).min(axis=1))
    return best


def _signed(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    """(id, key, n, digest, sig) of rows (id, key, text): set size, a 128-bit digest of the set, and its signature; null
    digest for no shingle."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            n, digest, sig = [], [], []
            for s in shingle_sets(batch.column("text"), size):
                n.append(len(s))
                digest.append(_digest(s))
                sig.append(signature(s, coordinates).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                ["id", "key", "n", "digest", "sig"],
            )

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, key binary, n long, digest binary, sig array<long>")


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in small_batches(batches, "text"):
            sets = list(shingle_sets(batch.column("text"), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["digest", "shingles"]
            )

    return docs.select("text").mapInArrow(run, "digest binary, shingles array<long>")


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, component): the least id reachable from each end of the links (a, b), by alternating large and small stars.

    Each round is written to the shared folder, and the one before it is taken away. Ids without a link are not in the
    result, which is written with ``scratch`` if that is given.
    """
    rounds, before = Scratch(links.sparkSession), None
    edges = rounds.write(links.select("a", "b").where("a != b").distinct(), "links")
    while True:
        # Large star: every greater neighbour of a node is tied to the least of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the lesser neighbours of a node and itself are tied to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = rounds.write(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        rounds.drop(edges)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 40)))).first()
        if state == before:
            out = edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
            if scratch is not None:
                out = scratch.write(out, "minhash-components")
                rounds.drop()
            return out
        before = state


def _linked(pairs: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the level."""
    of = lambda side: sets.select(F.col("id").alias(side), F.col("shingles").alias(f"set_{side}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    met = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("both", both)
    return met.where(F.lit(100) * F.col("both") >= F.lit(level) * (F.size("set_a") + F.size("set_b") - F.col("both"))).select("a", "b")


def _links_in_squares(members: DataFrame, sets: DataFrame, matches: int, level: int, side: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between components among list members (val, n, bytes, id, component, size, shared, own, sig).

    A pair is looked at in one list alone: of the lists both stand in (``own`` has a bit for the coordinate of each)
    that of the first coordinate they agree in. Of the links of a square as many come out as join its components.
    """
    parts = F.ceil(F.greatest(F.col("n") / F.lit(side), F.col("bytes") / F.lit(SQUARE_BYTES))).cast("int")
    dealt = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    columns = ["val", "part", "id", "component", "size", "shared", "own", "sig"]
    squares = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        *columns, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    id_type = dict(members.dtypes)["id"]

    def wanted_pairs(square: pa.Table):
        """Of each row in turn the rows it is to be compared with."""
        comp = square["component"].to_numpy()
        n, shared, part, own = (square[c].to_numpy() for c in ("size", "shared", "part", "own"))
        sig = square["sig"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(comp), -1)
        posted = (own[:, None] >> np.arange(sig.shape[1])) & 1 == 1
        val, i, j = (square[c][0].as_py() for c in ("val", "i", "j"))
        for x in np.flatnonzero(part == i):
            most = np.minimum(shared[x], shared)
            ok = (part == j) & (comp != comp[x]) & (100 * most >= level * (n[x] + n - most))
            if i == j:
                ok[: x + 1] = False
            at = np.flatnonzero(ok)
            agree = sig[at] == sig[x]
            first = (agree & posted[at] & posted[x]).argmax(axis=1)
            at = at[(agree.sum(axis=1) >= matches) & (sig[x][first] == val)]
            if len(at):
                yield x, at

    def wanted(square: pa.Table) -> pa.Table:
        has = np.zeros(len(square), bool)
        for x, at in wanted_pairs(square):
            has[x] = has[at] = True
        return square.filter(pa.array(has)).select([*columns, "i", "j"])

    def confirmed(square: pa.Table) -> pa.Table:
        ids, comp, n = (square[c].to_numpy() for c in ("id", "component", "size"))
        lists = square["shingles"].combine_chunks()
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        begins = ends - np.diff(ends, prepend=0)
        root = {}

        def find(c):
            while c in root:
                c = root[c]
            return c

        a, b = [], []
        for x, at in wanted_pairs(square):
            mine = np.sort(flat[begins[x] : ends[x]])
            theirs = np.concatenate([flat[begins[k] : ends[k]] for k in at])
            hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            both = np.add.reduceat(hit, np.cumsum(n[at]) - n[at], dtype=np.int64)
            for k in at[100 * both >= level * (n[x] + n[at] - both)]:
                c, d = find(comp[x]), find(comp[k])
                if c != d:
                    root[c] = d
                    a.append(min(ids[x], ids[k]))
                    b.append(max(ids[x], ids[k]))
        return pa.table({"a": pa.array(a, square.schema.field("id").type), "b": pa.array(b, square.schema.field("id").type)})

    schema = f"val long, part int, id {id_type}, component {id_type}, size long, shared long, own long, sig array<long>, i int, j int"
    left = scratch.write(squares.groupBy("val", "i", "j").applyInArrow(wanted, schema), "minhash-wanted-pairs")
    return left.join(sets, "id").groupBy("val", "i", "j").applyInArrow(confirmed, f"a {id_type}, b {id_type}")


def _ties(able: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) that tie the classes of each id that stands on several texts."""
    halves = [F.xxhash64("digest"), F.xxhash64("digest", F.lit(1))]
    found = able.groupBy("id").agg(*[f(h).alias(f"{n}{k}") for k, h in enumerate(halves) for n, f in (("lo", F.min), ("hi", F.max))])
    repeated = scratch.write(found.where("lo0 < hi0 or lo1 < hi1").select("id"), "minhash-repeated")
    several = able.select("id", "digest").join(repeated.hint("merge"), "id", "left_semi").distinct()
    tied = scratch.write(several.join(reps.select("digest", F.col("id").alias("b")).hint("merge"), "digest").select("id", "b"), "minhash-tied")
    return tied.join(tied.groupBy("id").agg(F.min("b").alias("a")), "id").where("a < b").select("a", "b")


def _classes(
    able: DataFrame, texts: DataFrame, by_id: bool, level: int, size: int, matches: int, side: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Classes (id, rep, key, n, sig, digest) of rows (id, key, n, digest, sig), and components (id, component) of linked classes.

    A class is numbered by itself, so that an id may stand in several; ``rep`` is its least id, null if it has none, and ``key``
    the least text key under that id. With ``by_id`` classes that share an id are linked too.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    classes = able.groupBy(F.col("digest").alias("d")).agg(first)
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")) & (F.col("digest") == F.col("d"))
    reps = able.join(classes, same, "left_semi").dropDuplicates(["digest"])
    # Written, so that the numbers are given once.
    reps = scratch.write(reps.select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("rep"), "key", "n", "sig", "digest"), "minhash-classes")
    ties = scratch.write(_ties(able, reps, scratch), "minhash-ties") if by_id else able.sparkSession.range(0).selectExpr("id AS a", "id AS b")

    posted = reps.select("id", F.posexplode("sig").alias("pos", "val"))
    shared = posted.groupBy("val").agg(F.count("*").alias("f")).where("f > 1")
    common = F.sort_array(F.collect_list(F.struct("f", "val", "pos")))
    prefixes = (
        posted.join(shared, "val").groupBy("id").agg(common.alias("common"), F.sum(F.log2("f")).alias("weight"))
        .where(F.size("common") >= matches)
        .select("id", "weight", F.explode(F.slice("common", 1, F.size("common") - F.lit(matches - 1))).alias("c"))
        .select("id", "weight", F.col("c.val").alias("val"), F.col("c.pos").alias("pos"))
    )
    prefixes = scratch.write(prefixes, "minhash-prefixes")
    # Lists of the same members say the same; one of them stays.
    lists = prefixes.groupBy("val").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40))).alias("y"),
        F.max(F.struct("weight", "id")).getField("id").alias("pivot"),
    ).where("n > 1")
    lists = lists.groupBy("n", "x", "y", "pivot").agg(F.min("val").alias("val")).select("val", "n", "pivot")
    members = scratch.write(prefixes.select("id", "val", "pos").join(lists, "val"), "minhash-lists")

    met = members.where("id != pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    sig = lambda name: reps.select(F.col("id").alias(name), F.col("sig").alias(f"sig_{name}"))
    agree = F.size(F.array_intersect("sig_a", "sig_b"))
    stars = scratch.write(met.join(sig("a"), "a").join(sig("b"), "b").where(agree >= matches).select("a", "b"), "minhash-stars")

    wanted = scratch.write(reps.join(members.select("id").distinct(), "id", "left_semi").select("id", "rep", "key", "digest"), "minhash-wanted")
    # Of each class the text under its least id makes its set, not those of its copies. Sorted and merged at any size: a
    # small list of keys would be broadcast, and the plan would change as it grows.
    named = wanted.select(F.col("rep").alias("id"), "key").distinct().hint("merge")
    source = texts.where("id is not null").join(named, ["id", "key"], "left_semi").select("text")
    if not by_id:
        unnamed = wanted.where("rep is null").select("key").distinct().hint("merge")
        source = source.unionByName(texts.where("id is null").dropDuplicates(["key"]).join(unnamed, "key", "left_semi").select("text"))
    sets = _full_sets(source, size).dropDuplicates(["digest"]).join(wanted.select("id", "digest").hint("merge"), "digest")
    sets = scratch.write(sets.select("id", "shingles"), "minhash-sets")
    links = scratch.write(_linked(stars, sets, level), "minhash-links")
    joined = components(links.unionByName(ties), scratch)

    labelled = members.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = scratch.write(labelled, "minhash-labelled")
    split = labelled.groupBy("val").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("val")
    left = scratch.write(labelled.where("n > 2").join(split, "val", "left_semi"), "minhash-left")
    own = left.select("id").distinct().join(sets, "id")
    each = own.select("id", F.explode("shingles").alias("shingle"))
    again = each.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1").select("shingle")
    sharing = each.join(again, "shingle").groupBy("id").agg(F.count("*").alias("shared"))
    fit = (
        sharing.join(reps.select("id", F.col("n").alias("size"), "sig"), "id").where(F.lit(100) * F.col("shared") >= F.lit(level) * F.col("size"))
        .join(left.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, pos)")).alias("own")), "id")
    )
    open_ = scratch.write(left.join(fit, "id"), "minhash-open")
    open_ = open_.join(open_.groupBy("val").agg(F.sum(F.col("size") * 8).alias("bytes")), "val")
    more = _links_in_squares(open_, sets, matches, level, side, scratch)
    joined = components(links.unionByName(ties).unionByName(more), scratch)
    return reps, joined


def _text_key(text: str):
    """A digest of a text; rows are told apart by it where ids are not enough."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, size: int = SHINGLE, coordinates: int = COORDINATES,
    matches: int = MATCHES, side: int = SIDE,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles (set size), component_id (least id reachable), kept (it is that one).

    Linked are documents whose sets have 100 * common >= level * union. Ids are integers. A null or blank text has no
    shingle and no link. A row without an id takes no part: its component is null and it is kept. Rows that repeat an
    id get that id's result each; if their texts differ, their links count together. A very long text is one set like any
    other, hashed in stretches. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(ready(docs))
    texts = docs.select(F.col(id_col).alias("id"), _text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    signed = scratch.write(_signed(texts, size, coordinates), "minhash-signed")
    able = signed.where("digest is not null and id is not null")
    reps, joined = _classes(able, texts, True, level, size, matches, side, scratch)

    linked = reps.select("id", "rep").join(joined, "id")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    joined = joined.join(least, "component").select("id", "least")
    named = reps.select("id", "rep", F.col("digest").alias("d")).join(joined, "id", "left").select("d", F.coalesce("least", "rep").alias("component_id"))
    named = scratch.write(named, "minhash-named")
    # A blank row has the result of other rows with its id.
    blank = signed.where("digest is null and id is not null")
    others = able.select("id", "digest").join(blank.select("id").distinct().hint("merge"), "id", "left_semi").distinct()
    others = others.join(named, F.col("digest") == F.col("d")).groupBy("id").agg(F.min("component_id").alias("component_id"))
    out = signed.where("digest is not null").join(named, F.col("digest") == F.col("d"), "left").select("id", "n", "component_id")
    out = out.unionByName(blank.join(others, "id", "left").select("id", "n", "component_id"))
    out = out.unionByName(signed.where("digest is null and id is null").select("id", "n", F.col("id").alias("component_id")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))
    out = scratch.write(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "minhash-result")
    scratch.drop(out)
    return out


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, size: int = SHINGLE) -> DataFrame:
    """One whole row of each group of linked texts: one with the group's least id, or without an id if none has one.

    Rows count by their texts: an id on texts that are not linked stays with each of them, and copies without an id go
    like others. Blank texts are not linked: of these, rows that repeat id and text stay once, and rows without an id all.
    Only keys and texts pass through Python, and whole rows are dealt once; rows that differ in other columns alone are
    copies. An empty table gives no rows.
    """
    scratch = Scratch(ready(docs))
    texts = docs.select(F.col(id_col).alias("id"), _text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    able = scratch.write(_signed(texts, size, COORDINATES).where("digest is not null"), "minhash-signed")
    reps, joined = _classes(able, texts, False, level, size, MATCHES, SIDE, scratch)
    # Of the classes of a component the one with the least id stays; classes that share this id are taken by key.
    linked = reps.select("id", "rep", "key").join(joined, "id")
    best = linked.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("best"))
    alone = reps.join(joined.select("id"), "id", "left_anti").select("rep", "key")

    key, least, none = (free_name(docs, n) for n in ("_key", "_least", "_none"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    stay = alone.unionByName(best.select("best.rep", "best.key"))
    stay = scratch.write(stay.select(F.col("key").alias(key), zero(F.col("rep")).alias(least), F.col("rep").isNull().alias(none)), "minhash-stay")
    scratch.drop(stay)
    blank = F.coalesce(F.col(text_col), F.lit("")).rlike(r"\A[ \t\n\x0B\f\r]*\z")
    marked = docs.where(~blank).withColumns({key: _text_key(text_col), least: zero(F.col(id_col)), none: F.col(id_col).isNull()})
    # Merged at any size, so that the plan does not change as the table grows; rows of a text and id then lie together anyway.
    keys = [key, least, none]
    whole = marked.join(stay.hint("merge"), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
    empty = docs.where(blank)
    return whole.unionByName(empty.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])).unionByName(empty.where(F.col(id_col).isNull()))
