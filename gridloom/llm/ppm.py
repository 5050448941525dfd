"""Language-model scores by prediction by partial matching (PPM, method D, with symbol exclusion).

The model is a trie of byte contexts of the orders 0 to ``ORDER``. A node is a row: the last bytes of the context,
packed into one 64-bit number with the predicted byte lowest, and its count in the training documents. The trie of
order k - 1 is the sum of that of order k over the oldest byte, so one pass over the texts counts all orders.

Escape and exclusion need only sums per context. Every byte seen after a long context was seen after its suffix too,
so the bytes excluded on leaving a context are those seen after it, and with T the total, D the distinct bytes and X
the count of the same bytes in the suffix context, the suffix predicts with ``T' - X`` and ``D' - D`` instead of T' and
D'. That turns the walk along the trie into one join and one window (of at most 252 rows) per order.

Texts are read in blocks of about ``BLOCK_BYTES``. A block lists its distinct words and byte strings once, dealt into
buckets by key; a bucket meets the counts or costs of the whole corpus for its keys and sends the values back to the
blocks that asked, where every position is looked up. A very common word is one entry per block, the number of buckets
grows with the corpus so that a bucket stays small, and nothing that grows is broadcast or collected. Words are known
by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm._util import hashed_words, lowered_chunks, ready, staged, text_bytes

ORDER = 5
BLOCK_BYTES = 40_000_000
#: 256 bytes without the six white-space ones, and the two that stand for the word gap and the end.
ALPHABET = 252
GAP, END = 0x20, 0x0A
_MIX = 0xBF58476D1CE4E5B9
#: The end, where words are counted; no mixed hash is known to take this value.
_END_WORD = -1


def _read(texts: list[bytes], order: int):
    """Of some texts: hash and text number of each word; packed context and text number of each coded byte.

    A text is coded as its words with one gap between and an end after them; before it stand ends alone.
    """
    data, space, last, stop, of_word, word = hashed_words(texts)
    inner = np.ones(len(stop), bool)
    inner[np.flatnonzero(np.diff(of_word, append=-1))] = False
    code = data.copy()
    code[stop[inner]] = GAP
    keep = ~space
    keep[stop[inner]] = True
    keep[last] = True
    code[last] = END
    times = keep.astype(np.int64)
    times[last] = order
    spread = np.concatenate([np.full(order, END, np.uint8), np.repeat(code, times)]).astype(np.int64)
    n = len(spread) - order
    gram = np.zeros(n, np.int64)
    for i in range(order + 1):
        gram = (gram << 8) | spread[i : i + n]
    real = np.ones(n, bool)
    first_end = np.cumsum(times)[last] - order
    for i in range(1, order):
        real[first_end + i] = False
    of_byte = np.repeat(np.arange(len(texts)), np.diff(np.cumsum(keep)[last], prepend=0))
    return word.view(np.int64), of_word, gram[real], of_byte


class _Index:
    """Places of 64-bit keys in an array: tables of hashed slots, each for the keys that lost in the one before."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables, left = keys, [], np.arange(len(keys))
        mixer = _MIX
        while len(left):
            bits = max(4, int(len(left) * 2).bit_length())
            mixer = mixer * 0x2545F4914F6CDD1D % (1 << 64) | 1
            table = np.full(1 << bits, -1, np.int64)
            slot = self._slot(keys[left], mixer, bits)
            table[slot] = left
            left = left[table[slot] != left]
            self.tables.append((mixer, bits, table))

    @staticmethod
    def _slot(keys, mixer, bits):
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(mixer)) >> np.uint64(64 - bits)).view(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key; all must be there."""
        out, left = np.empty(len(wanted), np.int64), None
        for mixer, bits, table in self.tables:
            some = wanted if left is None else wanted[left]
            place = table[self._slot(some, mixer, bits)]
            hit = self.keys[place] == some
            if left is None:
                out, left = place, np.flatnonzero(~hit)
            else:
                out[left[hit]] = place[hit]
                left = left[~hit]
            if not len(left):
                break
        return out


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(id, text, held, block) and the number of blocks; a block follows from id and text alone."""
    size = docs.agg(F.sum(text_bytes(text_col) + 64)).first()[0] or 0
    n = max(16, -(-size // block_bytes))
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held.alias("held"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).alias("block"),
    ), n


def _bucket_count(blocks: int) -> int:
    """A prime of about four times the blocks, a million at most."""
    n = min(4 * blocks, 1_000_000) | 1
    while any(n % d == 0 for d in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and summed counts of lists of (keys, counts)."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    by_key = np.argsort(keys, kind="stable")
    keys, counts = keys[by_key], counts[by_key]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _distinct(texts, held, order: int):
    """For grams, then words: the distinct keys of a block and how often they stand in its training texts."""
    found, at = ([], []), 0
    for some in lowered_chunks(texts):
        word, of_word, gram, of_byte = _read(some, order)
        trains = ~held[at : at + len(some)]
        at += len(some)
        for parts, keys, of in ((found[0], gram, of_byte), (found[1], word, of_word)):
            trained = trains[of]
            parts.append(np.unique(keys[trained], return_counts=True))
            other = np.unique(keys[~trained])
            parts.append((other, np.zeros(len(other), np.int64)))
            if len(parts) >= 16:
                parts[:] = [_merge(parts)]
    found[1].append((np.array([_END_WORD]), np.array([int((~held).sum())])))
    return _merge(found[0]), _merge(found[1])


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of sorted keys by bucket, the buckets met, and where each begins in that order (with the end)."""
    bucket = keys % buckets
    by = np.argsort(bucket, kind="stable")
    met, first = np.unique(bucket[by], return_index=True)
    return by, met, np.append(first, len(keys))


def _list_block(order: int, buckets: int):
    def run(block: pa.Table) -> pa.Table:
        held = block["held"].to_numpy()
        out = []
        for kind, (keys, counts) in enumerate(_distinct(block["text"], held, order)):
            by, met, first = _dealt(keys, buckets)
            offsets = pa.array(first, pa.int32())
            out.append(pa.table({
                "kind": pa.array(np.full(len(met), kind, np.int32)),
                "block": pa.array(np.full(len(met), block["block"][0].as_py(), np.int64)), "bucket": pa.array(met),
                "keys": pa.ListArray.from_arrays(offsets, pa.array(keys[by])),
                "counts": pa.ListArray.from_arrays(offsets, pa.array(counts[by])),
            }))
        return pa.concat_tables(out)

    return run


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _count_grams(bucket: pa.Table) -> pa.Table:
    keys, counts = _merge([(_flat(bucket["keys"]), _flat(bucket["counts"]))])
    return pa.table({"gram": pa.array(keys), "c": pa.array(counts)})


def _answer(bucket: pa.Table, keys: np.ndarray, values: np.ndarray, **more) -> pa.Table:
    """The asking rows with the values of their keys."""
    lists = bucket["keys"].combine_chunks()
    wanted = values[np.searchsorted(keys, lists.flatten().to_numpy(zero_copy_only=False))]
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    n = bucket.num_rows
    extra = {k: pa.array(np.concatenate([[v], np.zeros(n - 1, np.int64)])) for k, v in more.items()}
    return pa.table({
        "kind": bucket["kind"], "block": bucket["block"], "bucket": bucket["bucket"],
        "vals": pa.ListArray.from_arrays(offsets, pa.array(wanted)), **extra,
    })


def _count_words(bucket: pa.Table) -> pa.Table:
    keys, counts = _merge([(_flat(bucket["keys"]), _flat(bucket["counts"]))])
    return _answer(bucket, keys, counts.astype(np.float64), total=int(counts.sum()), distinct=int((counts > 0).sum()))


def _cost_grams(bucket: pa.Table, costs: pa.Table) -> pa.Table:
    keys, values = costs["gram"].to_numpy(), costs["logp"].to_numpy()
    by_key = np.argsort(keys)
    return _answer(bucket, keys[by_key], values[by_key])


def log_costs(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp): log10 of the model's probability of the last byte, for each row (gram, c) of the highest order."""
    levels = [counted]
    for k in range(order - 1, -1, -1):
        mask = F.lit((1 << (8 * (k + 1))) - 1)
        up = levels[-1]
        levels.append(up.groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("c").alias("c")))
    levels.reverse()

    seen = F.col("c") > 0
    node = None
    for k, level in enumerate(levels):
        ctx = Window.partitionBy(F.shiftright("gram", 8))
        if k == 0:
            joined = level.withColumn("pc", F.lit(0))
        else:
            mask = F.lit((1 << (8 * k)) - 1)
            joined = level.withColumn("pg", F.col("gram").bitwiseAND(mask)).join(node, "pg")
        joined = joined.withColumns({
            "t": F.sum("c").over(ctx), "d": F.sum(seen.cast("long")).over(ctx),
            "x": F.sum(F.when(seen, F.col("pc")).otherwise(0)).over(ctx),
        })
        if k == 0:
            below = F.try_divide(F.lit(1.0), ALPHABET - F.col("d"))
            unseen = F.lit(1.0 / ALPHABET)
        else:
            n, rest = F.col("pt") - F.col("x"), F.col("pd") - F.col("d")
            escape = F.when(rest > 0, F.try_divide(rest, 2.0 * n)).otherwise(1.0)
            below = F.when(F.col("pc") > 0, F.try_divide(2.0 * F.col("pc") - 1, 2.0 * n)).otherwise(escape * F.col("pbelow"))
            unseen = F.col("pp")
        p = (
            F.when(seen, F.try_divide(2.0 * F.col("c") - 1, 2.0 * F.col("t")))
            .when(F.col("t") > 0, F.try_divide(F.col("d").cast("double"), 2.0 * F.col("t")) * F.col("below"))
            .otherwise(unseen)
        )
        joined = joined.withColumn("below", below).withColumn("p", p)
        node = joined.select(
            F.col("gram").alias("pg"), F.col("c").alias("pc"), F.col("t").alias("pt"), F.col("d").alias("pd"),
            F.col("p").alias("pp"), F.col("below").alias("pbelow"),
        )
    return joined.select("gram", F.log10("p").alias("logp"))


def _score_block(order: int, buckets: int, total: int, distinct: int):
    floor = total + 0.5 * (distinct + 1)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        held = docs["held"].to_numpy()
        index, value = [], []
        for kind, (keys, _) in enumerate(_distinct(docs["text"], held, order)):
            mine = answers.filter(pc.equal(answers["kind"], kind)).sort_by("bucket")
            by, _, _ = _dealt(keys, buckets)
            index.append(_Index(keys[by]))
            value.append(_flat(mine["vals"]))
            assert len(value[-1]) == len(keys), "a block and its answers differ"
        end = value[1][index[1](np.array([_END_WORD]))[0]]
        columns = [[], [], [], []]
        for some in lowered_chunks(docs["text"]):
            word, of_word, gram, of_byte = _read(some, order)
            c, n = value[1][index[1](word)], len(some)
            base = np.log10((c + 0.5) / floor)
            columns[0].append(np.bincount(of_word, minlength=n) + 1)
            columns[1].append(np.bincount(of_word, c > 0, n).astype(np.int64) + int(end > 0))
            columns[2].append(np.bincount(of_word, base, n) + np.log10((end + 0.5) / floor))
            columns[3].append(np.bincount(of_byte, value[0][index[0](gram)], n))
        n_tokens, n_known, base, score = (pa.array(np.concatenate(x)) for x in columns)
        return pa.table({
            "doc_id": docs["id"], "held_out": docs["held"], "n_tokens": n_tokens, "n_known": n_known,
            "train_tokens": pa.array(np.full(docs.num_rows, total, np.int64)), "base_score": base, "score": score,
        })

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every text by a PPM model of the documents not held out, beside a unigram baseline.

    Held out are documents whose crc32(id as text) mod 5 is 1. One row per input row: doc_id, held_out, n_tokens
    (words and one end), n_known (tokens met in training), train_tokens, base_score (unigram, add one half), score:
    both log10 of the probability of the whole text.

    Null and blank texts are the end alone. A null id reads as empty text and is in training. Repeated rows count and
    are returned as often as they stand. With no training document every byte has one chance in 252. An empty table
    gives no rows. A very long text is one block and is coded whole. Other columns are not read. ``order`` is 1 to 6.
    """
    ready(docs)
    blocked, n = _blocks(docs, id_col, text_col, block_bytes)
    buckets = _bucket_count(n)
    id_type = dict(blocked.dtypes)["id"]
    items = staged(blocked.groupBy("block").applyInArrow(_list_block(order, buckets), "kind int, block long, bucket long, keys array<long>, counts array<long>"), "ppm-items")
    grams, words = items.where("kind = 0"), items.where("kind = 1")
    answer = "kind int, block long, bucket long, vals array<double>"

    counted_words = staged(words.groupBy("bucket").applyInArrow(_count_words, f"{answer}, total long, distinct long"), "ppm-words")
    total, distinct = counted_words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    counted = staged(grams.select("bucket", "keys", "counts").groupBy("bucket").applyInArrow(_count_grams, "gram long, c long"), "ppm-grams")
    costs = staged(log_costs(counted, order).withColumn("bucket", F.pmod("gram", F.lit(buckets))), "ppm-costs")
    costed = grams.drop("counts").groupBy("bucket").cogroup(costs.groupBy("bucket")).applyInArrow(_cost_grams, answer)
    answers = costed.unionByName(counted_words.drop("total", "distinct"))
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(order, buckets, total, distinct),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
