"""Quality by weak supervision.

Rules vote good (1), bad (-1) or abstain (0) on each document. How far each rule can be trusted is not set but
estimated: expectation-maximisation over all documents finds the share of good ones and, for each rule, how it votes on
good and on bad documents. A document's posterior probability of being good then replaces "all rules must pass".

The rules give at most 3 ** 9 patterns of votes, however many documents there are, so Spark counts patterns, the
estimate works on that small table, and its answer is a table of patterns again. Where some documents have a label, the
truth of those is not estimated but known; they count like any other, and keep the estimate from mistaking one frequent
kind of bad document for all of them.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm._util import free_name, hashed_words, lowered_chunks, ready, small_batches, staged

WINDOW = 8
LEAST_WORDS = 20
#: The posterior from which a document is kept.
LEAST_POSTERIOR = 0.5
_SYMBOLS = b"[#*$%&|<>]"
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_END_MARK = re.compile(r"[.!?:;\"')\]»…。！？]\s*$")

#: Name, then the vote on a document's measures: 1 good, -1 bad, 0 abstains.
RULES = (
    ("length", lambda m: -1 if m["n_words"] < 20 else 1 if m["n_words"] >= 50 else 0),
    ("word_length", lambda m: -1 if not 2.5 <= m["mean"] <= 12 else 1 if 3.5 <= m["mean"] <= 8 else 0),
    ("symbols", lambda m: -1 if m["symbols"] > 0.1 else 1 if m["symbols"] < 0.03 else 0),
    ("marked_words", lambda m: -1 if m["marked"] > 0.3 else 1 if m["marked"] < 0.1 else 0),
    ("repeats", lambda m: -1 if m["repeats"] > 0.2 else 1 if m["repeats"] < 0.05 else 0),
    ("lines", lambda m: -1 if m["lines"] > 0.3 else 1 if m["lines"] < 0.1 else 0),
    ("capitals", lambda m: -1 if m["capitals"] > 0.4 else 1 if m["capitals"] < 0.15 else 0),
    ("exclamations", lambda m: -1 if m["exclamations"] > 0.2 else 1 if m["exclamations"] < 0.05 else 0),
    ("plain_words", lambda m: -1 if m["plain"] < 0.6 else 1 if m["plain"] > 0.8 else 0),
)
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(word: np.ndarray, window: int = WINDOW) -> int:
    """Words that stand in a window found twice or more in the text, the first one included."""
    n = len(word) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        key = np.zeros(n, np.uint64)
        for j in range(window):
            key = key * np.uint64(0x9FB21C651E98DF25) + word[j : j + n]
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    depth = np.zeros(len(word) + 1, np.int64)
    depth[:n] += twice
    depth[window : window + n] -= twice
    return int((np.cumsum(depth)[:-1] > 0).sum())


def _duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measure(texts):
    """A dictionary of measures and votes for each Arrow string; null and blank texts have no word."""
    for some in lowered_chunks(texts, lower=False):
        data, space, last, stop, of_word, word = hashed_words(some)
        holds = np.zeros(len(word))
        holds[np.searchsorted(stop, np.flatnonzero(_SYMBOL[data]), "right")] = 1
        marked = np.bincount(of_word, holds, len(some))
        ends = np.searchsorted(of_word, np.arange(len(some)), "right")
        letters = ~space & ~_CONTINUES[data]
        begins = np.concatenate(([0], last[:-1] + 1))
        chars_at, symbols_at = (np.add.reduceat(x, begins, dtype=np.int64) for x in (letters, _SYMBOL[data]))
        start = 0
        for i, text in enumerate(some):
            words, start = word[start : ends[i]], ends[i]
            n = len(words)
            m = {"n_words": n, "word_chars": int(chars_at[i]), "n_symbols": int(symbols_at[i])}
            m["n_dup_lines"], m["n_repeat_words"] = _duplicate_lines(text), _repeated_words(words)
            m["base_failed"] = n < LEAST_WORDS or 100 * m["n_repeat_words"] > 30 * n
            plain = text.decode("utf-8", "surrogatepass")
            per = max(1, n)
            lines = max(1, text.count(b"\n") + 1)
            m["mean"] = m["word_chars"] / per
            m["symbols"] = m["n_symbols"] / per
            m["marked"] = marked[i] / per
            m["repeats"] = m["n_repeat_words"] / per
            m["lines"] = m["n_dup_lines"] / lines
            lower, upper = _cases(text, plain)
            m["capitals"] = upper / max(1, lower + upper)
            m["exclamations"] = plain.count("!") / per
            m["plain"] = _with_letters(plain) / per
            m["votes"] = "".join("b?g"[rule(m) + 1] for _, rule in RULES)
            yield m


def _cases(data: bytes, text: str) -> tuple[int, int]:
    """Lower-case and upper-case letters."""
    if text.isascii():
        a = np.frombuffer(data, np.uint8)
        return int(((a >= 97) & (a <= 122)).sum()), int(((a >= 65) & (a <= 90)).sum())
    lowered, raised = text.lower(), text.upper()
    if len(lowered) == len(text) == len(raised):
        a, b, c = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (text, lowered, raised))
        return int((a != c).sum()), int((a != b).sum())
    return sum(map(str.islower, text)), sum(map(str.isupper, text))


_PLAIN = re.compile(r"[^\W\d_]")


def _with_letters(text: str) -> int:
    """Words that hold a letter."""
    words = text.split()
    return sum(w.isalpha() or bool(_PLAIN.search(w)) for w in words)


def fit(patterns: list[tuple[str, int, int, int]], rounds: int = 200, tolerance: float = 1e-9) -> dict[str, float]:
    """Posterior probability of good for each pattern of votes.

    A pattern comes with the number of documents that have it: without a label, labelled good, labelled bad. Rules are
    taken as independent given the truth. Documents without a label count no more in all than those with one, so that
    many of the former do not outvote what is known. The start says that rules are right in most votes and that three documents in
    four are good; each share is smoothed by one document. Without documents nothing is returned.
    """
    patterns = sorted(patterns)
    if not patterns:
        return {}
    votes = np.array([["b?g".index(v) for v in p] for p, *_ in patterns])
    unknown, known_good, known_bad = np.array([n for _, *n in patterns], float).T
    known = (known_good + known_bad).sum()
    if known:
        unknown = unknown * min(1.0, known / max(1.0, unknown.sum()))
    each = np.arange(votes.shape[1])
    good, says = 0.75, np.empty((2, len(each), 3))
    says[0], says[1] = (0.5, 0.3, 0.2), (0.1, 0.2, 0.7)
    posterior = None
    for _ in range(rounds):
        log = np.log([1 - good, good]) + np.stack([np.log(says[k][each, votes]).sum(axis=1) for k in (0, 1)], axis=1)
        share = np.exp(log - log.max(axis=1, keepdims=True))
        new = share[:, 1] / share.sum(axis=1)
        if posterior is not None and np.abs(new - posterior).max() < tolerance:
            break
        posterior = new
        weights = (known_bad + unknown * (1 - posterior), known_good + unknown * posterior)
        good = (1 + weights[1].sum()) / (2 + sum(w.sum() for w in weights))
        for k in (0, 1):
            for v in range(3):
                says[k, :, v] = 1 + (weights[k][:, None] * (votes == v)).sum(axis=0)
            says[k] /= says[k].sum(axis=1, keepdims=True)
    return {p: float(x) for (p, *_), x in zip(patterns, posterior)}


def _measured(docs: DataFrame, text_col: str, names: dict[str, str]) -> DataFrame:
    """All columns and the measures under the given names."""
    at = docs.columns.index(text_col)
    types = {k: pa.bool_() if k == "base_failed" else pa.string() if k == "votes" else pa.int64() for k in names}
    spark_types = {k: T.BooleanType() if k == "base_failed" else T.StringType() if k == "votes" else T.LongType() for k in names}

    def run(batches):
        for batch in small_batches(batches, at):
            found = list(measure(batch.column(at)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([m[k] for m in found], types[k]) for k in names)], [*batch.schema.names, *names.values()]
            )

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema] + [T.StructField(names[k], spark_types[k]) for k in names])
    return docs.mapInArrow(run, schema)


def _verdicts(votes: DataFrame, labels: DataFrame | None) -> dict[str, float]:
    """Posterior by pattern, from rows (id, votes) and labels (id, good)."""
    counts = {r["votes"]: [r["n"], 0, 0] for r in votes.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    if labels is not None:
        known = votes.join(labels.groupBy("id").agg(F.min("good").alias("good")), "id").where("good is not null")
        for r in known.groupBy("votes", "good").agg(F.count("*").alias("n")).collect():
            counts[r["votes"]][0] -= r["n"]
            counts[r["votes"]][1 if r["good"] else 2] += r["n"]
    return fit([(v, *n) for v, n in counts.items()])


def labels_of(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Labels as (id, good)."""
    return labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).alias("good"))


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_POSTERIOR, labels: DataFrame | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, posterior, kept.

    ``kept`` is false where the base rule fails (fewer than 20 words, or over 30 % of words in repeated 8-word windows),
    else whether the posterior reaches ``least``. ``labels`` (id, good) may cover some documents; of contrary labels
    bad counts. A null or empty text has no word, fails the base and is not kept. Repeated rows weigh as often as they
    stand; ids may be null, which no label meets; a very long text is measured whole; other columns are not read; an empty
    table gives no rows.
    """
    spark = ready(docs)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = {k: k for k in (*_MEASURES, "base_failed", "votes")}
    measured = staged(_measured(source, "text", names).drop("text"), "quality-measures")
    table = spark.createDataFrame(list(_verdicts(measured, labels).items()), "votes string, posterior double")
    judged = measured.join(F.broadcast(table), "votes", "left")
    return judged.select(
        F.col("id").alias("doc_id"), *_MEASURES, "base_failed", "posterior", (~F.col("base_failed") & (F.col("posterior") >= least)).alias("kept")
    )


def keep_good_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_POSTERIOR, labels: DataFrame | None = None
) -> DataFrame:
    """The rows, with all their columns, that :func:`judge_documents` keeps, which says what becomes of odd rows.

    Rows are measured once and written with what was found; texts of any length are measured whole.
    """
    spark = ready(docs)
    failed, own = free_name(docs, "_failed"), free_name(docs, "_votes")
    marked = staged(_measured(docs, text_col, {"base_failed": failed, "votes": own}), "quality-votes")
    votes = marked.select(F.col(f"`{id_col}`").alias("id"), F.col(own).alias("votes"))
    good = [(v,) for v, p in _verdicts(votes, labels).items() if p >= least]
    right = F.broadcast(spark.createDataFrame(good, f"{own} string"))
    return marked.where(~F.col(failed)).join(right, own, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
