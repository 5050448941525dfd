"""Byte-pair encoding and decoding with a minimal acyclic transducer as lexicon.

Words are counted over the whole corpus. The most frequent ones, ``LEXICON`` at most, are encoded once and compiled into
a minimal acyclic automaton that shares prefixes and suffixes; every transition carries the number of words that pass
before it, so that the sum along a word's path is the word's number and points to its ids. The automaton is one file in
the shared folder, fetched by Spark to each executor once and memory-mapped there, so all workers of a machine share it.
A word that is not in it is merged exactly. What is frequent decides on speed alone, never on results.

A text is cut at ASCII white space: normalising and pre-tokenizing work within such pieces, so ids of pieces add up to
those of the text. A task looks at some megabytes of text together: each different piece is encoded once, all unseen
words are merged side by side, and the texts are put together by position. Special strings are found within pieces, as the library finds them.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import sys
import uuid
from array import array
from collections import Counter
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm._util import kept, ready, slices, staged
from gridloom.llm.merging import Cache, merge_pairs
from gridloom.session import shared_folder

LEXICON = 50_000
#: Pieces whose ids a worker knows at a time; fewer where whole rows pass through it.
PIECES, PIECES_WITH_ROWS = 400_000, 220_000
#: Pre-tokens of more characters are merged on a heap, each by itself.
LONG = 48
#: Bytes of texts that are looked up together, and that are counted together.
SLICE, COUNTED = 2_000_000, 8_000_000
#: The vocabulary file's pattern as it reads on printable ASCII without spaces.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_MAGIC = b"GLLEX001"
# Numbers in the file and in results are little-endian and of 32 bits, and are read and written as the machine has them.
assert sys.byteorder == "little" and array("I").itemsize == 4


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The automaton of some words with their ids, as the bytes of its file.

    Words are added in order; a state that can no longer change is replaced by an equal one if there is one.
    """
    words = sorted((w.encode(), ids) for w, ids in entries.items())
    # A state is [final, {byte: state}]; frozen states are known by what they hold.
    root, register, path, last = [False, {}], {}, [], b""

    def freeze(depth: int) -> None:
        while len(path) > depth:
            parent, byte, state = path.pop()
            key = (state[0], tuple((b, id(s)) for b, s in state[1].items()))
            parent[1][byte] = register.setdefault(key, state)

    for word, _ in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        freeze(shared)
        state = path[-1][2] if path else root
        for byte in word[shared:]:
            new = [False, {}]
            state[1][byte] = new
            path.append((state, byte, new))
            state = new
        state[0] = True
        last = word
    freeze(0)

    # States in an order where targets come first, with the number of words each accepts.
    states, order, below, stack = [], {}, {}, [(root, False)]
    while stack:
        state, done = stack.pop()
        if id(state) in order:
            continue
        if done:
            order[id(state)] = len(order)
            below[id(state)] = state[0] + sum(below[id(s)] for s in state[1].values())
            states.append(state)
        else:
            stack.append((state, True))
            stack.extend((s, False) for s in state[1].values())
    first, final, label, target, skip = [], [], [], [], []
    for state in states:
        first.append(len(label))
        final.append(state[0])
        passed = int(state[0])
        for byte, to in sorted(state[1].items()):
            label.append(byte)
            target.append(order[id(to)])
            skip.append(passed)
            passed += below[id(to)]
    first.append(len(label))
    starts = np.cumsum([0] + [len(ids) for _, ids in words])
    parts = [np.array(x, np.uint32) for x in (first, final, label, target, skip, starts, [i for _, ids in words for i in ids])]
    head = np.array([len(p) for p in parts], np.uint64)
    return _MAGIC + head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled automaton in a memory-mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError(f"{path} is not a lexicon")
        lengths = np.frombuffer(self._map, np.uint64, 7, 8)
        at, view = 8 + 56, memoryview(self._map)
        parts = []
        for n in lengths.tolist():
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self._first, self._final, self._label, self._target, self._skip, self._starts, self._ids = parts
        self._root = len(self._final) - 1
        # A byte for each transition, so that a state's are searched at once.
        self._labels = np.frombuffer(self._label, np.uint32).astype(np.uint8).tobytes()

    def __len__(self) -> int:
        return len(self._starts) - 1

    def get(self, word: str) -> list[int] | None:
        """Ids of a word, None if it is not in the lexicon."""
        first, find, skip, target, state, number = self._first, self._labels.find, self._skip, self._target, self._root, 0
        for byte in word.encode():
            t = find(byte, first[state], first[state + 1])
            if t < 0:
                return None
            number += skip[t]
            state = target[t]
        if not self._final[state]:
            return None
        return self._ids[self._starts[number] : self._starts[number + 1]].tolist()


class Merges:
    """The merges of a vocabulary, applied to many words at once.

    A round merges in every word the leftmost of its neighbours of least rank, so a word takes as many rounds as it has
    merges; words without any leave. Only neighbours of what a round has merged are looked up anew.
    """

    _NONE = np.int64(1 << 30)

    def __init__(self, vocab: dict[str, int], pairs: list[tuple[str, str]], suffix: str):
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self._key, self._rank = key[order], order
        self._made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        symbols = [c for c in vocab if len(c) == 1 and ord(c) < 1023]
        self._inner, self._last = np.full(1024, -1, np.int64), np.full(1024, -1, np.int64)
        for c in symbols:
            self._inner[ord(c)], self._last[ord(c)] = vocab[c], vocab.get(c + suffix, -1)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], self._NONE)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word starts and the last one ends; no word is empty."""
        length = np.array([len(w) for w in words], np.int64)
        code = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), 1023)
        last = np.cumsum(length) - 1
        ids, word = self._inner[code], np.repeat(np.arange(len(words)), length)
        ids[last] = self._last[code[last]]
        if len(ids) and ids.min() < 0:
            raise ValueError("a character is not in the vocabulary")
        rank = np.full(len(ids), self._NONE)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._ranks(ids[inside], ids[inside + 1])
        done = []
        while len(ids):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), start)
            live = best >> 32 < self._NONE
            if not live.all():
                here = np.repeat(live, np.diff(start, append=len(ids)))
                done.append((word[~here], ids[~here]))
                ids, word, rank = ids[here], word[here], rank[here]
                start = np.flatnonzero(np.diff(word, prepend=-1))
                best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), start) if len(ids) else start
            at = best & 0xFFFFFFFF
            ids[at] = self._made[best >> 32]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            touched = np.concatenate([at[at > 0] - 1, at])
            rank[touched] = self._NONE
            touched = touched[touched + 1 < len(ids)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._ranks(ids[touched], ids[touched + 1])
        word = np.concatenate([w for w, _ in done]) if done else word
        ids = np.concatenate([i for _, i in done]) if done else ids
        return ids[np.argsort(word, kind="stable")], np.searchsorted(np.sort(word), np.arange(len(words) + 1))


def _joined(values: list[bytes], index: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Values in the order of ``index``, those between two bounds as one."""
    taken = pa.array(values, pa.large_binary()).take(index)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = taken.buffers()[2] or pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends[bounds]), data])


class WordTokenizer:
    """Encodes and decodes as the library does with a byte-level word-end vocabulary, with a lexicon before the merges.

    Both caches hold the ids of their key as little-endian 32-bit numbers, and its tokens with a space after each.
    """

    def __init__(self, path: str, lexicon: Lexicon | None = None, pieces: int = PIECES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.vocab, self.suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.merges = Merges(self.vocab, merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t.encode() + b" " for t, i in (self.vocab | self.special).items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.lexicon = lexicon
        # Of about 30 bytes a key, so that the number of pieces is what is asked for in ordinary text.
        self.piece, self.word = Cache(None, most_bytes=480 * pieces, entry=360), Cache(None, most_bytes=60_000_000)

    def merged(self, word: str) -> list[int]:
        """Ids of one pre-token by merging."""
        return [self.vocab[s] for s in merge_pairs([*word[:-1], word[-1] + self.suffix], self.rank)]

    def _found(self, ids: list[int]) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), b"".join([self.names[i] for i in ids])

    def words(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and tokens of different pre-tokens, from the lexicon or by merging."""
        out, short = {}, []
        for word in words:
            ids = self.lexicon.get(word) if self.lexicon is not None else None
            if ids is not None:
                out[word] = self._found(ids)
            elif len(word) > LONG:
                out[word] = self._found(self.merged(word))
            else:
                short.append(word)
        if short:
            ids, bounds = self.merges(short)
            ids, bounds = ids.tolist(), bounds.tolist()
            for word, a, b in zip(short, bounds, bounds[1:]):
                out[word] = self._found(ids[a:b])
        return out

    def pre_tokens(self, piece: str) -> list[str]:
        if piece.isascii() and piece.isprintable():
            return _ASCII.findall(piece.lower())  # its own normal form, where the byte alphabet is plain text
        return [w for w, _ in self.split(self.normalize(piece))]

    def pieces(self, pieces: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and tokens of different pieces, which are texts without ASCII white space."""
        cut, special = {}, {}
        for piece in pieces:
            if self._special and self._special.search(piece):
                words = []
                for part in self._special.split(piece):
                    # A pre-token is never told from a special string by its text alone.
                    words += [(part,)] if part in self.special else self.pre_tokens(part) if part else ()
                special[piece] = words
            else:
                cut[piece] = self.pre_tokens(piece)
        wanted = dict.fromkeys(chain.from_iterable(cut.values()))
        wanted.update(dict.fromkeys(w for words in special.values() for w in words if isinstance(w, str)))
        known = self.word
        found = {w: known.get(w) for w in wanted}
        made = self.words([w for w, x in found.items() if x is None])
        found.update(made)
        known.hold(made)
        out = {}
        for piece, words in cut.items():
            if len(words) == 1:
                out[piece] = found[words[0]]
            else:
                both = [found[w] for w in words]
                out[piece] = b"".join([i for i, _ in both]), b"".join([t for _, t in both])
        for piece, words in special.items():
            both = [found[w] if isinstance(w, str) else self._found([self.special[w[0]]]) for w in words]
            out[piece] = b"".join([i for i, _ in both]), b"".join([t for _, t in both])
        return out

    def encode_texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each text its ids as little-endian 32-bit numbers, and what they decode to.

        A piece that stands many times in these texts is looked up once.
        """
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        stood = lists.flatten().dictionary_encode()
        pieces = stood.dictionary.to_pylist()
        known = self.piece
        found = [known.get(p) for p in pieces]
        made = self.pieces([p for p, x in zip(pieces, found) if x is None])
        found = [made[p] if x is None else x for p, x in zip(pieces, found)]
        known.hold(made)
        bounds = lists.offsets.to_numpy()
        ids, tokens = (_joined(list(map(itemgetter(k), found)), stood.indices, bounds) for k in (0, 1))
        # The library's text of ids, special tokens kept: its vocabulary names no decoder, so tokens stand apart.
        return ids, pc.ascii_rtrim(tokens.cast(pa.large_string()), " ")

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """:meth:`encode_texts` of one text."""
        ids, decoded = self.encode_texts(pa.array([text], pa.string()))
        return ids[0].as_py(), decoded[0].as_py()


def count_pieces(docs: DataFrame, text_col: str) -> DataFrame:
    """(piece, n): white-space separated pieces of all texts and how often they stand."""

    def run(batches):
        for batch in slices(batches, "text", COUNTED):
            pieces = pc.ascii_split_whitespace(batch.column("text").drop_null()).flatten()
            count = pc.value_counts(pieces.filter(pc.not_equal(pieces, "")))
            yield pa.RecordBatch.from_arrays([count.field("values").cast(pa.binary()), count.field("counts")], ["piece", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "piece binary, n long")
    return counted.groupBy("piece").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON) -> bytes:
    """The automaton of the most frequent words of all texts; ``words`` bounds it and what comes to the driver.

    How often counts stand tells from which count on there are no more than ``words`` pieces; those are fetched. A sort
    with a limit would send as many from every task.
    """
    tokenizer, count = WordTokenizer(tokenizer_path), Counter()
    counted = staged(count_pieces(docs, text_col), "piece-counts")
    least, room = None, words
    for row in counted.groupBy("n").agg(F.count("*").alias("pieces")).orderBy(F.desc("n")).collect():
        room -= row["pieces"]
        if room < 0:
            break
        least = row["n"]
    for row in counted.where(F.col("n") >= least).collect() if least is not None else ():
        for word in tokenizer.pre_tokens(bytes(row["piece"]).decode()):
            count[word] += row["n"]
    best = sorted(count, key=lambda w: (-count[w], w))[:words]
    return compile_lexicon({w: tokenizer.merged(w) for w in best})


def publish(spark: SparkSession, data: bytes) -> str:
    """Write the automaton to the shared folder and have Spark bring it to every executor; returns the file's name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{name}")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(data))
    stream.close()
    spark.sparkContext.addFile(path.toString())
    return name


def _tokenizer(path: str, name: str, pieces: int = PIECES) -> WordTokenizer:
    """One tokenizer a worker: the lexicon is mapped once and pieces met in one task are known in the next."""
    return kept((path, name), lambda: WordTokenizer(path, Lexicon(SparkFiles.get(name)), pieces))


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON) -> DataFrame:
    """All rows and columns, with the columns ``ids`` (array of int) and ``decoded`` in place of any of these names.

    A null or empty text has no id and decodes to the empty text; a very long one is encoded whole. Repeated rows are all encoded; an empty table gives
    no rows. ``tokenizer_path`` is at the same place on every machine.
    """
    spark = ready(docs)
    name = publish(spark, build_lexicon(docs, tokenizer_path, text_col, words))
    source = docs.drop(*[c for c in ("ids", "decoded") if c != text_col])
    at, schema = source.columns.index(text_col), source.schema

    def run(batches):
        tokenizer = _tokenizer(tokenizer_path, name, PIECES_WITH_ROWS)
        for batch in slices(batches, at, SLICE):
            found, decoded = tokenizer.encode_texts(batch.column(at))
            bounds = np.frombuffer(found.buffers()[1], np.int64) // 4
            flat = pa.Array.from_buffers(pa.int32(), int(bounds[-1]), [None, found.buffers()[2]])
            ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, decoded.cast(pa.string())], [*batch.schema.names, "ids", "decoded"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    return source.mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", words: int = LEXICON) -> DataFrame:
    """One row per input row: doc_id, n_tokens, and SHA-256 of the ids and of the decoded text; nulls as above."""
    spark = ready(docs)
    name = publish(spark, build_lexicon(docs, tokenizer_path, text_col, words))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        tokenizer = _tokenizer(tokenizer_path, name)
        for batch in slices(batches, "text", SLICE):
            found, decoded = tokenizer.encode_texts(batch.column("text"))
            n = pc.cast(pc.divide(pc.binary_length(found), 4), pa.int64())
            ids, texts = (pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string()) for column in (found, decoded))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, ids, texts], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
