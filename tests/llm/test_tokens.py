"""Token counts and ids against the libraries."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridloom.llm import bpe, tokencount
from gridloom.llm.merging import NEVER, _merge_long, _merge_short
from gridloom.llm.queries import tokenizer_file

PIECES, WORDS = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("word_bpe_49k.json")
HARD = [
    "", " ", "  a  b ", "\n\n x\ty", "<s> </s> <unk> <0x0A>", "▁▁a b▁c", "日本語 テスト 😀👍🏽", "a" * 500, "tab\t\tx \n y", "été  Ünï  ﬁ",
    " x　y", "İΣς ｆｕｌｌ", "x<|endoftext|>y <|startoftext|>", "can't I'LL 12345 ½ ² ٣", "é ́x", "\x00\x01 a\x85b", "aaaa<|endoftext|", "ﷺ ｶﾞ ǅ",
]


@pytest.fixture(scope="module")
def texts(docs, sample):
    return HARD + [r.text or "" for r in docs.collect()] + [r.text for r in sample.collect()]


def test_both_merges_are_one(spark):
    rng = random.Random(1)
    ranks = {(a, b): rng.random() for a in "abc" for b in "abc"} | {(a + b, c): rng.random() for a in "abc" for b in "abc" for c in "abc"}
    for n in range(1, 60):
        s = [rng.choice("abc") for _ in range(n)]
        rank = lambda a, b: ranks.get((a, b), NEVER)
        assert _merge_short(list(s), rank) == _merge_long(list(s), rank)


def test_counts_equal_the_library(texts):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), tokencount.PieceCounter(PIECES)
    assert own.splits and len(own.whole) > 30_000
    assert [own(t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_count_rows(docs, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or ""))
        want.append(str((r.doc_id, len((r.text or "").encode()), n, n > 4096)))
    assert sorted(str(tuple(r)) for r in tokencount.count_tokens(docs, PIECES).collect()) == sorted(want)
    assert tokencount.count_tokens(nothing, PIECES).count() == 0


def test_lexicon(tmp_path):
    rng = random.Random(2)
    words = {"".join(rng.choice("abé日") for _ in range(rng.randrange(1, 9))) for _ in range(2000)}
    entries = {w: [rng.randrange(50_000) for _ in range(rng.randrange(0, 4))] for w in words}
    data = bpe.compile_lexicon(entries)
    (tmp_path / "x.bin").write_bytes(data)
    lexicon = bpe.Lexicon(str(tmp_path / "x.bin"))
    assert len(lexicon) == len(entries) and all(lexicon.get(w) == ids for w, ids in entries.items())
    assert all(lexicon.get(w + "a") == entries.get(w + "a") for w in words) and lexicon.get("") is None
    (tmp_path / "e.bin").write_bytes(bpe.compile_lexicon({}))
    assert bpe.Lexicon(str(tmp_path / "e.bin")).get("a") is None
    suffixes = bpe.compile_lexicon({f"{a}{b}tion": [1] for a in "abcdefgh" for b in "abcdefgh"})
    assert len(suffixes) < 1500  # 64 words of 6 letters share all but their first two


def test_ids_equal_the_library(texts):
    library, own = Tokenizer.from_file(WORDS), bpe.WordTokenizer(WORDS)
    for t in texts:
        e = library.encode(t, add_special_tokens=False)
        ids, decoded = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids and decoded == library.decode(e.ids, skip_special_tokens=False)


def test_id_rows(docs, nothing):
    library, want, kept = Tokenizer.from_file(WORDS), [], []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append(str((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())))
        kept.append(str((r.doc_id, ids, text)))
    assert sorted(str(tuple(r)) for r in bpe.digest_documents(docs, WORDS, words=20).collect()) == sorted(want)
    full = bpe.encode_documents(docs, WORDS)
    assert full.columns == [*docs.columns, "ids", "decoded"]
    assert sorted(str((r.doc_id, r.ids, r.decoded)) for r in full.collect()) == sorted(kept)
    assert bpe.digest_documents(nothing, WORDS).count() == 0 and bpe.encode_documents(nothing, WORDS).count() == 0


def test_merges_side_by_side_equal_merges_one_by_one():
    own, rng = bpe.WordTokenizer(WORDS), random.Random(3)
    words = [w for t in HARD for p in t.split() for w in own.pre_tokens(p)]
    words += ["".join(rng.choice("aaabtheingÃ©ł1,") for _ in range(rng.randrange(1, bpe.LONG))) for _ in range(3000)]
    ids, bounds = own.merges(words)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [own.merged(w) for w in words]
    assert own.merges([])[0].tolist() == [] and own.merges(["a"])[1].tolist() == [0, 1]
    made = own.words(["a" * 5000, "the", "Ã©" * 40])
    assert made["a" * 5000][0] == np.array(own.merged("a" * 5000), "<u4").tobytes() and len(made) == 3
    with pytest.raises(ValueError):
        own.merges(["日"])


def test_texts_together_equal_texts_alone(texts):
    library, own = Tokenizer.from_file(WORDS), bpe.WordTokenizer(WORDS, pieces=40)  # caches that start anew all the time
    given = [None, *texts, "the end " * 20_000, None, " \t "]
    ids, decoded = own.encode_texts(pa.array(given, pa.string()))
    for text, i, d in zip(given, ids.to_pylist(), decoded.to_pylist()):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(i, "<u4").tolist() == want and d == library.decode(want, skip_special_tokens=False)
    ids, decoded = own.encode_texts(pa.array(given, pa.string())[3:7])
    assert decoded.to_pylist() == [own.encode(t)[1] for t in given[3:7]]
    assert [len(x) for x in own.encode_texts(pa.array([], pa.string()))] == [0, 0]
