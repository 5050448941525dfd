"""Token counts with a whole-token shortcut.

A vocabulary string that comes out of the merges as itself is one token wherever it stands as a pre-token. Which strings
do is proved once, on the driver, by merging every string of the vocabulary; their set is sent to the tasks and is as
large as the vocabulary at most. A text is cut into pre-tokens, those in the set count one, and only the rest is merged.

Cutting is exact because a merge makes a string of the vocabulary: no string holds a space mark after another character,
none holds a line end or a tab beside anything, so no merge reaches over such a place. That too is proved when the
vocabulary is read; where it fails, texts are merged whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm._util import kept, ready
from gridloom.llm.merging import NEVER, Cache, merge_symbols

MARK = "▁"
LIMIT = 4096
_UNIT = re.compile(f"{MARK}*[^{MARK}\n\t]+|{MARK}+|[\n\t]")


class PieceCounter:
    """Counts tokens of the byte-pair vocabulary in a sentencepiece model file."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank = {}
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)):
                self.rank[model.id_to_piece(i)] = -model.get_score(i)
        self.splits = not any(
            re.search(f"[^{MARK}]{MARK}", p) or len(p) > 1 and re.search("[\n\t]", p) for p in self.rank
        )
        self.whole = frozenset(p for p in self.rank if self.merged(p) == [p]) if whole is None else whole
        self.count = Cache(self.count_unit, most_bytes=320_000_000)

    def merged(self, unit: str) -> list[str]:
        rank = self.rank.get
        return merge_symbols(list(unit), lambda a, b: rank(a + b, NEVER))

    def count_unit(self, unit: str) -> int:
        if unit in self.whole:
            return 1
        # A character that is no piece is written byte by byte.
        return sum(1 if s in self.rank else len(s.encode("utf-8", "surrogatepass")) for s in self.merged(unit))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        return sum(map(self.count.__getitem__, _UNIT.findall(text) if self.splits else [text]))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens as the library counts them, over_limit.

    ``model_path`` is a sentencepiece byte-pair model with the identity normaliser and a leading space mark, at the
    same place on every machine. Special strings in a text are text. A null or empty text has no byte and no token; a
    very long one is counted whole. Ids may be null or repeated; other columns are not read; an empty table gives no rows.
    """
    spark = ready(docs)
    whole = spark.sparkContext.broadcast(PieceCounter(model_path).whole)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        count = kept((model_path, "pieces"), lambda: PieceCounter(model_path, whole.value))
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column("text")]
            n = [count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(x.encode("utf-8", "surrogatepass")) for x in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean")
