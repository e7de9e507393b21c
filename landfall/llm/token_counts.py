"""Token counts of a sentencepiece BPE model, by a whole-token shortcut.

Spaces become the mark U+2581 before merging. No vocabulary string of the model has the mark after another
character (checked when the model is loaded), so no merge crosses the start of a run of marks, and each run with the
characters up to the next is counted on its own. Which of these pre-tokens are a single token is found once by
encoding every vocabulary string alone; they are looked up, and only the others go to the library.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import map_batches

MODEL, LIMIT = "piece_bpe_32k.model", 4096
MARK = "▁"
# Counts of other pre-tokens that a task remembers before it starts anew, and the longest of them.
REMEMBERED, LONGEST = 300_000, 64
_RUN = re.compile(" +[^ ]*")


class TokenCounter:
    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a vocabulary string crosses the start of a pre-token")
        alone = [piece[1:].replace(MARK, " ") for piece in pieces if piece[:1] == MARK]
        self.whole = {text: 1 for text, ids in zip(alone, self.library.encode(alone, num_threads=1)) if len(ids) == 1}
        self.whole[""] = 1  # a mark alone
        self.known = dict(self.whole)

    def pre_tokens(self, text: str) -> list[str]:
        """Each without its first mark, which the library puts before what it encodes."""
        text = " " + text.replace(MARK, " ")
        return [run[1:] for run in _RUN.findall(text)] if "  " in text else text[1:].split(" ")

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        runs = self.pre_tokens(text)
        rest = list({run for run in runs if run not in self.known})
        if rest:
            if len(self.known) + len(rest) > REMEMBERED + len(self.whole):
                self.known = dict(self.whole)
                rest = list({run for run in runs if run not in self.known})
            counts = {run: len(ids) for run, ids in zip(rest, self.library.encode(rest, num_threads=1))}
            if len(rest) <= REMEMBERED:
                self.known |= {run: n for run, n in counts.items() if len(run) <= LONGEST}
            return sum(counts[run] if run in counts else self.known[run] for run in runs)
        return sum(map(self.known.__getitem__, runs))


@cache
def _counter(model: str) -> TokenCounter:
    return TokenCounter(public_tokenizers.path(model))


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """`docs(doc_id, text, ...)` -> one row for each row: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the library for the whole text, without begin and end; strings of special tokens are
    ordinary text, as the library's default has it. Null texts count as empty: 0 bytes, 0 tokens. Extra columns are ignored.
    """

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _counter(model)
        tokens = pa.array([counter.count(text) for text in batch.column("text").to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), tokens], ["doc_id", "n_bytes", "n_tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = map_batches(docs.select("doc_id", "text", size.alias("n_bytes")), counted, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
