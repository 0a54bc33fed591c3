"""Token counts of whole texts with a SentencePiece model, lengths only.

Texts are encoded in groups of about equal bytes. A long text is cut where no piece of the
vocabulary holds the two neighbouring characters: no merge can cross such a place, so the counts of
the parts add up to the count of the whole. A part other than the first must be encoded without the
space that the model puts before a text; it is encoded behind a line feed, which no piece holds, and
the two tokens that this costs are taken off.

Null and empty texts count zero tokens. Repeated rows and repeated ids stay separate rows. Other
columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import by_bytes, map_batches, per_process, whole_text

GROUP = 500_000
LONG = 50_000
_GUARD = "\n"


class Counter:
    def __init__(self, path: str, long: int = LONG):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.long = long
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model)) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.guarded = not any(_GUARD in p for p in pieces) and len(self.model.encode(_GUARD)) == 2

    def _safe(self, text: str, i: int) -> bool:
        return text[i - 1 : i + 1].replace(" ", "▁") not in self.joined

    def split(self, text: str) -> list[str]:
        """Parts whose counts add up; later parts start with the guard."""
        if len(text) <= self.long or not self.guarded:
            return [text]
        parts, start = [], 0
        while len(text) - start > self.long:
            end = start + self.long
            while end < len(text) and not self._safe(text, end):
                end += 1
            parts.append(text[start:end])
            start = end
        if start < len(text):
            parts.append(text[start:])
        return parts[:1] + [_GUARD + p for p in parts[1:]]

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        lengths: list[int] = []
        for group in by_bytes([p for parts in split for p in parts], GROUP):
            lengths.extend(map(len, self.model.encode(group, num_threads=1)))
        out, at = [], 0
        for parts in split:
            out.append(sum(lengths[at : at + len(parts)]) - 2 * (len(parts) - 1))
            at += len(parts)
        return out


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))

    def count(batch: pa.RecordBatch) -> dict:
        counter = per_process(("sentencepiece", path), lambda: Counter(path))
        texts = batch.column("text").to_pylist()
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counter.counts(texts)}

    counted = map_batches(given, count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("doc_id", id_col)
