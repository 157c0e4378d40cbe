"""Token counts of whole texts, huge ones by overlapping chunks."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatpulse.llm.common import SLICE_ROWS, column

#: Code points of a chunk, and by how many the first two overlap.
CHUNK = 1 << 15
OVERLAP = 1 << 9
LIMIT = 4096
_BLANK = "▁"


class PieceCounter:
    """Counts what a sentencepiece BPE model gives for a text.

    A text of more than ``chunk`` code points is encoded in chunks that overlap.
    Two neighbours are spliced where both begin a token and no piece of the
    vocabulary holds the two characters beside the border next to each other:
    no merge can cross such a border, so what stands on either side of it is the
    same in any context. If an overlap has no such place, it is widened; if it
    already reaches back to the last splice, the chunk itself is.
    """

    def __init__(self, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk, overlap
        self.inside = {
            piece[i : i + 2]
            for piece in map(self.encoder.id_to_piece, range(self.encoder.get_piece_size()))
            for i in range(len(piece) - 1)
        }

    def counts(self, texts: list[str]) -> list[int]:
        made = self.encoder.encode([t if len(t) <= self.chunk else "" for t in texts], num_threads=1)
        return [len(m) if len(t) <= self.chunk else self.spliced(t) for t, m in zip(texts, made)]

    def begins(self, text: str, low: int, high: int) -> list[int]:
        """Where the tokens of a chunk begin; the bytes of a character begin with it."""
        encoded = self.encoder.encode(text[low:high], return_type="offset_mapping")
        return [low + begin for begin, _ in encoded["offsets"]]

    def proven(self, text: str, place: int) -> bool:
        pair = text[place - 1 : place + 1].replace(" ", _BLANK)
        return pair not in self.inside

    def spliced(self, text: str) -> int:
        total, cut, low, size = 0, 0, 0, self.chunk
        tokens = self.begins(text, 0, size)
        while low + size < len(text):
            high, overlap, place = low + size, self.overlap, None
            while place is None:
                back = max(high - overlap, cut)
                following = self.begins(text, back, back + size)
                shared = set(following)
                place = next(
                    (p for p in reversed(tokens) if back < p < high and p in shared and self.proven(text, p)),
                    None,
                )
                if place is None and back == cut:
                    break
                overlap *= 2
            if place is None:
                size *= 2
                tokens = self.begins(text, low, low + size)
                continue
            total += bisect_left(tokens, place) - bisect_left(tokens, cut)
            cut, low, tokens = place, back, following
        return total + len(tokens) - bisect_left(tokens, cut)


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Counts are those of the library on the whole text, without begin and end
    tokens; the model goes to the executors as bytes. A null text counts as
    empty: 0 bytes, 0 tokens. Null ids and repeated rows stay, other columns are
    ignored, an empty table gives no rows. A very long text is encoded chunk by chunk;
    where it has no proven border, chunks double, up to the whole text.
    """
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    text = F.coalesce(column(docs, text_col), F.lit(""))
    picked = docs.select(
        column(docs, id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text")
    )

    def run(batches):
        counter = None
        for batch in batches:
            counter = counter or PieceCounter(shared.value, chunk, overlap)
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                made = pa.array(counter.counts(rows.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], made], names=["doc_id", "n_bytes", "n_tokens"])

    counted = picked.mapInArrow(run, picked.drop("text").schema.add("n_tokens", "long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
