"""Token counts: lengths only, from Arrow batches, for budgets and length limits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import wordpieces

#: A text longer than this is handed out in pieces, cut at white space.
PIECE_BYTES = 8 << 20
#: White space bytes at which no token of a word vocabulary crosses.
BLANKS = b" \t\n\x0b\x0c\r"


def pieces(data: bytes, limit: int = PIECE_BYTES) -> list[bytes]:
    """The text in pieces of at most ``limit`` bytes, each cut at the last white space in reach.

    A stretch without white space is longer than a piece only where the text leaves no choice.
    """
    out, start = [], 0
    while len(data) - start > limit:
        cut = max(data.rfind(bytes([blank]), start, start + limit) for blank in BLANKS)
        if cut <= start:
            found = [at for blank in BLANKS if (at := data.find(bytes([blank]), start + 1)) >= 0]
            if not found:
                break
            cut = min(found)
        out.append(data[start:cut])
        start = cut
    out.append(data[start:])
    return out


def token_counts(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens`` and whether the tokens exceed ``limit``.

    ``vocabulary`` names a file whose tokens never cross white space. A null or empty text has no
    bytes and no tokens; a null id stays null; repeated rows are counted each; further columns are
    left out. No row moves: each task encodes the distinct words of its Arrow batches, in calls of
    about equal bytes, and adds up their lengths.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_buffer().to_pybytes() if text.is_valid else b""
                     for text in batch.column(1)]
            tokens = np.array([sum(wordpieces.word_lengths(vocabulary, piece)
                                   for piece in pieces(text)) for text in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array([len(text) for text in texts], np.int64)),
                 pa.array(tokens), pa.array(tokens > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    schema = f"id {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return source.mapInArrow(count, schema).withColumnRenamed("id", id_col)
