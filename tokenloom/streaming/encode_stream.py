"""Encoding a stream of documents.

No state is kept between documents, so there is nothing to watermark. With a
literal vocabulary `operators.tokens.encode_inline` works on the stream itself;
the function here takes any vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tokenloom.operators.tokens import tokenize
from tokenloom.operators.vocabulary import Vocabulary


def encode_batches(
    corpus: DataFrame,
    vocab: Vocabulary,
    path: str,
    checkpoint: str,
    key: Sequence[str] = ("doc_id",),
    available_now: bool = False,
) -> StreamingQuery:
    """Encode a stream, micro-batch by micro-batch, into parquet.

    Each batch goes to a folder named by its number and replaces what an
    earlier attempt at the same batch left there.
    """

    def write(batch: DataFrame, number: int) -> None:
        tokenize(batch, vocab, key).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = corpus.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
