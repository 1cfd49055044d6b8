"""Token counts of whole texts, with the whole-token shortcut (see ``tokens``).

Which entries of the vocabulary encode alone as one token is proven on the driver, from the file
alone; tasks count the pre-tokens that are such entries directly and merge only the rest.

Defined results: null text counts as empty, empty texts have no tokens. Strings of added tokens
inside texts are handled as the library's default has it. Very long texts are counted whole. Ids may
be null or repeat: one row out for each row in. Further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, register, table, texts_of
from .tokens import not_whole, tokens

LIMIT = 1024


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit for each document."""
    rest = not_whole(str(path))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [np.diff(bounds) for _, _, bounds in tokens(str(path), rest).encode(texts_of(batch))]
        return pa.RecordBatch.from_arrays(
            [batch.column(id_column), batch.column("n_bytes"), pa.array(np.concatenate(parts).astype(np.int64))],
            [id_column, "n_bytes", "n_tokens"],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (
        docs.select(F.col(id_column), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
        .mapInArrow(per_batch(count), f"`{id_column}` {kind}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


@register("op4_token_counts")
def op4(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), default_tokenizer())
