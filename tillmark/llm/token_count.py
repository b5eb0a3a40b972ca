"""Token counts: Arrow functions that encode batches of balanced size and return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.pieces import balanced, encoder

# Bytes of text that one call encodes, whatever the number of texts; longer texts are cut at safe boundaries.
BATCH_BYTES = 1 << 20


def safe_parts(text: str, limit: int) -> Iterator[str]:
    """Cut a long text before a space or line break that has neither white space nor the text's end beside it.

    Such a place is a word boundary of every tokenizer of the known chains. A text without one stays whole.
    """
    start = 0
    while len(text) - start > limit:
        cut = start + limit
        while cut < len(text) - 1 and not (
            text[cut] in " \n" and not text[cut - 1].isspace() and not text[cut + 1].isspace()
        ):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) to every row.

    Null and empty texts have no bytes and no tokens. Repeated rows each get their counts; other columns are kept,
    but columns of these three names are replaced. Only lengths leave the Arrow function.
    """

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer, merge_only=False)
        for batch in batches:
            parts, owners = [], []
            for owner, t in enumerate(batch.to_pylist()):
                # Code points: no part has more than four times as many bytes.
                cut = list(safe_parts(t, batch_bytes)) if encode.kind != "whole" else [t]
                parts += cut
                owners += [owner] * len(cut)
            sizes = [len(p.encode("utf-8", "surrogatepass")) for p in parts]
            counts = [encode.counts(parts[a:b]) for a, b in balanced(sizes, batch_bytes)]
            totals = np.zeros(len(batch), np.int64)
            if counts:
                np.add.at(totals, owners, np.concatenate(counts).astype(np.int64))
            yield pa.array(totals)

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": lengths(whole)}).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
