"""Text to vectors: a caller's encoder, or the offline word-hash encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samesense.functions.text import CHARS_PER_TOKEN, embedding_text
from samesense.functions.vectors import DIMENSIONS, hashed_words

# The token limit of the encoders and the clamp of an all-masked text.
MAX_TOKENS = 512
CLAMP = 1e-9

# Estimated tokens of a batch, padding included.
BATCH_TOKENS = 16_384

Encoder = Callable[[list[str]], "np.ndarray"]


def with_text(df: DataFrame, name: str = "text") -> DataFrame:
    return df.withColumn(
        name, embedding_text(F.col("attribute_name"), F.col("attribute_definition"))
    )


def token_batches(texts: list[str], batch_texts: int, batch_tokens: int, limit: int) -> Iterator[np.ndarray]:
    """Places of the texts of each batch, short texts first.

    A batch is as wide as its longest text, as the encoder pads it: its number of texts times
    their longest estimate, cut at ``limit``, stays within ``batch_tokens``; a text alone may
    be up to ``limit`` wide.
    """
    sizes = np.array([min(max(1, len(t or "") // CHARS_PER_TOKEN), limit) for t in texts], np.int64)
    order = np.argsort(sizes, kind="stable")
    start = 0
    for end in range(1, len(order) + 1):
        if end == len(order) or end - start >= batch_texts or (end - start + 1) * sizes[order[end]] > batch_tokens:
            yield order[start:end]
            start = end


def embed(
    df: DataFrame,
    make_encoder: Callable[[], Encoder],
    text: str = "text",
    output: str = "embedding",
    batch_texts: int = 256,
    partitions: int | None = None,
    batch_tokens: int = BATCH_TOKENS,
    max_tokens: int = MAX_TOKENS,
    truncate: bool = False,
) -> DataFrame:
    """Add the vectors a caller's encoder gives for a text column.

    ``make_encoder`` runs once per partition, where it may load a model; the encoder maps
    a list of texts to a matrix. Texts of a like length go together, and a batch is bounded in
    texts and in estimated tokens, so a long text among short ones does not widen them all.
    An encoder is taken to read ``max_tokens`` of a text; with ``truncate`` the rest is not
    even handed over. ``partitions`` deals out a table that is small in bytes but much work.
    """
    if partitions:
        df = df.repartition(partitions)
    position = df.columns.index(text)
    longest = max_tokens * CHARS_PER_TOKEN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = make_encoder()
            texts = batch.column(position).to_pylist()
            if truncate:
                texts = [t and t[:longest] for t in texts]
            vectors = None
            for places in token_batches(texts, batch_texts, batch_tokens, max_tokens):
                matrix = np.asarray(encoder([texts[i] for i in places]), dtype=np.float32)
                if vectors is None:
                    vectors = np.empty((len(texts), matrix.shape[1]), np.float32)
                vectors[places] = matrix
            size = vectors.shape[1]
            offsets = np.arange(0, vectors.size + 1, size, dtype=np.int32) if size else np.zeros(len(texts) + 1, np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, output])

    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
    )
    return df.mapInArrow(run, f"{schema}, `{output}` array<float>")


def embed_hashed(
    df: DataFrame, text: str = "text", output: str = "embedding", dimensions: int = DIMENSIONS
) -> DataFrame:
    """Add word-hash vectors; needs no model and stays in the JVM."""
    return df.withColumn(output, hashed_words(F.col(text), dimensions))


def truncate_tokens(tokens: DataFrame, limit: int = MAX_TOKENS) -> DataFrame:
    """Keep the tokens the encoder would read (positions from 0)."""
    return tokens.where(F.col("pos") < limit)


def mean_pool(tokens: DataFrame, output: str = "embedding") -> DataFrame:
    """Masked mean of the token vectors of each row: ``row_id, pos, mask, vec`` in.

    One map-side combined aggregate over whole vectors; nothing is exploded.
    """
    masked = F.transform("vec", lambda x: x.cast("double") * F.col("mask").cast("double"))
    return (
        tokens.groupBy("row_id")
        .agg(
            Summarizer.sum(array_to_vector(masked)).alias("_sum"),
            F.greatest(F.sum(F.col("mask").cast("double")), F.lit(CLAMP)).alias("_n"),
        )
        .select(
            "row_id",
            F.transform(vector_to_array("_sum"), lambda x: x / F.col("_n")).alias(output),
        )
    )
