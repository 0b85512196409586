"""Token sequences: packing, label shifting and prompt/output shaping."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rubrica.operators.ordering import with_position, with_shuffled_position
from rubrica.operators.skew import lookup_join


def pack_sequences(
    df: DataFrame,
    key: str,
    tokens: str,
    seq_length: int,
    prefix_ids: Sequence[int] = (),
    suffix_ids: Sequence[int] = (),
    seed: str | int | None = None,
    length: str | None = None,
) -> DataFrame:
    """Concatenate all token arrays in order and cut the stream into rows of ``seq_length``.

    Labels are the inputs shifted by one over the whole stream, so a chunk needs seq_length + 1 tokens and the stream
    of N tokens gives floor((N - 1) / seq_length) chunks. Each document is sliced where chunk borders cross it: one row
    per (document, chunk) overlap travels, never one row per token, and a chunk's group holds seq_length + 1 tokens.
    """
    whole = F.concat(
        F.lit(list(prefix_ids)).cast("array<int>"), F.col(tokens), F.lit(list(suffix_ids)).cast("array<int>")
    )
    size = F.col(length) if length else F.size(tokens)
    docs = df.select(key, whole.alias("_ids"), (size + len(prefix_ids) + len(suffix_ids)).cast("bigint").alias("_size"))
    weight = F.col("_size")
    if seed is None:
        placed = with_position(docs, key, "_start", weight)
    else:
        placed = with_shuffled_position(docs, seed, key, "_start", weight)
    s = F.lit(seq_length)
    first_chunk = F.greatest(F.floor((F.col("_start") - 1) / s), F.lit(0))
    last_chunk = F.floor((F.col("_start") + F.col("_size") - 1) / s)

    def piece(chunk: Column) -> Column:
        begin = F.greatest(chunk * s - F.col("_start"), F.lit(0))
        end = F.least((chunk + 1) * s + 1 - F.col("_start"), F.col("_size"))
        return F.struct(
            chunk.alias("chunk_id"),
            (F.col("_start") + begin).alias("at"),
            F.slice(F.col("_ids"), (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"),
        )

    pieces = placed.where(F.col("_size") > 0).select(F.explode(F.transform(F.sequence(first_chunk, last_chunk), piece)).alias("p"))
    window = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("p.at", "p.ids"))), lambda e: e["ids"]))
    return (
        pieces.groupBy(F.col("p.chunk_id").alias("chunk_id"))
        .agg(window.alias("_window"))
        .where(F.size("_window") == seq_length + 1)
        .select(
            "chunk_id",
            F.slice("_window", 1, seq_length).alias("input_ids"),
            F.slice("_window", 2, seq_length).alias("labels"),
        )
    )


def shift_labels(
    tokens: DataFrame, seq: str = "seq_id", pos: str = "pos", token: str = "token_id", block: int = 4096
) -> DataFrame:
    """Add the token of the next position of the same sequence as ``label``, NULL where there is none.

    Positions are whole numbers and occur once in a sequence. A sequence is cut into blocks of positions, and the first row
    of a block is copied into the one before as well, so that each block finds its labels by itself: one shuffle, and even
    one very long sequence is spread over all tasks. Rows without a sequence or position have no label.
    """
    own = F.floor(F.col(pos) / block)
    first = F.col(pos) % block == 0
    blocks = F.when(first, F.array(own, own - 1)).otherwise(F.array(own))
    order = Window.partitionBy(seq, "_block").orderBy(pos)
    follows = F.col(seq).isNotNull() & (F.lead(pos).over(order) == F.col(pos) + 1)
    placed = tokens.withColumn("_block", F.explode(blocks))
    labelled = placed.withColumn("label", F.when(follows, F.lead(token).over(order)))
    return labelled.where(F.col("_block").eqNullSafe(own)).drop("_block")


def shift_labels_wide(ids: Column) -> Column:
    """The array form: all but the first id."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def shape_sequences(
    df: DataFrame, prompt_ids: str, output_ids: str, pad_id: int, batch: str, salt_by: str | list[str]
) -> DataFrame:
    """``input_ids``, ``labels`` and ``response_mask`` padded to the longest pair of the batch, minus one.

    A row shorter than the batch keeps its final token in ``input_ids``, because only a full row loses it.
    """
    pair_size = F.size(prompt_ids) + F.size(output_ids)
    widths = df.groupBy(batch).agg((F.max(pair_size) - 1).alias("_width"))
    padded = F.concat(F.col(prompt_ids), F.col(output_ids), F.array_repeat(F.lit(pad_id), F.col("_width")))
    slots = F.sequence(F.lit(0), F.col("_width") - 1)
    in_response = lambda i: (i >= F.size(prompt_ids) - 1) & (i < pair_size - 1)
    return (
        lookup_join(df, widths, batch, salt_by, how="inner")
        .withColumns(
            {
                "input_ids": F.slice(padded, F.lit(1), F.col("_width")),
                "labels": F.slice(padded, F.lit(2), F.col("_width")),
                "response_mask": F.transform(slots, in_response),
            }
        )
        .drop("_width")
    )
