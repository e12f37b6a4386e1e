"""Arrow batches of text as numpy buffers, and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import shared_dir

# Text bytes handled at once inside a task; longer batches are cut at row borders.
SLICE_BYTES = 8 << 20


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` texts in this session: Spark counts rows, not bytes, and holds whole batches."""
    if int(spark.conf.get(ROWS)) > rows:
        spark.conf.set(ROWS, str(rows))


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches, small ones put together until their texts hold about ``limit`` bytes."""
    held, size = [], 0
    for batch in sliced(batches, text, limit):
        more = int(text_buffer(batch.column(text))[1][-1])
        if held and size + more > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def as_binary(column: pa.Array) -> pa.LargeBinaryArray:
    """The UTF-8 bytes of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    return column.fill_null("").cast(pa.large_binary())


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column behind each other, and where each row begins (one entry more than rows)."""
    data = as_binary(column)
    _, places, content = data.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[data.offset:data.offset + len(data) + 1]
    content = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, np.uint8)
    return content[offsets[0]:offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, each cut so that its texts hold about ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def remainder(column: str, divisor: int) -> Column:
    """CRC-32 of an identifier as text, modulo a divisor; a null identifier counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def ragged(values: list[list] | list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column from one array per row."""
    ends = np.cumsum([0, *(len(v) for v in values)]).astype(np.int32)
    flat = np.concatenate(values) if values and ends[-1] else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def bitmap(positions: DataFrame, bits: int) -> np.ndarray:
    """The positions (one long column) as one packed array of 2^bits bits; its size does not depend on the data."""
    column = positions.columns[0]
    # Spark's bitmaps hold 32768 bits each.
    rows = positions.select((F.col(column) / 32768).cast("long").alias("part"), (F.col(column) % 32768).alias("bit")).groupBy(
        "part").agg(F.bitmap_construct_agg("bit").alias("held")).toPandas()
    held = np.zeros((max(1, (1 << bits) // 32768), 4096), dtype=np.uint8)
    for part, content in zip(rows["part"], rows["held"]):
        held[part] = np.frombuffer(content, dtype=np.uint8)
    return held.reshape(-1)


def marked(held: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (held[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1 == 1
