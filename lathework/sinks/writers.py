"""Writers. Output stays partitioned unless a single file is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from lathework.session import scratch_folder


def _writer(df: DataFrame, overwrite: bool, single_file: bool):
    df = df.coalesce(1) if single_file else df
    return df.write.mode("overwrite" if overwrite else "errorifexists")


def write_delimited(df: DataFrame, path: str, separator: str = "\t", overwrite: bool = False, single_file: bool = False) -> None:
    _writer(df, overwrite, single_file).csv(path, sep=separator)


def write_lines(df: DataFrame, path: str, overwrite: bool = False, single_file: bool = False) -> None:
    """A frame with one string column as text lines."""
    _writer(df, overwrite, single_file).text(path)


def write_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    _writer(df, overwrite, False).parquet(path)


def write_split(df: DataFrame, outputs: Sequence[tuple[Column, str]], overwrite: bool = False) -> None:
    """Several filtered outputs of one computation, which runs once: its rows are written below the shared folder, so a lost executor repeats nothing."""
    kept = _kept(df, scratch_folder(df.sparkSession))
    for condition, path in outputs:
        write_table(kept.where(condition), path, overwrite)


def _kept(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stream_split(stream: DataFrame, outputs: Sequence[tuple[Column, str]], folder: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Several filtered outputs of one pass over a stream, each in ``path``/batch=<id>.

    A batch is computed once into ``folder`` and read from there for every output. It only rewrites
    folders of its own id, so a batch that is repeated after a failure leaves the same files.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = _kept(batch, f"{folder}/batch={batch_id}")
        for condition, path in outputs:
            write_table(kept.where(condition), f"{path}/batch={batch_id}", overwrite=True)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_to_lines(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """A one-column stream appended to text files."""
    return _start(stream, "text", path, checkpoint, available_now)


def stream_to_table(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return _start(stream, "parquet", path, checkpoint, available_now)


def _start(stream: DataFrame, kind: str, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
