"""Text sinks: delimited lines, JSON lines, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import escaped_field, iso_instant, sql_time_text


def _fields(rows: DataFrame, columns: Sequence[str] | None, time_text) -> list[Column]:
    """The columns to write, times already as text."""
    fields = []
    for name in columns or rows.columns:
        is_time = isinstance(rows.schema[name].dataType, T.TimestampType)
        fields.append((time_text(F.col(name)) if is_time else F.col(name)).alias(name))
    return fields


def tsv_lines(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One tab-separated line per row, escaped, with a null marker."""
    fields = _fields(rows, columns, sql_time_text)
    return rows.select(F.concat_ws("\t", *[escaped_field(f) for f in fields]).alias("line"))


def json_text(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A JSON object of the columns; times in ISO-8601, nulls written out."""
    fields = _fields(rows, columns, iso_instant)
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_lines(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return rows.select(json_text(rows, columns).alias("line"))


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)


# The local file system without its checksum files: options of one write, which other file systems ignore.
PLAIN_LOCAL_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


def write_json_files(
    rows: DataFrame,
    path: str,
    by: Sequence[str] = (),
    records_per_file: int = 100,
    writers: int | None = None,
) -> None:
    """JSON-lines files of bounded length, one folder per value of ``by``.

    Opening files is most of the work; ``writers`` deals the rows evenly to that many tasks. On a local
    file system no checksum files are written beside them: without Hadoop's native library each file
    would start processes that set modes, more of them for a checksum file. A session that names a
    local file system of its own keeps it.
    """
    if writers is not None:
        rows = rows.repartition(writers)
    files = rows.write.mode("append").option("maxRecordsPerFile", records_per_file)
    if rows.sparkSession.conf.get("spark.hadoop.fs.file.impl", None) is None:
        files = files.options(**PLAIN_LOCAL_FILES)
    files.partitionBy(*by).json(path)
