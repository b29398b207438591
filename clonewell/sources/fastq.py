"""FASTQ as a Spark data source: plain files are split by bytes, compressed ones are read by one task each."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "read_id string, comment string, seq string, qual string, file string, offset bigint"


class Split(InputPartition):
    def __init__(self, path: str, start: int, end: int | None) -> None:
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system, inner


def _files(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs

    system, inner = _open(path)
    info = system.get_file_info(inner)
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    if info.type == fs.FileType.Directory:
        found = [i for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File and ".f" in i.base_name and i.base_name.rstrip("gz.").endswith(("fastq", "fq"))]
    elif info.type == fs.FileType.File:
        found = [info]
    else:
        raise FileNotFoundError(path)
    return sorted((scheme + i.path, i.size) for i in found)


def records(lines: Iterator[tuple[int, str]]) -> Iterator[tuple[int, str, str, str]]:
    """(offset, header, sequence, quality) of numbered lines that may begin inside a record.

    A record begins at a line with ``@`` whose second next line begins with ``+`` and whose sequence and quality have
    one length; a quality line that begins with ``@`` can't be mistaken for one, as a sequence has no ``+``.
    Once in step, every four lines are a record. A record cut off at the end of the file is left out.
    """
    window: list[tuple[int, str]] = []
    for line in lines:
        window.append(line)
        if len(window) < 4:
            continue
        (at, head), (_, seq), (_, plus), (_, qual) = window
        if head.startswith("@") and plus.startswith("+") and len(seq) == len(qual):
            yield at, head, seq, qual
            window = []
        else:
            window.pop(0)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options.get("path", "")
        self.split = int(options.get("splitbytes", options.get("splitBytes", 64 << 20)))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path, size in _files(self.path):
            system, inner = _open(path)
            with system.open_input_stream(inner, compression=None) as f:
                packed = f.read(2) == b"\x1f\x8b"
            if packed:
                out.append(Split(path, 0, None))
            else:
                out += [Split(path, a, min(size, a + self.split)) for a in range(0, size, self.split)]
        return out or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[tuple]:
        if not partition.path:
            return
        system, inner = _open(partition.path)
        if partition.end is None:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=system.open_input_stream(inner, compression=None)))
        else:
            stream = system.open_input_file(inner)
            stream.seek(max(0, partition.start - 1))

        def lines() -> Iterator[tuple[int, str]]:
            at = max(0, partition.start - 1)
            for k, raw in enumerate(_lines(stream)):
                # a later split drops the line it begins in, which ends with the byte before it if a line begins with it
                if k or not partition.start:
                    yield at, raw.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(raw)

        for at, head, seq, qual in records(lines()):
            if partition.end is not None and at >= partition.end:
                break
            name, _, comment = head[1:].partition(" ")
            yield name, comment or None, seq, qual, partition.path, at


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(1 << 20):
        parts = (rest + chunk).split(b"\n")
        rest = parts.pop()
        for p in parts:
            yield p + b"\n"
    if rest:
        yield rest


class FastqSource(DataSource):
    """``spark.read.format("fastq").load(path)``; ``splitBytes`` sets the size of the splits of plain files."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(dict(self.options))


def read_fastq(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Reads of a FASTQ file or folder of such files: ``read_id, comment, seq, qual, file, offset``.

    Whether a file is compressed is told by its first bytes, not its name. A split begins to read at the
    first record whose first line starts in it and ends with the one that starts before its end. Empty files give no rows.
    """
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("splitBytes", split_bytes).load(path)


def paired(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates joined by read id; raises in the job if a read has no mate or an id stands twice on one side."""
    a = first.groupBy("read_id").agg(F.count(F.lit(1)).alias("n1"), F.max("seq").alias("seq1"), F.max("qual").alias("qual1"))
    b = second.groupBy("read_id").agg(F.count(F.lit(1)).alias("n2"), F.max("seq").alias("seq2"), F.max("qual").alias("qual2"))
    both = a.join(b, "read_id", "full")
    message = F.concat(F.lit("reads without one mate each: "), "read_id")
    right = (F.col("n1") == 1) & (F.col("n2") == 1)
    return both.select(F.when(F.coalesce(right, F.lit(False)), F.col("read_id")).otherwise(F.raise_error(message)).alias("read_id"), "seq1", "qual1", "seq2", "qual2")


def write_fastq(df: DataFrame, path: str, comment: Column | None = None) -> None:
    """Rows ``read_id, seq, qual`` as compressed FASTQ files, one per partition."""
    head = F.concat_ws(" ", F.concat(F.lit("@"), "read_id"), comment) if comment is not None else F.concat(F.lit("@"), "read_id")
    df.select(F.concat_ws("\n", head, F.coalesce("seq", F.lit("")), F.lit("+"), F.coalesce("qual", F.lit(""))).alias("value")).write.option("compression", "gzip").text(path)
