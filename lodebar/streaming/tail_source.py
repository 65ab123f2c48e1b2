"""A source that follows text files which grow, as feeds do; as a stream, or once over what is there.

Spark's file source takes each file once and does not see what is appended later. This one keeps a byte position for each
file. It hands out whole lines only, waits for the rest of a line that is still being written, starts anew in a file that
has become shorter, and picks up new files that match.

The driver only lists files, and looks at each file's end for its last line feed. Ranges of bytes are read by tasks: one has
the lines that begin in its range. Files are opened through pyarrow's file systems, so a path may be local or a URI of any
store that these know.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Bytes of a file that one task reads.
CHUNK = 8 << 20
#: Bytes that are read at a time.
BLOCK = 64 << 10


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", path) else (fs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    """Bytes of a file; a line belongs to the range that it begins in. ``whole``: a last line without a line feed counts."""

    file: str
    begin: int
    end: int
    first: bool
    whole: bool


class _Tail:
    def __init__(self, path: str, chunk: int, since: str = "") -> None:
        self.path, self.chunk, self.since = path, chunk, since

    def files(self) -> dict[str, int]:
        """Sizes of the files that match; the pattern is in the last part of the path."""
        store, path = _store(self.path)
        folder, _, pattern = path.rpartition("/")
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return {i.path: i.size for i in sorted(found, key=lambda i: i.path) if i.is_file and fnmatch.fnmatch(i.base_name, pattern) and not self.finished(i.base_name)}

    def finished(self, name: str) -> bool:
        """Whether the date that a file's name ends in is before ``since``: such files are not even opened."""
        dated = re.search(r"\d{8}$", name)
        return bool(self.since and dated and dated[0] < self.since)

    def last_line_end(self, file: str, size: int) -> int:
        """The place after the last line feed before ``size``, looked for from the end."""
        with _store(self.path)[0].open_input_file(file) as f:
            end = size
            while end > 0:
                begin = max(0, end - BLOCK)
                at = f.read_at(end - begin, begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                end = begin
        return 0

    def ranges(self, file: str, begin: int, end: int, whole: bool = False) -> list[Range]:
        return [Range(file, at, min(end, at + self.chunk), at == begin, whole) for at in range(begin, end, self.chunk)]

    def read(self, partition: Range) -> Iterator[tuple]:
        """(line, file, position) of the lines that begin in the range; a later range's first bytes may end a line of the one before."""
        name = partition.file.rpartition("/")[2]
        with _store(self.path)[0].open_input_file(partition.file) as f:
            size = f.size()
            at = partition.begin if partition.first else partition.begin - 1  # whether a line begins here shows in the byte before
            skip, held = not partition.first, b""
            read_to = at
            while at < partition.end:
                cut = held.find(b"\n")
                while cut < 0 and read_to < size:
                    more = f.read_at(min(BLOCK, size - read_to), read_to)
                    read_to += len(more)
                    cut = more.find(b"\n")
                    cut, held = (cut + len(held) if cut >= 0 else -1), held + more
                line, held = (held[:cut], held[cut + 1 :]) if cut >= 0 else (held, b"")
                if not skip and (cut >= 0 or (partition.whole and line)):
                    yield line.rstrip(b"\r").decode("utf-8", "replace"), name, at
                skip = False
                if cut < 0:
                    return
                at += len(line) + 1


class TailReader(_Tail, DataSourceStreamReader):
    """Offsets are byte positions by file; what lies between two offsets can be read again."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {file: self.last_line_end(file, size) for file, size in self.files().items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for file, to in end.items():
            at = int(start.get(file, 0))
            out += self.ranges(file, 0 if int(to) < at else at, int(to))
        return out

    def commit(self, end: dict) -> None:
        pass


class TailOnce(_Tail, DataSourceReader):
    """All lines that are there; a last line without a line feed counts."""

    def partitions(self) -> list[Range]:
        return [r for file, size in self.files().items() for r in self.ranges(file, 0, size, True)]


class TailSource(DataSource):
    """``spark.readStream.format("tail").option("path", "/feeds/snapshot.csv.*")``: (line, file, position); ``spark.read``, too."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "line string, file string, position long"

    def streamReader(self, schema: object) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("chunk", CHUNK)), self.options.get("since", ""))

    def reader(self, schema: object) -> TailOnce:
        return TailOnce(self.options["path"], int(self.options.get("chunk", CHUNK)), self.options.get("since", ""))


def _options(path: str, chunk: int, since: date | None) -> dict[str, str]:
    return {"path": path, "chunk": str(chunk), "since": since.strftime("%Y%m%d") if since else ""}


def follow(spark: SparkSession, path: str, chunk: int = CHUNK, since: date | None = None) -> DataFrame:
    """Lines of all files that match ``path``, as a stream; files whose names end in a date before ``since`` are left out."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").options(**_options(path, chunk, since)).load()


def lines(spark: SparkSession, path: str, chunk: int = CHUNK, since: date | None = None) -> DataFrame:
    """Lines of all files that match ``path``, with the byte position of each and the date that the file's name ends in."""
    spark.dataSource.register(TailSource)
    return dated(spark.read.format("tail").options(**_options(path, chunk, since)).load())


def dated(rows: DataFrame) -> DataFrame:
    """``rows`` (file, ...) with ``date``: the eight digits that end the file's name, null without them."""
    return rows.withColumn("date", F.try_to_timestamp(F.nullif(F.regexp_extract("file", r"(\d{8})$", 1), F.lit("")), F.lit("yyyyMMdd")).cast("date"))


def latest_date(rows: DataFrame) -> DataFrame:
    """The rows of the newest date among ``rows`` (date, ...); of one date, positions start anew with each file."""
    newest = rows.agg(F.max("date").alias("__newest"))
    return rows.join(F.broadcast(newest), rows["date"] == newest["__newest"]).drop("__newest")
