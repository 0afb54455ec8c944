"""The CSV tree as a Spark data source, format `tape`: batch and stream reads, and the sink that writes the same tree.

Files are `<root>/<datatype>/<symbol>/<date>/<file>.csv`. A read is cut in ranges of `bytes` of a file, so long files are many tasks'.
Besides the lane's columns each row has date, file_name and seq, its place in the symbol's tape: the file's place among
the symbol's, by date and name, then the byte in the file at which the row starts, the same in any cut. Filters on symbol and date name the directories to list; those
on timestamp_ms leave out hourly files of other hours. The stream takes what each symbol's tape has grown by, whole lines only; of a
tape only the last file and how far it was read is remembered, so files that come later under earlier names are not seen.

Writing is by file, under a name of its own that becomes the file's at the commit, so a task that is tried again or a job that
fails leaves no rows. Filters are pushed only where the session sets spark.sql.python.filterPushdown.enabled, which register() does.

Defined results: cells that are no number of their column are null, as are empty ones; missing columns are null; lines with more or fewer cells than the header are skipped; an empty file, or one with a header alone, has no rows; an unfinished last line is a row of a batch read and waits in a stream.
"""

from __future__ import annotations

import contextlib
import datetime
import io
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import partition_parts
from ..schemas import DIRECTORY, HOUR, ddl, schema

#: Of a seq, the bits of the place in a file; the file's place is above them.
PLACE_BITS = 40
_FAR = 2**62


@dataclass
class Stretch(InputPartition):
    path: str
    symbol: str
    date: str
    rank: int
    start: int
    end: int


def _filesystem(root: str) -> tuple[pyarrow.fs.FileSystem, str]:
    found, path = pyarrow.fs.FileSystem.from_uri(root)
    return found, path.rstrip("/")


def file_hours(name: str, date: str) -> tuple[int, int]:
    """The epoch ms from and before which an hourly file's rows are, by its name; of other files its whole day's neighbourhood."""
    mark = name.partition(f"{date}_")[2][:4]
    with contextlib.suppress(ValueError):
        day = int(datetime.datetime.fromisoformat(f"{date}T00:00:00+00:00").timestamp()) * 1000
        if mark.isdigit() and len(mark) == 4 and "-to-" in name:
            return day + int(mark[:2]) * HOUR, day + (int(mark[:2]) + 1) * HOUR
    return -_FAR, _FAR


class _Tree:
    """The files of a lane."""

    def __init__(self, options: dict[str, str]):
        self.root, self.lane = options["path"], options["lane"]
        self.bytes = int(options.get("bytes", 64 << 20))
        self.only = "_" + self.lane if self.lane.startswith("depth_") else ""
        self.symbols: set[str] | None = None
        self.dates: set[str] | None = None
        self.since, self.until = -_FAR, _FAR

    def _folders(self, fs: pyarrow.fs.FileSystem, top: str, named: set[str] | None) -> list[str]:
        if named is not None:
            return sorted(x for x in named if "/" not in x and fs.get_file_info(f"{top}/{x}").type == pyarrow.fs.FileType.Directory)
        found = fs.get_file_info(pyarrow.fs.FileSelector(top, allow_not_found=True))
        return sorted(x.base_name for x in found if x.type == pyarrow.fs.FileType.Directory)

    def files(self) -> Iterator[tuple[str, str, int, str, int]]:
        """(symbol, date, rank, path, size), by symbol, date and name. Ranks count all files of a date, whatever is filtered: the day
        above, the place among the date's files below."""
        fs, root = _filesystem(self.root)
        top = f"{root}/{DIRECTORY[self.lane]}"
        for symbol in self._folders(fs, top, self.symbols):
            for date in self._folders(fs, f"{top}/{symbol}", self.dates):
                try:
                    day = (datetime.date.fromisoformat(date) - datetime.date(1970, 1, 1)).days
                except ValueError:
                    continue
                held = fs.get_file_info(pyarrow.fs.FileSelector(f"{top}/{symbol}/{date}"))
                names = sorted((x.base_name, x.size) for x in held if x.type == pyarrow.fs.FileType.File and x.base_name.endswith(".csv") and self.only in x.base_name)
                if len(names) >= 256:
                    raise ValueError(f"{len(names)} files of a day: {top}/{symbol}/{date}")
                for n, (name, size) in enumerate(names):
                    first, before = file_hours(name, date)
                    if first <= self.until and before > self.since:
                        yield symbol, date, day * 256 + n, f"{top}/{symbol}/{date}/{name}", size

    def narrow(self, f) -> None:
        column = f.attribute[0]
        if isinstance(f, (EqualTo, In)) and column in ("symbol", "date"):
            values = {str(v) for v in ([f.value] if isinstance(f, EqualTo) else f.value)}
            have = self.symbols if column == "symbol" else self.dates
            values = values if have is None else values & have
            if column == "symbol":
                self.symbols = values
            else:
                self.dates = values
        elif column == "timestamp_ms" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            self.since = max(self.since, f.value)
        if column == "timestamp_ms" and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            self.until = min(self.until, f.value)

    def stretches(self, symbol: str, date: str, rank: int, path: str, start: int, end: int) -> list[Stretch]:
        return [Stretch(path, symbol, date, rank, a, min(a + self.bytes, end)) for a in range(start, end, self.bytes)]


def _lines(fs: pyarrow.fs.FileSystem, part: Stretch) -> tuple[bytes, bytes, int]:
    """The header, the whole lines that start in the stretch, and where the first of them starts."""
    with fs.open_input_file(part.path) as f:
        size = f.size()
        header = b""
        while b"\n" not in header and len(header) < size:
            header += f.read_at(min(1 << 16, size - len(header)), len(header))
        head = header.partition(b"\n")[0]
        start, end = max(part.start, len(head) + 1), min(part.end, size)
        if start > len(head) + 1:  # a line that began before is the stretch before's
            at = start - 1
            while at < size:
                piece = f.read_at(min(1 << 16, size - at), at)
                cut = piece.find(b"\n")
                if cut >= 0:
                    start = at + cut + 1
                    break
                at += len(piece)
            else:
                start = size
        if start >= end:
            return head, b"", start
        data = f.read_at(end - start, start)
        while not data.endswith(b"\n") and start + len(data) < size:
            piece = f.read_at(min(1 << 16, size - start - len(data)), start + len(data))
            cut = piece.find(b"\n")
            data += piece if cut < 0 else piece[: cut + 1]
    return head, data, start


def _rows(part: Stretch | None, root: str, columns: list[str], types: pa.Schema) -> Iterator[pa.RecordBatch]:
    if part is None:  # what Spark asks for where there are no stretches
        return
    fs, _ = _filesystem(root)
    head, data, start = _lines(fs, part)
    if not data.strip():
        return
    own = {c: types.field(c).type for c in columns if c not in ("date", "file_name", "seq")}
    text = {c: pa.string() for c in own}
    skipped: set[int] = set()  # lines of another width, by number

    def other_width(row) -> str:
        skipped.add(row.number)
        return "skip"

    read = lambda kinds: pyarrow.csv.read_csv(
        io.BytesIO(head.rstrip(b"\r") + b"\n" + data),
        read_options=pyarrow.csv.ReadOptions(use_threads=False),
        convert_options=pyarrow.csv.ConvertOptions(column_types=kinds, include_columns=list(own), include_missing_columns=True, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False),
        parse_options=pyarrow.csv.ParseOptions(invalid_row_handler=other_width),
    )
    try:
        table = read(own)
    except pa.ArrowInvalid:  # a cell that is no number of its column
        table = read(text)
    n = table.num_rows
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    begins = np.r_[0, ends[ends < len(data)]]
    filled = [int(a) for a, b in zip(begins, np.r_[begins[1:], len(data)], strict=True) if data[a:b].strip(b"\r\n")]
    places = [a for line, a in enumerate(filled, 2) if line not in skipped]
    out = []
    for c in columns:
        if c == "date":
            out.append(pa.array([part.date] * n, pa.string()))
        elif c == "file_name":
            out.append(pa.array([posixpath.basename(part.path)] * n, pa.string()))
        elif c == "seq":
            out.append(pa.array(np.asarray(places, np.int64) + (part.rank << PLACE_BITS) + start, pa.int64()))
        else:
            col = table.column(c).combine_chunks()
            out.append(col if col.type == own[c] else pa.array([_number(x, own[c]) for x in col.to_pylist()], own[c]))
    whole = pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in out], columns)
    for at in range(0, n, 10_000):
        yield whole.slice(at, 10_000)


def _number(text: str | None, kind: pa.DataType):
    if text is None or pa.types.is_string(kind):
        return text
    with contextlib.suppress(ValueError, OverflowError):
        found = int(text) if pa.types.is_integer(kind) else float(text)
        return found if not pa.types.is_integer(kind) or -(2 ** (kind.bit_width - 1)) <= found < 2 ** (kind.bit_width - 1) else None
    return None


class _Reads:
    def __init__(self, tree: _Tree, kind: StructType):
        self.tree, self.columns, self.types = tree, kind.names, to_arrow_schema(kind)

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        return _rows(part, self.tree.root, self.columns, self.types)


class TapeReader(_Reads, DataSourceReader):
    def pushFilters(self, filters):
        """Filters on symbol and date are answered by the directories alone; those on time only leave files out."""
        for f in filters:
            pushed = isinstance(f, (EqualTo, In)) and f.attribute in (("symbol",), ("date",)) and None not in (f.value if isinstance(f, In) else (f.value,))
            if pushed or f.attribute == ("timestamp_ms",):
                self.tree.narrow(f)
            if not (pushed and f.attribute == ("date",)):  # a file's rows may name another symbol
                yield f

    def partitions(self) -> list[Stretch]:
        return [s for symbol, date, rank, path, size in self.tree.files() for s in self.tree.stretches(symbol, date, rank, path, 0, size)]


class TapeStream(_Reads, DataSourceStreamReader):
    """An offset is {symbol: [rank, path, bytes]}: the last file of each symbol's tape, and the whole lines that it has."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last: dict[str, tuple] = {}
        for symbol, _, rank, path, size in self.tree.files():
            last[symbol] = (rank, path, size)
        fs, _ = _filesystem(self.tree.root)
        return {symbol: [rank, path, self._whole(fs, path, size)] for symbol, (rank, path, size) in last.items()}

    @staticmethod
    def _whole(fs: pyarrow.fs.FileSystem, path: str, size: int) -> int:
        with fs.open_input_file(path) as f:
            at = size
            while at:
                step = min(1 << 16, at)
                cut = f.read_at(step, at - step).rfind(b"\n")
                if cut >= 0:
                    return at - step + cut + 1
                at -= step
        return 0

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for symbol, date, rank, path, size in self.tree.files():
            known, upto = start.get(symbol, [-1, "", 0]), end.get(symbol)
            if upto and known[0] <= rank <= upto[0]:
                out += self.tree.stretches(symbol, date, rank, path, known[2] if rank == known[0] else 0, upto[2] if rank == upto[0] else size)
        return out


@dataclass
class Files(WriterCommitMessage):
    moves: list[tuple[str, str]]


class TapeWriter(DataSourceWriter):
    """Rows come sorted by file; each is written under a temporary name beside where it goes."""

    def __init__(self, tree: _Tree, kind: StructType):
        self.root, self.lane, self.columns = tree.root, tree.lane, [c for c in kind.names if c not in ("date", "hour", "next_hour", "file_name", "seq")]

    def _path(self, row) -> str:
        hours = f"_{row['hour']:02d}00-to-{row['next_hour']:02d}00" if self.lane == "depth_updates" else ""
        return f"{DIRECTORY[self.lane]}/{row['symbol']}/{row['date']}/{row['symbol']}_{self.lane}_{row['date']}{hours}.csv"

    @staticmethod
    def _cell(value) -> str:
        text = "" if value is None else repr(value) if isinstance(value, float) else str(value)
        return '"' + text.replace('"', '""') + '"' if '"' in text or "," in text or "\n" in text else text

    def write(self, rows) -> Files:
        fs, root = _filesystem(self.root)
        moves, out, now = [], None, None
        try:
            for row in rows:
                path = self._path(row)
                if path != now:
                    if out:
                        out.close()
                    now, final = path, f"{root}/{path}"
                    fs.create_dir(posixpath.dirname(final), recursive=True)
                    moves.append((f"{posixpath.dirname(final)}/.{uuid.uuid4().hex}.tmp", final))
                    out = fs.open_output_stream(moves[-1][0])
                    out.write((",".join(self.columns) + "\n").encode())
                out.write((",".join(self._cell(row[c]) for c in self.columns) + "\n").encode())
        finally:
            if out:
                out.close()
        return Files(moves)

    def commit(self, messages: list[Files | None]) -> None:
        fs, _ = _filesystem(self.root)
        for m in messages:
            for part, final in m.moves if m else []:
                fs.move(part, final)

    def abort(self, messages: list[Files | None]) -> None:
        fs, _ = _filesystem(self.root)
        for m in messages:
            for part, _ in m.moves if m else []:
                with contextlib.suppress(OSError):
                    fs.delete_file(part)


class TapeSource(DataSource):
    """Options: path (the root), lane, and bytes (of a stretch)."""

    @classmethod
    def name(cls) -> str:
        return "tape"

    def schema(self) -> str:
        return f"{ddl(self.options['lane'])}, date STRING, file_name STRING, seq BIGINT"

    def reader(self, schema: StructType) -> TapeReader:
        return TapeReader(_Tree(self.options), schema)

    def streamReader(self, schema: StructType) -> TapeStream:
        return TapeStream(_Tree(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> TapeWriter:
        return TapeWriter(_Tree(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TapeSource)


def read_tape(spark: SparkSession, root: str, lane: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("tape").options(lane=lane, **options).load(root)


def stream_tape(spark: SparkSession, root: str, lane: str, **options) -> DataFrame:
    register(spark)
    return spark.readStream.format("tape").options(lane=lane, **options).load(root)


def write_tape(df: DataFrame, root: str, lane: str) -> None:
    """Writes a lane's rows (its columns, and what they are ordered by: seq, if there is one) as files of a symbol and day, diffs of a
    symbol and hour in the order of their update ids. A file that is there is replaced, so the rows of a file must come together."""
    register(df.sparkSession)
    parts = partition_parts(F.col("timestamp_ms"))
    names = schema(lane).names
    rows = df.withColumns({c: F.lit(None) for c in names if c not in df.columns}).withColumns(parts)
    by = ["symbol", "date", "hour"] if lane == "depth_updates" else ["symbol", "date"]
    order = [c for c in (["last_update_id"] if lane == "depth_updates" else []) + ["timestamp_ms", "seq"] if c in rows.columns]
    dealt = rows.repartition(*by).sortWithinPartitions(*by, *order)
    dealt.select(*[F.col(c).cast(schema(lane)[c].dataType) for c in names], *parts).write.format("tape").options(lane=lane).mode("append").save(root)


__all__ = ["TapeSource", "file_hours", "read_tape", "register", "stream_tape", "write_tape"]
