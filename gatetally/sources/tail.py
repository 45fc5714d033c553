"""JSON Lines files that are still being written, as a stream.

A log agent follows one growing file; Spark's own file source takes each file
once, when it first sees it. This source keeps a position inside every file. A
position always lies behind a line end, so a half-written last line waits until
the rest of it has come.

A file is known by its path and a fingerprint of its first line. When a path
holds another first line, the file was rotated: what is left of the old one is
read from wherever that first line is found now, on from the old position, and
the new one is read from its start. A file that shrank is read from its start.

The offset holds a position for each file that exists; files that were deleted
leave it. A batch is a set of byte ranges, cut at ``splitBytes`` so that several
tasks read one file; in a large batch the cuts are longer, so that it does not
become a task for every few lines. A task reads the lines that start inside its range, so cuts
need not lie at line ends. Ranges are read again in the same way when a batch is
repeated.

Files are opened through Arrow's file systems (local, HDFS, S3, GCS), on the
driver only to list them and to look for the last line end.
"""

import hashlib
import posixpath
from collections.abc import Iterator, Sequence
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
_BLOCK = 1 << 16
#: Cuts of one batch that its size is spread over before they grow beyond ``splitBytes``.
_PARTS = 256
#: Bytes of the first line that tell files apart.
_HEAD = 4096
#: Lines of one Arrow batch.
_LINES = 10_000


class FileRange(InputPartition):
    """Lines of one file that start from byte ``low`` up to but not including ``high``."""

    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI or a local path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///", 1))
    return fs.LocalFileSystem(), path


def listed(files: fs.FileSystem, pattern: str) -> dict[str, int]:
    """Sizes of the files that ``pattern`` names: a file, a folder, or a folder with a wild card in the last part."""
    folder, last = posixpath.split(pattern)
    if "*" not in last:
        info = files.get_file_info(pattern)
        if info.type == fs.FileType.File:
            return {info.path: info.size}
        folder, last = pattern, "*"
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    shown = [i for i in found if i.type == fs.FileType.File and i.base_name[:1] not in "._"]
    return {i.path: i.size for i in shown if fnmatch(i.base_name, last)}


def fingerprint(files: fs.FileSystem, path: str) -> str | None:
    """Digest of the first line (its first bytes, if it is long); none while that is incomplete."""
    with files.open_input_file(path) as file:
        head = file.read_at(min(_HEAD, file.size()), 0)
    line, end, _ = head.partition(b"\n")
    return hashlib.sha256(line).hexdigest()[:32] if end or len(head) == _HEAD else None


def last_line_end(files: fs.FileSystem, path: str, size: int) -> int:
    """Bytes up to and including the last line break among the first ``size``."""
    with files.open_input_file(path) as file:
        high = size
        while high > 0:
            low = max(0, high - _BLOCK)
            at = file.read_at(high - low, low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            high = low
    return 0


def snapshot(files: fs.FileSystem, pattern: str) -> dict[str, list]:
    """[fingerprint, position behind the last whole line] of every file that has one."""
    now = {}
    for path, size in listed(files, pattern).items():
        name = fingerprint(files, path) if size else None
        end = last_line_end(files, path, size) if name else 0
        if end:
            now[path] = [name, end]
    return now


def new_ranges(start: dict[str, list], end: dict[str, list]) -> list[tuple[str, str, int, int]]:
    """(path, fingerprint, from, to) of what ``end`` has beyond ``start``."""
    moved = {name: at for path, (name, at) in start.items() if end.get(path, [None])[0] != name}
    ranges = []
    for path, (name, to) in sorted(end.items()):
        if start.get(path, [None])[0] == name:
            low = start[path][1]
        else:
            low = moved.pop(name, 0)
        low = low if low <= to else 0
        if low < to:
            ranges.append((path, name, low, to))
    return ranges


def cut_ranges(path: str, low: int, high: int, split: int) -> list[FileRange]:
    return [FileRange(path, a, min(a + split, high)) for a in range(low, high, split)]


def range_bytes(ranges: list[tuple[str, str, int, int]], least: int) -> int:
    """Size of the cuts of a batch: ``least`` bytes, more (up to ``SPLIT_BYTES``) where that would be over ``_PARTS`` cuts."""
    total = sum(high - low for _, _, low, high in ranges)
    return max(least, min(SPLIT_BYTES, -(-total // _PARTS)))


def lines_of(files: fs.FileSystem, part: FileRange) -> Iterator[bytes]:
    """The lines that start in a range, without their ends; empty lines are left out."""
    with files.open_input_file(part.path) as file:
        at, held = part.low, b""
        if at:
            # The line of the byte before this range belongs to the task before, wherever it ends.
            at -= 1
            while True:
                block = file.read_at(_BLOCK, at)
                cut = block.find(b"\n")
                if cut >= 0 or not block:
                    at += cut + 1
                    break
                at += len(block)
        start = at
        while start < part.high:
            block = file.read_at(_BLOCK, at)
            if not block:
                return
            at += len(block)
            pieces = (held + block).split(b"\n")
            held = pieces.pop()
            for line in pieces:
                if start >= part.high:
                    return
                start += len(line) + 1
                if line.strip():
                    yield line


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.pattern = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return snapshot(*open_folder(self.pattern))

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        files, pattern = open_folder(self.pattern)
        where: dict[str, str] | None = None
        parts: list[FileRange] = []
        ranges = new_ranges(start, end)
        split = range_bytes(ranges, self.split)
        for path, name, low, high in ranges:
            # A batch that is repeated may find its file under another name.
            if files.get_file_info(path).type != fs.FileType.File or fingerprint(files, path) != name:
                if where is None:
                    where = {fingerprint(files, p): p for p in listed(files, pattern)}
                if name not in where:
                    raise FileNotFoundError(f"{path} went before bytes {low} to {high} of it were read")
                path = where[name]
            parts += cut_ranges(path, low, high, split)
        return parts

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(self.pattern)
        lines: list[str] = []
        for line in lines_of(files, partition):
            lines.append(line.decode("utf-8", "replace"))
            if len(lines) == _LINES:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                lines = []
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


class LineTail(DataSource):
    """``spark.readStream.format("line_tail").load(path)``: one column ``value``."""

    @classmethod
    def name(cls) -> str:
        return "line_tail"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)
