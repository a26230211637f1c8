"""Lines of files that grow: byte ranges read on the executors, each line told by file and offset.

A load reads what stands behind the position of the load before. The position is kept with a
digest of the file's first bytes, so that a file cut short or replaced is told from one that has
grown, and begins again as its next generation.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from logweir.schemas import FILES
from logweir.session import ship

#: Bytes of a file that one range holds, and that are read at a time.
RANGE_BYTES, CHUNK_BYTES, HEAD_CHUNK = 64 << 20, 4 << 20, 1 << 16
#: First bytes of a file by which it is known again.
HEAD_BYTES = 256
#: Tasks of one read at most; ranges beyond that share them.
MOST_TASKS = 50_000
# Files of these kinds are read whole, and again whole when they change.
_PACKED = (".gz", ".bz2", ".zst", ".lz4")
_LINES = pa.schema([("value", pa.string()), ("place", pa.string())])
_PLANNED = "path string, length long, modified long, start long, upto long, position long, generation int, head_bytes int, head string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, of a path as Spark lists it."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{quote(rest, safe='/:@')}")


def _head(file, size: int) -> str:
    file.seek(0)
    return hashlib.sha256(file.read(size)).hexdigest()


def _last_line(file, start: int, length: int) -> int:
    """Where the line begins that the file ends in, the length if it ends with a line end; from `start` on."""
    stop = length
    while stop > start:
        begin = max(start, stop - CHUNK_BYTES)
        file.seek(begin)
        found = file.read(stop - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        stop = begin
    return start


def _plan(whole: bool, wait: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                system, path = opened(r["path"])
                length, known = r["length"], r["position"] is not None
                packed = r["path"].endswith(_PACKED)
                with system.open_input_file(path) as file:
                    grown = known and not packed and length >= r["position"] and _head(file, r["head_bytes"]) == r["head"]
                    start = r["position"] if grown and not whole else 0
                    position = length if packed else _last_line(file, start, length)
                    size = min(HEAD_BYTES, position)
                    head = _head(file, size)
                generation = 0 if not known else r["generation"] + (not grown)
                upto = position if wait else length
                rows.append((r["path"], length, r["modified"], start, upto, position, generation, size, head))
            names = [f.split()[0] for f in _PLANNED.split(", ")]
            kinds = [pa.string(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def planned_reads(present: DataFrame, read: DataFrame, whole: bool = True, unfinished: str = "take") -> DataFrame:
    """What of the `present` files is to be read, after `read`, the newest row of each file.

    Files that are as they were give no row. Of one that has grown what was added is read,
    with `whole` all of it: its old lines keep their places. A last line without a line end is read as it is,
    and once more when the file has grown; with `unfinished="wait"` it waits for its end.
    Only first bytes and last lines are looked at here, file by file on the executors.
    """
    ship(present.sparkSession)
    known = read.select("path", F.col("length").alias("was"), F.col("modified").alias("at"), "position", "generation", "head_bytes", "head")
    due = present.join(known, "path", "left").filter(
        F.col("was").isNull() | (F.col("was") != F.col("length")) | (F.col("at") != F.col("modified"))
    )
    return due.drop("was", "at").mapInArrow(_plan(whole, unfinished == "wait"), _PLANNED)


def _ended(data: bytes, ends: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Spans of bytes as text; a carriage return before the line end goes."""
    whole = np.frombuffer(data, np.uint8)
    ends = ends - ((ends > starts) & (whole[np.maximum(ends - 1, 0)] == 13))
    try:
        # one array over the bytes, of which every second span is a line
        edges = np.r_[np.stack([starts, ends], 1).ravel(), len(data)].astype(np.int64)
        spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data)])
        return spans.take(pa.array(np.arange(0, 2 * len(starts), 2))).cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        found = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return pa.array(found, pa.string())


def range_lines(file, begin: int, end: int, upto: int, name: str):
    """Batches of the lines that begin in a range; the last one may end behind it, at `upto` at the latest."""
    at, skip = max(begin - 1, 0), begin > 0  # a line begins behind a line end
    file.seek(at)
    held, held_at = b"", at
    while held_at < end or skip:
        # as much again as is held, so that a very long line is copied a few times only
        chunk = file.read(min(max(CHUNK_BYTES, len(held)), upto - at))
        at += len(chunk)
        data = held + chunk
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        if not chunk:
            ends = np.array([len(data)] if data else [], np.int64)  # the last line has no end
        starts = np.r_[0, ends[:-1] + 1][: len(ends)]
        if skip and len(ends):
            ends, starts, skip = ends[1:], starts[1:], False
            first = int(ends[0]) if len(ends) else None
            rest = len(data) if not chunk else data.rfind(b"\n") + 1
        else:
            first, rest = (int(ends[0]) if len(ends) else None), (int(ends[-1]) + 1 if len(ends) else 0)
        own = held_at + starts < end
        if first is not None and own.any():
            places = pc.binary_join_element_wise(name, pa.array(held_at + starts[own]).cast(pa.string()), ":")
            yield pa.record_batch([_ended(data, ends[own], starts[own]), places], schema=_LINES)
        if not chunk:
            return
        held, held_at = data[rest:], held_at + rest


def _read(batches):
    for batch in batches:
        for r in batch.to_pylist():
            system, path = opened(r["path"])
            name = r["path"] if not r["generation"] else f"{r['path']}#{r['generation']}"
            if r["path"].endswith(_PACKED):
                with system.open_input_stream(path) as stream:
                    # offsets are those of the unpacked lines
                    yield from range_lines(_Unpacked(stream), 0, 1 << 62, 1 << 62, name)
            else:
                with system.open_input_file(path) as file:
                    yield from range_lines(file, r["begin"], r["end"], r["upto"], name)


class _Unpacked:
    """A stream that is only read on."""

    def __init__(self, stream):
        self._stream = stream

    def seek(self, at: int) -> None:
        pass

    def read(self, size: int) -> bytes:
        return self._stream.read(min(size, CHUNK_BYTES))


def planned_lines(planned: DataFrame, range_bytes: int = RANGE_BYTES, tasks: int | None = None) -> DataFrame:
    """(value, place) of stored `planned_reads`; the place is file, generation and byte offset.

    Lines end with a line feed, before which a carriage return may stand. Bytes that are not
    UTF-8 become U+FFFD. Without `tasks` a range is a task; a stream, which cannot be counted
    before it runs, names their number.
    """
    ship(planned.sparkSession)
    packed = F.col("path").rlike(f"({'|'.join(_PACKED)})$".replace(".", "[.]"))
    step = F.when(packed, F.col("upto")).otherwise(F.lit(range_bytes)).cast("long")
    ranges = planned.filter("upto > start").withColumn("begin", F.explode(F.sequence("start", F.col("upto") - 1, step)))
    ranges = ranges.select("path", "generation", "upto", "begin", F.least(F.col("begin") + range_bytes, F.col("upto")).alias("end"))
    # an exact number, since Spark would put these few small rows into one task
    tasks = min(max(ranges.count(), 1), MOST_TASKS) if tasks is None else tasks
    return ranges.repartition(tasks).mapInArrow(_read, "value string, place string")


def _first_line(file) -> bytes:
    held = b""
    while b"\n" not in held and (more := file.read(max(HEAD_CHUNK, len(held)))):
        held += more
    return held.partition(b"\n")[0].removesuffix(b"\r")


def _heads(batches):
    for batch in batches:
        values = []
        for name in batch.column("path").to_pylist():
            system, path = opened(name)
            with system.open_input_stream(path) as file:
                values.append(_first_line(file).decode("utf-8", "replace"))
        yield pa.record_batch([batch.column("path"), pa.array(values, pa.string())], ["path", "value"])


def head_lines(present: DataFrame) -> DataFrame:
    """(path, value): the first line of each file, of which no more than that is read, by 64 KB."""
    ship(present.sparkSession)
    return present.select("path").mapInArrow(_heads, "path string, value string")


def kept_files(planned: DataFrame) -> DataFrame:
    """What the store keeps of the files that a load has read."""
    return planned.select(*FILES.fieldNames())


def listed(pattern: str) -> dict[str, list[int]]:
    """Length and time of the files that a path stands for: a file, a folder's files, or a glob of either.

    Hidden files are left out, as Spark's readers do; `*` does not cross a folder's border.
    """
    fixed = re.split(r"[*?\[]", pattern, maxsplit=1)[0]
    system, wanted = opened(pattern)
    base = wanted.rstrip("/") if fixed == pattern else opened(fixed)[1].rpartition("/")[0]
    if (at := system.get_file_info(base)).type == fs.FileType.NotFound:
        return {}
    found = [at] if at.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base, recursive=True))
    parts = wanted.rstrip("/").split("/")
    scheme = "file:" if isinstance(system, fs.LocalFileSystem) else pattern.split("://")[0] + "://"
    out = {}
    for f in found:
        names = f.path.split("/")
        # the glob's file itself, or a file in the glob's folder
        met = len(names) - len(parts) in (0, 1) and all(map(fnmatch.fnmatchcase, names, parts))
        if f.type == fs.FileType.File and met and not f.base_name.startswith(("_", ".")):
            out[f"{scheme}{f.path}"] = [f.size, (f.mtime_ns or 0) // 1000]
    return out


class GrowingFiles(DataSource):
    """Files as they change: a row (path, length, modified) for each change that a trigger finds."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return "path string, length long, modified long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Changes(self.options["path"])


class _Changes(SimpleDataSourceStreamReader):
    """The offset holds every file's length and time, so that a repeated batch has the same rows."""

    def __init__(self, pattern: str):
        self._pattern = pattern

    def initialOffset(self) -> dict:
        return {"files": {}}

    def read(self, start: dict):
        end = {"files": listed(self._pattern)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([(path, *state) for path, state in sorted(end["files"].items()) if start["files"].get(path) != state])
