"""Landed ticket pages as a Spark data source (S1, S3, I1): ``spark.read.format("ticket_pages")``.

A page is one JSON file. Pages are grouped by their bytes, a group is one
partition; a record list's items are cut out of the page's text as they stand,
so numbers and key order survive. The cursor is the source's business, as it
is with a paging API:

- option ``created_after`` leaves out records older than that instant (the
  boundary stays) and counts them: a row without a record holds, per page,
  how many were skipped. Records whose time cannot be read are not skipped,
  validation judges them.
- a condition ``created_at >= ...`` (or ``>``) on the frame is pushed into the
  source and means what it means in SQL: rows without a time go.

``readStream`` gives the pages in the order they landed; an offset is the
landing time and path of the last page that was read, so a page must land under
its final name by a rename, not before pages that were read already. A page that
is no JSON, or holds no record list, is one row with ``error`` and the page's
text as ``record``. Items that are no objects are left out.

Paths are local ones, or URIs that Arrow's file systems open. The JVM text
reader (``landed.read_ticket_payloads``) reads everything Spark can.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
)

from moodline.sources.landed import BAD_SHAPE_MESSAGE, ENVELOPE_KEYS, MALFORMED_MESSAGE

FORMAT = "ticket_pages"
GROUP_BYTES = 64 << 20
FOLDERS = 64
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SCHEMA = "record string, created_at timestamp, _source string, _pos int, skipped long, error string"
_ARROW = pa.schema([("record", pa.string()), ("created_at", pa.timestamp("us", "UTC")), ("_source", pa.string()),
                    ("_pos", pa.int32()), ("skipped", pa.int64()), ("error", pa.string())])
_SPACE = re.compile(r"[ \t\r\n]*")


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


_DECODER = json.JSONDecoder(parse_constant=_no_constant)


def instant(text: object) -> dt.datetime | None:
    """An ISO time (UTC if it names no zone), or None."""
    if not isinstance(text, str):
        return None
    try:
        at = dt.datetime.fromisoformat(text.strip())
        return (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)
    except (ValueError, OverflowError):
        return None


def _past_space(text: str, at: int) -> int:
    return _SPACE.match(text, at).end()


def _members(text: str, at: int) -> Iterator[tuple[object, object, int, int]]:
    """(key or None, value, start, end) of the members of the valid JSON list or object that begins at ``at``."""
    keyed, at = text[at] == "{", _past_space(text, at + 1)
    while text[at] not in "]}":
        key = None
        if keyed:
            key, at = _DECODER.raw_decode(text, at)
            at = _past_space(text, _past_space(text, at) + 1)
        value, end = _DECODER.raw_decode(text, at)
        yield key, value, at, end
        at = _past_space(text, end)
        if text[at] == ",":
            at = _past_space(text, at + 1)


def page_items(text: str) -> list[tuple[int, dict, str]]:
    """(place, record, its text) of a page's objects; ValueError for a page that is no JSON or has no record list."""
    start = _past_space(text, 0)
    try:
        root, end = _DECODER.raw_decode(text, start)
    except RecursionError:
        raise ValueError(MALFORMED_MESSAGE) from None
    except ValueError:
        raise ValueError(MALFORMED_MESSAGE) from None
    if _past_space(text, end) != len(text):
        raise ValueError(MALFORMED_MESSAGE)
    if isinstance(root, dict):
        key = next((k for k in ENVELOPE_KEYS if isinstance(root.get(k), list)), None)
        if key is None:
            raise ValueError(BAD_SHAPE_MESSAGE)
        start = [at for k, _, at, _ in _members(text, start) if k == key][-1]
    elif not isinstance(root, list):
        raise ValueError(BAD_SHAPE_MESSAGE)
    return [(i, v, text[a:b]) for i, (_, v, a, b) in enumerate(_members(text, start)) if isinstance(v, dict)]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def land(pages: DataFrame, path: str) -> None:
    """Land each page (``value``, ``page``) as a file of its own, ``page=<page>.json``, in one of ``FOLDERS`` folders.

    Tasks write the files under hidden names and rename them, so a task that
    runs again replaces its files by equal ones. No folder is made or renamed per page.
    """
    def write(rows: Iterator[Row]) -> None:
        files, root = _opened(path)
        for row in rows:
            folder, name = f"{root}/{row.folder:02d}", f"page={row.page}.json"
            part = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as f:
                f.write(f"{row.value}\n".encode())
            files.move(part, f"{folder}/{name}")

    files, root = _opened(path)
    for folder in range(FOLDERS):
        files.create_dir(f"{root}/{folder:02d}", recursive=True)
    (pages.select("value", "page", F.pmod(F.crc32(F.col("page").cast("binary")), F.lit(FOLDERS)).alias("folder"))
     .foreachPartition(write))


def _listed(paths: list[str]) -> list[tuple[int, str, int]]:
    """(landing time in ns, path, bytes) of the pages under the paths, in landing order; hidden files are none."""
    found = []
    local = [_opened(path)[1] for path in paths if "://" not in path or path.startswith("file:")]
    known = dict(zip(local, fs.LocalFileSystem().get_file_info(local), strict=True)) if local else {}
    for path in paths:
        files, root = _opened(path)
        prefix = path[:len(path) - len(root)] if "://" in path and path.endswith(root) else ""
        info = known[root] if isinstance(files, fs.LocalFileSystem) else files.get_file_info(root)
        infos = files.get_file_info(fs.FileSelector(root, recursive=True)) if info.type == fs.FileType.Directory else [info]
        for f in infos:
            if f.type == fs.FileType.NotFound:
                raise FileNotFoundError(f.path)
            inner = f.path[len(root):].split("/")
            if f.type == fs.FileType.File and not any(p.startswith(("_", ".")) for p in inner if p):
                found.append((f.mtime_ns or 0, prefix + f.path, f.size or 0))
    return sorted(set(found))


@dataclass
class PageGroup(InputPartition):
    """The pages of one task."""

    paths: list[str]


def _groups(pages: list[tuple[int, str, int]], most: int) -> list[PageGroup]:
    groups, room = [], 0
    for _, path, size in pages:
        if not groups or size > room:
            groups.append(PageGroup([]))
            room = most
        groups[-1].paths.append(path)
        room -= size
    return groups


class _Pages:
    """What batch and stream readers share: listing, grouping, reading with a cursor."""

    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.most = int(options.get("groupbytes", GROUP_BYTES))
        self.after: dt.datetime | None = None
        self.bounds: list[tuple[dt.datetime, bool]] = []  # pushed: instant, boundary included
        if options.get("created_after"):
            self.after = instant(options["created_after"])
            if self.after is None:
                raise ValueError(f"created_after is no time: {options['created_after']!r}")

    def read(self, partition: PageGroup) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            files, at = _opened(path)
            with files.open_input_stream(at) as f:
                rows = self._rows(path, f.read().decode("utf-8", "replace"))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types,
                                                                                strict=True)], schema=_ARROW)

    def _rows(self, path: str, text: str) -> list[tuple]:
        try:
            items = page_items(text)
        except ValueError as bad:
            return [] if self.bounds else [(text, None, path, None, 0, str(bad))]
        rows, skipped = [], 0
        for place, record, own in items:
            at = instant(record.get("created_at"))
            if self.after is not None and at is not None and at < self.after:
                skipped += 1
            elif all(at is not None and (at > b or (at == b and same)) for b, same in self.bounds):
                rows.append((own, at, path, place, 0, None))
        if skipped and not self.bounds:
            rows.append((None, None, path, None, skipped, None))
        return rows


class PageReader(_Pages, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("created_at",):
                at = f.value if f.value.tzinfo else f.value.replace(tzinfo=dt.timezone.utc)
                self.bounds.append((at, isinstance(f, GreaterThanOrEqual)))
            else:
                yield f

    def partitions(self) -> list[PageGroup]:
        return _groups(_listed(self.paths), self.most) or [PageGroup([])]


class PageStreamReader(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"landed": -1, "path": ""}

    def latestOffset(self) -> dict:
        pages = _listed(self.paths)
        return {"landed": pages[-1][0], "path": pages[-1][1]} if pages else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[PageGroup]:
        first, last = ((o["landed"], o["path"]) for o in (start, end))
        return _groups([p for p in _listed(self.paths) if first < p[:2] <= last], self.most)

    def commit(self, end: dict) -> None:
        """Nothing to release: landed pages stay."""


class TicketPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filter pushdown."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(TicketPages)


def read_pages(spark: SparkSession, paths: str | list[str], created_after: str | None = None) -> tuple[DataFrame, Observation]:
    """Rows as ``landed.unwrap_payloads`` gives them, and an observation of how many records the cursor ``skipped``."""
    register(spark)
    reader = spark.read.format(FORMAT).option("paths", json.dumps([paths] if isinstance(paths, str) else list(paths)))
    if created_after:
        reader = reader.option("created_after", created_after)
    seen = Observation()
    rows = reader.load().observe(seen, F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped")).where("record is not null")
    parsed = rows.select("*", F.when(F.col("error").isNull(), F.try_parse_json("record")).alias("parsed"))
    # JSON that only Spark's stricter parser refuses (such as a repeated key) is malformed, too.
    error = F.coalesce("error", F.when(F.col("parsed").isNull(), F.lit(MALFORMED_MESSAGE)))
    return parsed.select(F.col("parsed").alias("record"), "_source",
                         F.struct(F.col("_source").alias("f"), F.col("_pos").alias("p")).alias("_ordinal"),
                         F.when(error.isNotNull(), F.col("record")).alias("_bad_text"), error.alias("_bad_error")), seen
