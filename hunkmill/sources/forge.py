"""Review comments of a code forge as a Spark data source, in batch and as a stream.

``spark.read.format("forge_comments").option("pages", FOLDER)`` reads pages of comments in the forge's JSON
from a folder with an ``index.json`` ({"pages": [[name, first, last], ...]}, ordered by ``updated_at``).  With
``since`` and ``until`` and ``workers`` the time between is cut into equal half-open windows, one task each;
filters on ``updated_at`` are pushed into the scan.  The stream's offset is the largest ``updated_at`` read; its
pages are read by the tasks, one each, and only the index by the driver.

The folder may be on any file system that pyarrow knows; all machines must see it.

The HTTP side is a decision table and header parsers without a connection of their own, so that a transport
can be injected and everything can be tested.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from hunkmill.operators.shards import windows
from hunkmill.schemas import REVIEW_COMMENT

MAX_WAITS = 5
SNIPPET = 300


@dataclass
class Step:
    """What to do after an answer: ok, wait and ask again, or fail."""

    action: str
    seconds: float = 0.0
    message: str = ""


def _number(headers: dict[str, str], name: str) -> int | None:
    text = {k.lower(): v for k, v in headers.items()}.get(name, "")
    return int(text) if text.strip().isdigit() else None


def next_step(status: int, headers: dict[str, str], body: str, waits: int, now: float) -> Step:
    """The decision table of a GET: rate limits wait for their reset, server errors back off, the rest fails.

    A good answer that used the last allowed request waits after it.
    """
    left, reset = _number(headers, "x-ratelimit-remaining"), _number(headers, "x-ratelimit-reset")
    until_reset = max(reset - now, 0) + 1 if reset is not None else 60.0
    if 200 <= status < 300:
        return Step("ok", until_reset if left == 0 else 0.0)
    limited = status == 429 or (status == 403 and left == 0)
    if limited and waits < MAX_WAITS:
        after = _number(headers, "retry-after")
        return Step("wait", float(after) if after is not None else until_reset)
    if 500 <= status < 600 and waits < MAX_WAITS:
        return Step("wait", float(2**waits))
    return Step("fail", message=f"status {status}: {body[:SNIPPET]}")


def next_link(header: str | None) -> str | None:
    """The address with rel="next" of a Link header."""
    for part in (header or "").split(","):
        if 'rel="next"' in part and "<" in part and ">" in part:
            return part[part.index("<") + 1 : part.index(">")]
    return None


def fetch(get: Callable[[str], tuple[int, dict[str, str], str]], url: str, sleep: Callable[[float], None], now: Callable[[], float]) -> tuple[dict[str, str], str]:
    """One page by an injected transport, with the waits of :func:`next_step`."""
    waits = 0
    while True:
        status, headers, body = get(url)
        step = next_step(status, headers, body, waits, now())
        if step.seconds:
            sleep(step.seconds)
        if step.action == "ok":
            return headers, body
        if step.action == "fail":
            raise OSError(step.message)
        waits += 1


def crawl(get, url: str, sleep, now, limit: int = 0) -> Iterator[dict]:
    """All rows from a first page on, following next links; an empty page ends it, a limit ends it after its page."""
    seen = 0
    while url:
        headers, body = fetch(get, url, sleep, now)
        rows = json.loads(body)
        yield from rows
        seen += len(rows)
        url = next_link({k.lower(): v for k, v in headers.items()}.get("link"))
        if not rows or (limit and seen >= limit):
            return


def seconds(stamp: str) -> int:
    return int(datetime.fromisoformat(stamp.replace("Z", "+00:00")).timestamp())


def stamp(at: int) -> str:
    return datetime.fromtimestamp(at, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def as_tuple(row: dict) -> tuple:
    """Declared fields only, in order; unknown fields are ignored."""
    user = row.get("user")
    out = [row.get(f.name) for f in REVIEW_COMMENT.fields]
    out[5] = (user.get("login"),) if isinstance(user, dict) else None
    return tuple(out)


class Folder:
    """Small files of a folder, wherever it is."""

    def __init__(self, folder: str):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(folder if "://" in folder else "file://" + os.path.abspath(folder.removeprefix("file:")))

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return f.read()

    def write(self, name: str, content: bytes) -> None:
        self.fs.create_dir(self.root, recursive=True)
        with self.fs.open_output_stream(f"{self.root}/{name}") as f:
            f.write(content)


def in_window(row: dict, since: str | None, until: str | None) -> bool:
    """Whether a row was updated from ``since`` on and before ``until``; rows without a time are in the first window only."""
    at = row.get("updated_at") or ""
    return (since is None or at >= since) and (until is None or at < until)


class Pages:
    """Pages of a folder, ordered by time."""

    def __init__(self, folder: str):
        self.folder = Folder(folder)
        self.index = json.loads(self.folder.read("index.json"))["pages"]

    def rows(self, since: str | None, until: str | None) -> Iterator[dict]:
        """From ``since`` on, before ``until``; pages outside aren't opened."""
        for name, first, last in self.index:
            if (since is not None and last < since) or (until is not None and first >= until):
                continue
            yield from (row for row in json.loads(self.folder.read(name)) if in_window(row, since, until))


@dataclass
class Window(InputPartition):
    since: str | None
    until: str | None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["pages"]
        self.since, self.until = options.get("since"), options.get("until")
        self.workers = int(options.get("workers", "1"))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrow the time by bounds on ``updated_at``; Spark applies every filter again."""
        for f in filters:
            if getattr(f, "attribute", None) == ("updated_at",) and isinstance(getattr(f, "value", None), str):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.since = max(self.since or "", f.value)
                if isinstance(f, LessThan):
                    self.until = min(self.until or "~", f.value)
                elif isinstance(f, (LessThanOrEqual, EqualTo)):
                    self.until = min(self.until or "~", f.value + "\0")
            yield f

    def partitions(self) -> list[InputPartition]:
        pages = Pages(self.folder)
        timed = [at for p in pages.index for at in p[1:] if at]  # rows without a time have an empty one
        if self.workers <= 1 or not timed:
            return [Window(self.since, self.until)]
        first = self.since or min(timed)
        last = self.until.rstrip("\0") if self.until else stamp(seconds(max(timed)) + 1)
        cuts = windows(seconds(first), seconds(last), self.workers)
        out = [Window(stamp(a), stamp(b)) for a, b in cuts if a < b]
        if out:
            out[0].since, out[-1].until = self.since, self.until
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in Pages(self.folder).rows(partition.since, partition.until):
            yield as_tuple(row)


@dataclass
class Page(InputPartition):
    name: str
    since: str | None
    until: str | None


class _Stream(DataSourceStreamReader):
    """Pages in order of time; the offset is the mark from which the next read starts, inclusive.

    Rows at the mark come again with the next batch and are told apart downstream by their identifier.  A batch
    has ``pages_per_batch`` pages, or more if the next one ends at the same mark; each is a task of its own.
    """

    def __init__(self, options: dict[str, str]):
        self.folder, self.start = options["pages"], options.get("since")
        self.most = int(options.get("pages_per_batch", "1"))
        self.mark: str | None = None  # up to where batches have been planned

    def initialOffset(self) -> dict:
        return {"since": self.start}

    def latestOffset(self) -> dict:
        mark = self.mark if self.mark is not None else self.start
        ahead = [last for _, _, last in Pages(self.folder).index if mark is None or last > mark]
        if ahead:
            self.mark = mark = max(ahead[: self.most])
        return {"since": mark}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        since, end_mark = start["since"], end["since"]
        self.mark = end_mark if self.mark is None else max(self.mark, end_mark or "")  # also after a restart
        if end_mark is None or since == end_mark:
            return []
        until = end_mark + "\0"
        return [Page(name, since, until) for name, first, last in Pages(self.folder).index if (since is None or last >= since) and first < until]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = json.loads(Folder(self.folder).read(partition.name))
        return (as_tuple(row) for row in rows if in_window(row, partition.since, partition.until))

    def commit(self, end: dict) -> None:
        """Nothing to release; the stream's checkpoint holds the mark."""


def checkpoint_name(out: str) -> str:
    """The checkpoint beside an output: its name with another ending."""
    folder, _, name = out.rpartition("/")
    return f"{folder}/{name.rpartition('.')[0] or name}.checkpoint"


def save_checkpoint(out: str, mark: str | None) -> None:
    folder, _, name = checkpoint_name(out).rpartition("/")
    Folder(folder).write(name, (mark or "").encode())


def resume_mark(since: str | None, out: str) -> str | None:
    """Where a crawl into ``out`` starts: the given mark, else the checkpoint's; a blank one is none."""
    if since is None:
        folder, _, name = checkpoint_name(out).rpartition("/")
        try:
            since = Folder(folder).read(name).decode()
        except FileNotFoundError:
            return None
    return since.strip() or None


class ForgeComments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "forge_comments"

    def schema(self) -> StructType:
        return REVIEW_COMMENT

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with the push-down of filters into Python sources, which Spark has off by default."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ForgeComments)


def write_pages(rows: list[dict], folder: str, size: int = 100) -> None:
    """A fixture folder from rows, ordered by ``updated_at``."""
    target = Folder(folder)
    ordered = sorted(rows, key=lambda r: (r["updated_at"], r["id"]))
    index = []
    for k in range(0, len(ordered), size):
        page = ordered[k : k + size]
        name = f"page-{k // size:05d}.json"
        target.write(name, json.dumps(page).encode())
        index.append([name, page[0]["updated_at"], page[-1]["updated_at"]])
    target.write("index.json", json.dumps({"pages": index}).encode())
