"""REST endpoints and plain URLs as Spark data sources, one task per page or byte range."""

from __future__ import annotations

import json
import sys
import urllib.error
import urllib.request

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tablekit.errors import InvalidSpec, UnsupportedFormat
from tablekit.sources.records import parse_records


def _get(url: str, headers: dict[str, str], timeout: float = 60.0) -> bytes:
    request = urllib.request.Request(url, headers=headers)
    with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
        return reply.read()


def _field(body, path: str | None):
    """What a dotted path leads to; without one the body itself."""
    for name in (path or "").split("."):
        body = body[name] if name else body
    return body


def _records(endpoint: dict, body) -> list:
    found = _field(body, endpoint.get("records"))
    return found if isinstance(found, list) else [found]


class Pages(InputPartition):
    """Consecutive pages of one endpoint, from ``first`` to before ``end``."""

    def __init__(self, endpoint: dict, first: int, end: int):
        self.endpoint = endpoint
        self.first = first
        self.end = end


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.base = options["base_url"].rstrip("/")
        self.endpoints = json.loads(options["endpoints"])
        self.headers = json.loads(options.get("headers") or "{}")

    def partitions(self):
        found = []
        for endpoint in self.endpoints:
            pages, step = int(endpoint.get("pages", 1)), int(endpoint.get("pages_per_task", 1))
            for first in range(0, pages, step):
                found.append(Pages(endpoint, first, min(first + step, pages)))
        return found

    def read(self, partition):
        endpoint = partition.endpoint
        for page in range(partition.first, partition.end):
            path = endpoint["path"].replace("{page}", str(page)).lstrip("/")
            body = json.loads(_get(f"{self.base}/{path}", self.headers))
            for record in _records(endpoint, body):
                yield endpoint["name"], page, json.dumps(record, ensure_ascii=False)


class PagedRecords(DataSource):
    """``spark.read.format("paged_records")``: endpoint, page and the JSON text of each record."""

    @classmethod
    def name(cls):
        return "paged_records"

    def schema(self):
        return "endpoint string, page int, record string"

    def reader(self, schema):
        return PagedReader(self.options)

    def streamReader(self, schema):
        return PagedStream(self.options)


#: Tasks that read the pages behind cursors of one batch at most; longer ways are read in longer stretches.
STRETCHES = 1000


class Stretch(InputPartition):
    """Records of one endpoint from ``start`` to before ``end``: places as in the offsets of :class:`PagedStream`.

    ``number`` is that of the first page, if pages are behind cursors.
    """

    def __init__(self, endpoint: dict, start: dict, end: dict, number: int = 0):
        self.endpoint = endpoint
        self.start = start
        self.end = end
        self.number = number


class PagedStream(DataSourceStreamReader):
    """New records of paged endpoints. An offset holds for each endpoint a page, and how many of its records are read.

    Numbered pages (``{page}`` in the path) are looked for by doubling steps and halving, so the driver asks for few of
    them and keeps two numbers; tasks read ranges of pages. Pages linked by cursors (``{cursor}`` in the path, the
    next page's cursor in the field ``next``) can only be walked: the driver follows the links and keeps the last
    cursor, and one of every ``pages_per_task`` (10) on the way, or of more pages if these are too many. From each a
    task reads on to the next one. A page may grow until the next one appears: its new records come with the
    next batch. A numbered page without records counts as absent, unless the endpoint is ``sparse``.
    """

    def __init__(self, options):
        self.base = options["base_url"].rstrip("/")
        self.endpoints = json.loads(options["endpoints"])
        self.headers = json.loads(options.get("headers") or "{}")
        self.reached = json.loads(options.get("reached") or "{}")
        self.walked = {}

    def _first(self, endpoint: dict) -> dict:
        return {"at": endpoint.get("cursor", "") if "{cursor}" in endpoint["path"] else 0, "records": 0}

    def initialOffset(self):
        return {e["name"]: self._first(e) for e in self.endpoints}

    def _page(self, endpoint: dict, at: int | str):
        """The body of a page; None if there is none."""
        path = endpoint["path"].replace("{cursor}" if isinstance(at, str) else "{page}", str(at)).lstrip("/")
        try:
            return json.loads(_get(f"{self.base}/{path}", self.headers))
        except urllib.error.HTTPError as error:
            if error.code != 404:
                raise
        except urllib.error.URLError as error:
            if not isinstance(error.reason, FileNotFoundError):
                raise
        return None

    def _there(self, endpoint: dict, page: int) -> bool:
        body = self._page(endpoint, page)
        return body is not None and bool(endpoint.get("sparse") or _records(endpoint, body))

    def _next(self, endpoint: dict, body) -> str | None:
        try:
            found = _field(body, endpoint["next"])
        except (KeyError, TypeError):
            return None
        return str(found) if found else None

    def _walk(self, endpoint: dict, start: dict, stop: str | None = None) -> tuple[dict, list[tuple[int, str]]]:
        """The last place behind cursors, no further than ``stop``, and numbers and cursors of pages on the way."""
        at, size, number = start["at"], start["records"], 0
        marks, step = [], int(endpoint.get("pages_per_task", 10))
        while True:
            if number % step == 0:
                marks.append((number, at))
                if len(marks) > STRETCHES:
                    marks, step = marks[::2], step * 2
            body = None if at == stop else self._page(endpoint, at)
            if body is None:
                break
            following, size = self._next(endpoint, body), len(_records(endpoint, body))
            if following is None:
                break
            at, size, number = following, 0, number + 1
        return {"at": at, "records": size}, marks

    def _stretches(self, endpoint: dict, first: dict, last: dict) -> list[Stretch]:
        """The way from one place behind cursors to another; walked again if the batch began in another run."""
        start, end, marks = self.walked.get(endpoint["name"], (None, None, []))
        if (start, end) != (first["at"], last["at"]):
            marks = self._walk(endpoint, first, last["at"])[1]
        places = [first, *({"at": cursor, "records": 0} for _, cursor in marks[1:]), last]
        return [Stretch(endpoint, places[k], places[k + 1], number) for k, (number, _) in enumerate(marks)]

    def _last(self, endpoint: dict, start: dict) -> dict:
        at, size = start["at"], start["records"]
        if isinstance(at, str):
            last, marks = self._walk(endpoint, start)
            self.walked[endpoint["name"]] = (at, last["at"], marks)
            return last
        step = 1
        while self._there(endpoint, at + step):
            at, step = at + step, step * 2
        while step > 1:  # the last page is less than ``step`` pages on
            step //= 2
            if self._there(endpoint, at + step):
                at += step
        body = self._page(endpoint, at)
        found = 0 if body is None else len(_records(endpoint, body))
        return {"at": at, "records": max(found, size) if at == start["at"] else found}

    def latestOffset(self, *_):
        self.reached = {e["name"]: self._last(e, self.reached.get(e["name"]) or self._first(e)) for e in self.endpoints}
        return self.reached

    def partitions(self, start, end):
        found = []
        for endpoint in self.endpoints:
            first, last = start.get(endpoint["name"]) or self._first(endpoint), end.get(endpoint["name"])
            if last is None or first == last:
                continue
            if isinstance(last["at"], str):
                found.extend(self._stretches(endpoint, first, last))
                continue
            pages, step = last["at"] + 1, int(endpoint.get("pages_per_task", 1))
            for page in range(first["at"], pages, step):
                low = first if page == first["at"] else {"at": page, "records": 0}
                found.append(Stretch(endpoint, low, last if page + step >= pages else {"at": page + step, "records": 0}))
        return found

    def read(self, partition):
        endpoint, at, skip = partition.endpoint, partition.start["at"], partition.start["records"]
        stop, size = partition.end["at"], partition.end["records"]
        number = partition.number
        while at is not None and (at != stop or size > skip):
            body = self._page(endpoint, at)
            if body is None:
                return
            for record in _records(endpoint, body)[skip : size if at == stop else None]:
                yield endpoint["name"], number if isinstance(at, str) else at, json.dumps(record, ensure_ascii=False)
            if at == stop:
                return
            at, skip, number = self._next(endpoint, body) if isinstance(at, str) else at + 1, 0, number + 1


class ByteRange(InputPartition):
    def __init__(self, start: int, end: int):
        self.start = start
        self.end = end


class UrlLineReader(DataSourceReader):
    """Text lines of one URL; each task owns the lines that begin inside its byte range."""

    def __init__(self, options):
        self.url = options["url"]
        self.chunk = int(options.get("chunk_bytes") or 64 * 1024 * 1024)

    def partitions(self):
        request = urllib.request.Request(self.url, method="HEAD")
        with urllib.request.urlopen(request, timeout=60) as reply:  # noqa: S310
            size = int(reply.headers.get("Content-Length") or 0)
            ranged = reply.headers.get("Accept-Ranges") == "bytes" or self.url.startswith("file:")
        if not ranged or not size:
            return [ByteRange(0, -1)]
        return [ByteRange(at, min(at + self.chunk, size)) for at in range(0, size, self.chunk)]

    def _open(self, start: int):
        if self.url.startswith("file:"):
            stream = urllib.request.urlopen(self.url, timeout=60)  # noqa: S310
            stream.read(start)
            return stream
        headers = {"Range": f"bytes={start}-"} if start else {}
        return urllib.request.urlopen(urllib.request.Request(self.url, headers=headers), timeout=60)  # noqa: S310

    def read(self, partition):
        # Start one byte early: the line that begins exactly at ``start`` is ours, a partial one is not.
        at = max(partition.start - 1, 0)
        with self._open(at) as stream:
            if partition.start:
                at += len(stream.readline())
            while partition.end < 0 or at < partition.end:
                line = stream.readline()
                if not line:
                    return
                yield at, line.decode("utf-8").rstrip("\r\n")
                at += len(line)


class UrlLines(DataSource):
    """``spark.read.format("url_lines")``: byte offset and text of each line behind a URL."""

    @classmethod
    def name(cls):
        return "url_lines"

    def schema(self):
        return "position bigint, value string"

    def reader(self, schema):
        return UrlLineReader(self.options)


def _register(spark: SparkSession) -> None:
    # Python workers need no installed tablekit: the classes travel with the plan.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedRecords)
    spark.dataSource.register(UrlLines)


def scan_rest(
    spark: SparkSession,
    base_url: str,
    endpoints: list[dict],
    headers: dict[str, str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Records of REST endpoints.

    ``endpoints`` holds ``{"name", "path", "pages", "pages_per_task", "records"}``; ``{page}`` in the path is the page
    number. A page's records are what its field ``records`` (a dotted path; without it the page itself) holds: all of
    an array, or one value. With ``schema`` records are parsed.
    """
    if not endpoints:
        raise InvalidSpec("no endpoints given")
    _register(spark)
    raw = (
        spark.read.format("paged_records")
        .options(base_url=base_url, endpoints=json.dumps(endpoints), headers=json.dumps(headers or {}))
        .load()
    )
    return parse_records(raw, "record", schema, keep=["endpoint", "page"]) if schema else raw


def _committed(spark: SparkSession, checkpoint: str) -> str:
    """The newest offset in a checkpoint as JSON; an empty object if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    newest = max((int(n) for n in names if n.isdigit()), default=None)
    if newest is None:
        return "{}"
    lines = spark.read.text(f"{checkpoint}/offsets/{newest}").collect()  # a version, metadata, one line for each source
    return lines[-1].value if lines[-1].value.startswith("{") else "{}"


def stream_rest(
    spark: SparkSession,
    base_url: str,
    endpoints: list[dict],
    headers: dict[str, str] | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """New records of paged REST endpoints as a stream of ``endpoint``, ``page`` and the JSON text ``record``.

    Endpoints are those of :func:`scan_rest` without ``pages``, or have ``{cursor}`` in their path, ``next`` (the dotted
    path of the next page's cursor) and ``cursor`` (the first one). How far each was read is in the checkpoint of the
    query. Name it here too, if this is the query's only source: the search for the last page then goes on from there
    after a restart, instead of from the first page. ``page`` of a page behind a cursor is its number in the batch.
    """
    if not endpoints:
        raise InvalidSpec("no endpoints given")
    for endpoint in endpoints:
        if ("{page}" in endpoint["path"]) == ("{cursor}" in endpoint["path"] and "next" in endpoint):
            raise InvalidSpec(f"endpoint {endpoint['name']!r} needs {{page}}, or {{cursor}} and next")
    _register(spark)
    options = {"base_url": base_url, "endpoints": json.dumps(endpoints), "headers": json.dumps(headers or {})}
    if checkpoint:
        options["reached"] = _committed(spark, checkpoint)
    return spark.readStream.format("paged_records").options(**options).load()


def scan_url(
    spark: SparkSession, url: str, fmt: str, schema: StructType | str, chunk_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """A csv (with header) or JSON-lines file behind http(s), read in parallel byte ranges."""
    if fmt not in ("csv", "json"):
        raise UnsupportedFormat(f"{fmt} over http; copy it to an object store first")
    if schema is None:
        raise InvalidSpec("a scan over http needs a schema")
    _register(spark)
    lines = spark.read.format("url_lines").options(url=url, chunk_bytes=str(chunk_bytes)).load()
    if fmt == "json":
        return parse_records(lines, "value", schema)
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    rows = lines.where((F.col("position") > 0) & (F.col("value") != ""))
    return rows.select(F.from_csv("value", ddl).alias("r")).select("r.*")
