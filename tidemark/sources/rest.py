"""Paginated HTTP sources: selectors, paginators, response actions, retries, and a Spark data source over them.

Every partition of the data source is one sequence of pages: the stream itself, or one for each of a few given parents.
read_stream() reads a stream in one task too, as typed columns. The children of a table of parents are read by read_children(),
in as many tasks as are wanted.
"""

from __future__ import annotations

import email.utils
import http.client
import io
import json
import re
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache
from itertools import chain, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Records that go to Spark at once.
BATCH = 5_000
#: Records that are encoded at once, so that no more of them are held besides those of a page.
PIECE = 100


class RestError(RuntimeError):
    """kind is fatal, transient or rate_limited (with wait in seconds)."""

    def __init__(self, message: str, kind: str = "fatal", wait: float | None = None):
        super().__init__(message)
        self.kind, self.wait = kind, wait

    def __reduce__(self):
        return RestError, (str(self), self.kind, self.wait)


# Selectors: names by dots, [N] for a place, [*] for all places.
@cache
def parse_selector(text: str) -> list[str | int | None]:
    """The steps of a selector; None stands for [*]."""
    steps: list[str | int | None] = []
    at = 0
    while at < len(text):
        m = re.compile(r"\[(\d+|\*)\]|(?:^|(?<=.)\.)?([^.\[\]*]+)").match(text, at)
        if not m or (m[2] and at and text[at] != "."):
            raise ValueError(f"selector {text!r} can't be read at {at}")
        steps.append(m[2] if m[2] is not None else None if m[1] == "*" else int(m[1]))
        at = m.end()
    if not steps:
        raise ValueError("the selector is empty")
    return steps


def select(value, steps: list[str | int | None]) -> tuple[list, bool]:
    """What the steps lead to, and whether a [*] met an empty array."""
    found, empty = [value], False
    for step in steps:
        out = []
        for v in found:
            if step is None:
                if isinstance(v, list):
                    out += v
                    empty = empty or not v
            elif isinstance(step, int):
                out += v[step : step + 1] if isinstance(v, list) else []
            elif isinstance(v, dict) and step in v:
                out.append(v[step])
        found = out
    return found, empty


def records_of(body, selector: str | None) -> list:
    """The records in a body: the body itself must be an array without a selector; one selected array is unwrapped."""
    if selector is None:
        if not isinstance(body, list):
            raise RestError("the body isn't an array and no selector is given")
        return body
    found, empty = select(body, parse_selector(selector))
    if len(found) == 1 and isinstance(found[0], list):
        return found[0]
    if not found and not empty:
        raise RestError(f"{selector} leads to nothing")
    return found


# Paginators
@dataclass
class Pages:
    """How pages follow one another. kind: none, page, offset, cursor, header_cursor, next_url or link_header."""

    kind: str = "none"
    param: str = "page"
    start: int = 1
    size: int | None = None
    size_param: str | None = None
    total: str | None = None  # selector of the number of pages (page) or of records (offset)
    path: str | None = None  # selector of the cursor or next address; name of the header
    max_pages: int = 10_000

    def first(self) -> dict:
        extra = {self.size_param: str(self.size)} if self.size_param and self.size else {}
        return {self.param: str(self.start), **extra} if self.kind in ("page", "offset") else {}

    def next(self, at: dict, page: int, body, records: list, headers: dict) -> dict | str | None:
        """Params of the next page, its address, or None at the end. page counts from 0."""
        def one(selector):
            found = select(body, parse_selector(selector))[0] if selector else []
            return found[0] if found else None

        if self.kind in ("page", "offset"):
            total, seen = one(self.total), self.start + page
            if not records:
                return None
            if self.kind == "page":
                if total is not None and seen - self.start + 1 >= int(total):
                    return None
                value = seen + 1
            else:
                value = int(at[self.param]) + len(records)
                if (total is not None and value >= int(total)) or (total is None and self.size and len(records) < self.size):
                    return None
            return {**at, self.param: str(value)}
        if self.kind == "cursor":
            return {**at, self.param: str(c)} if (c := one(self.path)) not in (None, "") else None
        if self.kind == "header_cursor":
            return {**at, self.param: c} if (c := headers.get(self.path.lower())) else None
        if self.kind == "next_url":
            return one(self.path) or None
        if self.kind == "link_header":
            for part in re.split(r",\s*(?=<)", headers.get("link", "")):
                if re.search(r';\s*rel="?next"?(;|$|\s)', part) and (m := re.match(r"\s*<([^>]*)>", part)):
                    return m[1]
        return None


@dataclass
class Action:
    """On a status and/or a text in the first 64 KiB of the body: ignore the page, end the stream, or fail."""

    do: str
    status: int | None = None
    contains: str | None = None

    def __post_init__(self):
        if self.do not in ("ignore", "end_stream", "error") or (self.status is None and self.contains is None):
            raise ValueError("an action is ignore, end_stream or error, on a status or a text")
        if self.status is not None and not 100 <= self.status <= 599:
            raise ValueError("a status is from 100 to 599")

    def meets(self, status: int, body: bytes) -> bool:
        return (self.status is None or self.status == status) and (self.contains is None or self.contains.encode() in body[: 64 << 10])


@dataclass
class Auth:
    """kind: none, bearer, header, basic, api_key or oauth2 (client credentials). Secrets don't show in its text."""

    kind: str = "none"
    name: str = ""
    secret: str = field(default="", repr=False)
    user: str = ""
    query: bool = False
    token_url: str = ""
    token: str = field(default="", repr=False)

    def apply(self, headers: dict, params: dict) -> None:
        import base64

        if self.kind == "bearer":
            headers["Authorization"] = f"Bearer {self.secret}"
        elif self.kind == "basic":
            headers["Authorization"] = "Basic " + base64.b64encode(f"{self.user}:{self.secret}".encode()).decode()
        elif self.kind == "header" or (self.kind == "api_key" and not self.query):
            headers[self.name] = self.secret
        elif self.kind == "api_key":
            params[self.name] = self.secret
        elif self.kind == "oauth2":
            if not self.token:
                data = urllib.parse.urlencode({"grant_type": "client_credentials", "client_id": self.user, "client_secret": self.secret}).encode()
                with urllib.request.urlopen(urllib.request.Request(self.token_url, data), timeout=30) as r:
                    self.token = json.load(r)["access_token"]
            headers["Authorization"] = f"Bearer {self.token}"


@dataclass
class Stream:
    base_url: str
    path: str
    method: str = "GET"
    params: dict = field(default_factory=dict)
    headers: dict = field(default_factory=dict)
    body: dict | None = None
    records: str | None = None
    pages: Pages = field(default_factory=Pages)
    actions: list[Action] = field(default_factory=list)
    auth: Auth = field(default_factory=Auth)
    start_param: str | None = None
    start_value: str | None = None
    end_param: str | None = None
    end_value: str | None = None
    cursor_field: str | None = None
    include: list[str] = field(default_factory=list)
    timeout: float = 30
    tries: int = 4
    longest_wait: float = 300
    pause: float = 0

    def validate(self) -> None:
        if urllib.parse.urlsplit(self.base_url).scheme not in ("http", "https") or not urllib.parse.urlsplit(self.base_url).netloc:
            raise ValueError("base_url is an absolute http or https address")
        if self.timeout < 1 or self.tries < 1:
            raise ValueError("timeout and tries are at least 1")
        if secret := {h.lower() for h in self.headers} & {"authorization", "proxy-authorization", "cookie", "x-api-key"}:
            raise ValueError(f"header {min(secret)} carries credentials: use auth")
        if (self.end_param is None) != (self.end_value is None):
            raise ValueError("end_param and end_value go together")
        if self.body is not None and self.method != "POST":
            raise ValueError("a body needs POST")
        if self.records is not None:
            parse_selector(self.records)


def classify(status: int, headers: dict) -> RestError:
    """What an answer other than success means for the run."""
    if status == 429:
        told = headers.get("retry-after", "")
        if told.isdigit():
            return RestError("rate limited", "rate_limited", float(told))
        when = email.utils.parsedate_to_datetime(told) if told else None
        return RestError("rate limited", "rate_limited", max(0.0, when.timestamp() - time.time()) if when else None)
    return RestError(f"status {status}", "transient" if status >= 500 else "fatal")


def origin(url: str) -> tuple:
    u = urllib.parse.urlsplit(url)
    return u.scheme.lower(), (u.hostname or "").lower(), u.port or {"http": 80, "https": 443}.get(u.scheme)


class _SameOrigin(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, req, fp, code, msg, headers, newurl):
        if origin(newurl) != origin(req.full_url):
            raise RestError(f"a redirect leaves {req.full_url} for another origin")
        return super().redirect_request(req, fp, code, msg, headers, newurl)


class _Kept(threading.local):
    """The connection of a thread that its last answer left open, and where it leads."""

    to, connection = None, None


_kept = _Kept()


class _Keeping:
    """Requests without a body go over the connection that the one before them left open, if it leads to the same place; an
    answer is read whole before the next request. urllib itself opens a connection for each."""

    def do_open(self, http_class, req, **more):
        if req.data is not None or req._tunnel_host or not req.host:
            return super().do_open(http_class, req, **more)
        to = (http_class, req.host)
        headers = {k.title(): v for k, v in {**req.headers, **req.unredirected_hdrs}.items()}
        while True:
            old, known, _kept.to, _kept.connection = _kept.connection, _kept.to == to, None, None
            if old is not None and not known:
                old.close()
            connection = old if known else http_class(req.host, timeout=req.timeout, **more)
            try:
                if known:
                    connection.sock.settimeout(req.timeout)
                try:
                    connection.request(req.get_method(), req.selector, None, headers)
                except OSError as e:
                    raise urllib.error.URLError(e) from e
                r = connection.getresponse()
            except (OSError, http.client.BadStatusLine) as e:
                connection.close()
                if known and isinstance(getattr(e, "reason", e), (ConnectionError, http.client.BadStatusLine)):
                    continue  # the server had closed it
                raise
            try:
                answer = urllib.request.addinfourl(io.BytesIO(r.read()), r.msg, req.full_url, r.status)
            except BaseException:
                connection.close()
                raise
            if r.will_close:
                connection.close()
            else:
                _kept.to, _kept.connection = to, connection
            answer.msg = r.reason
            return answer


class _Http(_Keeping, urllib.request.HTTPHandler):
    pass


class _Https(_Keeping, urllib.request.HTTPSHandler):
    pass


@cache
def opener() -> urllib.request.OpenerDirector:
    """Made once a process, as the certificates are loaded with it."""
    return urllib.request.build_opener(_SameOrigin, _Http, _Https)


def fetch(s: Stream, url: str, params: dict, body: dict | None) -> tuple[int, dict, bytes]:
    """An answer; transient failures and short waits are tried again."""
    headers, query = {"Accept": "application/json", **s.headers}, dict(params)
    s.auth.apply(headers, query)
    full = url + (("&" if "?" in url else "?") + urllib.parse.urlencode(query) if query else "")
    data = None if body is None else json.dumps(body).encode()
    if data is not None:
        headers["Content-Type"] = "application/json"
    for attempt in range(s.tries):
        if s.pause:
            time.sleep(s.pause)
        try:
            with opener().open(urllib.request.Request(full, data, headers, method=s.method), timeout=s.timeout) as r:
                return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read()
        except urllib.error.HTTPError as e:
            heads, content = {k.lower(): v for k, v in e.headers.items()}, e.read()
            if any(a.meets(e.code, content) for a in s.actions):
                return e.code, heads, content
            why = classify(e.code, heads)
        except OSError as e:
            why = RestError(f"{url}: {e}", "transient")
        wait = why.wait if why.wait is not None else 0.2 * 2**attempt
        if why.kind == "fatal" or attempt + 1 == s.tries or wait > s.longest_wait:
            raise why
        time.sleep(wait)
    raise AssertionError


def fill(template: str, parent: dict, quote: bool = True) -> str:
    """{name} replaced by the parent's value, percent-encoded in a path."""
    def one(m):
        if m[1] not in parent:
            raise RestError(f"the parent has no {m[1]}")
        text = parent[m[1]] if isinstance(parent[m[1]], str) else json.dumps(parent[m[1]])
        if not text:
            raise RestError(f"the parent's {m[1]} is empty")
        return urllib.parse.quote(text, safe="") if quote else text

    return re.sub(r"\{(\w+)\}", one, template)


def with_parent(r, parent: dict, include: list[str]) -> dict:
    """A child's record with fields of its parent."""
    if not isinstance(r, dict):
        raise RestError("a child that isn't an object can't take its parent's fields")
    more = {f"_parent_{f}": parent.get(f) for f in include}
    if more.keys() & r.keys():
        raise RestError(f"a child has {min(more.keys() & r.keys())} already")
    return {**r, **more}


def deep_fill(value, parent: dict):
    if isinstance(value, str):
        return fill(value, parent, quote=False)
    if isinstance(value, dict):
        return {k: deep_fill(v, parent) for k, v in value.items()}
    return [deep_fill(v, parent) for v in value] if isinstance(value, list) else value


def json_or_none(content: bytes):
    try:
        return json.loads(content)
    except ValueError:
        return None


def read_pages(s: Stream, parent: dict | None = None) -> Iterator[dict]:
    """The records of a stream's pages in order; with a parent, of its child stream, parent fields included."""
    return chain.from_iterable(pages_of(s, parent))


def pages_of(s: Stream, parent: dict | None = None) -> Iterator[list]:
    """As read_pages(), the records of each page together."""
    s.validate()
    url = s.base_url.rstrip("/") + "/" + (fill(s.path, parent) if parent is not None else s.path).lstrip("/")
    params = {k: fill(str(v), parent, quote=False) if parent is not None else str(v) for k, v in s.params.items()}
    if s.start_param and s.start_value is not None:
        params[s.start_param] = s.start_value
    if s.end_param:
        params[s.end_param] = s.end_value
    at: dict | str | None = s.pages.first()
    seen, page = set(), 0
    try:
        while at is not None:
            if page >= s.pages.max_pages:
                raise RestError(f"more than {s.pages.max_pages} pages")
            body = deep_fill(s.body, parent) if s.body is not None and parent is not None else s.body
            if isinstance(at, str):
                target = urllib.parse.urljoin(url, at)
                if origin(target) != origin(s.base_url):
                    raise RestError(f"the next page is at another origin: {target}")
                request = (target, {}, body)
            elif body is not None:
                request = (url, params, {**body, **at})
            else:
                request = (url, {**params, **at}, None)
            if (mark := json.dumps(request, sort_keys=True)) in seen:
                raise RestError("a page leads to one that was read before")
            seen.add(mark)
            status, headers, content = fetch(s, *request)
            action = next((a for a in s.actions if a.meets(status, content)), None)
            if action and action.do == "error":
                raise RestError(f"status {status} is an error for this stream")
            if action and action.do == "end_stream":
                return
            if action:  # an ignored page has no records, but its body or headers may lead on
                answer, records = json_or_none(content), []
            else:
                answer = json.loads(content)
                records = records_of(answer, s.records)
            yield [with_parent(r, parent, s.include) for r in records] if s.include and parent is not None else records
            at = s.pages.next(at if isinstance(at, dict) else {}, page, answer, records, headers)
            page += 1
    except RestError as e:
        raise RestError(f"{e} (parent {json.dumps(parent)})", e.kind, e.wait) if parent is not None else e


def as_texts(records: Iterator) -> Iterator[str]:
    """Each record as JSON text. Objects are encoded several in one call and parted where one ends and another begins, if that
    is found so often as records meet; if more often, some have it within, and each is encoded by itself."""
    while some := list(islice(records, PIECE)):
        parts = json.dumps(some, sort_keys=True)[2:-2].split("}, {")
        if len(parts) == len(some) and {*map(type, some)} == {dict}:
            yield from (f"{{{p}}}" for p in parts)
        else:
            yield from (json.dumps(r, sort_keys=True) for r in some)


def greatest(records: list[dict], name: str, before: str | None = None) -> str | None:
    """The greatest cursor as text, in the order of its characters."""
    values = [str(r[name]) for r in records if isinstance(r.get(name), (str, int, float)) and not isinstance(r.get(name), bool)]
    return max([*values, *([before] if before is not None else [])], default=None)


class _Parent(InputPartition):
    def __init__(self, parent: dict | None):
        self.parent = parent


class RestReader(DataSourceReader):
    def __init__(self, stream: Stream, parents: list[dict] | None):
        self.stream, self.parents = stream, parents

    def partitions(self):
        return [_Parent(None)] if self.parents is None else [_Parent(p) for p in self.parents] or [_Parent({})]

    def read(self, partition):
        if self.parents == []:
            return
        texts = as_texts(read_pages(self.stream, partition.parent))
        while batch := list(islice(texts, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], ["value"])


def rest_source(stream: Stream, parents: list[dict] | None = None, name: str = "rest_stream") -> type[DataSource]:
    """A data source class to register: a column value holds each record as JSON, to be typed by from_json."""
    stream.validate()

    class RestSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "value string"

        def reader(self, schema):
            return RestReader(stream, parents)

    return RestSource


#: By the name of a column's type: what a decoded value has to be so that it is the column's value as it stands, and Arrow's type.
PLAIN = {"bigint": (int, pa.int64()), "double": (float, pa.float64()), "string": (str, pa.string()), "boolean": (bool, pa.bool_())}


def as_columns(records: list, fields: dict[str, str]) -> list[pa.Array] | None:
    """The columns, name and type, that from_json() would make of the records' texts, if each value is absent, null or plain."""
    if {*map(type, records)} != {dict}:
        return None
    columns = []
    for name, kind in fields.items():
        values = [r.get(name) for r in records]
        if not {*map(type, values)} <= {PLAIN[kind][0], type(None)}:
            return None
        try:
            columns.append(pa.array(values, PLAIN[kind][1]))
        except (OverflowError, UnicodeError, pa.ArrowException):  # a number or a text that the type doesn't hold
            return None
    return columns


def read_stream(spark: SparkSession, stream: Stream, schema: str) -> DataFrame:
    """The records of a stream, each as from_json() makes it of its text. Pages follow one another, so one task reads them; a
    page goes to Spark as columns if all its values are plain, and as texts otherwise. Python isn't asked for a plan, as it is
    for a data source."""
    stream.validate()
    fields = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema)}
    if not {*fields.values()} <= PLAIN.keys():
        fields = {}
    names = ["text", *(f"c{k}" for k in range(len(fields)))]

    def parted(records: list) -> list[pa.Array]:
        columns = as_columns(records, fields) if fields else None
        if columns is not None:
            return [pa.nulls(len(records), pa.string()), *columns]
        return [pa.array(as_texts(iter(records)), pa.string()), *(pa.nulls(len(records), PLAIN[kind][1]) for kind in fields.values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for records in chain.from_iterable(pages_of(stream) for b in batches if b.num_rows):
            if records:
                held.append(parted(records))
                rows += len(records)
            if rows >= BATCH:
                yield pa.RecordBatch.from_arrays([*map(pa.concat_arrays, zip(*held, strict=True))], names)
                held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.concat_arrays, zip(*held, strict=True))], names)

    kinds = zip(names, ["string", *fields.values()], strict=True)
    read = spark.range(0, 1, 1, 1).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in kinds))
    record = F.from_json("text", schema)
    if fields:
        record = F.when(F.col("text").isNull(), F.struct(*[F.col(c).alias(f) for c, f in zip(names[1:], fields, strict=True)])).otherwise(record)
    return read.select(record.alias("r")).select("r.*")


def read_children(parents: DataFrame, stream: Stream, tasks: int = 4) -> DataFrame:
    """The records of a child stream of every row of parents, as JSON in a column value. The parents are dealt to so many
    tasks, each of which asks for one at a time, so no more requests are under way at once; the pause between requests holds
    over all tasks together."""
    if tasks < 1:
        raise ValueError("tasks are at least 1")
    stream.validate()
    mine = replace(stream, pause=stream.pause * tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = as_texts(r for batch in batches for parent in batch["parent"] for r in read_pages(mine, json.loads(parent)))
        while out := list(islice(texts, BATCH)):
            yield pd.DataFrame({"value": out})

    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in parents.columns]), {"ignoreNullFields": "false"})
    return parents.select(whole.alias("parent")).repartition(tasks).mapInPandas(run, "value string")
