"""A paged JSON service as a Spark data source, for tables and for streams; filters, columns, key ranges and limit are in the requests.

``spark.read.format("paged_json").options(url=..., where=..., page_size=500).load()`` gives rows (snapshot_key, key, payload). With a schema of
its own (``.schema("ID long, NAME string")``) the service is asked for these fields alone and their values come typed.

Partitions. With ``ranges=n`` the service is asked for the least and largest id (``outStatistics``), and each task pages through a range of ids, which later
insertions don't shift. Else it is asked how many rows fit (``returnCountOnly``), and each page is a partition, after them one open end; a service that says neither is read to its end by
one task. ``limit`` bounds the rows in all (and is counted by offsets, so it goes without ranges).

Filters on typed columns go into ``where`` (Spark asks for them with ``spark.sql.python.filterPushdown.enabled``). Spark applies them again to what comes, so a service that compares
more loosely does no harm. A stream's offset is the largest id read: each batch holds the ids above the last.

``fetch`` names a function ``module:function`` of (url, parameters) to text, for tests and for services that want credentials.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
from collections.abc import Iterable, Iterator
from typing import Any
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import BooleanType, DateType, FractionalType, IntegralType, StructType, TimestampType

SCHEMA = "snapshot_key string, key string, payload string"
OWN = {"snapshot_key", "key", "payload"}


def http_get(url: str, parameters: dict) -> str:
    with urlopen(f"{url}?{urlencode(parameters)}", timeout=60) as response:
        return response.read().decode()


def parse_page(text: str, where: str) -> dict:
    """The page, or an error that says what is wrong with it."""
    try:
        page = json.loads(text)
    except ValueError as e:
        raise ValueError(f"{where}: no JSON") from e
    if page.get("error"):
        raise ValueError(f"{where}: {page['error'].get('message', 'error')}")
    if not isinstance(page.get("features"), list):
        raise ValueError(f"{where}: no features")
    return page


def is_last(page: dict, size: int) -> bool:
    """Empty, or said to be the last, or short where nothing is said."""
    more = page.get("exceededTransferLimit")
    return not page["features"] or (len(page["features"]) < size if more is None else not more)


def literal(value: Any) -> str | None:
    """The value in a where clause, or None where it has no safe form."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int | float):
        return repr(value) if value == value and abs(value) != float("inf") else None
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'" if not value.microsecond else None
    return f"DATE '{value:%Y-%m-%d}'" if isinstance(value, dt.date) else None


#: Comparisons and how a where clause writes them.
COMPARISONS = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<="}
#: Beginnings and the like, as LIKE patterns.
PATTERNS = {"StringStartsWith": "{}%", "StringEndsWith": "%{}", "StringContains": "%{}%"}


def clause(f: Any, columns: set[str]) -> str | None:
    """A filter as a where clause over the service's fields, or None."""
    kind = type(f).__name__
    if kind == "Not":
        inner = clause(f.child, columns)
        return f"NOT ({inner})" if inner else None
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name not in columns:
        return None
    if kind in ("IsNull", "IsNotNull"):
        return f"{name} IS {'NOT ' if kind == 'IsNotNull' else ''}NULL"
    if kind == "In":
        values = [literal(v) for v in f.value]
        return f"{name} IN ({', '.join(values)})" if values and all(values) else None
    if kind in PATTERNS and isinstance(f.value, str) and not set(f.value) & set("%_\\"):
        return f"{name} LIKE {literal(PATTERNS[kind].format(f.value))}"
    value = literal(f.value) if kind in COMPARISONS else None
    return f"{name} {COMPARISONS[kind]} {value}" if value else None


class Run(InputPartition):
    """Pages ``first`` and on, ``pages`` of them or (0) to the last, of the rows with ids in [low, high)."""

    def __init__(self, first: int, pages: int, low: int | None = None, high: int | None = None) -> None:
        self.first, self.pages, self.low, self.high = first, pages, low, high


class Service:
    """Requests to the service, as the options say."""

    def __init__(self, options: dict, schema: StructType | None = None) -> None:
        self.options, self.clauses = dict(options), []
        self.columns = [] if schema is None else [f for f in schema.fields if f.name not in OWN]
        self.names = ["snapshot_key", "key", "payload"] if schema is None else schema.names

    def fetch(self, **parameters: Any) -> str:
        module, _, name = self.options.get("fetch", "").partition(":")
        get = getattr(importlib.import_module(module), name) if module else http_get
        return get(self.options["url"], {**parameters, "f": "json"})

    def where(self, low: int | None = None, high: int | None = None) -> str:
        """The option, what was pushed down, and the range of ids."""
        each = [self.options["where"]] if "where" in self.options else []
        each += self.clauses
        each += [f"{self.id_field()} >= {low}"] if low is not None else []
        each += [f"{self.id_field()} < {high}"] if high is not None else []
        return " AND ".join(f"({c})" for c in each) if len(each) > 1 else each[0] if each else "1=1"

    def id_field(self) -> str:
        return self.options.get("id_field", "OBJECTID")

    def size(self) -> int:
        return int(self.options.get("page_size", 500))

    def fields(self) -> str:
        wanted = self.options.get("fields")
        if wanted or not self.columns or "payload" in self.names:
            return wanted or "*"
        return ",".join(dict.fromkeys([self.id_field(), *(f.name for f in self.columns)]))

    def bounds(self, low: int | None = None) -> tuple[int, int] | None:
        """The least and the largest id of what is asked for; None if the service says nothing."""
        stats = [{"statisticType": k, "onStatisticField": self.id_field(), "outStatisticFieldName": f"{k}_id"} for k in ("min", "max")]
        try:
            found = parse_page(self.fetch(where=self.where(low), outStatistics=json.dumps(stats)), "statistics")["features"][0]["attributes"]
            return (int(found["min_id"]), int(found["max_id"]))
        except (ValueError, LookupError, TypeError):
            return None

    def rows(self, run: Run) -> Iterator[tuple]:
        size, limit = self.size(), int(self.options["limit"]) if "limit" in self.options else None
        page_no = run.first
        while True:
            offset = page_no * size
            count = size if limit is None else min(size, limit - offset)
            if count <= 0:
                return
            order = {"orderByFields": self.id_field()} if run.low is not None or run.high is not None else {}
            text = self.fetch(where=self.where(run.low, run.high), outFields=self.fields(), returnGeometry="false", resultOffset=offset, resultRecordCount=count, **order)
            page = parse_page(text, f"{self.options['url']} at {offset}")
            id_field = self.options.get("id_field") or page.get("objectIdFieldName") or "OBJECTID"
            start = f"page:{offset}" if run.low is None else f"ids:{run.low}:{offset}"
            for feature in page["features"]:
                yield self.row(feature["attributes"], start, id_field)
            page_no += 1
            if run.pages and page_no >= run.first + run.pages or is_last(page, count):
                return

    def row(self, attributes: dict, start: str, id_field: str) -> tuple:
        own = {"snapshot_key": start, "key": str(attributes[id_field]), "payload": None}
        if "payload" in self.names:
            own["payload"] = json.dumps(attributes, ensure_ascii=False)
        return tuple(own[f] if f in OWN else typed(attributes.get(f), k) for f, k in self.kinds())

    def kinds(self) -> list[tuple[str, Any]]:
        by_name = {f.name: f.dataType for f in self.columns}
        return [(n, by_name.get(n)) for n in self.names]


def typed(value: Any, kind: Any) -> Any:
    """A JSON value as the column's type; times are milliseconds since 1970, UTC. None where it doesn't fit."""
    try:
        if value is None or isinstance(value, dict | list):
            return None
        if isinstance(kind, IntegralType):
            return int(value)
        if isinstance(kind, FractionalType):
            return float(value)
        if isinstance(kind, BooleanType):
            return bool(value)
        if isinstance(kind, TimestampType | DateType):
            at = dt.datetime.fromtimestamp(value / 1000, dt.UTC)
            return at.date() if isinstance(kind, DateType) else at
    except (TypeError, ValueError, OverflowError):
        return None
    return value if isinstance(value, str) else json.dumps(value)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType | None = None) -> None:
        self.service = Service(options, schema)

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:  # noqa: N802
        columns = {f.name for f in self.service.columns}
        for f in filters:
            found = clause(f, columns)
            if found:
                self.service.clauses.append(found)
            yield f  # Spark applies it too

    def partitions(self) -> list[InputPartition]:
        o = self.service.options
        if "ranges" in o and "limit" not in o:
            found = self.service.bounds()
            if found:
                return list(cut(*found, int(o["ranges"])))
        n = int(o["pages"]) if "pages" in o else self.counted_pages()
        return [*(Run(i, 1) for i in range(n)), Run(n, 0)]

    def counted_pages(self) -> int:
        """Full pages of what the service counts, within the limit; 0 if it gives no count."""
        try:
            said = json.loads(self.service.fetch(where=self.service.where(), returnCountOnly="true"))
        except ValueError:
            return 0
        count = said.get("count") if isinstance(said, dict) else None
        if not isinstance(count, int) or isinstance(count, bool):
            return 0
        return min(count, int(self.service.options.get("limit", count))) // self.service.size()

    def read(self, partition: Run) -> Iterator[tuple]:
        return self.service.rows(partition)


def cut(low: int, high: int, n: int) -> Iterator[Run]:
    """[low, high] in ``n`` ranges at most."""
    step = max(1, -(-(high - low + 1) // max(1, n)))
    for at in range(low, high + 1, step):
        yield Run(0, 0, at, min(at + step, high + 1))


class PagedStream(DataSourceStreamReader):
    """Rows by ascending id, the new ones in each batch."""

    def __init__(self, options: dict, schema: StructType | None = None) -> None:
        self.service = Service(options, schema)
        self.latest = int(options.get("after", 0))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": int(self.service.options.get("after", 0))}

    def latestOffset(self) -> dict:  # noqa: N802
        found = self.service.bounds(self.latest + 1)
        self.latest = max(self.latest, found[1] if found else 0)
        return {"after": self.latest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return list(cut(start["after"] + 1, end["after"], int(self.service.options.get("ranges", 1)))) if end["after"] > start["after"] else []

    def read(self, partition: Run) -> Iterator[tuple]:
        return self.service.rows(partition)


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self.options, schema)

    def streamReader(self, schema: StructType) -> PagedStream:  # noqa: N802
        return PagedStream(self.options, schema)


def register(spark) -> None:
    spark.dataSource.register(PagedJson)
