"""Feature services and map-data servers over HTTP.

A layer is a data source: ``spark.read.format("feature_layer")`` with the options url, fields (a schema of the wanted
attributes, which are also all that is asked for), where, outSR, page, retries and pause. Every partition is a batch of
ids; filters on the attributes are sent to the service as part of ``where``.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import StructType

# The longest query that is sent as a GET, and the most features of one request.
LONGEST_GET, MOST_FEATURES = 1500, 500


class ServiceError(OSError):
    """A service answered with an error payload."""


@dataclass
class Service:
    """Requests that are tried again after a pause that grows with each attempt."""

    retries: int = 3
    pause: float = 2.0
    timeout: float = 120.0

    def ask(self, url: str, params: dict) -> dict:
        """The JSON answer; a query of more than LONGEST_GET bytes is posted, and an ``error`` in the answer raises."""
        body = urllib.parse.urlencode(params).encode()
        if len(body) > LONGEST_GET:
            request = urllib.request.Request(url, data=body, headers={"Content-Type": "application/x-www-form-urlencoded"})
        else:
            request = urllib.request.Request(f"{url}?{body.decode()}")
        for attempt in range(1, self.retries + 1):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    found = json.load(answer)
                if isinstance(found, dict) and "error" in found:
                    raise ServiceError(str(found["error"]))
                return found
            except (OSError, ValueError):
                if attempt == self.retries:
                    raise
                time.sleep(self.pause * attempt)
        raise ValueError("no attempts")


@dataclass
class Layer:
    """A layer of a feature service."""

    url: str
    service: Service

    def info(self) -> dict:
        return self.service.ask(self.url, {"f": "json"})

    def _query(self, **params) -> dict:
        return self.service.ask(f"{self.url}/query", {"f": "json", **params})

    def count(self, where: str = "1=1") -> int:
        return self._query(where=where, returnCountOnly="true")["count"]

    def ids(self, where: str = "1=1") -> list[int]:
        found = self._query(where=where, returnIdsOnly="true")
        return sorted(found.get("objectIds") or (found.get("properties") or {}).get("objectIds") or [])

    def features(self, ids: list[int], fields: str, out_sr: int, form: str) -> list[dict]:
        return self._query(objectIds=",".join(map(str, ids)), outFields=fields, returnGeometry="true", outSR=out_sr, f=form).get("features", [])


def _geometry(paths: list) -> dict | None:
    lines = [[point[:2] for point in path] for path in paths if len(path) > 1]
    if not lines:
        return None
    return {"type": "LineString", "coordinates": lines[0]} if len(lines) == 1 else {"type": "MultiLineString", "coordinates": lines}


def features_of(layer: Layer, ids: list[int], id_field: str, fields: str = "*", out_sr: int = 4326) -> Iterator[tuple[int | None, dict, dict | None, bool]]:
    """(id, attributes, geometry, lost) of the ids, each once.

    A batch that keeps failing is halved, down to single ids; such a one is asked for in the service's own format, and is
    lost only if that fails as well.
    """
    try:
        for f in layer.features(ids, fields, out_sr, "geojson"):
            known = f.get("properties") or {}
            yield known.get(id_field, f.get("id")), known, f.get("geometry"), False
    except (OSError, ValueError):
        if len(ids) > 1:
            half = len(ids) // 2
            yield from features_of(layer, ids[:half], id_field, fields, out_sr)
            yield from features_of(layer, ids[half:], id_field, fields, out_sr)
            return
        try:
            found = layer.features(ids, fields, out_sr, "json")
        except (OSError, ValueError):
            yield ids[0], {}, None, True
            return
        for f in found:
            yield ids[0], f.get("attributes") or {}, _geometry((f.get("geometry") or {}).get("paths") or []), False


def clause(f: Filter) -> str | None:
    """A filter as a condition of the service; null where it has no such form."""
    name = ".".join(f.attribute)
    signs = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}

    def literal(v) -> str | None:
        if isinstance(v, bool) or not isinstance(v, int | float | str):
            return None
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    if type(f) in signs:
        value = literal(f.value)
        return f"{name} {signs[type(f)]} {value}" if value else None
    if isinstance(f, In):
        values = [literal(v) for v in f.value]
        return f"{name} IN ({', '.join(values)})" if values and all(values) else None
    if isinstance(f, IsNull):
        return f"{name} IS NULL"
    if isinstance(f, IsNotNull):
        return f"{name} IS NOT NULL"
    if isinstance(f, StringStartsWith) and not set("%_") & set(f.value):
        return f"{name} LIKE {literal(f.value + '%')}"
    return None


class _Batch(InputPartition):
    def __init__(self, ids: list[int], id_field: str):
        self.ids, self.id_field = ids, id_field


class _LayerReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.layer = Layer(options["url"].rstrip("/"), Service(int(options.get("retries", 3)), float(options.get("pause", 2.0))))
        self.where, self.out_sr, self.page = options.get("where", "1=1"), int(options.get("outsr", 4326)), options.get("page")
        self.fields = [f.name for f in schema.fields if f.name not in ("oid", "kind", "coordinates", "lost")]
        self.schema, self.more = schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            made = clause(f) if f.attribute[0] in self.fields else None
            if made is None:
                yield f
            else:
                self.more.append(made)

    def partitions(self) -> list[_Batch]:
        info = self.layer.info()
        page = int(self.page or min(info.get("maxRecordCount", 1000), MOST_FEATURES))
        where = " AND ".join([f"({self.where})", *self.more]) if self.more else self.where
        ids = self.layer.ids(where)
        return [_Batch(ids[k : k + page], info.get("objectIdField", "OBJECTID")) for k in range(0, len(ids), page)]

    def read(self, partition: _Batch) -> Iterator[tuple]:
        kinds = {f.name: f.dataType.typeName() for f in self.schema.fields}
        make = {"double": float, "float": float, "long": int, "integer": int, "string": str}
        asked = ",".join(dict.fromkeys([partition.id_field, *self.fields]))
        for oid, known, geometry, lost in features_of(self.layer, partition.ids, partition.id_field, asked, self.out_sr):
            values = [None if known.get(c) is None else make.get(kinds[c], str)(known[c]) for c in self.fields]
            if geometry is not None or lost:  # a feature without geometry is dropped, a lost one is told
                yield (oid, *values, geometry and geometry["type"], geometry and json.dumps(geometry["coordinates"]), lost)


class FeatureLayer(DataSource):
    """(oid, attributes..., kind, coordinates as JSON text, lost) of a layer's features."""

    @classmethod
    def name(cls) -> str:
        return "feature_layer"

    def schema(self) -> str:
        fields = self.options.get("fields", "").strip()
        return f"oid long, {fields + ', ' if fields else ''}kind string, coordinates string, lost boolean"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _LayerReader(dict(self.options), schema)


def register_layer(spark: SparkSession) -> None:
    """Make ``spark.read.format("feature_layer")`` known, with filters sent to the service."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeatureLayer)


def from_mirrors(mirrors: list[str], query: str, rounds: int = 2, pause: float = 20.0, ask: Callable[[str, str], dict] | None = None) -> dict:
    """The first answer of a list of mirrors, tried in order, all of them again after a pause that grows; raises where none answers."""
    last: Exception | None = None
    for k in range(1, rounds + 1):
        for url in mirrors:
            try:
                return (ask or _post)(url, query)
            except (OSError, ValueError) as error:
                last = error
        if k < rounds:
            time.sleep(pause * k)
    raise ServiceError(f"no mirror answers: {last}")


def _post(url: str, query: str) -> dict:
    request = urllib.request.Request(url, data=urllib.parse.urlencode({"data": query}).encode())
    with urllib.request.urlopen(request, timeout=300) as answer:
        return json.load(answer)


_ELEMENTS = "area string, element string, problem string"
#: An element of the answers.
ELEMENT = "id long, tags map<string,string>, geometry array<struct<lat:double,lon:double>>"


def fetch_areas(spark: SparkSession, areas: dict[str, str], query: str, mirrors: list[str], rounds: int = 2, pause: float = 30.0) -> DataFrame:
    """(area, id, tags, geometry, problem): the elements of every area, each fetched by one task.

    ``{box}`` in the query is the area's box. An area that no mirror answers for is one row with its problem, not a failure.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for name, box in zip(batch["area"], batch["box"], strict=True):
                try:
                    found = from_mirrors(mirrors, query.replace("{box}", box), rounds, pause).get("elements", [])
                    rows = [(name, json.dumps(e), None) for e in found]
                except OSError as error:
                    rows = [(name, None, str(error))]
                yield pd.DataFrame(rows, columns=["area", "element", "problem"])

    asked = spark.createDataFrame(sorted(areas.items()), "area string, box string").repartition(max(1, len(areas)), "area")
    got = asked.mapInPandas(run, _ELEMENTS)
    return got.select("area", F.from_json("element", ELEMENT).alias("e"), "problem").select("area", "e.*", "problem")
