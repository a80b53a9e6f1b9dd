"""Feature services and mirrors against a server of our own on this machine."""

import json
import threading
import time
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from kerbstone.sources import features, service

POISON, GONE, EMPTY = 7, 11, 13
ROWS = {i: {"OBJECTID": i, "NAME": f"N{i % 3}", "LEN": i / 2} for i in range(1, 41)}


class Handler(BaseHTTPRequestHandler):
    log: list = []
    failures: dict = {}

    def log_message(self, *_):
        pass

    def _answer(self, method, params):
        path = self.path.split("?")[0]
        self.log.append((method, path, params))
        if self.failures.get(path, 0) > 0:
            self.failures[path] -= 1
            self.send_error(503)
            return
        self._send(getattr(self, "do_" + path.strip("/").split("/")[-1])(params))

    def _send(self, found):
        body = json.dumps(found).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        self._answer("GET", dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query)))

    def do_POST(self):
        self._answer("POST", dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode())))

    def do_layer(self, _):
        return {"maxRecordCount": 6, "objectIdField": "OBJECTID"}

    def do_bad(self, _):
        return {"error": {"code": 400}}

    def do_map(self, params):
        if "box9" in params["data"]:
            return self.nothing()
        return {"elements": [{"id": 1, "tags": {"name": "A", "highway": "road"}, "geometry": [{"lat": 1.0, "lon": 2.0}, {"lat": 1.5, "lon": 2.5}]}, {"id": 2, "tags": {"highway": "road"}, "geometry": [{"lat": 1.0, "lon": 2.0}, {"lat": 1.5, "lon": 2.5}]}, {"id": 3, "tags": {"name": "C"}, "geometry": [{"lat": 1.0, "lon": 2.0}]}]}

    def nothing(self):
        raise ConnectionError

    def do_query(self, params):
        def keep(row):
            where = params.get("where", "1=1")
            names = {"OBJECTID": row["OBJECTID"], "NAME": row["NAME"], "LEN": row["LEN"]}
            return eval(where.replace(" AND ", " and ").replace(" IN ", " in ").replace("NAME IS NOT NULL", "True").replace("LEN IS NOT NULL", "True").replace("=", "==").replace(">==", ">=").replace("1==1", "True"), {}, names)

        if params.get("returnCountOnly"):
            return {"count": sum(map(keep, ROWS.values()))}
        if params.get("returnIdsOnly"):
            return {"objectIds": sorted((i for i, r in ROWS.items() if keep(r)), reverse=True)}
        ids = [int(x) for x in params["objectIds"].split(",")]
        if GONE in ids or (POISON in ids and params["f"] == "geojson"):
            return {"error": "can't convert"}
        fields = params["outFields"].split(",")
        pick = lambda i: {k: v for k, v in ROWS[i].items() if k in fields}
        if params["f"] == "json":
            return {"features": [{"attributes": pick(i), "geometry": {"paths": [[[0, 0]], [[1, 2, 9], [3, 4, 9]]]}} for i in ids]}
        return {"features": [{"type": "Feature", "properties": pick(i), "geometry": None if i == EMPTY else {"type": "LineString", "coordinates": [[i, 0], [i, int(params["outSR"])]]}} for i in ids]}


@pytest.fixture(scope="module")
def server():
    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}"
    made.shutdown()


@pytest.fixture(autouse=True)
def fresh():
    Handler.log.clear()
    Handler.failures.clear()


def test_requests_are_tried_again_with_growing_pauses(server, monkeypatch):
    slept = []
    monkeypatch.setattr(time, "sleep", slept.append)
    Handler.failures["/layer"] = 2
    assert service.Service(3, 2.0).ask(f"{server}/layer", {})["maxRecordCount"] == 6 and slept == [2.0, 4.0]
    with pytest.raises(service.ServiceError):
        service.Service(2, 0.0).ask(f"{server}/bad", {})
    assert [x[1] for x in Handler.log].count("/bad") == 2


def test_long_queries_are_posted(server):
    layer = service.Layer(f"{server}/layer", service.Service(1, 0.0))
    assert layer.count("LEN >= 10") == 21 and layer.ids() == list(range(1, 41))
    service.Service(1, 0.0).ask(f"{server}/layer", {"x": "y" * 1490})
    service.Service(1, 0.0).ask(f"{server}/layer", {"x": "y" * 1499})
    assert [x[0] for x in Handler.log][-2:] == ["GET", "POST"]


def test_layer_source(spark, server):
    service.register_layer(spark)
    read = spark.read.format("feature_layer").option("url", f"{server}/layer").option("fields", "NAME string, LEN double").option("outSR", 26910).option("retries", 1).option("pause", 0)
    rows = {r.oid: r for r in read.load().collect()}
    assert set(rows) == set(ROWS) - {EMPTY} and [i for i, r in rows.items() if r.lost] == [GONE]
    assert rows[5].NAME == "N2" and rows[5].LEN == 2.5 and json.loads(rows[5].coordinates) == [[5, 0], [5, 26910]]
    # the id that can't be had in one format comes in the other, without its path of one point and third numbers
    assert rows[POISON].kind == "LineString" and json.loads(rows[POISON].coordinates) == [[1, 2], [3, 4]] and rows[POISON].LEN == 3.5
    asked = [p for m, path, p in Handler.log if "objectIds" in p]
    assert all(p["outFields"] == "OBJECTID,NAME,LEN" for p in asked) and max(len(p["objectIds"].split(",")) for p in asked) == 6


def test_filters_reach_the_service(spark, server):
    service.register_layer(spark)
    read = spark.read.format("feature_layer").option("url", f"{server}/layer").option("fields", "NAME string, LEN double").option("where", "OBJECTID > 20").option("retries", 1).option("pause", 0).load()
    got = {r.oid for r in read.where((F.col("NAME") == "N1") & (F.col("LEN") >= 15.0)).collect()}
    assert got == {i for i, r in ROWS.items() if i > 20 and r["NAME"] == "N1" and r["LEN"] >= 15}
    where = next(p["where"] for _, _, p in Handler.log if p.get("returnIdsOnly"))
    assert where.startswith("(OBJECTID > 20)") and "NAME = 'N1'" in where and "LEN >= 15.0" in where
    assert {int(x) for _, _, p in Handler.log if "objectIds" in p for x in p["objectIds"].split(",")} == got


def test_mirrors_in_order_and_failed_areas(spark, server):
    tried = []

    def ask(url, query):
        tried.append(url)
        if url != "c" or len(tried) < 6:
            raise OSError("busy")
        return {"elements": []}

    assert service.from_mirrors(["a", "b", "c"], "q", 2, 0.0, ask) == {"elements": []} and tried == ["a", "b", "c"] * 2
    with pytest.raises(service.ServiceError):
        service.from_mirrors(["a"], "q", 2, 0.0, ask)
    found = service.fetch_areas(spark, {"north": "box1", "south": "box9"}, "way({box})", [f"{server}/down", f"{server}/map"], 1, 0.0)
    assert {(r.area, r.problem is not None) for r in found.collect()} == {("north", False), ("south", True)}
    ways = features.named_ways(found.where("problem is null")).collect()
    assert [(r.osm_id, r.tags["name"], r.tags["osm_id"], len(r.pts)) for r in ways] == [(1, "A", "1", 2)]
    assert features.osm_features(found.where("problem is null")).count() == 2
