"""Scalar functions and kernels against hand-traced values."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbstone.functions import geometry, names, scalars
from kerbstone.operators import gates, network
from kerbstone.operators.match import _interval
from kerbstone.sources import features


def column(spark, values, made, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", made(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_normalize(spark):
    cases = {
        "1 AV": "1ST AVE", "112 ST": "112TH ST", "02 ST": "2ND ST", "SHATTUCK AVE (SB)": "SHATTUCK AVE", "M.L. KING JR WAY": "MARTIN LUTHER KING JR WAY", "EAST BOLIVAR DR": "BOLIVAR DR",
        "E 12th St, WB": "12TH ST", "FLORANCE ST": "FLORENCE ST", "PARK": "PARK", "MC GEE AV": "MCGEE AVE", "THE UPLANDS": "UPLANDS", "O'FARRELL ST": "O FARRELL ST", "WEST ST": "WEST ST",
        "MARTIN LUTHER KING JR W": "MARTIN LUTHER KING JR WAY", "(SB)": "", "": "", None: "",
    }
    assert column(spark, list(cases), names.normalize) == list(cases.values())


def test_labels(spark):
    assert column(spark, ["", "(GATE)", "CUL-DE-SAC", "WEST END", "RRX", "WESTEND", None], names.is_terminal) == [True, True, True, True, False, False, True]
    cases = {"CITY LIMIT (DOVER ST)": ["DOVER ST", "CITY LIMIT"], "MLK/ ADELINE ST": ["MLK", "ADELINE ST"], "374' E/O MARTIN LUTHER KING JR WAY": ["374' E", "O MARTIN LUTHER KING JR WAY"], "100 FT NO PRINCE ST": ["PRINCE ST"], "OPP ELM ST": ["ELM ST"]}
    assert column(spark, list(cases), names.label_alternatives) == list(cases.values())


def test_classes_and_keys(spark):
    assert column(spark, ["2.3A", "2B", "3.0", "0.2", " 4 ", "0", "", "9", None], lambda x: scalars.oakland_class(x)["primary"]) == ["II", "IIB", "III", "II", "IV", None, None, None, None]
    rows = spark.createDataFrame([("00123", "0010"), ("a07", "020"), ("A01", "0")], "a string, b string").select(scalars.section_key(F.col("a"), F.col("b")).alias("k")).collect()
    assert [r.k for r in rows] == ["123-10", "A07-20", "A01-"]
    assert column(spark, [0.0, 24.0, 25.0, 79.5, 80.0, 101.0], scalars.band, "double") == ["Failed", "Failed", "Poor", None, "Very Good / Excellent", None]


def test_control_totals_stop(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    gates.require(gates.totals(rows, {"x": (F.sum("x"), 3, 0.0)}))
    with pytest.raises(gates.ControlTotalError):
        gates.require(gates.totals(rows, {"x": (F.sum("x"), 4, 0.1)}))


def test_bridges_are_single_linkage():
    nodes = [(0, 0), (100, 0), (115, 0), (215, 0), (246, 0), (346, 0)]
    assert network.bridges(nodes, [(0, 1), (2, 3), (4, 5)]) == [(15.0, 1, 2)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-30, 30), min_size=8, max_size=8), st.floats(0.5, 20))
def test_interval_against_sampling(c, radius):
    a, b, p, q = (c[0], c[1]), (c[2], c[3]), (c[4], c[5]), (c[6], c[7])
    found = _interval(a, b, p, q, radius) or (2, -1)
    for t in np.linspace(0, 1, 101):
        x, y = a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])
        w = (q[0] - p[0], q[1] - p[1])
        s = 0 if w == (0, 0) or w[0] ** 2 + w[1] ** 2 == 0 else max(0, min(1, ((x - p[0]) * w[0] + (y - p[1]) * w[1]) / (w[0] ** 2 + w[1] ** 2)))
        gap = math.dist((x, y), (p[0] + s * w[0], p[1] + s * w[1]))
        if abs(gap - radius) > 1e-6 and math.dist(a, b) > 1e-6:
            assert (found[0] - 1e-9 <= t <= found[1] + 1e-9) == (gap <= radius)


def test_geojson_and_csv(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[{"geometry":{"type":"LineString","coordinates":[[1,2],[3,4]]},"properties":{"n":"a"}},{"geometry":null,"properties":{}},{"geometry":{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[5,6],[7,8,9]]]},"properties":{"n":"b"}}]}')
    rows = features.read_geojson(spark, str(tmp_path / "a.geojson")).orderBy("ord").collect()
    assert [(r.ord, len(r.parts), r.properties["n"]) for r in rows] == [(0, 1, "a"), (2, 2, "b")]
    (tmp_path / "a.csv").write_text("x,y\n01,a b\n")
    assert features.read_csv(spark, str(tmp_path / "a.csv"), ["x", "y"]).first().x == "01"


def test_simplify_keeps_what_is_far():
    from kerbstone.functions.simplify import kept

    x, y = np.array([0.0, 1, 2, 3, 4]), np.array([0.0, 0.01, 0, 1, 0])
    assert kept(x, y, 0.1).tolist() == [0, 2, 3, 4]


def test_sinks(spark, tmp_path):
    import json

    from kerbstone.sources import sinks

    rows = spark.createDataFrame([(1, "a", [[(1.0, 2.0), (3.0, 4.0)]]), (2, None, [])], "n int, s string, parts array<array<struct<x:double,y:double>>>")
    whole = json.loads(sinks.feature_collection(rows, "parts", ["n"]).first().value)
    assert [f["geometry"] for f in whole["features"]] == [{"type": "LineString", "coordinates": [[1, 2], [3, 4]]}, None] and whole["features"][1]["properties"] == {"n": 2, "s": None}
    sinks.write_csv(rows, ["s", "missing"], str(tmp_path / "c"))
    summary = spark.createDataFrame([("b", 2, None), ("a", 1, 0.5)], "city string, rows int, rate double")
    sinks.write_report(summary, "city", str(tmp_path / "r"), rows.select("n", "s"))
    assert json.loads(spark.read.text(str(tmp_path / "r/summary")).first().value) == sinks.report(summary, "city") == {"a": {"rows": 1, "rate": 0.5}, "b": {"rows": 2, "rate": None}}
    assert spark.read.json(str(tmp_path / "r/listed")).count() == 2
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["s", "missing"]
    assert sinks.page("<script>__PAYLOAD__</script>", {"a": "</script>"}) == '<script>{"a":"<\\/script>"}</script>'


def test_streamed_gaps(spark, tmp_path):
    from kerbstone.streaming.gaps import gap_sessions

    path = str(tmp_path / "in")
    spark.sql("select 1 as k, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h) as ts from values (0), (3), (40), (45), (500) t(h)").write.parquet(path)
    found = gap_sessions(spark.readStream.schema("k int, ts timestamp").parquet(path), ["k"], "ts")
    q = found.writeStream.outputMode("append").format("memory").queryName("gaps").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.sql("select n from gaps").collect()) == [2, 2]


def test_bikeway_sources(spark):
    from kerbstone.operators import bikeways

    line = [(0.0, 0.0), (1609.344, 0.0)]
    rows = spark.createDataFrame([("MAIN ST", "A", "B", "2.3A", "4", "2010", line), ("X", "A", "B", "0", "", "0", line)], "ROADWAY string, BEGINNING string, ENDING string, EXISTINGCL string, PROPOSEDCL string, YEARCURREN string, pts array<struct<x:double,y:double>>")
    got = sorted((r.status, r.bikeway_class, r.class_secondary, r.street, r.miles, r.year) for r in bikeways.from_network(rows).collect())
    assert got == [("existing", "II", "IIIA", "Main St", 1.0, "2010"), ("proposed", "IV", None, "Main St", 1.0, None)]


def test_six_decimals_as_c_prints_them(spark):
    values = [0.0, -0.0, 0.0078125, -0.0078125, 0.0234375, 0.1234565, 0.9999995, -4e-7, 5e-324, 564321.1234565, 2.0**51 + 0.5, 2.0**40 + 2.0**-7]
    line = F.array(F.struct(F.col("x").alias("x"), F.col("x").alias("y")))
    assert column(spark, values, lambda x: geometry.wkt(F.array(line)), "double") == [f"LINESTRING ({v:.6f} {v:.6f})" for v in values]
