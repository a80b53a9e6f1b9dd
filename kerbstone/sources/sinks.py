"""Sinks: CSV, GeoJSON, JSON reports, and the single-file page."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(rows: DataFrame, fields: list[str], path: str) -> None:
    """Exactly these fields, in this order: others are dropped, missing ones empty."""
    rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in fields]).write.mode("overwrite").csv(path, header=True, escape='"')


def feature(parts: Column, properties: Column) -> Column:
    """A feature as JSON text: LineString of one part, MultiLineString of several, null of none."""
    lines = F.transform(parts, lambda line: F.transform(line, lambda p: F.array(p["x"], p["y"])))
    kind = F.when(F.size(parts) == 1, F.concat(F.lit('{"type":"LineString","coordinates":'), F.to_json(lines[0]), F.lit("}"))).when(F.size(parts) > 1, F.concat(F.lit('{"type":"MultiLineString","coordinates":'), F.to_json(lines), F.lit("}")))
    return F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(kind, F.lit("null")), F.lit(',"properties":'), F.to_json(properties, {"ignoreNullFields": "false"}), F.lit("}"))


def write_features(rows: DataFrame, parts: str, path: str) -> None:
    """Newline-delimited features, written by all tasks; every column but ``parts`` is a property."""
    rows.select(feature(F.col(parts), F.struct(*[c for c in rows.columns if c != parts])).alias("value")).write.mode("overwrite").text(path)


def feature_collection(rows: DataFrame, parts: str, order: list[str]) -> DataFrame:
    """One row with a whole collection in order, for layers of the size of a map."""
    made = rows.select(F.struct(*order, feature(F.col(parts), F.struct(*[c for c in rows.columns if c != parts])).alias("__f")).alias("x"))
    whole = made.agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["__f"]), ",").alias("f"))
    return whole.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))


def report_rows(summary: DataFrame, key: str) -> DataFrame:
    """One row with a summary as a JSON object by key, in order of keys; nulls are written."""
    rest = [c for c in summary.columns if c != key]
    entry = F.struct(F.col(key).cast("string").alias("key"), F.struct(*rest).alias("value"))
    return summary.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))), {"ignoreNullFields": "false"}).alias("value"))


def report(summary: DataFrame, key: str) -> dict:
    """A summary as a nested dict by key, all of its rows."""
    return {r[key]: {k: v for k, v in r.asDict(True).items() if k != key} for r in summary.toLocalIterator()}


def write_report(summary: DataFrame, key: str, path: str, listed: DataFrame | None = None) -> None:
    """The summary as one JSON object, and beside it the rows it does not sum up (unmatched ones), one JSON object a line."""
    report_rows(summary, key).coalesce(1).write.mode("overwrite").text(f"{path}/summary")
    if listed is not None:
        listed.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/listed")


def page(template: str, payload: dict) -> str:
    """A single-file page: the payload takes the place of ``__PAYLOAD__``, safe inside a script element."""
    return template.replace("__PAYLOAD__", json.dumps(payload, separators=(",", ":")).replace("</", "<\\/"))
