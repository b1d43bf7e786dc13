"""Flows described by data: delimited sources, channels that filter, unite and join them, delimited sinks.

A flow lists its sources, channels and sinks. Nodes without names form one line: the source, through the
channels in their order, to the sink. With several of a kind, a source has an ``id``, a channel an ``id`` and the
``inputs`` it takes, and a sink its ``inputs``. A channel with several inputs unites them by column names, or
joins them one after the other where it has ``on`` (and ``how``, inner if absent); its ``filter`` comes after. A
sink with several inputs takes their union.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crowdtide.plans.lineage import scratch_folder

# The word replaced in file patterns, and the codes of column types.
START_WORD = "#flow.startDataTime#"
DATA_TYPES = {0: T.StringType(), 1: T.IntegerType()}


def file_path(node: Mapping[str, Any], start: datetime) -> str:
    name = node["filePattern"].replace(START_WORD, start.strftime("%Y%m%d%H%M%S"))
    return f"{node['filePath'].rstrip('/')}/{name}"


def _columns(node: Mapping[str, Any], side: str) -> list[Mapping[str, Any]]:
    return [column for group in node[side] for column in group["columns"]]


def input_schema(node: Mapping[str, Any]) -> T.StructType:
    """Schema of the input columns; an unknown type code is an error."""
    fields = []
    for column in _columns(node, "inputGroups"):
        code = column.get("dataType", 0)
        if code not in DATA_TYPES:
            raise ValueError(f"unknown dataType {code!r} of column {column['name']!r}")
        fields.append(T.StructField(column["name"], DATA_TYPES[code]))
    return T.StructType(fields)


def output_names(node: Mapping[str, Any]) -> list[str]:
    return [column["name"] for column in _columns(node, "outputGroups")]


def apply_flow(rows: DataFrame, flow: Mapping[str, Any]) -> DataFrame:
    """The columns each step lets through, and the filters of the channel between them."""
    for node in flow["source"]:
        rows = rows.select(*output_names(node))
    for channel in flow.get("channel", []):
        if channel.get("filter"):
            rows = rows.where(channel["filter"])
    for node in flow["sink"]:
        rows = rows.select(*output_names(node))
    return rows


def _linked(flow: Mapping[str, Any]) -> list[tuple[str, str, Mapping[str, Any], list[str]]]:
    """(kind, id, node, inputs) of every node, each after its inputs; an unnamed channel or sink takes what is before it."""
    found, last = [], None
    for kind in ("source", "channel", "sink"):
        nodes = list(flow.get(kind, []))
        if kind == "sink" and not nodes or kind == "source" and not nodes:
            raise ValueError(f"a flow needs a {kind}")
        for number, node in enumerate(nodes):
            name = node.get("id", f"{kind} {number}")
            if any(name == other for _, other, _, _ in found):
                raise ValueError(f"two nodes are called {name!r}")
            inputs = list(node.get("inputs", [])) if kind != "source" else []
            if kind != "source" and not inputs:
                if last is None:
                    raise ValueError(f"{name!r} needs inputs: there are several sources")
                inputs = [last]
            known = {other for other_kind, other, _, _ in found if other_kind != "sink"}
            if not set(inputs) <= known:
                raise ValueError(f"{name!r} takes {sorted(set(inputs) - known)}, which is not before it")
            found.append((kind, name, node, inputs))
            if kind == "channel" or kind == "source" and len(nodes) == 1:
                last = name
    return found


def _channel(inputs: list[DataFrame], node: Mapping[str, Any]) -> DataFrame:
    if node.get("on"):
        rows = reduce(lambda a, b: a.join(b, list(node["on"]), node.get("how", "inner")), inputs)
    else:
        rows = reduce(DataFrame.unionByName, inputs)
    return rows.where(node["filter"]) if node.get("filter") else rows


def run_flow(spark: SparkSession, flow: Mapping[str, Any], start: datetime) -> None:
    """Reads the sources, runs the channels and writes the sinks.

    What several nodes take is written to the shared folder first, so that each source is read once however
    many sinks there are.
    """
    nodes = _linked(flow)
    takers = Counter(name for *_, inputs in nodes for name in inputs)
    made: dict[str, DataFrame] = {}
    for kind, name, node, inputs in nodes:
        given = [made[i] for i in inputs]
        if kind == "source":
            rows = spark.read.schema(input_schema(node)).csv(file_path(node, start), sep=node["delimiter"]).select(*output_names(node))
        elif kind == "channel":
            rows = _channel(given, node)
        else:
            rows = reduce(DataFrame.unionByName, [g.select(*output_names(node)) for g in given])
            rows.write.mode("overwrite").csv(file_path(node, start), sep=node["delimiter"])
        if kind != "sink" and takers[name] > 1:
            folder = scratch_folder(spark, "flow")
            rows.write.parquet(folder)
            rows = spark.read.schema(rows.schema).parquet(folder)
        made[name] = rows
