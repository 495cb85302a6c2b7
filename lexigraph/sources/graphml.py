"""View graphs as GraphML."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_xml
from ..operators.views import dangling

_HEAD = """<?xml version="1.0" encoding="UTF-8"?>
<graphml xmlns="http://graphml.graphdrawing.org/xmlns">
  <key id="label" for="node" attr.name="label" attr.type="string"/>
  <key id="type" for="node" attr.name="type" attr.type="string"/>
  <key id="predicate" for="edge" attr.name="predicate" attr.type="string"/>
  <key id="confidence" for="edge" attr.name="confidence" attr.type="double"/>
  <graph id="lexigraph" edgedefault="directed">"""


def number(c):
    """A double as JavaScript writes it, for values from 0.000001 up: 1, not 1.0."""
    return F.regexp_replace(F.rtrim(F.format_string("%.15f", c), F.lit("0")), r"\.$", "")


def lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(place, line): the document's elements in order. Edges are numbered by id; the view graph is limited, so one task numbers it."""
    if not dangling(nodes, edges).isEmpty():
        raise ValueError("an edge names an unknown node")
    spark = nodes.sparkSession
    part = lambda c, n: F.concat(F.lit(f'      <data key="{n}">'), c, F.lit("</data>\n"))
    node = F.concat(F.lit('    <node id="'), escape_xml("id"), F.lit('">\n'), part(escape_xml("label"), "label"), part(escape_xml("type"), "type"), F.lit("    </node>"))
    own = nodes.select(F.struct(F.lit(1).alias("kind"), F.col("id").alias("id")).alias("place"), node.alias("line"))
    at = (F.row_number().over(Window.orderBy("id")) - 1).cast("string")
    confidence = F.when(F.col("confidence").isNotNull(), part(number(F.col("confidence").cast("double")), "confidence")).otherwise(F.lit(""))
    edge = F.concat(F.lit('    <edge id="e'), at, F.lit('" source="'), escape_xml("source"), F.lit('" target="'), escape_xml("target"), F.lit('">\n'), part(escape_xml("predicate"), "predicate"), confidence, F.lit("    </edge>"))
    links = edges.select(F.struct(F.lit(2).alias("kind"), F.col("id").alias("id")).alias("place"), edge.alias("line"))
    frame = spark.createDataFrame([(0, "", _HEAD), (3, "", "  </graph>\n</graphml>")], "kind int, id string, line string").select(F.struct("kind", "id").alias("place"), "line")
    return frame.unionByName(own).unionByName(links).orderBy("place").select("place.kind", "place.id", "line")


def write(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    lines(nodes, edges).orderBy("kind", "id").select("line").coalesce(1).write.text(path)
