"""What stands inside what on a page: questions about intervals of positions, asked after the parse.

An element spans the positions from pos to end_pos, and spans are nested or apart. So both answers are linear in a
page's nodes, once they are sorted by position: pages are dealt out by key, and no node is held against all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def inside(nodes: DataFrame, when: Column, keys: list[str], into: str = "inside") -> DataFrame:
    """nodes with a column that tells whether a node stands inside another one that fulfils a condition.

    Of the spans that began before, the one that reaches farthest encloses the node, or none does.
    """
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(when, F.col("end_pos"))).over(before)
    return nodes.withColumn(into, F.coalesce(reach >= F.col("pos"), F.lit(False)))


def of_class(name: str) -> Column:
    return F.array_contains("classes", name)


def enclosing(nodes: DataFrame, when: Column, keys: list[str]) -> DataFrame:
    """(keys, pos, outer, depth): each node with each node around it that fulfils a condition; depth 1 is the innermost.

    A stack over the sorted nodes of a page: an interval join that makes one row for each answer.
    """
    kinds = [nodes.schema[k] for k in keys]
    rows = nodes.select(*keys, "pos", "end_pos", F.coalesce(when, F.lit(False)).alias("_outer"))
    placed = rows.repartition(*keys).sortWithinPartitions(*keys, "pos")
    names = [*keys, "pos", "outer", "depth"]
    types = to_arrow_schema(nodes.select(*keys).schema).types + [pa.int32()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, stack = None, []
        for batch in batches:
            out = []
            for *key, pos, end, is_outer in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != page:
                    page, stack = key, []
                while stack and stack[-1][1] < pos:
                    stack.pop()
                out += [(*key, pos, outer, depth) for depth, (outer, _) in enumerate(reversed(stack), 1)]
                if is_outer:
                    stack.append((pos, end))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "pos int, outer int, depth int"])
    return placed.mapInArrow(run, schema)
