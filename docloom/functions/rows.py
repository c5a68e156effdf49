"""Python functions of single rows as Arrow UDFs that hold a slice of a batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows and bytes of a slice. A batch may have 10,000 rows; as Python objects they would take many times their size.
SLICE_ROWS, SLICE_BYTES = 64, 1 << 20


def sliced(arrays: tuple[pa.Array, ...]) -> Iterator[tuple[pa.Array, ...]]:
    """A batch's columns in slices of so many rows as SLICE_BYTES hold on average, SLICE_ROWS at most."""
    n = len(arrays[0])
    step = max(1, min(SLICE_ROWS, SLICE_BYTES * n // max(1, sum(a.nbytes for a in arrays))))
    for at in range(0, n, step):
        yield tuple(a.slice(at, step) for a in arrays)


def by_row(answer: Callable, kind: T.DataType | str, *columns: Column) -> Column:
    """answer(value of each column) for each row. Values and answers are Python objects for one slice only."""
    made = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    arrow = to_arrow_type(made)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in sliced(batch):
                yield pa.array([answer(*row) for row in zip(*(a.to_pylist() for a in part), strict=True)], arrow)

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run((batch,) for batch in batches)

    def more(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(one if len(columns) == 1 else more, made)(*columns)
