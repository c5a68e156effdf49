"""Embedding near-dedup: tiled comparison in the order of principal components.

Vectors are normalised and rotated onto the principal components of their label, so that the leading
dimensions hold most of each vector. Equal vectors collapse first. What is left is dealt into tiles of
at most `tile` neighbouring vectors; a tile keeps the box of its first coordinates and the cells of its first two,
which are as wide as linked vectors may be apart. Two tiles of a label meet only if cells of theirs touch and
their boxes come near enough for a cosine of `threshold`. Within a tile pair the products
of the leading dimensions are accumulated first; the rest of a product is at most the product of the
suffix norms, and only pairs that can still reach the threshold are finished - in double precision, on
the vectors as they came. A rotation keeps products, so the bound is sound whatever rows it was fitted on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import components, materialize, shuffle_partitions, spanning

THRESHOLD = 0.98
#: Vectors in a tile; rows of a label that its rotation is fitted on; coordinates of a tile's box.
TILE, FIT_ROWS, BOX = 512, 1000, 8
#: What rounding may add to a bound.
SLACK = 1e-9


def sound(name: str) -> Column:
    """Whether a vector is not null, has only finite components and not only zeros."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(name).isNotNull() & finite & F.exists(name, lambda x: x != 0)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles) of rows that can link: label and vector not null, all components finite, not all zero."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).where(sound("embedding"))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that neither very large nor very small components overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def rotations(distinct: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(label, dims, rotation): principal axes, fitted for each label and dimension on at most fit_rows rows taken by hash."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(pdf["embedding"].to_numpy()))
        _, axes = np.linalg.eigh(x.T @ x)
        return pd.DataFrame({"label": [pdf["label"].iloc[0]], "dims": [x.shape[1]], "rotation": [np.ascontiguousarray(axes[:, ::-1]).ravel().tolist()]})

    by = Window.partitionBy("label", "dims").orderBy(F.xxhash64("vec_id"))
    sample = distinct.withColumn("at", F.row_number().over(by)).where(F.col("at") <= fit_rows).drop("at")
    return sample.groupBy("label", "dims").applyInPandas(fit, f"label {distinct.schema['label'].dataType.simpleString()}, dims int, rotation array<double>")


def rotate(distinct: DataFrame, axes: DataFrame) -> DataFrame:
    """Add x (unit vector in component order, leading first) to the distinct vectors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, part in pdf.groupby(["label", "dims"], sort=False):
                n = int(part["dims"].iloc[0])
                x = unit(np.stack(part["embedding"].to_numpy())) @ np.asarray(part["rotation"].iloc[0]).reshape(n, n)
                yield part[["vec_id", "members", "label", "dims", "embedding"]].assign(x=list(x))

    label = distinct.schema["label"].dataType.simpleString()
    return distinct.join(axes, ["label", "dims"]).mapInPandas(run, f"vec_id long, members long, label {label}, dims int, embedding array<double>, x array<double>")


def reach(threshold: float) -> float:
    """How far apart unit vectors of that cosine can be, and a little more."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6)


def tiles(rotated: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(label, dims, part, ids, members, raw, x, low, high, cells): tiles of neighbours.

    The vectors of a label are dealt out by range of coarse cells of their leading coordinates and cut
    into tiles; no task holds a label, only a part of the order.
    """
    width = reach(threshold)
    cells = [F.floor(F.coalesce(F.get("x", F.lit(k)), F.lit(0.0)) / width).alias(f"c{k}") for k in range(3)]
    keys = ["label", "dims", "c0", "c1", "c2", "vec_id"]
    placed = rotated.select("*", *cells).repartitionByRange(shuffle_partitions(rotated.sparkSession), *keys).sortWithinPartitions(*keys)

    def cut(rows: pd.DataFrame, done: bool) -> tuple[list[pd.DataFrame], list[pd.DataFrame]]:
        """Full tiles of the ordered rows, and what is left unless done."""
        made, left = [], []
        groups = [g for _, g in rows.groupby(["label", "dims"], sort=False)]
        for k, group in enumerate(groups):
            for at in range(0, len(group), tile):
                some = group.iloc[at : at + tile]
                if len(some) < tile and k == len(groups) - 1 and not done:
                    left = [some]
                else:
                    made.append(some)
        return made, left

    def row(some: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(some["x"].to_numpy())
        one = {"label": some["label"].iloc[0], "dims": int(some["dims"].iloc[0]), "part": int(some["vec_id"].iloc[0]), "ids": some["vec_id"].tolist(), "members": some["members"].tolist()}
        one |= {"raw": np.stack(some["embedding"].to_numpy()).tobytes(), "x": x.tobytes(), "low": x[:, :BOX].min(axis=0).tolist(), "high": x[:, :BOX].max(axis=0).tolist()}
        near = np.floor(x[:, :2] / width).astype(np.int64)
        one["cells"] = [{"a": a, "b": b} for a, b in {(int(r[0]), int(r[-1]) if len(r) > 1 else 0) for r in near}]
        return pd.DataFrame({k: [v] for k, v in one.items()})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in frames:
            held.append(pdf)
            if sum(map(len, held)) >= 8 * tile:
                made, held = cut(pd.concat(held), False)
                yield from map(row, made)
        if held:
            yield from map(row, cut(pd.concat(held), True)[0])

    label = rotated.schema["label"].dataType.simpleString()
    schema = f"label {label}, dims int, part long, ids array<long>, members array<long>, raw binary, x binary, low array<double>, high array<double>, cells array<struct<a:long,b:long>>"
    return placed.select("vec_id", "members", "label", "dims", "embedding", "x").mapInPandas(run, schema)


def compare(a: tuple, b: tuple, dims: int, threshold: float) -> np.ndarray:
    """Index pairs (i, j) of two tiles whose cosine is at least threshold."""
    (raw_a, xa), (raw_b, xb) = a, b
    steps = sorted({min(dims, s) for s in (8, 16, 32, 64, 128, 256, dims)})
    i = j = None
    total = np.zeros(())
    start = 0
    for stop in steps:
        if i is None:
            total = xa[:, start:stop] @ xb[:, start:stop].T
            rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", xa[:, :stop], xa[:, :stop])))[:, None] * np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", xb[:, :stop], xb[:, :stop])))[None, :]
            i, j = np.nonzero(total + rest >= threshold - SLACK)
            total = total[i, j]
        else:
            total = total + np.einsum("ij,ij->i", xa[i, start:stop], xb[j, start:stop])
            rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", xa[i, :stop], xa[i, :stop])) * np.maximum(0, 1 - np.einsum("ij,ij->i", xb[j, :stop], xb[j, :stop])))
            go = total + rest >= threshold - SLACK
            i, j, total = i[go], j[go], total[go]
        start = stop
        if not len(i):
            break
    if len(i):
        go = cosine(raw_a[i], raw_b[j]) >= threshold
        i, j = i[go], j[go]
    return np.stack([i, j], axis=1)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine in double precision of rows, scaled so that no product overflows."""
    a, b = a / np.abs(a).max(axis=1)[:, None], b / np.abs(b).max(axis=1)[:, None]
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def tile_links(distinct: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Rows (a, b, null): edges that connect what links connect; rows (a, null, linked): linked vectors, to be summed by a.

    Every pair of distinct vectors of one label and dimension is compared or excluded by a bound. A tile pair
    gives at most one edge and one count for each of its vectors, however many pairs link.
    """
    distinct = distinct.withColumn("dims", F.size("embedding"))
    made = materialize(tiles(rotate(distinct, rotations(distinct)), threshold, tile), "tiles")
    box = made.select("label", "dims", "part", "low", "high")
    other = box.toDF("l", "d", "other", "low2", "high2")
    held = made.select("label", "dims", "part", F.explode("cells").alias("cell"))
    around = F.array(*[F.struct((F.col("cell.a") + i).alias("a"), (F.col("cell.b") + j).alias("b")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    touched = held.select("label", "dims", "part", F.explode(around).alias("cell")).distinct()
    touch = touched.join(held.withColumnRenamed("part", "other"), ["label", "dims", "cell"]).where("part <= other").select("label", "dims", "part", "other").distinct()
    # unit vectors at that cosine lie within a squared distance of 2 - 2 * threshold; so do their boxes' gaps
    apart = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.greatest(p - q, F.lit(0.0))), F.lit(0.0), lambda s, d: s + d * d)
    near = touch.join(box, ["label", "dims", "part"]).join(other.withColumnRenamed("other", "o"), (F.col("label") == F.col("l")) & (F.col("dims") == F.col("d")) & (F.col("other") == F.col("o")))
    near = near.where(apart("low", "high2") + apart("low2", "high") <= 2 - 2 * threshold + SLACK).select("label", "dims", "part", "other")
    content = ["ids", "members", "raw", "x"]
    left = near.join(made.select("label", "dims", "part", *content), ["label", "dims", "part"])
    right = made.select(F.col("label").alias("l"), F.col("dims").alias("d"), F.col("part").alias("p"), *[F.col(c).alias(f"{c}2") for c in content])
    pairs = left.join(right, (F.col("label") == F.col("l")) & (F.col("dims") == F.col("d")) & (F.col("other") == F.col("p")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dims, same, *values = (batch.column(k)[row].as_py() for k in range(batch.num_columns))
                ids, members, raw, x, ids2, members2, raw2, x2 = (np.frombuffer(v).reshape(-1, dims) if isinstance(v, bytes) else np.asarray(v, np.int64) for v in values)
                found = compare((raw, x), (raw2, x2), dims, threshold)
                i, j = found[:, 0], found[:, 1]
                if same:
                    i, j = i[i != j], j[i != j]
                    linked = np.bincount(i, members2[j], len(ids)).astype(np.int64)
                    every, all_ids, label = linked, ids, spanning(i, j, len(ids))
                else:
                    every = np.concatenate([np.bincount(i, members2[j], len(ids)), np.bincount(j, members[i], len(ids2))]).astype(np.int64)
                    all_ids, label = np.concatenate([ids, ids2]), spanning(i, j + len(ids), len(ids) + len(ids2))
                edge, count = np.flatnonzero(label != np.arange(len(label))), np.flatnonzero(every)
                a = np.concatenate([all_ids[edge], all_ids[count]])
                b = pa.array(np.concatenate([all_ids[label[edge]], np.zeros(len(count), np.int64)]), mask=np.arange(len(a)) >= len(edge))
                n = pa.array(np.concatenate([np.zeros(len(edge), np.int64), every[count]]), mask=np.arange(len(a)) < len(edge))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, n], names=["a", "b", "linked"])

    args = pairs.select("dims", (F.col("part") == F.col("other")).alias("same"), *content, *[f"{c}2" for c in content])
    return args.mapInArrow(run, "a long, b long, linked long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors.

    Vectors link when their labels are equal and not null and their cosine is at least threshold. A vector that
    is null, empty, zero or holds null or non-finite components, or whose label is null, links with nothing: 0
    links, its own component. Vectors of different length do not link. Equal vectors of a label are one node with
    its members counted; copies are not expanded to pairs. Rows that share a vec_id stay one row each; a null vec_id
    links with nothing and has a null component. An empty table gives no rows.
    """
    good = usable(vectors)
    same = F.sha2(F.array_join(F.transform("embedding", lambda x: (x + 0.0).cast("string")), ","), 256)
    member = good.withColumn("same", same)
    classes = member.groupBy("label", "same").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("members"), F.min_by("embedding", "vec_id").alias("embedding"))
    # numbers that rise with vec_id and are unique even where vec_ids are not
    classes = classes.repartitionByRange(shuffle_partitions(vectors.sparkSession), "vec_id").sortWithinPartitions("vec_id", "label", "same")
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = materialize(tile_links(classes.select(F.col("node").alias("vec_id"), "members", "label", "embedding"), threshold, tile), "links")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))
    joined = components(classes.select(F.col("node").alias("id")), found.where("b is not null").select("a", "b")).select(F.col("id").alias("node"), F.col("component").alias("head"))
    by_class = classes.select("node", "label", "same", "members").join(degree, "node", "left").join(joined, "node")
    by_class = by_class.join(classes.select(F.col("node").alias("head"), F.col("vec_id").alias("component")), "head")
    of = by_class.select(F.col("label").alias("l"), F.col("same").alias("s"), (F.coalesce("linked", F.lit(0)) + F.col("members") - 1).alias("links"), "component")
    # each row finds its class by its own label and vector, so that rows which share a vec_id stay one row each
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    every = every.select("vec_id", "label", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound("embedding"), same).alias("same"))
    out = every.join(of, (F.col("label") == F.col("l")) & (F.col("same") == F.col("s")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
