"""Exact range join of vectors by pivots, for near-duplicate embeddings.

Unit vectors ``u, v`` have ``|u - v|**2 = 2 - 2 cos``, so a least cosine is a largest
distance ``r``. A bounded number of pivots per label is drawn by hash and thinned until they
lie more than ``2 r`` apart. A vector belongs to the cell of its nearest pivot ``p``. By the
triangle inequality a partner in the cell of ``q`` is possible only if ``d(x, q) <= d(x, p) +
2 r``; such a vector is copied to that cell as well, unless its distance to the plane between
both pivots is above ``r``. So all partners of a vector lie in its own cell, and the cells
are joined independently, by matrix products in double precision. Large cells are cut into
tiles of at most ``TILE`` rows a side. A tile gives counts per vector and a star of links per
local component, never the pairs.

Equal unit vectors of a label are one class from the start and counted by their number.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows
without a label, link with nothing and are kept; vectors of different lengths do not link;
repeated rows link like other copies; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import saved, table
from softsearch.llm.components import components

#: Vectors that a cell should hold; pivots of a label and in all.
CELL, PER_LABEL, PIVOTS = 512, 32, 4096
#: Rows on each side of a tile, and rows of a tile that are multiplied at a time.
TILE, BLOCK = 2048, 512


def unit_vectors(df: DataFrame, keep: list[str], vec: str) -> DataFrame:
    """Add ``unit`` (float64 bytes), ``digest`` of it and ``dim``; null for invalid vectors."""
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{vec}`").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            rows = []
            for v in batch.column(1):
                x = v.values.to_numpy(zero_copy_only=False).astype(float) if v.is_valid else np.zeros(0)
                top = np.abs(x).max() if len(x) else 0.0
                if not np.isfinite(top) or top == 0:
                    rows.append((None, None, None))
                    continue
                x = x / top
                raw = (x / np.sqrt(x @ x) + 0.0).astype("<f8").tobytes()
                rows.append((raw, hashlib.blake2b(raw, digest_size=16).digest(), len(x)))
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.binary(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["row", "unit", "digest", "dim"])

    kind = src.schema["row"].dataType.simpleString()
    return src.mapInArrow(run, f"row {kind}, unit binary, digest binary, dim int").select("row.*", "unit", "digest", "dim")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def pivots_of(classes: DataFrame, radius: float) -> dict[str, np.ndarray]:
    """At most ``PER_LABEL`` pivots a part, ``PIVOTS`` in all, more than ``2 * radius`` apart."""
    share = min(1 / CELL, PIVOTS / (2 * max(1, classes.count())))
    spread = F.xxhash64("digest").cast("double") / (2.0**64) + 0.5
    drawn = classes.where(spread < share).orderBy(spread).limit(PIVOTS).select("part", "unit").collect()
    found: dict[str, list] = {}
    for r in drawn:
        x, mine = np.frombuffer(bytes(r.unit), "<f8"), found.setdefault(r.part, [])
        if len(mine) < PER_LABEL and all(np.sqrt(max(0.0, 2 - 2 * (x @ p))) > 2 * radius for p in mine):
            mine.append(x)
    return {part: np.array(rows) for part, rows in found.items()}


def cells_of(classes: DataFrame, pivots: dict[str, np.ndarray], radius: float) -> DataFrame:
    """``part, cell, own, node, weight, unit``: each class in its own cell, and as a copy
    (``own`` false) in every other cell that may hold partners."""
    slack = 1e-9

    def run(batches):
        for batch in batches:
            parts = np.array(batch.column("part").to_pylist(), object)
            units = batch.column("unit").to_pylist()
            at, cell, own = [], [], []
            for part in set(parts):
                rows = np.flatnonzero(parts == part)
                p = pivots.get(part)
                if p is None or len(p) == 1:
                    at.append(rows), cell.append(np.zeros(len(rows), int)), own.append(np.ones(len(rows), bool))
                    continue
                d = np.sqrt(np.maximum(0.0, 2 - 2 * (_matrix([units[i] for i in rows]) @ p.T)))
                between = np.sqrt(np.maximum(0.0, 2 - 2 * (p @ p.T)))
                near = d.argmin(axis=1)
                least = d[np.arange(len(rows)), near][:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d**2 - least**2) / (2 * between[near])
                hit = (d <= least + 2 * radius + slack) & (plane <= radius + slack)
                hit[np.arange(len(rows)), near] = True
                i, j = np.nonzero(hit)
                at.append(rows[i]), cell.append(j), own.append(near[i] == j)
            if not at:
                continue
            order = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").take(order), pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(own)),
                 *(batch.column(c).take(order) for c in ("node", "weight", "unit"))],
                names=["part", "cell", "own", "node", "weight", "unit"],
            )

    return classes.select("part", "node", "weight", "unit").mapInArrow(
        run, "part string, cell int, own boolean, node long, weight long, unit binary"
    )


def join_tile(left: pd.DataFrame, right: pd.DataFrame, least: float) -> pd.DataFrame:
    """``node, links, root``: rows of the right within reach of each left row, by weight, and
    the least node of the local component of each row."""
    a, b = _matrix(left["unit"]), _matrix(right["unit"])
    weight, near = right["weight"].to_numpy(), np.zeros((len(a), len(b)), bool)
    for i in range(0, len(a), BLOCK):
        near[i : i + BLOCK] = a[i : i + BLOCK] @ b.T >= least
    links = near @ weight
    ids = left["node"].to_numpy(), right["node"].to_numpy()
    root, todo = [x.copy() for x in ids], np.ones(len(a), bool)
    for start in np.argsort(ids[0]):
        if not todo[start]:
            continue
        rows, cols = np.zeros(len(a), bool), np.zeros(len(b), bool)
        new = np.zeros(len(a), bool)
        new[start] = True
        while new.any():
            rows |= new
            fresh = near[new].any(axis=0) & ~cols
            cols |= fresh
            new = near[:, fresh].any(axis=1) & ~rows if fresh.any() else np.zeros(len(a), bool)
        todo &= ~rows
        low = min([ids[0][start], *ids[1][cols]])
        root[0][rows], root[1][cols] = low, np.minimum(root[1][cols], low)
    out = pd.DataFrame({"node": np.concatenate(ids), "links": np.concatenate([links, np.zeros(len(b), int)]), "root": np.concatenate(root)})
    return out[(out["links"] > 0) | (out["root"] != out["node"])]


def near_vectors(
    df: DataFrame, keep: list[str], key: str, vec: str, label: str, *, cosine: float = 0.98
) -> DataFrame:
    """Add ``n_links``, ``component_id`` and ``kept`` to the columns ``keep``."""
    radius = math.sqrt(2 - 2 * cosine)
    keep = [c for c in keep if c not in ("n_links", "component_id", "kept")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept")  # apart from names used below
    src = df.select(
        row, F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{label}`").cast("string").alias("_label"), F.col(f"`{vec}`").alias("_vec")
    )
    rows = unit_vectors(src, ["_kept", "_key", "_label"], "_vec").withColumn("_row", F.monotonically_increasing_id())
    valid = F.col("unit").isNotNull() & F.col("_label").isNotNull()
    rows = saved(rows.withColumn("part", F.when(valid, F.concat_ws(":", "_label", "dim"))), "vectors")
    last = F.lit((1 << 63) - 1)
    classes = rows.where("part is not null").groupBy("part", "digest").agg(
        F.min("_row").alias("node"), F.min(F.struct(F.coalesce("_key", last).alias("k"), F.col("_row").alias("r"))).alias("best"),
        F.count("*").alias("weight"), F.first("unit").alias("unit"),
    )
    classes = saved(classes, "vector-classes")
    placed = saved(cells_of(classes, pivots_of(classes, radius), radius), "vector-cells")
    sizes = placed.groupBy("part", "cell").agg(F.count("*").alias("all"), F.count_if("own").alias("mine"))
    tiled = placed.join(sizes, ["part", "cell"])
    tiles = lambda c: F.ceil(F.col(c) / TILE).cast("int")
    spot = lambda c: F.pmod(F.xxhash64("node"), tiles(c)).cast("int")
    upto = lambda c: F.sequence(F.lit(0), F.greatest(tiles(c), F.lit(1)) - 1)
    left = tiled.where("own").withColumn("a", spot("mine")).withColumn("b", F.explode(upto("all"))).withColumn("is_left", F.lit(True))
    right = tiled.where("mine > 0").withColumn("b", spot("all")).withColumn("a", F.explode(upto("mine"))).withColumn("is_left", F.lit(False))
    columns = ["part", "cell", "a", "b", "is_left", "node", "weight", "unit"]

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        side = frame["is_left"].to_numpy(bool)
        if not side.any() or side.all():
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        return join_tile(frame[side], frame[~side], cosine)

    both = left.select(columns).unionByName(right.select(columns))
    found = saved(both.groupBy("part", "cell", "a", "b").applyInPandas(compare, "node long, links long, root long"), "vector-links")
    links = found.groupBy("node").agg((F.sum("links") - 1).alias("n_links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = classes.select("part", "digest", "node", "best").join(links, "node", "left").join(roots, "node", "left")
    named = saved(named.withColumn("root", F.coalesce("root", "node")), "vector-roots")
    best = named.groupBy("root").agg(F.min("best").alias("first"))
    whole = saved(named.join(best, "root").select("part", "digest", F.coalesce("n_links", F.lit(0)).alias("n_links"), "first"), "vector-named")
    out = rows.drop("unit").join(whole, ["part", "digest"], "left")
    return out.select(
        "_kept.*", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.nullif(F.col("first.k"), last), F.col("_key")).alias("component_id"),
        F.coalesce(F.col("first.r") == F.col("_row"), F.lit(True)).alias("kept"),
    )


def op3_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), ["vec_id"], "vec_id", "embedding", "label")


#: All pairs of a label, and everything reachable over links.
OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT links.b, reach.other FROM reach JOIN links ON links.a = reach.node
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT node AS vec_id, min(other) AS component_id FROM reach GROUP BY node)
"""
