"""MinHash near-duplicate search: minima, bands, signatures, full sets, components.

1. One pass over the texts gives every document the digest of its shingle set, up to
   ``HASHES`` minima of universal hashes, as one key per band, and a byte of each minimum
   as its signature. Documents with equal sets are one class, the rest is about classes.
2. Classes that share a band key form a bucket. Each is linked to the least of its bucket if
   the signatures allow it and the full sets, computed in a second pass for these classes
   only, confirm it. Components of these links settle most of each bucket.
3. Pairs of a bucket that are still in different components are compared inside tasks:
   by signature first, and those that pass by full sets, in the first band that they share.
   Only links that join components leave a task. Buckets above ``TILE`` classes, or above
   ``TILE_BYTES`` of sets, are cut into tiles, and every two tiles meet in a task of their own.
4. Components again, by alternating large-star and small-star.

No pair of copies is ever listed, and no partner is left out: a pair at the similarity limit
misses all bands with a probability of ``MISS`` at most and fails the signature test with
less than 1e-6; whatever is linked has been confirmed on the full sets.

Defined results: a null text, an empty one and one without words have an empty set, are
linked with nothing and kept; below ``size`` words the whole sequence is the one shingle;
repeated rows are copies; a null key counts as the greatest; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import give_back, map_texts, saved, slices, table
from softsearch.llm.components import components

#: Hash functions at most, and chance at most that a pair at the limit shares no band.
HASHES, MISS = 192, 1e-6
#: Signatures agree in this many standard deviations less than the limit at least.
DEVIATIONS = 5
#: Classes of a bucket, and bytes of their sets on average, that a task compares with each other.
TILE, TILE_BYTES = 1024, 16 << 20
#: Bits of the filter that tells the second pass which documents to look at.
FILTER_BITS = 1 << 23
#: Distinct words whose hash a task remembers.
REMEMBERED = 200_000
#: Multipliers of a 64-bit finaliser.
GOLDEN, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def chained(columns, start: np.ndarray) -> np.ndarray:
    for c in columns:
        start = mix(start * GOLDEN + c)
    return start


class Shingles:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z in lower case."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in {w for w in words if w not in known}:
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(hashes))
        if not n:
            return hashes
        last = len(hashes) - n + 1
        return np.unique(chained((hashes[i : last + i] for i in range(n)), np.full(last, n, np.uint64)))


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of universal hashes modulo 2**64."""
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed))
    return x[:n] | np.uint64(1), x[n:]


def minima(items: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = family
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(items), 256):
        least = np.minimum(least, (items[i : i + 256, None] * a + b).min(axis=0))
    return least


def banding(percent: int) -> tuple[int, int]:
    """Rows of a band and number of bands: the longest bands that keep to ``MISS``."""
    s = percent / 100
    return next(((r, HASHES // r) for r in range(12, 0, -1) if (1 - s**r) ** (HASHES // r) <= MISS), (1, HASHES))


def sketches(df: DataFrame, keep: list[str], text: str, size: int, seed: int, percent: int) -> DataFrame:
    per_band, bands = banding(percent)

    def make():
        shingles, family = Shingles(size), hash_family(per_band * bands, seed)

        def func(texts):
            rows = []
            for value in texts:
                items = shingles(value)
                if not len(items):
                    rows.append((0, None, None, None))
                    continue
                least = minima(items, family)
                by_band = least.reshape(bands, per_band)
                keys = chained((by_band[:, i] for i in range(per_band)), np.arange(1, bands + 1, dtype=np.uint64))
                rows.append((
                    len(items), hashlib.blake2b(items.tobytes(), digest_size=16).digest(), keys.astype("<u8").tobytes(),
                    (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes(),
                ))
            return list(zip(*rows)) if rows else [[]] * 4

        return func

    return map_texts(df, text, keep, make, "n_shingles long, digest binary, bands binary, sig binary")


def full_sets(df: DataFrame, key: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """``node, items`` of the classes ``wanted`` (``node, digest, least``): the second pass.

    A bitmap of hashed keys, of fixed size, spares the documents that are surely not wanted;
    what it lets through too much goes in the join on the digest."""
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = wanted.select(spot(F.col("least")).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    # F.bitmap_bucket_number starts at 1 for positions above 0; 32,768 positions per bucket
    parts = {r.k: bytes(r.bits) for r in bits.collect()}
    src = df.select(spot(F.col(f"`{key}`")).alias("p"), F.col(f"`{text}`").alias("text"))
    src = src.withColumns({"k": F.bitmap_bucket_number("p"), "b": F.bitmap_bit_position("p")})

    def run(batches):
        shingles = Shingles(size)
        for whole in batches:
            for at, n in slices(whole.column("text")):
                batch = whole.slice(at, n)
                rows = []
                for i, (k, b) in enumerate(zip(batch.column("k").to_pylist(), batch.column("b").to_pylist())):
                    if k in parts and parts[k][b >> 3] >> (b & 7) & 1:
                        items = shingles(batch.column("text")[i].as_py())
                        rows.append((hashlib.blake2b(items.tobytes(), digest_size=16).digest(), items.astype("<u8").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.binary()) for i in range(2)], names=["digest", "items"]
                )
        give_back()

    found = src.mapInArrow(run, "digest binary, items binary")
    return found.join(wanted.select("node", "digest"), "digest").select("node", "items").dropDuplicates(["node"])


def shared(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, none of them empty."""
    whole = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, whole), len(x) - 1)
    starts = np.cumsum([0, *map(len, others)])[:-1]
    return np.add.reduceat((x[at] == whole).astype(np.int64), starts)


def may_link(sig: np.ndarray, n: np.ndarray, i, j, limit: int) -> np.ndarray:
    """Whether sizes and signatures allow a similarity of ``limit`` percent (broadcast)."""
    s = limit / 100
    least = s - DEVIATIONS * (s * (1 - s) / sig.shape[1]) ** 0.5
    sizes = np.minimum(n[i], n[j]) * 100 >= limit * np.maximum(n[i], n[j])
    return sizes & ((sig[i] == sig[j]).mean(axis=-1) >= least)


def _checked(pairs: DataFrame, limit: int) -> DataFrame:
    """``a, b`` of the pairs whose sets ``items_a``, ``items_b`` are similar enough."""

    def run(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (a, b))
                n = int(shared(x, [y])[0])
                ok.append(100 * n >= limit * (len(x) + len(y) - n))
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _signed(pairs: DataFrame, limit: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b")]
            n = np.concatenate([batch.column(c).to_numpy() for c in ("n_a", "n_b")])
            rows = np.arange(batch.num_rows)
            ok = may_link(np.concatenate(sig), n, rows, rows + batch.num_rows, limit)
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _open_pairs(frame: pd.DataFrame, limit: int):
    """For each class of a tile the later ones that it may be linked with: in another
    component, first met in this band, allowed by size and signature."""
    sig = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(len(frame), -1)
    bands = np.frombuffer(b"".join(frame["bands"]), "<u8").reshape(len(frame), -1)
    n, root, cell, band = frame["n_shingles"].to_numpy(), frame["root"].to_numpy(), frame["cell"].to_numpy(), int(frame["band"].iloc[0])
    two = len(set(cell)) > 1
    for i in range(len(frame) - 1):
        j = np.arange(i + 1, len(frame))
        j = j[(root[j] != root[i]) & ((cell[j] != cell[i]) | (not two))]
        if len(j):
            j = j[may_link(sig, n, i, j, limit)]
        if len(j) and band:
            j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
        if len(j):
            yield i, j


def link_classes(nodes: DataFrame, sets_of, limit: int) -> DataFrame:
    """``node, root`` of the classes ``nodes`` (node, digest, least, n_shingles, bands, sig)."""
    band_keys = F.transform(
        F.sequence(F.lit(0), F.lit(banding(limit)[1] - 1)), lambda i: F.struct(i.alias("band"), F.substring("bands", i * 8 + 1, F.lit(8)).alias("key"))
    )
    places = nodes.select("node", "n_shingles", F.explode(band_keys).alias("p")).select("node", "n_shingles", "p.band", "p.key")
    tiles = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n_shingles") * 8 / TILE_BYTES)).cast("int")
    buckets = places.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count("*").alias("many"), tiles.alias("tiles")).where("many > 1")
    members = saved(places.drop("n_shingles").join(buckets, ["band", "key"]), "minhash-members")
    star = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()

    def both(pairs, side, columns):
        for end in ("a", "b"):
            pairs = pairs.join(side.select(F.col("node").alias(end), *[F.col(c).alias(f"{x}_{end}") for c, x in columns.items()]), end)
        return pairs

    star = saved(_signed(both(star, nodes, {"sig": "sig", "n_shingles": "n"}), limit), "minhash-star")
    several = members.where("many > 2").select("node")
    wanted = star.select(F.col("a").alias("node")).union(star.select(F.col("b").alias("node"))).union(several).distinct()
    sets = saved(sets_of(nodes.join(wanted, "node").select("node", "digest", "least")), "minhash-sets")
    first = saved(components(_checked(both(star, sets, {"items": "items"}), limit)), "minhash-first")
    # what the stars left apart
    placed = members.where("many > 2").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("band", "key").agg((F.min("root") != F.max("root")).alias("apart")).where("apart").select("band", "key")
    cell = F.pmod(F.xxhash64("node"), "tiles").cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least(o, F.col("cell")).alias("low"), F.greatest(o, F.col("cell")).alias("high")))
    tiled = (
        saved(placed, "minhash-placed").join(apart, ["band", "key"]).withColumn("cell", cell)
        .select("band", "key", "node", "root", "cell", F.explode(pair).alias("tile")).select("*", "tile.low", "tile.high").drop("tile")
    )
    group = ["band", "key", "low", "high"]

    def active(frame: pd.DataFrame) -> pd.DataFrame:
        hit = sorted({x for i, j in _open_pairs(frame, limit) for x in (i, *j.tolist())})
        return frame.iloc[hit][[*group, "node", "root", "cell"]]

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        items = [np.frombuffer(x, "<u8") for x in frame["items"]]
        parent, found = {r: r for r in frame["root"]}, []

        def top(r):
            while parent[r] != r:
                r = parent[r]
            return r

        for i, j in _open_pairs(frame, limit):
            mine = frame["root"].iloc[i]
            j = np.array([k for k in j if top(frame["root"].iloc[k]) != top(mine)], int)
            if not len(j):
                continue
            n = shared(items[i], [items[k] for k in j])
            sizes = np.array([len(items[k]) for k in j])
            for k in j[100 * n >= limit * (len(items[i]) + sizes - n)]:
                x, y = top(mine), top(frame["root"].iloc[k])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((x, y))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    features = nodes.select("node", "n_shingles", "sig", "bands")
    kinds = "band int, key binary, low int, high int, node long, root long, cell int"
    busy = saved(tiled.join(features, "node").groupBy(*group).applyInPandas(active, kinds), "minhash-active")
    more = busy.join(features, "node").join(sets, "node").groupBy(*group).applyInPandas(links, "a long, b long")
    second = saved(components(more), "minhash-second").select(F.col("node").alias("root"), F.col("root").alias("top"))
    mine = nodes.select("node").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return mine.join(second, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def near_duplicates(
    df: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", *, size: int = 5, percent: int = 80, seed: int = 1
) -> DataFrame:
    """Add ``n_shingles``, ``component_id`` (the least key of the component) and ``kept`` (one
    row of each component: that of the least key) to the columns ``keep``."""
    keep = [c for c in keep if c not in ("n_shingles", "component_id", "kept")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept")  # apart from names used below
    src = df.select(row, F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    docs = saved(
        sketches(src, ["_kept", "_key"], "_text", size, seed, percent).withColumn("_row", F.monotonically_increasing_id()), "minhash-documents"
    )
    last = F.lit((1 << 63) - 1)
    rank = F.struct(F.coalesce("_key", last).alias("k"), F.col("_row").alias("r"))
    some = docs.where("n_shingles > 0")
    first = some.groupBy("digest").agg(F.min(rank).alias("first"), F.min_by(F.struct("n_shingles", "bands", "sig", "_key"), rank).alias("x"))
    nodes = saved(
        first.select(F.col("first.r").alias("node"), "digest", F.col("first.k").alias("least_key"), F.col("x._key").alias("least"), "x.n_shingles", "x.bands", "x.sig"),
        "minhash-classes",
    )
    roots = link_classes(nodes, lambda wanted: full_sets(src, "_key", "_text", size, wanted), percent)
    placed = saved(roots.join(nodes.select("node", "digest", "least_key"), "node"), "minhash-roots")
    named = placed.groupBy("root").agg(F.min(F.struct("least_key", "node")).alias("best"))
    classes = saved(placed.join(named, "root").select("digest", "best.least_key", "best.node"), "minhash-named")
    found = docs.drop("bands", "sig").join(classes, "digest", "left")
    own = F.coalesce(F.nullif("least_key", last), F.col("_key"))
    return found.select(
        "_kept.*", "n_shingles", own.alias("component_id"), F.coalesce(F.col("node") == F.col("_row"), F.lit(True)).alias("kept")
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], size=3, percent=85)


#: Pairs that share a shingle, and everything reachable over links.
OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT links.b, reach.other FROM reach JOIN links ON links.a = reach.node
)
SELECT r.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, r.doc_id = component_id AS kept
FROM (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) r LEFT JOIN n ON n.doc_id = r.doc_id
"""
