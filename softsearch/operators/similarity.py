"""Exact keyed top-k similarity join, the core of search and of the cache.

Both sides carry vectors and a few string keys (a cluster, or cache and bucket). For every
left row the ``k`` most similar right rows that share a key are wanted. No pair leaves a
task unless it is among the best ``k`` seen there, and there is no cross join: vectors meet
as blocks of a matrix product inside tasks. Three physical forms give the same rows:

* right side small: it is shipped to the tasks that scan the left side; no shuffle;
* left side small: it is shipped to the tasks that scan the right side, which keep a running
  top-k per left row; only these winners are shuffled;
* both large: every key is cut into tiles of bounded size on both sides (so a key that
  holds a third of all rows is many tiles), and tiles meet by an equi-join.

"Small" is measured, see ``max_bytes``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from softsearch.config import BROADCAST_BYTES, TILE_BYTES, broadcast_if_small, cut_lineage
from softsearch.operators.fcm import to_matrix

#: similarities that agree to this many decimals are ties, decided by key rank and order
SIM_DECIMALS = 9
#: more than rounding to these decimals can move a similarity
_SLACK = 1e-9
#: left and right rows of one block of a matrix product
_ROWS, _COLS = 512, 4096
#: columns that a row without a match is multiplied with first
_FIRST_COLS = 256
#: winners that a task holds besides those of one block
_HELD = 1 << 20
#: bytes of a winner that a scan of the right side keeps for each left row
_WINNER_BYTES = 64
#: winners that leave a task in one batch
_OUT_ROWS = 1 << 16

PAIRS = "left_id string, right_id string, similarity double, key_rank int, ord long"


@dataclass
class Side:
    """Rows of one side inside a task. Places of the right side are in tie-break order; rows
    with equal ids have equal codes. ``groups`` holds the places of each (rank of the key in
    its row, key); where ranks do not count they are 0, so there are no more groups than keys.
    ``bound`` is a left row's floor or a right row's cell."""

    ids: pa.Array
    code: np.ndarray
    vec: np.ndarray
    ord: np.ndarray
    groups: dict[tuple[int, str], np.ndarray]
    bound: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, cells: Any = None, ranked: bool = False) -> Side:
        """``table(id, vec, ord, bound)`` with ``keys``, or with ``key_rank`` where all rows have one key."""
        table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
        table = table.combine_chunks()
        vec = to_matrix(table.column("vec"))
        if cells is None:
            at = pc.sort_indices(table.select(["ord", "id"]), sort_keys=[("ord", "ascending"), ("id", "ascending")]).to_numpy()
        else:  # rows of one block have cells in common
            at = np.argsort(cells.nearest_pivot(vec), kind="stable")
        ids = _flat(table.column("id")).take(pa.array(at))
        code = pc.fill_null(ids.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        order, bound = (table.column(c).to_numpy()[at] for c in ("ord", "bound"))
        place = np.empty(len(at), np.int64)
        place[at] = np.arange(len(at))
        if "key_rank" in table.column_names:
            row, rank = np.arange(len(at)), table.column("key_rank").to_numpy()
            names, key = [""], np.zeros(len(at), np.int64)
        else:
            row, rank, names, key = _exploded(_flat(table.column("keys")))
        return cls(ids, code, vec[at], order, _groups(place[row], rank if ranked else np.zeros(len(row), np.int64), names, key), bound)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def _exploded(keys: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Row, rank and number of each key that is not null, and the keys."""
    sizes = pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    coded = keys.flatten().dictionary_encode()
    key = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return row[key >= 0], rank[key >= 0], coded.dictionary.to_pylist(), key[key >= 0]


def _groups(place: np.ndarray, rank: np.ndarray, names: list[str], key: np.ndarray) -> dict[tuple[int, str], np.ndarray]:
    at = np.lexsort((place, key, rank))
    place, rank, key = place[at], rank[at], key[at]
    once = np.append(True, (np.diff(place) != 0) | (np.diff(key) != 0) | (np.diff(rank) != 0))[: len(at)]
    place, rank, key = place[once], rank[once], key[once]
    new = np.flatnonzero(np.diff(rank, prepend=-1).astype(bool) | np.diff(key, prepend=-1).astype(bool))
    return {(int(rank[i]), names[key[i]]): part for i, part in zip(new, np.split(place, new[1:]))} if len(place) else {}


@dataclass(frozen=True)
class Rule:
    """Which pairs count: similarity floor, and whether the right row must come earlier.

    ``unique`` says that no pair of rows shares more than one key; ``cells`` knows which cells
    may hold rows as similar as a left row's floor, see ``pivots``. With ``any_match`` one pair
    that counts is enough for a left row, be it the best or not.
    """

    k: int
    min_sim: float | None = None
    earlier: bool = False
    ranked_keys: bool = False
    unique: bool = False
    cells: Any = None
    any_match: bool = False

    @property
    def shared(self) -> bool:
        """Whether what a row found under one key bounds what it needs under others."""
        return self.unique or self.k == 1

    def floors(self, left: Side) -> np.ndarray:
        least = -np.inf if self.min_sim is None else self.min_sim
        return np.fmax(left.bound.astype(float), least) if self.cells is not None else np.full(len(left.ids), least)


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_NONE: Found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))


def _cut(code: np.ndarray, found: Found, rule: Rule) -> Found:
    """The best ``k`` per left id of ``found``: left and right places, similarities, key ranks."""
    r, c, s, g = found
    owner = code[r]
    at = np.lexsort((c, g, -s, owner))
    if rule.k > 1 and not rule.unique:  # of a pair the first is the best
        _, first = np.unique(r[at] * (c.max(initial=0) + 1) + c[at], return_index=True)
        at = at[np.sort(first)]
    owner = owner[at]
    at = at[np.arange(len(at)) - np.searchsorted(owner, owner, side="left") < rule.k]
    return r[at], c[at], s[at], g[at]


def _raise(low: np.ndarray, code: np.ndarray, r: np.ndarray, s: np.ndarray, k: int) -> None:
    """Raise the floors of rows that have ``k`` winners, given sorted ones of whole rows."""
    owner = code[r]
    last = np.arange(len(r)) - np.searchsorted(owner, owner, side="left") == k - 1
    low[r[last]] = np.maximum(low[r[last]], s[last])


def _block(left: Side, right: Side, rows: np.ndarray, cols: np.ndarray, low: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """The best ``k`` of ``cols`` for each of ``rows`` that reach ``low``: left and right places
    and similarities. Columns are multiplied part by part; the best so far raise the floor."""
    x, k = left.vec[rows], rule.k
    low, br, bc, bs = low.copy(), _NONE[0], _NONE[1], _NONE[2]
    one, first = np.full(len(rows), -np.inf), np.zeros(len(rows), np.int64)
    for offset in range(0, len(cols), _COLS):
        part = cols[offset : offset + _COLS]
        sims = x @ right.vec[part].T
        if rule.earlier:
            sims[right.ord[part][None, :] >= left.ord[rows][:, None]] = -np.inf
        if k == 1:  # the first maximum is the first in tie-break order
            top = np.round(sims.max(axis=1), SIM_DECIMALS)
            up = np.flatnonzero((top > one) & (top >= low))
            if len(up):
                one[up] = top[up]
                first[up] = part[(np.round(sims[up], SIM_DECIMALS) >= top[up, None]).argmax(axis=1)]
            continue
        near = sims >= (low - _SLACK)[:, None]
        if len(part) > k and np.count_nonzero(near) > 4 * k * len(rows):
            least = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
            low = np.fmax(low, np.round(least, SIM_DECIMALS))
            near = sims >= (low - _SLACK)[:, None]
        r, c = np.nonzero(near)
        s = np.round(sims[r, c], SIM_DECIMALS)
        ok = np.isfinite(s) & (s >= low[r])
        if not ok.any():
            continue
        r, c, s = np.append(br, r[ok]), np.append(bc, part[c[ok]]), np.append(bs, s[ok])
        at = np.lexsort((c, -s, r))
        r, c, s = r[at], c[at], s[at]
        place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        br, bc, bs = (v[place < k] for v in (r, c, s))
        full = place[place < k] == k - 1
        low[br[full]] = np.maximum(low[br[full]], bs[full])
    if k == 1:
        br = np.flatnonzero(np.isfinite(one))
        bc, bs = first[br], one[br]
    return rows[br], bc, bs


def _matched(left: Side, right: Side, rows: np.ndarray, cols: np.ndarray, low: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """One of ``cols`` for each of ``rows`` that reaches ``low``, as ``_block``. A row is multiplied
    until its first match, with more and more columns, so rows with many matches cost little."""
    found, start, width = [_NONE[:3]], 0, _FIRST_COLS
    rows, low = rows[low < np.inf], low[low < np.inf]
    while start < len(cols) and len(rows):
        part = cols[start : start + width]
        sims = left.vec[rows] @ right.vec[part].T
        if rule.earlier and right.ord[part[-1]] >= left.ord[rows].min():
            sims[right.ord[part][None, :] >= left.ord[rows][:, None]] = -np.inf
        at = sims.argmax(axis=1)
        top = np.round(sims[np.arange(len(rows)), at], SIM_DECIMALS)
        hit = np.isfinite(top) & (top >= low)
        found.append((rows[hit], part[at[hit]], top[hit]))
        rows, low = rows[~hit], low[~hit]
        start, width = start + width, min(2 * width, _COLS)
    return tuple(map(np.concatenate, zip(*found)))


def _winners(left: Side, right: Side, rule: Rule, low: np.ndarray, near: dict) -> Iterator[Found]:
    """Per left row its best ``k`` right rows over all shared keys that reach ``low``, for
    so many left rows at a time that about ``_HELD`` winners are held. ``near`` keeps which cells the
    blocks of the left side search, for all batches of the right side."""
    by_key: dict[str, list[np.ndarray]] = {}
    for (_, key), cols in right.groups.items():
        by_key.setdefault(key, []).append(cols)
    columns = {key: np.sort(np.concatenate(parts)) for key, parts in by_key.items()}
    cell = right.bound.astype(np.int64) if rule.cells is not None else None
    step = max(_ROWS, _HELD // rule.k)
    for begin in range(0, len(left.ids), step):
        own, parts, held = low.copy(), [_NONE], 0
        for (rank, key), rows in left.groups.items():
            if key not in columns:
                continue
            rows = rows[np.searchsorted(rows, begin) : np.searchsorted(rows, begin + step)]
            for start in range(0, len(rows), _ROWS):
                block, cols = rows[start : start + _ROWS], columns[key]
                if rule.earlier:  # what comes later is not multiplied
                    cols = cols[: int(np.searchsorted(right.ord[cols], left.ord[block].max()))]
                if rule.cells is not None:
                    at = (begin, rank, key, start)
                    if at not in near:
                        near[at] = rule.cells.possible(left.vec[block], left.bound[block]).any(axis=0)
                    cols = cols[near[at][cell[cols]]]
                r, c, s = (_matched if rule.any_match else _block)(left, right, block, cols, own[block], rule)
                if not len(r):
                    continue
                if rule.any_match:  # needs no other
                    own[r] = np.inf
                parts.append((r, c, s, np.full(len(r), rank if rule.ranked_keys else 0)))
                held += len(r)
                if held > 2 * _HELD:
                    parts = [_cut(left.code, tuple(map(np.concatenate, zip(*parts))), rule)]
                    held = len(parts[0][0]) - _HELD
                    if rule.shared:
                        _raise(own, left.code, parts[0][0], parts[0][2], rule.k)
        if len(parts) > 1:
            yield _cut(left.code, tuple(map(np.concatenate, zip(*parts))), rule)


def _batches(left: Side, r: np.ndarray, right_ids: pa.Array, s: np.ndarray, g: np.ndarray, o: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(r), _OUT_ROWS):
        part = slice(i, i + _OUT_ROWS)
        yield pa.RecordBatch.from_arrays(
            [
                left.ids.take(pa.array(r[part])), right_ids.slice(i, _OUT_ROWS), pa.array(s[part].astype(np.float64)),
                pa.array(g[part].astype(np.int32)), pa.array(o[part].astype(np.int64)),
            ],
            names=["left_id", "right_id", "similarity", "key_rank", "ord"],
        )


def _all_winners(left: Side, right: Side, rule: Rule) -> Iterator[pa.RecordBatch]:
    for r, c, s, g in _winners(left, right, rule, rule.floors(left), {}):
        yield from _batches(left, r, right.ids.take(pa.array(c)), s, g, right.ord[c])


def _take_small(df: DataFrame, max_bytes: int) -> pa.Table | None:
    """The side as one Arrow table if its vectors, ids and keys fit the bound, else None."""
    keys = F.aggregate("keys", F.lit(0), lambda n, k: n + F.coalesce(F.octet_length(k), F.lit(0)) + 8)
    row = F.coalesce(F.size("vec"), F.lit(0)) * 8 + F.coalesce(F.octet_length("id"), F.lit(0)) + F.coalesce(keys, F.lit(0)) + 32
    if (df.agg(F.sum(row.cast("long"))).first()[0] or 0) > max_bytes:
        return None
    return df.toArrow()


def _scan_left(left: DataFrame, small: pa.Table, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = Side.of(small)
        for batch in batches:
            if batch.num_rows:
                yield from _all_winners(Side.of(batch, rule.cells, rule.ranked_keys), right, rule)

    return left.mapInArrow(run, PAIRS)


def _scan_right(small: pa.Table, right: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, near = Side.of(small, rule.cells, rule.ranked_keys), {}
        low, ids = rule.floors(left), pa.array([], pa.string())
        r, s, g, o = _NONE[0], _NONE[2], _NONE[3], _NONE[0]
        for batch in batches:
            side = Side.of(batch)
            for fr, fc, fs, fg in _winners(left, side, rule, low, near):
                touched = np.zeros(int(left.code.max()) + 2, bool)  # the last is that of null ids
                touched[left.code[fr]] = True
                same = touched[left.code[r]]  # these rows are ranked anew
                found = pa.concat_arrays([ids.filter(pa.array(same)), side.ids.take(pa.array(fc))])
                fr, fs, fg, fo = (np.append(a[same], b) for a, b in ((r, fr), (s, fs), (g, fg), (o, side.ord[fc])))
                order = pa.table({"l": left.code[fr], "s": fs, "g": fg, "o": fo, "id": found})
                at = pc.sort_indices(order, sort_keys=[("l", "ascending"), ("s", "descending"), ("g", "ascending"), ("o", "ascending"), ("id", "ascending")]).to_numpy()
                owner = left.code[fr[at]]
                at = at[np.arange(len(at)) - np.searchsorted(owner, owner, side="left") < rule.k]
                if rule.shared:
                    _raise(low, left.code, fr[at], fs[at], rule.k)
                ids = pa.concat_arrays([ids.filter(pa.array(~same)), found.take(pa.array(at))])
                r, s, g, o = (np.append(a[~same], b[at]) for a, b in ((r, fr), (s, fs), (g, fg), (o, fo)))
        yield from _batches(left, r, ids, s, g, o)

    return right.mapInArrow(run, PAIRS)


def _tiled(left: DataFrame, right: DataFrame, rule: Rule, tile_rows: int) -> DataFrame:
    """Cut every key into tiles on both sides and join tile with tile."""

    def spread(df: DataFrame) -> DataFrame:
        ranked = df.select("id", "vec", "ord", "bound", F.posexplode("keys").alias("key_rank", "key"))
        return ranked.where(F.col("key").isNotNull())

    def tiles(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias(name))

    lhs, rhs = spread(left), spread(right)
    # one row per key with more than one tile: at most (rows / tile_rows) of them
    grid = tiles(lhs, "n_l").join(tiles(rhs, "n_r"), "key").where("n_l > 1 OR n_r > 1")
    grid = broadcast_if_small(cut_lineage(grid))

    def place(df: DataFrame, is_left: bool) -> DataFrame:
        own, other = ("l", "r") if is_left else ("r", "l")
        number = lambda side: F.coalesce(F.col(f"n_{side}"), F.lit(1))
        return (
            df.join(grid, "key", "left")
            .withColumn(f"tile_{own}", F.pmod(F.xxhash64("id"), number(own)).cast("int"))
            .withColumn(f"tile_{other}", F.explode(F.sequence(F.lit(0), number(other) - 1)))
            .select("key", "tile_l", "tile_r", F.lit(is_left).alias("is_left"), "id", "vec", "ord", "bound", "key_rank")
        )

    def run(cell: pa.Table) -> pa.Table:  # of one key
        is_left = cell.column("is_left")
        lhs = cell.filter(is_left)
        rhs = cell.filter(pc.invert(is_left))
        del cell
        found = [pa.RecordBatch.from_pylist([], _PAIRS)]
        if lhs.num_rows and rhs.num_rows:
            found += _all_winners(Side.of(lhs, rule.cells, rule.ranked_keys), Side.of(rhs), rule)
        return pa.Table.from_batches(found)

    cells = place(lhs, True).unionByName(place(rhs, False))
    return cells.groupBy("key", "tile_l", "tile_r").applyInArrow(run, PAIRS)


_PAIRS = pa.schema([("left_id", pa.string()), ("right_id", pa.string()), ("similarity", pa.float64()), ("key_rank", pa.int32()), ("ord", pa.int64())])


def similarity_pairs(
    left: DataFrame,
    right: DataFrame,
    k: int,
    *,
    min_sim: float | None = None,
    earlier: bool = False,
    ranked_keys: bool = False,
    unique_pairs: bool = False,
    prefer_small: str = "right",
    max_bytes: int = BROADCAST_BYTES,
    tile_bytes: int = TILE_BYTES,
    cells: Any = None,
    any_match: bool = False,
) -> DataFrame:
    """The winners of all tasks, ``PAIRS``, which ``best_pairs`` ranks. With ``cells`` (of
    ``pivots``) a column ``bound`` holds a left row's floor, or null, and a right row's cell."""
    rule = Rule(k, min_sim, earlier, ranked_keys, unique_pairs, cells, any_match)
    none = F.lit(None).cast("double").alias("bound")
    left, right = (df.select("id", "vec", "ord", "keys", none if cells is None else F.col("bound")) for df in (left, right))
    for side in (prefer_small, "left" if prefer_small == "right" else "right"):
        small = _take_small(left if side == "left" else right, max_bytes)
        if small is not None and side == "right":
            return _scan_left(left, small, rule)
        if small is not None:  # so many left rows at a time that their winners fit as well
            n = max(1, max_bytes // (_WINNER_BYTES * k))
            parts = [small.slice(i, n) for i in range(0, small.num_rows, n)] or [small]
            return reduce(DataFrame.unionByName, [_scan_right(part, right, rule) for part in parts])
    width = left.agg(F.max(F.size("vec"))).first()[0] or 0
    return _tiled(left, right, rule, max(1, tile_bytes // (8 * max(1, width))))


def best_pairs(pairs: DataFrame, k: int, unique_pairs: bool = False) -> DataFrame:
    """Final ranking of the winners of all tasks."""
    if k > 1 and not unique_pairs:
        pairs = pairs.groupBy("left_id", "right_id").agg(
            F.max("similarity").alias("similarity"), F.min("key_rank").alias("key_rank"), F.min("ord").alias("ord")
        )
    w = Window.partitionBy("left_id").orderBy(F.desc("similarity"), "key_rank", "ord", "right_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def similar_rows(left: DataFrame, right: DataFrame, min_sim: float, **options: Any) -> DataFrame:
    """``(left_id)`` of the left rows with a right row that shares a key and is similar enough."""
    return similarity_pairs(left, right, 1, min_sim=min_sim, any_match=True, **options).select("left_id").distinct()


def similarity_topk(left: DataFrame, right: DataFrame, k: int, *, unique_pairs: bool = False, **options: Any) -> DataFrame:
    """``(left_id, right_id, similarity, key_rank, ord, rank)``, ``rank`` from 1.

    Both sides need ``id STRING`` (unique), ``vec``, ``ord LONG`` (tie-break, and the clock
    for ``earlier``) and ``keys ARRAY<STRING>``. With ``ranked_keys`` a tie goes to the pair
    that meets in the left row's first key; ``unique_pairs`` promises that no two rows share
    more than one key, which saves a step. ``prefer_small`` is the side measured first.
    """
    return best_pairs(similarity_pairs(left, right, k, unique_pairs=unique_pairs, **options), k, unique_pairs)
