"""Operators on groups: near duplicates, vectors, components, chats, shards, and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from softsearch.llm import chat_format, metric_join, minhash, sharding
from softsearch.llm.common import table
from softsearch.llm.components import components
from softsearch.llm.queries import ORACLES, QUERIES


class Union:
    def __init__(self):
        self.up = {}

    def top(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


# components


def test_components_match_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5200)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    rows = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(rows).collect()}
    assert found == {x: u.top(x) for x in u.up if u.top(x) != x}
    assert components(rows.limit(0)).count() == 0


# near duplicates of texts


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute_components(rows, size, percent):
    u, sets = Union(), {k: shingles(t, size) for k, t in rows}
    inverted = defaultdict(list)
    for k, s in sets.items():
        u.top(k)
        both = Counter(o for g in s for o in inverted[g])
        for o, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                u.join(o, k)
        for g in s:
            inverted[g].append(k)
    return {k: (u.top(k), len(s)) for k, s in sets.items()}


def same(out, want):
    assert len(out) == len(want)
    for r in out:
        assert (r.component_id, r.n_shingles) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_minhash_matches_brute_force(spark, small):
    docs = table(spark, small, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    same(minhash.near_duplicates(docs, ["doc_id"], size=3, percent=85).collect(), brute_components(rows, 3, 85))


@pytest.mark.parametrize("bound, value", [("TILE", 16), ("TILE_BYTES", 16_000)])
def test_minhash_on_one_large_group_cut_into_tiles(spark, monkeypatch, bound, value):
    monkeypatch.setattr(minhash, bound, value)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):  # around the limit, so that many pairs must be refused
        text = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    want = brute_components(rows, 3, 85)
    assert 1 < len({c for c, _ in want.values()}) < 150
    same(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], size=3, percent=85).collect(), want)


def test_minhash_on_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(9, "a b c d e f g"), (3, "A b  c\nd e f g"), (None, "a b c d e f g"), (4, None), (5, ""), (6, " \n"), (7, "one two"), (2, "ONE two"),
            (2, "ONE two"), (11, long), (12, long + " more"), (None, "alone here"), (13, "É a"), (14, "é a")]
    docs = spark.createDataFrame([(*r, "k", "x", 1, b"d") for r in rows], "doc_id long, text string, kept string, node string, _n int, digest binary")
    out = minhash.near_duplicates(docs, ["doc_id", "text", "node", "digest"]).collect()
    assert len(out) == len(rows) and all(r.node == "x" for r in out)
    got = Counter((r.doc_id, r.component_id, r.n_shingles > 0, r.kept) for r in out)
    assert got == Counter([(9, 3, True, False), (3, 3, True, True), (None, 3, True, False), (4, 4, False, True), (5, 5, False, True), (6, 6, False, True),
                           (7, 2, True, False), (2, 2, True, True), (2, 2, True, False), (11, 11, True, True), (12, 11, True, False), (None, None, True, True),
                           (13, 13, True, True), (14, 14, True, True)])
    assert minhash.near_duplicates(docs.limit(0), ["doc_id"]).count() == 0


def test_banding_keeps_to_its_chance():
    for percent in range(50, 100):
        rows, bands = minhash.banding(percent)
        assert rows * bands <= minhash.HASHES and (1 - (percent / 100) ** rows) ** bands <= minhash.MISS


# vectors


def brute_links(rows, least):
    u, links = Union(), Counter()
    unit = {k: np.array(v) / np.linalg.norm(v) for k, v, _ in rows}
    for i, (a, x, la) in enumerate(rows):
        u.top(a)
        for b, y, lb in rows[:i]:
            if la == lb and len(x) == len(y) and unit[a] @ unit[b] >= least:
                u.join(a, b), links.update([a, b])
    return {k: (links[k], u.top(k)) for k, _, _ in rows}


@pytest.mark.parametrize("cell, tile", [(512, 2048), (8, 5)])
def test_metric_join_matches_brute_force(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "TILE", tile)
    rng, rows = np.random.default_rng(4), []
    for label in range(3):
        for center in rng.normal(size=(12, 6)):
            for _ in range(rng.integers(1, 9)):
                v = center + rng.normal(size=6) * 0.12
                rows += [(len(rows), [float(x) for x in v], label)]
    rows += [(len(rows) + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(5)]
    want = brute_links(rows, 0.98)
    assert 20 < sum(n for n, _ in want.values())
    out = metric_join.near_vectors(spark.createDataFrame(rows, "id long, v array<double>, l int"), ["id"], "id", "v", "l").collect()
    assert {r.id: (r.n_links, r.component_id) for r in out} == want and all(r.kept == (r.id == r.component_id) for r in out)


def test_metric_join_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0),
            (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [], 0), (11, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (12, [5.0, 5.0], 2), (12, [5.0, 5.0], 2)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, v array<double>, l int, part string, n_links int")
    got = Counter((r.id, r.n_links, r.component_id, r.kept and r.part == "x") for r in metric_join.near_vectors(docs, ["id", "part", "n_links"], "id", "v", "l").collect())
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == Counter([(1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (12, 1, 12, True), (12, 1, 12, False), *lone])
    assert metric_join.near_vectors(docs.limit(0), ["id"], "id", "v", "l").count() == 0


# chats


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, small, name):
    out = QUERIES[name](spark, small)
    rows = [tuple(r) for r in out.collect()]
    assert not compare.differences((out.columns, rows), compare.sql_rows(small, ORACLES[name]))


def test_chats_with_control_strings_and_odd_rows(spark):
    start, end = chat_format.START, chat_format.END
    rows = [(1, 0, "user", f"{start}x"), (1, 1, "assistant", r"a<\|b"), (1, 2, "as\nsistant<n|", r"<|foo|> <\\|"), (1, 3, None, None),
            (2, None, "assistant", f"é{end}\n"), (None, 1, "assistant", "x"), (3, 0, r"<\n|", "<"), (3, 0, r"<\n|", "<"), (3, 1, "assistant", "|im_end|>"),
            (4, 1, "assistant", "long " * 50_000), (6, 1, "user", "<|foo|> is no control string"), (5, 0, "user", f"{end}{start}assistant ok"), (5, 1, "assistant", f"{end}{start}assistant ok")]
    df = spark.createDataFrame([(*r, "t", "s") for r in rows], "conv_id long, turn long, role string, text string, turns string, span string")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert len(out) == 7
    for conv, r in out.items():
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == conv]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.formatted.count(start) == r.formatted.count(end) == len(want)
        shown = [r.formatted[a:b] for a, b in r.loss_spans]
        assert len(shown) == sum(role == "assistant" for role, _ in want)
        assert all(s == t or "<\\" in s for s, t in zip(shown, [t for role, t in want if role == "assistant"]))
    assert "<|foo|> is" in out[6].formatted and chat_format.format_chats(df.limit(0)).count() == 0


# shards


def smallest_capacity(sizes, shards):
    low, high = max([*sizes, 0]), sum(sizes)
    while low < high:
        mid, used, n = (low + high) // 2, 0, 1
        for s in sizes:
            if used + s > mid:
                n, used = n + 1, 0
            used += s
        low, high = (low, mid) if n <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_are_minimax(spark, monkeypatch, hot):
    monkeypatch.setattr(sharding, "POINTS", 8)  # several looks at finer pieces
    monkeypatch.setattr(sharding, "FINER", 8)
    monkeypatch.setattr(sharding, "BUCKET", 20)
    rng = np.random.default_rng(9)
    texts = ["é" * int(n) + str(i) for i, n in enumerate(rng.integers(0, 300, 500))] + ["hot text"] * hot + [None, "", None, "x" * 20_000]
    docs = spark.createDataFrame([(i, t, "l", "r") for i, t in enumerate(texts)], "doc_id long, text string, law string, row string")
    out = sharding.shard(docs, ["doc_id", "law", "row"], shards=7).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: r["size"] for r in out} == size and all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in out)
    groups, shards, slots, of_text = Counter(), Counter(), defaultdict(list), {}
    for r in out:
        groups[hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()] += r["size"]
        shards[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert of_text.setdefault(texts[r.doc_id] or "", r.shard) == r.shard and r.grown_shard is None and 0 <= r.shard < 7
    assert max(shards.values()) == smallest_capacity([groups[k] for k in sorted(groups)], 7)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.shard(docs.limit(0), ["doc_id"]).count() == 0


# the pipeline


def test_pipeline_stages(spark, small):
    import corpus_pipeline
    from softsearch.llm.common import saved

    docs, labels = table(spark, small, "documents"), {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    rows, ids = docs, [{r.doc_id for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, saved(stage(spark, rows, small), name)
        assert rows.columns == docs.columns
        ids.append({r.doc_id for r in rows.collect()})
        assert ids[-1] <= ids[-2]
        if name == "near_dedup":
            want = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert ids[-1] == {k for k, (c, _) in want.items() if c == k}
    good = [k for k in ids[0] if labels.get(k) == 1]
    assert sum(k in ids[1] for k in good) > 0.98 * len(good) and ids[3] == ids[4]
    assert all(r.n_chars == len(r.text) for r in rows.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, small)
    assert {r.doc_id for r in packed.collect()} == ids[-1]
    assert corpus_pipeline.run(spark, small).select(F.sum("length")).first() == packed.select(F.sum("length")).first()
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for extra in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            extra = stage(spark, extra, small)
        assert extra.count() == 0


def test_signatures_of_long_disjoint_sets_differ():
    """Bytes of the signatures, as stored, agree by chance only, however long the texts are."""
    rng = np.random.default_rng(3)
    family = minhash.hash_family(120, 1)
    for size in (50, 1000, 5000):
        one, two = (rng.integers(0, 1 << 63, size, dtype=np.uint64) for _ in range(2))
        sig = [(minhash.mix(minhash.minima(x, family)) >> np.uint64(56)).astype(np.uint8) for x in (one, two)]
        assert (sig[0] == sig[1]).mean() < 0.05
