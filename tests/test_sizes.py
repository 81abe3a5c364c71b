"""What a task holds does not grow with the number of lists, keys or rows of the other side."""

import hashlib
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import direction

from softsearch.llm import segment_sampling
from softsearch.operators import embed, pqindex, semcache, similarity


def _table(keys: list[list[str]]) -> pa.Table:
    n = len(keys)
    vec = np.random.default_rng(1).normal(size=(n, 4))
    return pa.table(
        {
            "id": pa.array([str(i) for i in range(n)]), "vec": pa.array(vec.tolist()), "ord": pa.array([0] * n, pa.int64()),
            "keys": pa.array(keys, pa.list_(pa.string())), "bound": pa.nulls(n, pa.float64()),
        }
    )


def test_a_side_has_no_more_groups_than_keys_unless_ranks_count():
    names = [str(i) for i in range(6)]
    table = _table([names[i:] + names[:i] for i in range(6)] + [["2", "2"]])
    plain = similarity.Side.of(table)
    assert sorted(plain.groups) == [(0, n) for n in names]
    assert all((np.diff(rows) > 0).all() for rows in plain.groups.values())
    assert len(similarity.Side.of(table, ranked=True).groups) == 36


def test_a_search_of_the_index_has_tasks_by_rows_and_not_by_lists(spark, tmp_path):
    x = np.random.default_rng(2).normal(size=(400, 8))
    rows = spark.createDataFrame([(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(x)], "doc_id long, embedding array<double>")
    index = pqindex.fit_index(rows, str(tmp_path / "index"), lists=40)
    cores, held = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        assert index.rows(spark).rdd.getNumPartitions() > cores
        asked = rows.where("doc_id % 40 = 0").withColumnRenamed("doc_id", "query_id")
        seen = []
        real = pqindex.similarity_topk
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(pqindex, "similarity_topk", lambda left, right, *a, **o: seen.append(right) or real(left, right, *a, **o))
            found = pqindex.search_index(index, asked, rows, 3, n_probe=40, rerank=400)
        assert seen[0].rdd.getNumPartitions() <= cores
        got = {(r.query_id, r["rank"]): r.doc_id for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(q, n + 1): int(d) for q in range(0, 400, 40) for n, d in enumerate(np.argsort(-(unit @ unit[q]))[:3])}
    assert got == want


def test_a_word_of_a_batch_is_looked_up_once():
    vocabulary = segment_sampling.Vocabulary("piece_bpe_32k.model")
    asked = []

    class Counted(segment_sampling.States):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    vocabulary.states = Counted()
    texts, seeds = ["one two  three\none two\n" * 50, "", "two three", " one"], np.arange(4, dtype=np.uint64)
    found = segment_sampling.sample_batch(vocabulary, texts, seeds, 2)
    assert 0 < len(asked) == len(set(asked)) < 12
    for text, samples in zip(texts, found):
        paths = [segment_sampling.piece_ids(vocabulary, s[0]) for s in samples]
        assert all(segment_sampling.round_trips(vocabulary, paths, [text.encode()] * len(paths)))
        assert text == "" or len(samples) == 2


def test_words_of_a_text_are_cut_once_however_often_they_occur(monkeypatch):
    cut = []

    class Counting:
        def __init__(self, pattern):
            self.pattern = re.compile(pattern)

        def findall(self, text):
            cut.extend(self.pattern.findall(text))
            return self.pattern.findall(text)

    monkeypatch.setattr(embed, "re", SimpleNamespace(compile=Counting))
    texts = ["say don't stop, " * 500, "", " ", "été ½½ x　yy\x1fzz-zz " * 300]
    got = embed.hashed_model(16)()(np.array(texts, dtype=object))
    assert len(cut) < 20
    for text, row in zip(texts, got):
        want = np.zeros(16)
        for word in re.findall(r"\w{2,}", text):
            digest = hashlib.md5(word.encode()).hexdigest()
            want[int(digest[:8], 16) % 16] += 1 if int(digest[8], 16) < 8 else -1
        assert row.tolist() == want.tolist()


def test_no_word_holds_what_parts_tokens():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    parts = pc.list_value_length(pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in every]))).to_numpy()
    alone = pc.match_substring_regex(pa.array([f"a{c}" for c in every]), embed.ONE_WORD).to_numpy(zero_copy_only=False)
    word = np.array([re.fullmatch(r"\w", c) is not None for c in every])
    assert not (word & (parts > 1)).any() and not (alone & ~word).any()


@pytest.mark.parametrize("options", [{}, {"max_bytes": 0}, {"max_bytes": 0, "tile_bytes": 8 * 8 * 20}, {"prefer_small": "left"}])
def test_rows_with_any_match(spark, options):
    data = [(str(i), direction(i), i, [["a"], ["b", "a"], ["c", "b"]][i % 3]) for i in range(150)]
    side = spark.createDataFrame(data, "id string, vec array<float>, ord long, keys array<string>").cache()
    x = np.round(np.array([d[1] for d in data], dtype=float) @ np.array([d[1] for d in data], dtype=float).T, 9)
    want = {a[0] for i, a in enumerate(data) if any(x[i, j] >= 0.7 and set(a[3]) & set(b[3]) for j, b in enumerate(data[:i]))}
    got = similarity.similar_rows(side, side, 0.7, earlier=True, **options).collect()
    assert 0 < len(want) < 150 and sorted(r.left_id for r in got) == sorted(want)


def test_a_row_is_compared_until_its_first_match(monkeypatch):
    n = 20_000
    table = pa.table({
        "id": [str(i) for i in range(n)], "vec": [direction(i % 40) for i in range(n)], "ord": pa.array(range(n)),
        "bound": pa.nulls(n, pa.float64()), "keys": [["a", "b"]] * n,
    })
    parts = []
    monkeypatch.setattr(np, "round", lambda a, d, round=np.round: parts.append(np.size(a)) or round(a, d))
    side = similarity.Side.of(table)
    found = list(similarity._all_winners(side, side, similarity.Rule(1, 0.999999, earlier=True, any_match=True)))
    assert {i for b in found for i in b.column(0).to_pylist()} == {str(i) for i in range(40, n)}
    assert len(parts) < 100  # about one part of the columns for each block of rows, and not all of them


def test_a_cache_sends_no_more_to_a_task_however_long_its_log(spark, monkeypatch):
    sent, take = [], similarity._take_small
    monkeypatch.setattr(similarity, "_take_small", lambda df, max_bytes: sent.append(max_bytes) or take(df, max_bytes))
    rows = [("c", i, direction(i), [0.5, 0.4, 0.1]) for i in range(400)]
    log = spark.createDataFrame(rows, "cache_id string, seq long, embedding array<float>, membership array<double>").cache()
    hits = lambda **options: sorted(semcache.replay(log, 0.8, None, tail_rows=10, **options).decisions.collect())
    want = hits()
    assert max(sent) <= 8 << 20
    assert hits(max_bytes=0, tile_bytes=8 * 8 * 50) == want and any(r.cache_hit for r in want)
