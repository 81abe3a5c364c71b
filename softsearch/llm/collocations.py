"""Phrase collocations from count streams kept in prefix and in suffix order.

Counting: level by level, a phrase of n words is counted only where both phrases of n - 1
words inside it may be frequent, as told by a bitmap of fixed size over the level before.
Tasks count blocks of text, Spark sums the blocks. A bitmap errs only to the safe side: it
spares work, and the sums are exact whatever it lets through. The empty phrase stands for all
words of a language, so it heads the stream of its language.

Streams: the frequent phrases of all lengths are sorted by their words (prefix order). A task
walks through its range of them in lockstep: the phrases that head the present one lie open
on a path, so each phrase meets the counts of all its heads, and each head the largest count
of its extensions to the right, by comparing neighbours alone. Sorted again by their reversed
words (suffix order), the same walk gives the counts of the ends and the extensions to the
left. A range may begin inside the extensions of a phrase of an earlier range: those phrases
(at most one path a range) are looked up apart and put in where the next walk reads the rows.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows
count again; equal scores are ordered by count, then by phrase; an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import saved, table
from softsearch.operators.ranking import top_per_group

#: Words of a block of texts, and distinct words, that a worker counts before it passes the counts on.
BLOCK_WORDS = 1 << 19
DISTINCT_WORDS = 200_000
#: Rows of a batch that become Python objects at a time.
ROWS = 256
#: The bitmap has 2 ** BITS places.
BITS = 26
#: Characters between pieces, and the byte that stands for them while counting.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"

_STREAM = "lang string, words array<string>, n long, heads array<long>, ends array<long>, ext long, ghost boolean"


def pieces(raw: bytes) -> list[bytes]:
    """Words of a text in lower case of A-Z, with ``BREAK`` between pieces."""
    upper = bytes(range(65, 91))
    plain = raw.translate(bytes.maketrans(upper + BREAKS, upper.lower() + BREAK * len(BREAKS)))
    return plain.replace(BREAK, b" " + BREAK + b" ").split()


def places(hashes: list[np.ndarray]) -> np.ndarray:
    """Place in the bitmap of phrases, given the hashes of their first, second, ... words."""
    if len(hashes) == 1:
        return hashes[0] & np.uint64((1 << BITS) - 1)
    h = np.zeros(len(hashes[0]), np.uint64)
    for x in hashes:
        h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)


class Vocabulary(dict):
    """Numbers and hashes of the words that may be frequent; breaks and all other words have
    number 0 and, as they seldom come again, are not remembered."""

    def __init__(self, lang: str, frequent: bytes):
        super().__init__({BREAK: 0})
        self.seed, self.frequent, self.words, self.hashes = zlib.crc32(lang.encode()), frequent, [b""], [0]

    def __missing__(self, word: bytes) -> int:
        h = zlib.crc32(word, self.seed)
        at = h & ((1 << BITS) - 1)
        if not self.frequent[at >> 3] >> (at & 7) & 1:
            return 0
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(h)
        return number


def _phrases(lang: str, known: Vocabulary, ids: np.ndarray, size: int, bitmap: np.ndarray) -> tuple[pa.Array, np.ndarray] | None:
    """The phrases of ``size`` words of a block and how often they stand there."""
    inner = size - 1
    n = len(ids) - inner + 1
    hashes = np.array(known.hashes, np.uint64)[ids]
    at = places([hashes[j : n + j] for j in range(inner)])
    may = (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    for j in range(inner):
        may &= ids[j : n + j] > 0
    rows = np.flatnonzero(may[:-1] & may[1:])
    if not len(rows):
        return None
    rows = ids[rows[:, None] + np.arange(size)]
    key = rows[:, 0]
    for j in range(1, size):
        if j > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(known.words) + rows[:, j]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    words = pa.array(known.words, pa.binary()).cast(pa.string()).take(pa.array(rows[first].ravel()))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * size, pa.int32()), words)
    return pc.binary_join(lists, " "), counts


def _batch(phrases: pa.Array, counts: np.ndarray, lang: str) -> pa.RecordBatch:
    keys = pc.binary_join_element_wise(phrases, lang, "\t")  # no word holds a tab
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["key", "n"])


def _texts(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _count_words(batches):
    counts: dict[str, Counter] = {}

    def rows():
        for lang, c in counts.items():
            c.pop(BREAK, None)
            total = sum(c.values())
            if total:
                c[b""] = total  # the empty phrase
                yield _batch(pa.array(list(c), pa.binary()).cast(pa.string()), np.fromiter(c.values(), np.int64, len(c)), lang)
        counts.clear()

    held = 0
    for lang, raw in _texts(batches):
        c = counts.setdefault(lang, Counter())
        held -= len(c)
        c.update(pieces(raw))
        held += len(c) + 1
        if held >= DISTINCT_WORDS:
            yield from rows()
            held = 0
    yield from rows()


def count_phrases(df: DataFrame, size: int, frequent: np.ndarray | None, bitmap: np.ndarray | None) -> DataFrame:
    """``lang, words, n`` of phrases of ``size`` words in ``df(lang, text)``, text as bytes.
    Those of several words are counted only where all words lie in the bitmap ``frequent``, and
    both phrases of ``size - 1`` words in ``bitmap``."""
    told = None if frequent is None else frequent.tobytes()

    def run(batches):
        known, blocks, held = {}, {}, 0

        def rows():
            for lang, ids in blocks.items():
                out = _phrases(lang, known[lang], np.concatenate([*ids, np.zeros(size, np.int64)]), size, bitmap)
                if out is not None:
                    yield _batch(*out, lang)
            blocks.clear()
            if sum(map(len, known.values())) > DISTINCT_WORDS:
                known.clear()

        for lang, raw in _texts(batches):
            if lang not in known:
                known[lang] = Vocabulary(lang, told)
            words = pieces(raw)
            words.append(BREAK)
            blocks.setdefault(lang, []).append(np.fromiter(map(known[lang].__getitem__, words), np.int64, len(words)))
            held += len(words)
            if held >= BLOCK_WORDS:
                yield from rows()
                held = 0
        yield from rows()

    counted = df.mapInArrow(_count_words if size == 1 else run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\t", 1)
    words = F.when(phrase == "", F.array().cast("array<string>")).otherwise(F.split(phrase, " "))
    return counted.select(F.expr("substring(key, instr(key, '\t') + 1)").alias("lang"), words.alias("words"), "n")


def frequent_places(level: DataFrame) -> np.ndarray:
    """The bitmap of a level of frequent phrases, ``2 ** BITS`` bits whatever their number."""

    def run(batches):
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(lang.encode())
                by_lang.setdefault(lang, []).append([zlib.crc32(w.encode(), seed) for w in words])
            if not by_lang:
                continue
            at = places(list(np.array([h for hs in by_lang.values() for h in hs], np.uint64).T))
            cell, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(cell), np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(bits.view(np.int64))], names=["cell", "bits"])

    cells = level.where(F.size("words") > 0).select("lang", "words").mapInArrow(run, "cell long, bits long")
    found = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()  # 2 ** (BITS - 6) rows at most
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.view(np.uint8)


def frequent_phrases(df: DataFrame, text: str, lang: str, max_words: int, min_count: int) -> DataFrame:
    """``lang, words, n``: phrases of up to ``max_words`` words found ``min_count`` times, and
    the empty phrase of each language with the number of its words."""
    rows = df.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    levels, bitmaps = [], [None]
    for size in range(1, max_words + 1):
        counted = count_phrases(rows, size, bitmaps[min(size - 1, 1)], bitmaps[-1]).where((F.col("n") >= min_count) | (F.size("words") == 0))
        levels.append(saved(counted, f"phrases-{size}"))
        if size < max_words:
            bitmaps.append(frequent_places(levels[-1]))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole


def _walk(backward: bool, known: dict):
    """Lockstep over one range of the stream: the phrases that begin (``backward``: end) the
    present one lie on ``path``, by their number of words. A place on the path whose own row
    lies in an earlier range is a ghost: it has no count, only extensions."""
    own = "ends" if backward else "heads"

    def run(batches):
        path, done, lang = [], [], None  # of the path: [words, row or None, largest extension]

        def close(depth):
            while len(path) > depth:
                words, row, ext = path.pop()
                if row is None:
                    row = {"lang": lang, "words": words[::-1] if backward else words, "n": None, "heads": None, "ends": None, "ext": None, "ghost": True}
                row["ext"] = max(x for x in (row["ext"], ext, -1) if x is not None)
                done.append(row)

        def out():
            batch = pa.RecordBatch.from_pylist(done, schema=schema)
            done.clear()
            return batch

        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                for row in whole.slice(at, 4096).to_pylist():
                    row["ghost"] = False
                    if backward:  # what the walk forward could not see
                        _put_in(row, "heads", known)
                    words = row["words"][::-1] if backward else row["words"]
                    size, same = len(words), 0
                    if row["lang"] == lang:
                        while same < len(path) and same <= size and path[same][0] == words[:same]:
                            same += 1
                    close(same)
                    lang = row["lang"]
                    while len(path) < size:
                        path.append([words[: len(path)], None, -1])
                    row[own] = [p[1] and p[1]["n"] for p in path]
                    if path:
                        path[-1][2] = max(path[-1][2], row["n"])
                    path.append([words, row, -1])
                if done:
                    yield out()
        close(0)
        if done:
            yield out()

    schema = pa.schema([
        ("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64()), ("heads", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("ext", pa.int64()), ("ghost", pa.bool_()),
    ])
    return run


def _put_in(row: dict, side: str, known: dict) -> None:
    """Counts and extensions of a row that lie in other ranges."""
    words, counts = row["words"], row[side]
    for k, n in enumerate(counts):
        if n is None:
            part = words[:k] if side == "heads" else words[len(words) - k :]
            counts[k] = known[row["lang"], tuple(part)][0]
    if (more := known.get((row["lang"], tuple(words)))) is not None:
        row["ext"] = max(row["ext"], more[1])


def lockstep(stream: DataFrame, backward: bool, known: dict, name: str) -> tuple[DataFrame, dict]:
    """Walk through the stream in prefix (``backward``: suffix) order. Returns the rows and what
    the ranges could not see: ``{(lang, words): (count, largest extension)}`` of the phrases
    that ranges begin within, at most one path of phrases for each range."""
    order = F.reverse("words") if backward else F.col("words")
    none = F.lit(None).cast("array<long>")
    rows = stream if backward else stream.select("lang", "words", "n", none.alias("heads"), none.alias("ends"), F.lit(-1).cast("long").alias("ext"))
    ranged = rows.withColumn("order", order).repartitionByRange("lang", "order").sortWithinPartitions("lang", "order").drop("order")
    walked = saved(ranged.mapInArrow(_walk(backward, known), _STREAM), name)
    rows = walked.where(~F.col("ghost")).drop("ghost")
    ghosts = walked.where("ghost").groupBy("lang", "words").agg(F.max("ext").alias("more"))
    seen = rows.join(F.broadcast(ghosts), ["lang", "words"]).select("lang", "words", "n", "more").collect()
    return rows, {(r.lang, tuple(r.words)): (r.n, r.more) for r in seen}


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", *, max_words: int = 3, min_count: int = 10, min_share: int = 50
) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of phrases of 2 to ``max_words`` words found at least
    ``min_count`` times (``a``) that no longer phrase with ``min_share`` percent of ``a`` contains.

    ``l`` and ``r`` are the counts of both parts of the cut with the lowest ``score``, which is
    ``1000000 a a / (l r)`` rounded down in integers of any length; ``n`` counts all words."""
    counts = frequent_phrases(df, text, lang, max_words, min_count)
    forward, before = lockstep(counts, False, {}, "phrases-prefix")
    both, behind = lockstep(forward, True, before, "phrases-suffix")

    def run(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                words, a = row["words"], row["n"]
                _put_in(row, "ends", behind)
                if len(words) < 2 or 100 * row["ext"] >= min_share * a and row["ext"] >= min_count:
                    continue
                heads, ends = row["heads"], row["ends"]
                score, k = min((1_000_000 * a * a // (heads[k] * ends[len(words) - k]), k) for k in range(1, len(words)))
                found.append((row["lang"], " ".join(words), a, heads[k], ends[len(words) - k], heads[0], score))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), [pa.string()] * 2 + [pa.int64()] * 5)],
                    names=["lang", "phrase", "a", "l", "r", "n", "score"],
                )

    # an extension closes its shorter phrase only when both are of the stream, so both are candidates
    return both.mapInArrow(run, "lang string, phrase string, a long, l long, r long, n long, score long")


def op11_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    found = collocations(table(spark, sf_dir, "documents"))
    best = top_per_group(found, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], 2000)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM cut
), grams AS (
  SELECT lang, w[i : i + k - 1] AS g FROM (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM pieces, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, g, count(*) AS a FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang
), cand AS (
  SELECT * FROM f WHERE len(g) >= 2 AND a >= 10
), inside AS (
  SELECT lang, g[1:2] AS g, a FROM cand WHERE len(g) = 3 UNION ALL SELECT lang, g[2:3], a FROM cand WHERE len(g) = 3
), longest AS (
  SELECT lang, g, max(a) AS ext FROM inside GROUP BY ALL
), parts AS (
  SELECT *, g[1:k] AS first, g[k + 1 : len(g)] AS rest FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS k FROM cand)
), heads AS (
  SELECT p.*, f.a AS l FROM parts p JOIN f ON p.first = f.g AND p.lang = f.lang
), cuts AS (
  SELECT p.*, f.a AS r, (1000000::HUGEINT * p.a * p.a) // (l::HUGEINT * f.a) AS score
  FROM heads p JOIN f ON p.rest = f.g AND p.lang = f.lang
), least AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), kept AS (
  SELECT c.lang, array_to_string(c.g, ' ') AS phrase, c.a, l, r, n, score::BIGINT AS score
  FROM least c JOIN total USING (lang) LEFT JOIN longest x ON x.lang = c.lang AND x.g = c.g
  WHERE x.ext IS NULL OR 100 * x.ext < 50 * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
