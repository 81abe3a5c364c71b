"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (documents labelled good) and
one of raw text (all documents), give every document the log ratio of its probabilities. N-grams of
a text overlap and repeat, so they are no independent evidence, and the sum over a long text
would drown any noise: a document counts as ``effective`` n-grams at most, and its log weight is
the sum of the log ratios times ``min(1, effective / n_grams)``. With Gumbel noise added, the
``k`` largest values are a sample without replacement in proportion to the weights. ``k`` is a
number or a share of the table; by default it is the number of documents, of the whole table,
whose weight is at least the one that best parts the labelled documents into good ones and the
rest. Then the noise decides about documents near that weight, and about few others.

N-grams are words and pairs of words in lower case, and pairs of word shapes (letters in
upper and lower case, digits and other characters as runs, and whether a word repeats the one
before it); both kinds are hashed into a fixed number of buckets. The raw model counts all
documents, inside tasks before a shuffle of at most one row per task and bucket. The target
model may be fitted on a bounded sample: the labelled documents of least hash, ``max_labelled``
at most.

Defined results: null and empty texts have no n-grams and weight 0; repeated rows get equal
noise and equal values, and rows tied with the last one taken are all kept; a null key has
the noise of its own hash; without labels everything is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import map_texts, saved, slices, table

#: Buckets of word n-grams and of shape n-grams.
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 15, 1 << 12
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
#: Largest number of labelled documents that the target model is fitted on.
MAX_LABELLED = 20_000
#: Counts that pull the ratio of a bucket towards 1, so that rare n-grams decide little.
SMOOTHING = 10.0
#: N-grams that a document counts as at most.
EFFECTIVE = 8.0
#: What a good document that is lost costs, in documents of the rest that stay.
LOSS = 4.0
REMEMBERED = 200_000
#: Bytes by the kind of character that they belong to, others stay as they are.
KINDS = bytes.maketrans(
    bytes([*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100), *range(ord("0"), ord("9") + 1)]),
    b"A" * 26 + b"a" * (26 + 128) + b"0" * 10,
)
RUN = re.compile(rb"(.)\1+", re.DOTALL)
GOLDEN, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


class Features:
    """Buckets of the n-grams of a text, repeated as often as they occur."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of_word(self, word: bytes) -> int:
        """Hash of the word in lower case above that of its shape, 32 bits each."""
        shape = RUN.sub(rb"\1\1", word.translate(KINDS))
        return zlib.crc32(word.lower()) << 32 | zlib.crc32(shape)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = self.of_word(w)
        both = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        one, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        two = one[:-1] * np.uint64(GOLDEN) + one[1:]
        same = (one[:-1] == one[1:]).astype(np.uint64)
        shapes = (shape[:-1] * np.uint64(MIX_A) + shape[1:]) * np.uint64(MIX_B) + same
        spread = lambda x, n: (x * np.uint64(GOLDEN)) >> np.uint64(65 - n.bit_length())
        buckets = [spread(one, WORD_BUCKETS), spread(two, WORD_BUCKETS), spread(shapes, SHAPE_BUCKETS) + np.uint64(WORD_BUCKETS)]
        return np.concatenate(buckets).astype(np.int64)


def bucket_counts(df: DataFrame, text: str) -> np.ndarray:
    """N-grams of all documents by bucket. The result has a fixed size."""

    def run(batches):
        features, total = Features(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for at, n in slices(batch.column(0)):
                found = [features(x) for x in batch.column(0).slice(at, n).to_pylist()]
                total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket int, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on key and seed alone."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """Exact, by counting in 1,024 intervals that close in on it; no rows reach the driver."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0  # values above ``high``
    while low < high:
        width = (high - low) / 1024
        cell = F.least(F.lit(1023), F.floor((F.col(column) - low) / width)).cast("int") if width > 0 else F.lit(0)
        rows = values.where(F.col(column).between(low, high)).groupBy(cell.alias("cell"))
        found = sorted(rows.agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect(), reverse=True)
        for r in found:
            if above + r.n >= k:
                if (low, high) == (r.a, r.b):  # two neighbouring numbers that one interval holds
                    top = values.where(F.col(column) == high).count()
                    return high if above + top >= k else low
                low, high = r.a, r.b
                break
            above += r.n
    return low


def parting(weights: np.ndarray, good: np.ndarray) -> float:
    """The value from which on documents count as good at the least cost; the lowest on ties."""
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    cost = np.cumsum(np.where(good, LOSS, -1.0))  # of dropping the first rows
    cost = np.concatenate([[0.0], cost])
    ends = np.concatenate([[True], weights[1:] != weights[:-1], [True]])  # equal values are not parted
    at = int(np.argmin(np.where(ends, cost, np.inf)))
    if at == len(weights):
        return float("inf")
    return float(weights[at] if at == 0 else (weights[at] + weights[at - 1]) / 2)


def resample(
    df: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", label: str = "quality", *,
    k: int | None = None, share: float | None = None, effective: float = EFFECTIVE, max_labelled: int = MAX_LABELLED, seed: int = 6,
) -> DataFrame:
    """Add ``n_grams``, ``log_weight``, ``gumbel_score`` and ``kept`` to the columns ``keep``.

    ``labels`` holds ``key`` and ``label``, 1 for target text and 0 for the rest. ``k`` documents
    are drawn, or ``share`` of all (rounded up); where both are left out, the labels decide.
    """
    if k is not None and share is not None:
        raise ValueError("give k or share, not both")
    if not effective > 0 or (k is not None and k < 0) or (share is not None and not 0 <= share <= 1):
        raise ValueError("effective has to be above 0, k at least 0, share between 0 and 1")
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_k")).agg((F.min(label) == 1).alias("_good"))
    part = min(1.0, 0.95 * max_labelled / max(1, known.count()))
    # max_labelled keys at most are sent to the tasks
    sample = F.broadcast(saved(known.where(uniform(F.col("_k"), seed + 1) < part).limit(max_labelled), "importance-labels"))
    # two thirds of the keys fit the target model, the rest part good documents from others
    fitting = uniform(F.col("_k"), seed + 2) < 2 / 3
    target = df.join(sample.where(fitting & F.col("_good")), F.col(f"`{key}`") == F.col("_k"), "left_semi")
    counts, raw = bucket_counts(target, text), bucket_counts(df, text)
    expected = raw / max(1.0, raw.sum()) * counts.sum()
    ratio = np.log((counts + SMOOTHING) / (expected + SMOOTHING))

    def make():
        features = Features()

        def func(texts):
            found = [features(t) for t in texts]
            return [[len(x) for x in found], [float(ratio[x].sum()) * min(1.0, effective / max(1, len(x))) for x in found]]

        return func

    keep = [c for c in keep if c not in ("n_grams", "log_weight", "gumbel_score", "kept")]
    src = df.withColumn("_key", F.col(f"`{key}`")).withColumn("_noise", -F.log(-F.log(uniform(F.col("_key"), seed))))
    fields, value = "n_grams long, log_weight double", F.col("log_weight") + F.col("_noise")
    # only numbers are stored; the rows are scored again below rather than kept with their texts
    numbers = map_texts(src, text, ["_key", "_noise"], make, fields).select("_key", "log_weight", value.alias("gumbel_score"))
    scored = saved(numbers, "importance")
    if share is not None:
        k = math.ceil(share * scored.count())
    elif k is not None:
        k = min(k, scored.count())
    else:
        marked = scored.select("_key", "log_weight").join(sample.where(~fitting), F.col("_key") == F.col("_k"))
        # a number for each labelled key: max_labelled at most
        rows = marked.groupBy("_key").agg(F.min("log_weight").alias("w"), F.first("_good").alias("good")).collect()
        good = np.array([r.good for r in rows], bool)
        least = parting(np.array([r.w for r in rows]), good) if good.any() else float("-inf")
        k = scored.where(F.col("log_weight") >= least).count()
    limit = kth_largest(scored.select("gumbel_score"), "gumbel_score", k) if k else float("inf")
    again = map_texts(src, text, [*keep, "_noise"], make, fields).withColumn("gumbel_score", value).drop("_noise")
    return again.withColumn("kept", F.col("gumbel_score") >= limit)


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
