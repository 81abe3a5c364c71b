"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

Labels are read from a bounded sample: the labelled training documents of least hash,
``max_labelled`` at most. One half of it gives the lexicon, the words and word beginnings
that are far more frequent in toxic documents; the other half is described by the features
and fits the trees (most of it) and the calibration (the rest), so the lexicon is not judged
on the texts it was taken from. Then every document is scored from its whole text.

Features: densities of lexicon words and lexicon beginnings, their largest log odds, the share
of lexicon words near a second-person pronoun, and rates of capitals, exclamation and
other punctuation, digits inside words, symbols inside words, repeated letters.

Defined results: null and empty texts have features 0 and the score that the model gives
them; repeated rows get equal scores; if the training rows have one class only, every
document gets its share of label 1 as score; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import map_texts, saved, table
from softsearch.llm.importance import uniform

#: Largest number of labelled documents that lexicon, trees and calibration are fitted on.
MAX_LABELLED = 24_000
#: A lexicon entry: documents of label 1 that hold it at least, least odds ratio, entries at most.
LEAST_DOCS, LEAST_ODDS, ENTRIES = 6, 6.0, 4000
#: Lengths of word beginnings, and words on either side in which a pronoun counts as near.
BEGINNINGS, NEAR = (4, 5), 6
#: Distinct words that a task remembers.
REMEMBERED = 200_000
#: Second-person pronouns of the four languages, and letters written as other characters.
PRONOUNS = set(
    "you your yours yourself u ya du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus vosotros vuestro usted ustedes".split()
)
LEET = str.maketrans("@0134$57", "aoieasst")
EDGES = ".,;:!?\"'()[]#*$%&|<>-_"
REPEATED = re.compile(r"(.)\1\1")
FEATURES = [
    "word_density", "word_odds", "start_density", "start_odds", "near_pronoun", "pronouns", "capitals", "exclamations",
    "punctuation", "digit_words", "symbol_words", "stretched",
]


def plain(word: str) -> str:
    """Lower case, without punctuation at the ends, disguised letters put back."""
    word = word.lower().strip(EDGES)
    return word if word.isalpha() or word.isdigit() else word.translate(LEET)


def entries(word: str) -> list[str]:
    """What a word can be found by in the lexicon: ``=word`` itself and its beginnings."""
    return ["=" + word, *(f"{n}{word[:n]}" for n in BEGINNINGS if len(word) > n)]


def lexicon_of(texts: DataFrame) -> dict[str, float]:
    """Log odds of the entries that mark label 1, from ``text, label``; ``ENTRIES`` at most."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {plain(w) for w in (text or "").split()}
                counts.update({(e, label) for w in words if w for e in entries(w)})
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0][0] for r in rows], pa.string()), pa.array([int(r[0][1]) for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())],
            names=["entry", "label", "n"],
        )

    total = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counted = texts.select("text", "label").mapInArrow(run, "entry string, label int, n long").groupBy("entry").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("good")
    )
    odds = F.col("bad") / total[1] / ((F.col("good") + 1) / total[0])
    found = counted.where(F.col("bad") >= LEAST_DOCS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    return {r.entry: math.log(r.odds) for r in found.orderBy(F.desc(F.col("bad") * F.log("odds")), "entry").limit(ENTRIES).collect()}


def describe(df: DataFrame, text: str, keep: list[str], lexicon: dict[str, float]) -> DataFrame:
    """Add the ``FEATURES`` of a text to the columns ``keep``."""

    def make():
        known: dict[str, tuple] = {}

        def look(raw: str) -> tuple:
            word = plain(raw)
            body = raw.strip(EDGES)
            by_start = max((lexicon.get(e, 0.0) for e in entries(word)[1:]), default=0.0)
            return (
                lexicon.get("=" + word, 0.0), by_start, word in PRONOUNS, any(map(str.isdigit, body)) and any(map(str.isalpha, body)),
                bool(body) and not body.isalnum(), bool(REPEATED.search(body)),
            )

        def one(value: str | None) -> list[float]:
            words = (value or "").split()
            if not words:
                return [0.0] * len(FEATURES)
            if len(known) > REMEMBERED:
                known.clear()
            for w in {w for w in words if w not in known}:
                known[w] = look(w)
            rows = np.array([known[w] for w in words], float)
            word, start, pronoun = rows[:, 0], rows[:, 1], rows[:, 2]
            hit = (word > 0) | (start > 0)
            sums = np.concatenate([[0.0], np.cumsum(pronoun)])
            at = np.arange(len(words))
            near = sums[np.minimum(at + NEAR + 1, len(words))] - sums[np.maximum(at - NEAR, 0)] > 0
            n, letters = len(words), max(1, len(value))
            capitals = sum(map(str.isupper, value)) if not value.islower() else 0
            return [
                float((word > 0).sum()) / n, float(word.max()), float((start > 0).sum()) / n, float(start.max()),
                float((hit & near).sum()) / n, float(pronoun.sum()) / n, capitals / letters, value.count("!") / letters,
                sum(map(value.count, ".,;:?")) / letters, *(float(x) / n for x in rows[:, 3:6].sum(axis=0)),
            ]

        return lambda texts: list(zip(*map(one, texts))) if texts else [[]] * len(FEATURES)

    return map_texts(df, text, keep, make, ", ".join(f"{name} double" for name in FEATURES))


def score(
    df: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", label: str = "toxic", *,
    max_labelled: int = MAX_LABELLED, seed: int = 5, trees: int = 20, depth: int = 4,
) -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to the columns ``keep``.

    A row is held out, and its label is never read, if crc32 of its key as text is divisible
    by 5; a null key is not held out.
    """
    out = lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_k")).agg(F.max(F.col(label)).cast("int").alias("label"))
    n = known.count()
    sample = known.where(uniform(F.col("_k"), seed) < min(1.0, 0.95 * max_labelled / max(1, n))).limit(max_labelled)
    fold = F.floor(uniform(F.col("_k"), seed + 1) * 10).cast("int")
    # max_labelled keys at most are sent to the tasks
    fitted = saved(df.join(F.broadcast(sample), F.col(f"`{key}`") == F.col("_k")).select(F.col(f"`{text}`").alias("text"), "label", fold.alias("fold")), "toxic-sample")
    counts = {(r.part, r.label): r.n for r in fitted.groupBy((F.when(F.col("fold") < 5, 0).when(F.col("fold") < 8, 1).otherwise(2)).alias("part"), "label").agg(F.count("*").alias("n")).collect()}
    keep = [c for c in keep if c not in ("held_out", "score", "predicted")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept")  # apart from the names of features
    flagged = df.select(row, out(F.col(f"`{key}`")).alias("held_out"), F.col(f"`{text}`").alias("_text"))
    if not all(counts.get((part, x)) for part in range(3) for x in (0, 1)):
        rows = sum(counts.values())
        share = sum(v for (_, x), v in counts.items() if x == 1) / rows if rows else 0.0
        scored = flagged.select("_kept.*", "held_out", F.lit(float(share)).alias("score"))
    else:
        lexicon = lexicon_of(fitted.where("fold < 5"))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features")
        described = saved(rows.transform(describe(fitted.where("fold >= 5"), "text", ["label", "fold"], lexicon).coalesce(4)), "toxic-features")
        model = GBTClassifier(
            labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, minInstancesPerNode=5
        ).fit(described.where("fold < 8"))
        raw = lambda d: model.transform(d).withColumn("margin", vector_to_array("probability")[1])
        calibrated = IsotonicRegression(labelCol="label", featuresCol="margin", predictionCol="calibrated").fit(
            raw(described.where("fold >= 8")).select("label", "margin")
        )
        found = raw(rows.transform(describe(flagged, "_text", ["_kept", "held_out"], lexicon)))
        scored = calibrated.transform(found).select(
            "_kept.*", "held_out", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated"))).alias("score")
        )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
