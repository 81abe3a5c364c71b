"""Texts to unit vectors with a model that is loaded once per Python worker."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.config import cut_lineage
from softsearch.functions.vectors import dot
from softsearch.sources.corpus import distinct_queries

#: texts whose words the default model numbers at a time
HASHED_BATCH = 512
#: tokens that are one word in any version of Unicode; the others are cut by Python's ``\w``
ONE_WORD = r"^[0-9A-Za-z_À-ÖØ-öø-ɏ]{2,}$"

#: makes, inside the worker, a function from a batch of strings to a matrix
ModelFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]


def hashed_model(dim: int = 64) -> ModelFactory:
    """Offline default model: signed feature hashing of lower-cased words.

    A word adds +1 or -1 at one position; both come from its MD5, so any engine can
    recompute the vector and equal texts get equal vectors.
    """

    def make():
        words, md5 = re.compile(r"\w{2,}"), hashlib.md5

        def places(found: Iterable[bytes]) -> np.ndarray:
            """Position of each word, ``dim`` higher where it counts as -1."""
            digests = np.frombuffer(b"".join([md5(word).digest() for word in found]), np.uint8).reshape(-1, 16)
            number = np.ascontiguousarray(digests[:, :4]).view(">u4").ravel().astype(np.int64)
            return number % dim + np.where(digests[:, 4] < 128, 0, dim)

        def predict(texts: np.ndarray) -> np.ndarray:
            # no word holds white space, so only the distinct tokens between it are cut into words
            split = pc.utf8_split_whitespace(pa.array(texts.ravel(), pa.large_string()))
            tokens = split.flatten().dictionary_encode()
            whole = pc.match_substring_regex(tokens.dictionary, ONE_WORD)
            rest = pc.invert(whole)
            cut = [words.findall(token) for token in tokens.dictionary.filter(rest).to_numpy(zero_copy_only=False)]
            alone = tokens.dictionary.filter(whole).cast(pa.large_binary()).to_numpy(zero_copy_only=False)
            at = places(chain(alone, (word.encode() for found in cut for word in found)))
            if not len(at):
                return np.zeros((len(texts), dim))
            whole, rest = (c.to_numpy(zero_copy_only=False) for c in (whole, rest))
            n, first = np.ones(len(whole), np.int64), np.empty(len(whole), np.int64)
            n[rest] = [len(found) for found in cut]
            first[whole], first[rest] = np.arange(len(alone)), len(alone) + np.cumsum(n[rest]) - n[rest]
            code = tokens.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
            times = n[code]  # the words of each token that occurs
            word = np.repeat(first[code] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            sums = np.bincount(np.repeat(rows, times) * (2 * dim) + at[word], minlength=len(texts) * 2 * dim).reshape(-1, 2, dim)
            return (sums[:, 0] - sums[:, 1]).astype(np.float64)

        return predict

    return make


def embed(
    df: DataFrame,
    text_col: str = "text",
    out_col: str = "embedding",
    model: ModelFactory | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Add the unit-norm float vector of each text; null texts count as empty.

    ``model`` follows the ``predict_batch_udf`` contract, so a sentence encoder plugs in
    as a factory that loads it and returns its ``encode``. The default model takes batches of
    ``HASHED_BATCH`` texts at least.
    """
    factory = model or hashed_model()
    batch_size = batch_size if model else max(batch_size, HASHED_BATCH)

    def make_unit():
        predict = factory()

        def unit(texts: np.ndarray) -> np.ndarray:
            vectors = np.asarray(predict(texts), dtype=np.float64)
            norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            return (vectors / np.maximum(norms, 1e-8)).astype(np.float32)

        return unit

    encode = predict_batch_udf(make_unit, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return df.withColumn(out_col, encode(F.lower(F.coalesce(F.col(text_col), F.lit("")))))


def embed_pairs(pairs: DataFrame, model: ModelFactory | None = None, batch_size: int = 64) -> DataFrame:
    """Similarity of the two texts of each pair, ``(..., q1, q2, similarity)``.

    Every distinct text is embedded once, however many pairs it occurs in.
    """
    vectors = cut_lineage(embed(distinct_queries(pairs, "q1", "q2"), "query", "vec", model, batch_size))
    left = vectors.select(F.col("query").alias("q1"), F.col("vec").alias("left_vec"))
    right = vectors.select(F.col("query").alias("q2"), F.col("vec").alias("right_vec"))
    found = pairs.join(left, "q1").join(right, "q2")
    return found.select(*pairs.columns, dot("left_vec", "right_vec").alias("similarity"))
