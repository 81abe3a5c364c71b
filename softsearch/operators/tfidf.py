"""TF-IDF weights and the cluster profiles drawn from them."""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.config import broadcast_if_small, cut_lineage, scratch_path
from softsearch.functions.text import word_tokens
from softsearch.operators.ranking import top_per_group

# Common English words that carry no topic. Pass any other list instead.
STOP_WORDS = tuple(
    """
    a about above after again against all also am an and any are as at be because been before
    being below between both but by can could did do does doing down during each few for from
    further had has have having he her here hers herself him himself his how i if in into is
    it its itself just me more most my myself no nor not now of off on once only or other our
    ours ourselves out over own same she should so some such than that the their theirs them
    themselves then there these they this those through to too under until up very was we were
    what when where which while who whom why will with would you your yours yourself yourselves
    """.split()
)
#: bytes of terms up to which the vocabulary is sent to every task
VOCABULARY_BYTES = 32 << 20


def _pairs(tokens: pa.Array, stop: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, term number and count of the distinct terms of each row of a batch, and the terms.
    Words are numbered by one dictionary per batch; nothing is done word by word."""
    offsets = np.asarray(tokens.offsets)
    words = tokens.flatten().dictionary_encode()
    terms, code = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(tokens)), np.diff(offsets))
    wanted = ~pc.is_in(terms, value_set=stop).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    found, n = np.unique(rows[wanted] * max(1, len(terms)) + code[wanted], return_counts=True)
    return found // max(1, len(terms)), found % max(1, len(terms)), n, terms


def term_counts(docs: DataFrame, key: str, text_col: str, stop_words: Collection[str]) -> DataFrame:
    """``(key, terms, tf)``: the distinct terms of each document and their counts, as arrays.
    They are counted inside the row's batch, so no text and no word is shuffled."""
    stop = list(stop_words)
    src = docs.select(key, F.coalesce(word_tokens(text_col), F.array().cast("array<string>")).alias("tokens"))
    schema = T.StructType([
        src.schema[key], T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tf", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(stop, pa.string())
        for batch in batches:
            rows, code, n, terms = _pairs(batch.column(1), known)
            at = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, c) for c in (terms.take(pa.array(code)), pa.array(n.astype(np.int64)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=schema.names)

    return src.mapInArrow(run, schema)


def _stored(counts: DataFrame) -> DataFrame:
    """Written to the shared folder and read again. As Parquet, terms take a fraction of the bytes
    of a checkpoint, and a file is read by as many tasks as its size asks for."""
    path = scratch_path(counts.sparkSession, "terms")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def tfidf_weights(
    docs: DataFrame,
    key: str = "doc_id",
    text_col: str = "text",
    *,
    stop_words: Collection[str] = STOP_WORDS,
    min_df: int = 2,
    max_features: int | None = None,
    vocabulary_bytes: int = VOCABULARY_BYTES,
) -> DataFrame:
    """``(key, term, tf, weight)``: smoothed idf ``ln((1+n)/(1+df)) + 1``, unit-length rows.

    Terms in fewer than ``min_df`` documents are dropped. With ``max_features`` only that
    many, the most frequent of the corpus, are kept, equal counts in alphabetical order.

    The texts are read once and leave the scan as term counts; what is shuffled are terms with
    their counts, summed in tasks. The most frequent terms, as many as fit ``vocabulary_bytes``,
    go to the tasks that hold the counts; only what documents hold of the others is joined by term.
    """
    numbered = term_counts(docs, key, text_col, stop_words).withColumn("row", F.monotonically_increasing_id())
    counts = _stored(numbered.select("row", key, "terms", "tf"))  # read several times below, without texts
    used = counts.select(F.explode(F.arrays_zip("terms", "tf")).alias("t")).select("t.terms", "t.tf")
    terms = used.groupBy(F.col("terms").alias("term")).agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocabulary = terms.where(F.col("df") >= min_df)
    if max_features is not None:
        vocabulary = vocabulary.orderBy(F.desc("total"), "term").limit(max_features)
    n_docs = counts.count()
    vocabulary = cut_lineage(vocabulary.select("term", "df", (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf")))
    least, whole = _least_df(vocabulary, vocabulary_bytes)
    frequent = vocabulary.where(F.col("df") >= least).select("term", "idf").toArrow()
    if not whole:
        rare = vocabulary.where(F.col("df") < least).select("term", "idf")
        pairs = counts.select("row", "terms").mapInArrow(_outside(frequent), "row long, term string").join(rare, "term")
        found = pairs.groupBy("row").agg(F.collect_list("term").alias("found"), F.collect_list("idf").alias("idf"))
        counts = counts.join(found, "row", "left")
    else:
        counts = counts.withColumns({"found": F.lit(None).cast("array<string>"), "idf": F.lit(None).cast("array<double>")})
    schema = T.StructType([
        counts.schema[key], *T.StructType.fromDDL("term string, tf long, weight double").fields,
    ])
    return counts.select(key, "terms", "tf", "found", "idf").mapInArrow(_weigh(frequent), schema)


def _least_df(vocabulary: DataFrame, vocabulary_bytes: int) -> tuple[int, bool]:
    """The least document frequency from which on all terms fit the bytes, and whether that is
    the whole vocabulary. A row per different frequency comes to the driver."""
    size = F.sum(F.octet_length("term") + F.lit(16).cast("long")).alias("size")
    least, total = 1 << 62, 0
    sizes = vocabulary.groupBy("df").agg(size).orderBy(F.desc("df")).collect()
    for r in sizes:
        total += r["size"]
        if total > vocabulary_bytes:
            return least, False
        least = r["df"]
    return least, True


def _rows_of(lists: pa.ListArray) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


def _outside(frequent: pa.Table):
    """The terms of each row that are not among the frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _column(frequent, "term")
        for batch in batches:
            terms = batch.column(1).flatten()
            other = pc.invert(pc.is_in(terms, value_set=known))
            rows = batch.column(0).take(pa.array(_rows_of(batch.column(1)))).filter(other)
            yield pa.RecordBatch.from_arrays([rows, terms.filter(other)], names=["row", "term"])

    return run


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays([*table.column(name).chunks, pa.array([], table.schema.field(name).type)])


def _weigh(frequent: pa.Table):
    """Weights of the terms of each row ``(key, terms, tf, found, idf)`` that the vocabulary holds:
    the frequent ones, and those that were found for the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_idf = _column(frequent, "term"), _column(frequent, "idf").to_numpy()
        for batch in batches:
            terms, rows = batch.column(1).flatten(), _rows_of(batch.column(1))
            place = pc.index_in(terms, value_set=known)
            inside = place.is_valid().to_numpy(zero_copy_only=False).copy()
            idf = np.zeros(len(terms))
            idf[inside] = known_idf[place.drop_null().to_numpy(zero_copy_only=False)]
            if batch.column(3).null_count < batch.num_rows:
                in_row = lambda at, names: pc.binary_join_element_wise(pa.array(at).cast(pa.string()), names, "\x1f")
                other = np.flatnonzero(~inside)
                own = in_row(rows[other], terms.take(pa.array(other)))
                place = pc.index_in(own, value_set=in_row(_rows_of(batch.column(3)), batch.column(3).flatten()))
                other = other[place.is_valid().to_numpy(zero_copy_only=False)]
                idf[other] = batch.column(4).flatten().take(place.drop_null()).to_numpy(zero_copy_only=False)
                inside[other] = True
            rows, tf = rows[inside], batch.column(2).flatten().to_numpy(zero_copy_only=False)[inside]
            raw = tf * idf[inside]
            norm = np.sqrt(np.bincount(rows, raw * raw, minlength=batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), terms.filter(pa.array(inside)), pa.array(tf), pa.array(raw / norm[rows])],
                names=[batch.schema.names[0], "term", "tf", "weight"],
            )

    return run


def cluster_top_terms(weights: DataFrame, assigned: DataFrame, key: str = "doc_id", n: int = 12) -> DataFrame:
    """``(cluster, n_docs, rank, term, score)``.

    ``assigned(key, dominant_cluster, mem_top1)``; the score is the mean over the
    cluster's documents of membership times weight.
    """
    sizes = assigned.groupBy("dominant_cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    # up to 64 MB of documents go to the weights, so that these are not dealt out by document
    narrow = broadcast_if_small(assigned.select(key, "dominant_cluster", "mem_top1"), max_rows=2_000_000)
    sums = (
        weights.select(key, "term", "weight")
        .join(narrow, key)
        .groupBy("dominant_cluster", "term")
        .agg(F.sum(F.col("mem_top1") * F.col("weight")).alias("total"))
    )
    scores = sums.join(sizes, "dominant_cluster").select(
        F.col("dominant_cluster").alias("cluster"), "n_docs", "term",
        F.round(F.col("total") / F.col("n_docs"), 9).alias("score"),
    )
    return top_per_group(scores, ["cluster"], [F.desc("score"), F.col("term")], n)


def cluster_top_categories(assigned: DataFrame, n: int = 3) -> DataFrame:
    """``(cluster, rank, label, n)``: the most frequent labels of each cluster."""
    counts = assigned.groupBy(F.col("dominant_cluster").alias("cluster"), "label").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["cluster"], [F.desc("n"), F.col("label")], n)
