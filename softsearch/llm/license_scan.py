"""License scans by diagonal voting, with native operations.

Every window of ``K`` words of a text (of all its words, in a template of fewer) is joined to
the templates by the hash of its first two words and counts if all its words are equal. A
window at word p that stands at word q of a template is a vote for the diagonal p - q: the
place where the template would begin. Votes are summed by diagonal in the map tasks, as a bit
for every template word, so only texts with votes have more than one row in the shuffle.

Words put in or left out move the rest of a copy to a neighbouring diagonal: diagonals of a
long template at most ``SHIFT`` words apart are one span. A span is verified by the share of
template words that its votes cover: ``COVER`` for long templates, all of them, on a single
diagonal, for phrases of fewer than ``LONG`` words. The base phrases are such phrases.

Defined results: null and empty texts have no words and no labels; rows are scanned one by
one, so repeated rows get equal results; a very long text is only more rows, as words are
exploded before they are joined; an empty table gives no rows; ``keep`` may hold any columns,
those named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from softsearch.llm.common import saved, table

#: Words of a window, words by which a span may shift, words of a long template, and the share
#: of its words that votes have to cover.
K, SHIFT, LONG, COVER = 4, 4, 8, 0.6
#: Template words per bit mask.
BITS = 32
#: The phrases that always count, with their labels.
BASE = [
    ("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"),
]
#: Openings of public licenses and of their notices, with their labels.
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc"), ("cc-by-nd", "cc by nd"), ("cc-by-sa", "cc by sa"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
     "publish distribute sublicense and or sell copies of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

Template = tuple[str, bool, str]


def templates() -> list[Template]:
    """``(label, is a base phrase, text)``."""
    return [(label, True, text) for label, text in BASE] + [(label, False, text) for label, text in NOTICES]


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(plain, _NO_WORD), "")


def windows(df: DataFrame) -> DataFrame:
    """A row for every word of ``words``, with the ``K - 1`` words after it and their place."""
    shifted = [F.col("words"), *[F.slice("words", j + 1, F.greatest(F.size("words"), F.lit(1))) for j in range(1, K)]]
    rest = [c for c in df.columns if c != "words"]
    rows = df.select(*rest, F.size("words").cast("long").alias("n_words"), F.arrays_zip(*[c.alias(f"w{j}") for j, c in enumerate(shifted)]).alias("zip"))
    rows = rows.select(*rest, "n_words", F.posexplode_outer("zip").alias("at", "w"))
    return rows.select(*rest, "n_words", "at", *[F.col(f"w.w{j}").alias(f"w{j}") for j in range(K)])


def template_windows(spark: SparkSession, given: Sequence[Template]) -> DataFrame:
    """Windows of the templates; their number is that of the words given."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(text).alias("text"))
        for i, (label, base, text) in enumerate(given)
    ])
    listed = spark.range(1).select(F.inline(rows)).select("template", "label", "base", words_of(F.col("text")).alias("words"))
    found = windows(listed).where(F.col("at") + F.least(F.lit(K), F.col("n_words")) <= F.col("n_words"))
    return found.where("n_words >= 2").withColumnRenamed("n_words", "size")


def votes(df: DataFrame, text: str, keep: Sequence[str], given: Sequence[Template]) -> DataFrame:
    """For each row of ``df`` its number, ``row`` (the columns ``keep``) and ``n_words``, once
    without a template, and once for each ``template, diagonal, block`` with votes: ``mask`` has
    a bit for each of the ``BITS`` template windows of the block that the text has there."""
    rows = windows(df.select(
        F.monotonically_increasing_id().alias("number"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        words_of(F.col(f"`{text}`")).alias("words"),
    )).withColumn("hash", F.when(F.col("w1").isNotNull(), F.xxhash64("w0", "w1")))
    known = template_windows(df.sparkSession, given).select(
        F.xxhash64("w0", "w1").alias("t_hash"), "template", F.col("at").alias("t_at"), *[F.col(f"w{j}").alias(f"t{j}") for j in range(K)]
    )
    equal = (F.col("hash") == F.col("t_hash")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1"))
    for j in range(2, K):
        equal &= F.col(f"t{j}").isNull() | (F.col(f"w{j}") == F.col(f"t{j}"))
    met = rows.join(F.broadcast(known), equal, "left")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t_at") % BITS)
    return met.groupBy(
        "number", "row", "n_words", "template", (F.col("at") - F.col("t_at")).cast("long").alias("diagonal"),
        F.floor(F.col("t_at") / BITS).cast("int").alias("block"),
    ).agg(F.bit_or(bit).alias("mask"))


def spans(found: DataFrame, given: Sequence[Template]) -> DataFrame:
    """Verified spans of ``votes``: ``number, label, base, start, stop`` (words) and ``cover``."""
    sizes = template_windows(found.sparkSession, given).select("template", "label", "base", "size").distinct()
    rows = found.where(F.col("template").isNotNull()).join(F.broadcast(sizes), "template")
    order = Window.partitionBy("number", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    near = F.when(F.col("size") >= LONG, SHIFT).otherwise(0)
    rows = rows.withColumn("new", F.when(step <= near, 0).otherwise(1))
    rows = rows.withColumn("span", F.sum("new").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    at = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("getbit", F.col("mask"), i) == 1), lambda i: i + F.col("block") * BITS
    )
    rows = rows.select("number", "label", "base", "size", "template", "span", "diagonal", at.alias("at"))
    width = F.least(F.lit(K), F.col("size"))
    grouped = rows.groupBy("number", "template", "span", "label", "base", "size").agg(
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"), (F.max(F.col("diagonal") + F.array_max("at"))).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),  # at most the windows of the template
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(i.cast("long"), i + width - 1)))))
    judged = grouped.withColumn("cover", covered / F.col("size"))
    enough = F.when(F.col("size") >= LONG, COVER).otherwise(1.0)
    return judged.where(F.col("cover") >= enough).select("number", "label", "base", "start", (F.col("last") + width).alias("stop"), "cover")


def scan(df: DataFrame, keep: Sequence[str], text: str = "text", given: Sequence[Template] | None = None) -> DataFrame:
    """Add ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and
    ``score`` (the largest share of a template that a span covers) to the columns ``keep``."""
    given = templates() if given is None else given
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    keep = [c for c in keep if c not in added]
    found = saved(votes(df, text, keep, given), "license-votes")
    by_row = spans(found, given).groupBy("number").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("cover").alias("score"),
    )
    rows = found.where(F.col("template").isNull()).select("number", "row", "n_words").join(by_row, "number", "left")
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in keep], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", *[F.coalesce(F.array_join(c, ","), F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), ["doc_id"])


_LISTED = ",\n  ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, (label, base, text) in enumerate(templates()))
OP13_SQL = rf"""
WITH given(template, label, base, said) AS (VALUES
  {_LISTED}
), t AS (
  SELECT *, len(w) AS size, least({K}, len(w)) AS k FROM (SELECT template, label, base, string_split(said, ' ') AS w FROM given)
), tw AS (
  SELECT *, w[q + 1 : q + k] AS g FROM (SELECT *, unnest(generate_series(0, size - k)) AS q FROM t)
), d AS (
  SELECT row_number() OVER () AS number, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_NO_WORD}'), lambda x: x <> '') AS w FROM documents
), dw AS (
  SELECT number, p, w[p + 1 : p + k] AS g FROM (
    SELECT number, w, k, unnest(generate_series(0, len(w) - k)) AS p FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)
), v AS (
  SELECT DISTINCT number, template, p - q AS diagonal, q FROM dw JOIN tw USING (g)
), lagged AS (
  SELECT *, dense_rank() OVER (PARTITION BY number, template ORDER BY diagonal) AS nth FROM v
), diagonals AS (
  SELECT DISTINCT number, template, diagonal, nth FROM lagged
), fresh AS (
  SELECT number, template, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY number, template ORDER BY diagonal)
    <= CASE WHEN size >= {LONG} THEN {SHIFT} ELSE 0 END THEN 0 ELSE 1 END AS new FROM diagonals JOIN t USING (template)
), spans AS (
  SELECT number, template, diagonal, sum(new) OVER (PARTITION BY number, template ORDER BY diagonal) AS span FROM fresh
), words AS (
  SELECT number, template, span, diagonal, q, unnest(generate_series(q, q + k - 1)) AS word
  FROM v JOIN spans USING (number, template, diagonal) JOIN t USING (template)
), found AS (
  SELECT number, label, base, min(diagonal + q) AS start, count(DISTINCT word) / any_value(size)::DOUBLE AS cover, any_value(size) AS size
  FROM words JOIN t USING (template) GROUP BY number, template, span, label, base
), kept AS (
  SELECT * FROM found WHERE cover >= CASE WHEN size >= {LONG} THEN {COVER} ELSE 1.0 END
), by_row AS (
  SELECT number, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(cover) AS score FROM kept GROUP BY number
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN by_row USING (number)
"""
