"""Quality rules: counts, repeats and distribution divergence from language references.

A document is compared with the reference of its language by two Jensen-Shannon distances
(base 2, so between 0 and 1): over character classes and over common words. The references
are histograms over all documents of the language. A word is common if it makes up at least
``COMMON`` of the words of its language, so a reference has at most ``1 / COMMON`` of them.
Every language has its own reference, whatever its share of the corpus: a row of a stored
table, which goes to all tasks at once only if it is measured to be small and is joined by
language otherwise. Words are counted inside tasks before they are shuffled.

Defined results: null and empty texts have no words and fail the base rules; both distances
are null, and decide nothing, for rows without a language and for languages of fewer than
``min_reference`` words; below ``min_chars`` or ``min_words`` the distance concerned is null;
rows are judged one by one, so repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.config import broadcast_if_small
from softsearch.llm.common import map_texts, saved, table

#: Least share of a common word among the words of its language.
COMMON = 0.002
#: Least number of words of a language whose documents are held to its reference.
MIN_REFERENCE = 1000
#: Distinct words, and languages, that a worker counts before it passes the counts on.
CHUNK_WORDS = 150_000
CHUNK_LANGS = 10_000
#: Largest references, in bytes, that are sent to all tasks; references that a worker remembers of larger ones.
REFERENCE_BYTES = 4 << 20
REMEMBERED = 64
#: Characters counted as symbols, and punctuation taken off words before they are looked up.
SYMBOLS = b"#*$%&|<>"
EDGES = b".,;:!?\"'()"
CLASSES = ["vowel", "consonant", "upper", "digit", "space", "line", "stop", "mark", "symbol", "control", "other"]


#: Largest distances of a kept document, over classes and over common words.
MAX_CLASS = 0.25
MAX_WORD = 0.45


def class_of_byte() -> np.ndarray:
    """Character class of the first byte of a code point; -1 for the bytes that follow it."""
    kind = np.full(256, CLASSES.index("other"))
    for name, members in {
        "control": bytes(range(32)) + b"\x7f", "symbol": bytes(range(33, 127)), "space": b" \t", "line": b"\r\n",
        "stop": b".,", "mark": b";:!?'\"()-", "digit": b"0123456789", "vowel": b"aeiou",
        "consonant": b"bcdfghjklmnpqrstvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    }.items():
        kind[list(members)] = CLASSES.index(name)
    kind[0x80:0xC0] = -1
    return kind


def byte_counts(raw: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(raw, np.uint8), minlength=256)


def class_counts(by_byte: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return np.bincount(kind[kind >= 0], by_byte[kind >= 0], minlength=len(CLASSES))


def repeated_words(words: list) -> int:
    """Words that lie in a three-word window found at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows) if len(set(windows)) < len(windows) else None
    if not counts:
        return 0
    total, covered = 0, 0  # covered: end of the words counted so far
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(covered, i)
            covered = i + 3
    return total


def base_counts(text: str, words: list, by_byte: np.ndarray) -> tuple[int, int, int, int]:
    """Code points in words, symbols, repeated lines, repeated words."""
    spaces, symbols = (int(by_byte[list(x)].sum()) for x in (b" \t\n\x0b\x0c\r", SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return (
        len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words),
    )


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms with at least one count each."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    parts = [np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])) for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def _bare(counts: Counter) -> Counter:
    """Words without punctuation at their ends, in lower case of A-Z."""
    bare = Counter()
    for word, n in counts.items():
        if word := word.lower().strip(EDGES):
            bare[word] += n
    return bare


def _count(df: DataFrame, text: str, lang, make: Callable) -> DataFrame:
    """``lang, key, n`` summed over all documents. ``make()`` gives a counter of a task: a pair
    of functions (add a text of a language, rows so far or None if there is room for more)."""

    def run(batches):
        add, rows = make()

        def out(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in found], type=t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["lang", "key", "n"],
            )

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                add(name, (value or "").encode("utf-8", "surrogatepass"))
                if found := rows(False):
                    yield out(found)
        yield out(rows(True))

    counted = df.select(lang.alias("lang"), F.col(f"`{text}`").alias("text")).mapInArrow(run, "lang string, key string, n long")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _count_classes():
    kind, sums = class_of_byte(), defaultdict(lambda: np.zeros(len(CLASSES) + 1))

    def add(name, raw):
        sums[name] += np.append(class_counts(byte_counts(raw), kind), len(raw.split()))

    def rows(end):
        if not end and len(sums) < CHUNK_LANGS:
            return None
        found = [(name, key, int(n)) for name, c in sums.items() for key, n in zip([*CLASSES, "words"], c)]
        sums.clear()
        return found

    return add, rows


def _count_words():
    words, held = defaultdict(Counter), 0

    def add(name, raw):
        nonlocal held
        counts = words[name]
        held -= len(counts)
        counts.update(raw.split())
        held += len(counts)

    def rows(end):
        nonlocal held
        if not end and held < CHUNK_WORDS and len(words) < CHUNK_LANGS:
            return None
        found = [(name, w.decode("utf-8", "replace"), n) for name, c in words.items() for w, n in _bare(c).items()]
        words.clear()
        held = 0
        return found

    return add, rows


class References(Mapping):
    """The table of references, one row per language: ``lang``, ``classes`` (counts by class),
    ``common`` (of ``word`` and ``n``) and ``words`` (in all). As a mapping it reads the row of a
    language: ``(class histogram, {common word: count}, words in all)``. Under ``None`` are the
    counts of rows without a language, which no document is compared with."""

    def __init__(self, rows: DataFrame):
        self.table = rows

    def __getitem__(self, lang: str | None) -> tuple:
        row = self.table.where(F.col("lang").eqNullSafe(F.lit(lang).cast("string"))).first()
        if row is None:
            raise KeyError(lang)
        return np.array(row.classes, float), {x.word: x.n for x in row.common}, row.words

    def __iter__(self) -> Iterator:
        return (r.lang for r in self.table.select("lang").collect())

    def __len__(self) -> int:
        return self.table.count()


def language_references(df: DataFrame, text: str = "text", lang: str = "lang") -> References:
    lang = F.col(f"`{lang}`").cast("string")
    first = saved(_count(df, text, lang, _count_classes), "quality-classes")
    of = {k: F.coalesce(F.sum(F.when(F.col("key") == k, F.col("n"))), F.lit(0)) for k in [*CLASSES, "words"]}
    whole = first.groupBy("lang").agg(F.array(*[of[k] for k in CLASSES]).alias("classes"), of["words"].alias("words"))
    totals = first.where((F.col("key") == "words") & F.col("lang").isNotNull()).select("lang", F.col("n").alias("words"))
    counted = _count(df.where(lang.isNotNull()), text, lang, _count_words).join(broadcast_if_small(totals), "lang")
    common = counted.where(F.col("n") >= F.greatest(F.lit(1.0), COMMON * F.col("words"))).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct(F.col("key").alias("word"), "n"))).alias("common")
    )
    none = F.array().cast(common.schema["common"].dataType)
    rows = whole.join(common, "lang", "left").select("lang", "classes", F.coalesce("common", none).alias("common"), "words")
    return References(saved(rows, "quality-references"))


def _ready(told: str) -> tuple[np.ndarray, dict, np.ndarray]:
    """Class histogram, place of each common word, and their counts with the rest at the end."""
    ref = json.loads(told)
    index = {x["word"].encode("utf-8"): i for i, x in enumerate(ref["common"])}
    shares = np.array([x["n"] for x in ref["common"]], float)
    return np.array(ref["classes"], float), index, np.append(shares, max(0.0, ref["words"] - shares.sum()))


def judge(
    df: DataFrame, references: References, keep: list[str], text: str = "text", lang: str = "lang", *, min_words: int = 50,
    max_repeated: float = 0.5, min_chars: int = 200, max_class: float = MAX_CLASS, max_word: float = MAX_WORD,
    min_reference: int = MIN_REFERENCE,
) -> DataFrame:
    """Add the counts, both distances, ``base_failed`` and ``kept`` to the columns ``keep``.

    ``class_distance`` is null below ``min_chars`` characters, ``word_distance`` below
    ``min_words`` words or where the reference has no common words; both are null where the
    language is null or has fewer than ``min_reference`` words. A document is kept if it
    passes the base rules (``min_words`` words, at most ``max_repeated`` of them in repeated
    windows) and no distance is above its limit.
    """
    usable = references.table.where(F.col("lang").isNotNull() & (F.col("words") >= min_reference)).select(
        F.col("lang").alias("_of"), F.to_json(F.struct("classes", "common", "words")).alias("_told")
    )
    size = usable.agg(F.sum(F.octet_length("_of") + F.octet_length("_told") + F.lit(16).cast("long"))).first()[0] or 0
    sent = {r["_of"]: r["_told"] for r in usable.collect()} if size <= REFERENCE_BYTES else None

    def make():
        kind = class_of_byte()
        refs = {name: _ready(told) for name, told in (sent or {}).items()}
        nothing = np.zeros(len(CLASSES)), {}, np.zeros(1)

        def reference(name, told):
            if told is not None and name not in refs:
                if len(refs) >= REMEMBERED:
                    refs.clear()
                refs[name] = _ready(told)
            return refs.get(name, nothing)

        def func(texts, langs, said):
            out = []
            for value, name, told in zip(texts, langs, said):
                value = value or ""
                raw = value.encode("utf-8", "surrogatepass")
                words = raw.split()
                by_byte = byte_counts(raw)
                chars, symbols, lines, repeated = base_counts(value, words, by_byte)
                classes, index, shares = reference(name, told)
                class_distance = word_distance = None
                if len(value) >= min_chars and classes.sum():
                    class_distance = js_distance(class_counts(by_byte, kind), classes)
                if len(words) >= min_words and index:
                    found = np.zeros(len(shares))
                    for word, n in _bare(Counter(words)).items():
                        found[index.get(word, -1)] += n
                    word_distance = js_distance(found, shares) if found.sum() else 1.0
                failed = len(words) < min_words or repeated > max_repeated * len(words)
                kept = not failed and (class_distance or 0.0) <= max_class and (word_distance or 0.0) <= max_word
                out.append((len(words), chars, symbols, lines, repeated, class_distance, word_distance, failed, kept))
            return list(zip(*out)) if out else [[]] * 9

        return func

    named = F.col(f"`{lang}`").cast("string")
    if sent is None:
        df = df.join(usable, named == F.col("_of"), "left")
    told = F.lit(None).cast("string") if sent is not None else F.col("_told")
    both = df.withColumns({"_lang": named, "_told": told})
    return map_texts(
        both, text, keep, make,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, "
        "word_distance double, base_failed boolean, kept boolean", ["_lang", "_told"],
    )


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, language_references(docs), ["doc_id"])
