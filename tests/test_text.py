import re

import pytest
from pyspark.sql import functions as F

from softsearch.functions import text as tx
from softsearch.sources.corpus import distinct_queries, load_corpus, load_summary, select_subset, with_category


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn("t")).first()[0]


# input and what is left of it
CLEANED = [
    ("", ""), ("From: a\nSubject: b\n", ""), ("Fromage is nice\nkept", "kept"), ("from x\nhello\n> quoted\nDate", "hello Date"),
    ("> only", ""), ("a@b.c x", "x"), ("@foo.bar y", "foo bar y"), ("a@@b.c.d z", "z"), ("a@.b", "a b"), ("x a@b. y", "x a b y"),
    ("a@b.c.", ""), ("\x1ca\x1fb@c.d\x1d", "a"), ("é@è.ü ü", "ü"), ("a@b@c.d", ""), ("@@b.c", ""), ("ab@cd", "ab cd"), ("a@b..", ""),
    ("é ⁵ ² ½ _x_", "é ⁵ ² ½ _x_"), ("tab\there\r\nnext\u2028line\xa0end", "tab here next line end"), ("x" * 600, "x" * 600),
    ("a b " * 300, "a b " * 299 + "a b"), ("Lines: 3\n> q\nmail me: joe@host.org, now!\n  spaced   out  ", "mail me now spaced out"),
    ("I\u0307stanbul e\u0301tude", "I stanbul e tude"), ("kept\nFrom: tail", "kept From tail"),
]


def test_clean_text_gives_the_expected_texts(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "i int, t string").select("i", tx.clean_text("t").alias("c"))
    assert {r.i: r.c for r in rows.collect()} == {i: want for i, (_, want) in enumerate(CLEANED)}


def test_single_steps(spark):
    assert one(spark, "Subject: hi\nbody", tx.strip_header_lines) == "body"
    assert one(spark, "Fromage\nbody", lambda c: tx.strip_header_lines(c, strict=True)) == "Fromage\nbody"
    assert one(spark, "a\n> b\nc", tx.strip_quoted_lines) == "a\n\nc"
    assert "@" not in one(spark, "write to joe@host.org today", tx.blank_emails)
    assert one(spark, "a,b!c", tx.blank_punctuation) == "a b c"
    assert one(spark, "  a \n\t b ", tx.collapse_space) == "a b"
    assert len(one(spark, "y" * 2000, tx.clean_text)) == 2000
    assert len(one(spark, "y" * 2000, lambda c: tx.clean_text(c, 512))) == 512
    assert one(spark, "", tx.clean_text) == ""


def test_one_very_long_run_is_linear(spark):
    text = "a" * 1_000_000
    assert one(spark, text + "@", lambda c: F.length(tx.blank_emails(c))) == 1_000_001


def test_fixed3_prints_like_c(spark):
    values = [round(i / 10000, 4) for i in range(-10000, 10001, 5)] + [0.1234, 0.9999, 0.0004]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", tx.fixed3("v").alias("s")).collect()
    assert [(r.v, r.s) for r in rows if float(r.s) != float("%.3f" % r.v)] == []


def test_post_parts(spark):
    post = "From: a\nSubject: b\n\nJoe writes:\n> old\nnew text\nmore\n--\nJoe\n"
    assert one(spark, post, tx.strip_post_parts) == "new text\nmore"
    assert one(spark, "no blank line", tx.strip_post_header) == ""
    assert one(spark, "---\nonly first line is a rule", tx.strip_post_footer) == "---\nonly first line is a rule"


@pytest.fixture(scope="module")
def posts(spark):
    long, medium = "A fairly long sentence about things. " * 15, "Another sentence of some length here. " * 10
    rows = [(1, long, 3), (2, medium, 1), (3, "hi", 0), (4, long, 17), (5, "From: x\n" + medium, 17), (6, long + " tail", 2)]
    return spark.createDataFrame(rows, "src_id long, text string, label int")


def test_corpus_drops_short_and_keeps_first_copy(posts):
    rows = {r.src_id: r for r in load_corpus(posts).collect()}
    assert set(rows) == {1, 2, 6}  # 6 agrees with 1 in its first 512 characters only
    assert set(r.src_id for r in load_corpus(posts, max_chars=512).collect()) == {1, 2}
    assert rows[1].label == 3 and rows[2].label == 1
    assert all(re.fullmatch("[0-9a-f]{16}", r.doc_id) for r in rows.values())
    assert load_summary(posts).first().asDict() == {
        "n_read": 6, "n_kept": 3, "n_short": 1, "n_duplicate": 2, "n_dropped": 3,
    }


def test_unknown_category_is_kept(spark):
    docs = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "src_id long, label int")
    names = spark.createDataFrame([(5, "five")], "label int, category string")
    assert {r.src_id: r.category for r in with_category(docs, names).collect()} == {1: "five", 2: None, 3: None}


def test_posts_lose_their_parts_when_loaded(spark):
    body = "what was said here is long enough to be kept as a document of its own"
    rows = spark.createDataFrame([(1, f"From: a\n\nIn article x\n> old\n{body}\n--\nJoe\n", 0)], "src_id long, text string, label int")
    assert load_corpus(rows, strip_parts=True).first().text == body


def test_all_short_is_empty(posts):
    assert load_corpus(posts.where("src_id = 3")).isEmpty()
    assert load_summary(posts.limit(0)).first().n_read == 0


def test_first_copy_does_not_depend_on_layout(posts):
    spread = [load_corpus(posts.repartition(n)).orderBy("doc_id").collect() for n in (1, 7)]
    assert spread[0] == spread[1]


def test_subset_and_distinct(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "t string, split string")
    assert select_subset(df, "train").count() == 1 and select_subset(df).count() == 2
    with pytest.raises(ValueError):
        select_subset(df, "dev")
    pairs = spark.createDataFrame([("a", "b"), ("b", None)], "q1 string, q2 string")
    assert sorted(r[0] for r in distinct_queries(pairs, "q1", "q2").collect()) == ["a", "b"]


def test_repeated_text_is_combined_before_the_shuffle(posts):
    plan = load_corpus(posts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and plan.count("Exchange") == 1
