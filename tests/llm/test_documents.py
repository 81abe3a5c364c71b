"""Operators on single documents: quality rules, secrets, toxicity, importance, segmentations, packing."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from softsearch.llm import importance, packing, quality_rules, secret_scan, segment_sampling, toxicity
from softsearch.llm.common import table
from softsearch.llm.minhash import mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, score string, ids string, key string"
LONG = "word " * 60_000 + "end"


def odd_rows():
    """Null and repeated keys, null, empty, blank and very long texts, and columns named like results."""
    texts = [None, "", " \n\t ", LONG, "same text here", "same text here", "x", "a  b c \n d\x0b\te\x1ff"]
    keys = [1, 2, None, 4, 5, 5, None, 8]
    return [(k, t, None if i % 3 else "en", None if i % 2 else "s", 1, "k", "r", "s", "i", "y") for i, (k, t) in enumerate(zip(keys, texts))]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# quality rules


def brute_counts(text):
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_quality_counts_match_brute_force(spark, small, odd):
    for docs in (table(spark, small, "documents").where("doc_id % 2 = 0"), odd):
        texts = Counter((r.doc_id, brute_counts(r.text)) for r in docs.select("doc_id", "text").collect())
        out = quality_rules.judge(docs, quality_rules.language_references(docs), ["doc_id"]).collect()
        assert Counter((r.doc_id, tuple(r[1:6])) for r in out) == texts
        for r in out:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_quality_references_and_distances(spark):
    good = "the cat sat on the mat and the dog ran to the door of the old house " * 8
    rows = [(i, f"{good} {i}", "en") for i in range(20)] + [(99, "zz## || QQ " * 60, "en"), (100, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = quality_rules.language_references(docs)
    counted = Counter(w.lower().strip(".,;:!?\"'()") for _, t, lang in rows if lang for w in t.split())
    total = sum(len(t.split()) for _, t, lang in rows if lang)
    assert refs["en"][1] == {w: n for w, n in counted.items() if w and n >= quality_rules.COMMON * total}
    assert refs["en"][2] == total and set(refs) == {"en", None}
    out = {r.doc_id: r for r in quality_rules.judge(docs, refs, ["doc_id"], max_repeated=1.0).collect()}
    assert out[0].kept and not out[99].kept and out[99].class_distance > out[0].class_distance
    assert out[100].class_distance is None and out[100].word_distance is None


@pytest.mark.parametrize("limit", [quality_rules.REFERENCE_BYTES, 0])  # sent to the tasks, joined by language
def test_every_language_has_its_own_reference(spark, monkeypatch, limit):
    monkeypatch.setattr(quality_rules, "REFERENCE_BYTES", limit)
    monkeypatch.setattr(quality_rules, "CHUNK_LANGS", 3)
    monkeypatch.setattr(quality_rules, "REMEMBERED", 2)
    good = "the cat sat on the mat and the dog ran to the door of the old house " * 8
    texts = [(f"{good} {i}", "en") for i in range(3000)] + [(f"{good} {i}", None) for i in range(40)]
    for n, lang in enumerate(["zh", "ja", "ko", "ru"]):  # each less than a hundredth of the words
        at = 0x4E00 + 40 * n
        texts += [(" ".join(chr(at + (i + j) % 11) * 9 for j in range(60)), lang) for i in range(25)]
    texts += [(good + "zz## " * 40, "few"), ("zz## || QQ " * 60, None), ("zz## || QQ " * 60, "zh")]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string, words string")
    refs = quality_rules.language_references(docs)
    assert set(refs) == {"en", None, "zh", "ja", "ko", "ru", "few"} and refs["few"][2] == 176
    for lang in ("zh", "ru"):
        held = [t for t, name in texts if name == lang]
        assert refs[lang][0][quality_rules.CLASSES.index("other")] == sum(ord(c) > 127 for t in held for c in t)
        assert refs[lang][2] == sum(len(t.split()) for t in held) < 0.01 * 3000 * 137
    out = {r.doc_id: r for r in quality_rules.judge(docs, refs, ["doc_id", "lang", "words"], max_repeated=1.0).collect()}
    assert len(out) == len(texts) and all(r.words == "x" for r in out.values())
    for i, (_, lang) in enumerate(texts[:-1]):
        assert out[i].kept, (i, lang, out[i])
        assert (out[i].class_distance is None) == (out[i].word_distance is None) == (lang in (None, "few"))
    last = out[len(texts) - 1]
    assert not last.kept and last.class_distance > quality_rules.MAX_CLASS


def test_js_distance():
    assert quality_rules.js_distance(np.array([1, 1.0]), np.array([2, 2.0])) == 0
    assert quality_rules.js_distance(np.array([1, 0.0]), np.array([0, 3.0])) == pytest.approx(1)


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_secret_base_spans_match_brute_force(spark, small, odd):
    docs = table(spark, small, "documents").select("doc_id", "text", "source")
    tricky = ["API_KEY='abcdefghijklmnop' password: token = 0123456789abcdef0", "é AKIAABCDEFGHIJKLMN", "ſecret=abcdefghijklmn", "tokEN=short token=aaaaaaaaaaaa.b"]
    docs = docs.union(spark.createDataFrame([(10_000 + i, t, "s") for i, t in enumerate(tricky)], docs.schema)).union(odd.select("doc_id", "text", "source"))
    want = Counter((r.doc_id, hashlib.sha256(",".join(brute_spans(r.text)).encode()).hexdigest()) for r in docs.collect())
    out = secret_scan.scan(docs, ["doc_id"], "source", "doc_id").collect()
    assert Counter((r.doc_id, r.base_sha256) for r in out) == want
    assert all(r.n_assign + r.n_access + r.n_hex <= len(r.found) for r in out)


def test_ownership_separates_examples_from_live_values(spark):
    shared, own, entropy = "password=copiedexample123", "password=onlyminehere999", "Zk3xQ9vLm2Tt7Rb5Wp8Yc4"
    rows = [(i, f"say {shared} and", f"owner{i % 4}") for i in range(8)] + [(50, f"x {own}", "owner1"), (51, f"value {entropy} end", "owner2")]
    rows += [(60 + i, f"the Zz9example0Aa8copied1B here", f"owner{i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in secret_scan.scan(docs, ["doc_id", "text"], "source", "doc_id").collect()}
    assert [(x.live, x.n_owners, x.n_repos) for x in out[0].found] == [(False, 4, 8)] and out[50].found[0].live
    assert out[51].spans == f"entropy:6:{6 + len(entropy)}" and out[60].spans == out[60].copied_spans == "entropy:4:26"
    clean = secret_scan.scan(docs, ["doc_id", "text"], "source", "doc_id").select("doc_id", secret_scan.redacted(F.col("text"), F.col("found")).alias("t"))
    texts = {r.doc_id: r.t for r in clean.collect()}
    assert texts[50] == "x [SECRET]" and texts[51] == "value [SECRET] end" and shared in texts[0]


def test_a_secret_of_one_owner_is_live_in_any_number_of_documents(spark, tmp_path):
    import corpus_pipeline

    github, key, example = "ghp_" + "a1B2" * 9, "AKIAONEOWNERSKEY01", "Zz9example0Aa8copied1B"
    own = f"password=onlyminehere999 {key} {github} 0123456789abcdef01"
    texts = [(f"{i} {own}", "hot") for i in range(300)] + [(f"copy {own}", "hot")] * 200 + [(own, None)]
    texts += [(f"the {example} here password=copiedexample123", f"owner{i}") for i in range(3)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, (t, s) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in secret_scan.op2_secret_ownership(spark, str(tmp_path)).collect()}
    assert len(out) == 504 and all(out[i].n_live == 4 and "github:" in out[i].spans and out[i].copied_spans == "" for i in range(501))
    for i in range(501, 504):
        assert out[i].n_live == 0 and out[i].spans == out[i].copied_spans == "entropy:4:26,assign:32:57"
    clean = {r.doc_id: r.text for r in corpus_pipeline.secret_scan(spark, docs, str(tmp_path)).collect()}
    assert clean[0] == "0 [SECRET] [SECRET] [SECRET] [SECRET]" and clean[499] == "copy [SECRET] [SECRET] [SECRET] [SECRET]"
    assert clean[501] == texts[501][0]


def test_overlapping_spans_are_redacted_once(spark):
    text = "é token = 0123456789abcdef0123 é 0123456789abcdef99"
    docs = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    out = secret_scan.scan(docs, ["text"], "source", "doc_id").select(secret_scan.redacted(F.col("text"), F.col("found")).alias("t")).first()
    assert out.t == "é [SECRET] é [SECRET]"


def test_distances_match_brute_force(spark, small):
    """Character by character and word by word; the divergence from entropies."""
    kinds = {**dict.fromkeys("aeiou", "v"), **dict.fromkeys("bcdfghjklmnpqrstvwxyz", "c"), **dict.fromkeys("0123456789", "d")}
    kinds |= {**dict.fromkeys(" \t", "s"), **dict.fromkeys("\r\n", "l"), **dict.fromkeys(".,", "."), **dict.fromkeys(":;!?'\"()-", "m")}

    def kind(c):
        return kinds.get(c) or ("A" if "A" <= c <= "Z" else "o" if ord(c) > 127 else "x" if ord(c) < 32 or ord(c) == 127 else "y")

    def bare(text):
        found = (re.sub("[A-Z]", lambda m: m[0].lower(), w).strip(".,;:!?\"'()") for w in words(text))
        return Counter(w for w in found if w)

    def distance(p, q):
        entropy = lambda x: -math.fsum(v * math.log2(v) for v in x.values() if v)
        p, q = ({k: v / sum(x.values()) for k, v in x.items()} for x in (p, q))
        middle = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
        return math.sqrt(max(0.0, entropy(middle) - (entropy(p) + entropy(q)) / 2))

    docs = table(spark, small, "documents")
    texts = {r.doc_id: (r.lang, r.text or "") for r in docs.collect()}
    classes, counts, totals = {}, {}, Counter()
    for lang, text in texts.values():
        classes.setdefault(lang, Counter()).update(map(kind, text))
        counts.setdefault(lang, Counter()).update(bare(text))
        totals[lang] += len(words(text))
    common = {}
    for lang, c in counts.items():
        common[lang] = {w: n for w, n in c.items() if n >= quality_rules.COMMON * totals[lang]}
        common[lang][None] = totals[lang] - sum(common[lang].values())
    out = quality_rules.judge(docs, quality_rules.language_references(docs), ["doc_id"]).collect()
    seen = 0
    for r in out:
        lang, text = texts[r.doc_id]
        usable = lang is not None and totals[lang] >= quality_rules.MIN_REFERENCE
        if usable and len(text) >= 200:
            assert abs(r.class_distance - distance(Counter(map(kind, text)), classes[lang])) < 1e-5
        else:
            assert r.class_distance is None
        if usable and len(words(text)) >= 50:
            found = Counter()
            for w, n in bare(text).items():
                found[w if w in common[lang] else None] += n
            assert abs(r.word_distance - (distance(found, common[lang]) if found else 1.0)) < 1e-5
            seen += 1
        else:
            assert r.word_distance is None
        assert r.kept == (not r.base_failed and (r.class_distance or 0) <= quality_rules.MAX_CLASS and (r.word_distance or 0) <= quality_rules.MAX_WORD)
    assert seen > 50


# importance resampling


def test_kth_largest_is_exact(spark):
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=3000) * 1e6, np.repeat([1.5, 2.5, -3.0], 40), np.array([7.0]), np.nextafter(1.0, [0.0, 2.0, 2.0])):
        rows = spark.createDataFrame([(float(x),) for x in values], "v double")
        for k in {1, len(values) // 2 or 1, len(values)}:
            assert importance.kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]


def test_importance_keeps_good_documents(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    out = importance.resample(docs, labels, ["doc_id"])
    marked = out.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
    share = {r.quality: r.share for r in marked}
    assert share[1] > 0.98 and share[0] < 0.4
    weights = {r.doc_id: r for r in out.collect()}
    limit = min(r.gumbel_score for r in weights.values() if r.kept)
    assert all(r.kept == (r.gumbel_score >= limit) for r in weights.values())


def brute_buckets(text):
    """Buckets of n-grams, word by word in plain integers."""
    mask, golden = (1 << 64) - 1, importance.GOLDEN
    one = [zlib.crc32(w.lower()) for w in (text or "").encode().split()]

    def shape(word):
        kinds = b"".join(b"A" if 65 <= c <= 90 else b"a" if 97 <= c <= 122 or c >= 128 else b"0" if 48 <= c <= 57 else bytes([c]) for c in word)
        return zlib.crc32(re.sub(rb"(?s)(.)\1+", rb"\1\1", kinds))

    shapes = [shape(w) for w in (text or "").encode().split()]
    spread = lambda x, bits: ((x & mask) * golden & mask) >> (64 - bits)
    out = [spread(x, 15) for x in one]
    for i in range(len(one) - 1):
        out.append(spread(one[i] * golden + one[i + 1], 15))
        pair = (shapes[i] * importance.MIX_A + shapes[i + 1]) * importance.MIX_B + (one[i] == one[i + 1])
        out.append((1 << 15) + spread(pair, 12))
    return out


def test_importance_weights_and_draw_match_brute_force(spark, small):
    """Log weights, noise and kept set, from the labelled keys that the same rule picks."""
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    u = importance.uniform
    noise = docs.select("doc_id", "text", u(F.col("doc_id"), 6).alias("n"), (u(F.col("doc_id"), 8) < 2 / 3).alias("fit"))
    rows, good = noise.collect(), {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    # fewer labels than the bound: all but a twentieth of them, or all, may be sampled
    part = min(1.0, 0.95 * importance.MAX_LABELLED / len(good))
    assert part == 1.0
    raw, target, found = Counter(), Counter(), {}
    for r in rows:
        found[r.doc_id] = brute_buckets(r.text)
        raw.update(found[r.doc_id])
        if good.get(r.doc_id) == 1 and r.fit:
            target.update(found[r.doc_id])
    scale = sum(target.values()) / sum(raw.values())
    ratio = {b: math.log((target[b] + importance.SMOOTHING) / (n * scale + importance.SMOOTHING)) for b, n in raw.items()}
    weight = {i: math.fsum(ratio[b] for b in x) * min(1, importance.EFFECTIVE / max(1, len(x))) for i, x in found.items()}
    value = {r.doc_id: weight[r.doc_id] - math.log(-math.log(r.n)) for r in rows}
    for given in ({}, {"k": 37}, {"share": 0.5}):
        out = {r.doc_id: r for r in importance.resample(docs, labels, ["doc_id"], **given).collect()}
        assert all(r.n_grams == len(found[i]) for i, r in out.items())
        assert all(abs(r.log_weight - weight[i]) < 1e-7 and abs(r.gumbel_score - value[i]) < 1e-7 for i, r in out.items())
        held = [i for i in weight if i in good and not next(r.fit for r in rows if r.doc_id == i)]
        cuts = sorted({weight[i] for i in held} | {math.inf})
        cost = lambda c: sum(importance.LOSS * (weight[i] < c) if good[i] == 1 else weight[i] >= c for i in held)
        best = min(cuts, key=lambda c: (cost(c), c))
        below = max((weight[i] for i in held if weight[i] < best), default=best)
        n = given.get("k") or (math.ceil(len(rows) / 2) if given else sum(w >= (best + below) / 2 for w in weight.values()))
        assert {i for i, r in out.items() if r.kept} == set(sorted(value, key=value.get, reverse=True)[:n])


def test_importance_draws_in_proportion(spark):
    """Over many seeds, rows are drawn as often as a draw without replacement by weight draws them."""
    texts = ["good words here", "good words there", "bad stuff", "more bad stuff here"]
    docs = spark.createDataFrame([(i, texts[i % 4]) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(40)], "doc_id long, quality int")
    first = importance.resample(docs, labels, ["doc_id"], k=1, effective=2.0)
    weight = {r.doc_id: math.exp(r.log_weight) for r in first.collect()}
    total, keys = sum(weight.values()), spark.range(40)
    seeds = range(6, 406)
    draws = keys.select("id", *[(-F.log(-F.log(importance.uniform(F.col("id"), s)))).alias(f"s{s}") for s in seeds]).collect()
    won = Counter(max(draws, key=lambda r: r[f"s{s}"] + math.log(weight[r.id])).id % 4 for s in seeds)
    for kind in range(4):
        p = sum(w for i, w in weight.items() if i % 4 == kind) / total
        assert abs(won[kind] / 400 - p) < 5 * math.sqrt(p * (1 - p) / 400) + 1e-9
    kept = [r.doc_id for r in first.collect() if r.kept]
    assert kept == [max(draws, key=lambda r: r.s6 + math.log(weight[r.id])).id]
    assert importance.resample(docs, labels, ["doc_id"], k=0).where("kept").count() == 0
    assert importance.resample(docs, labels, ["doc_id"], k=100).where("kept").count() == 40
    with pytest.raises(ValueError):
        importance.resample(docs, labels, ["doc_id"], k=1, share=0.1)


def test_importance_on_odd_rows(spark, odd, none, small):
    labels = table(spark, small, "labels")
    out = importance.resample(odd, labels, ["doc_id", "kept", "row"]).collect()
    assert len(out) == 8 and {r.n_grams for r in out if r.doc_id in (1, 2)} == {0}
    assert len({r.gumbel_score for r in out if r.doc_id == 5}) == 1 and all(r.row == "r" for r in out)
    assert importance.resample(none, labels, ["doc_id"]).count() == 0
    assert importance.resample(odd, labels.limit(0), ["doc_id"]).where("kept").count() == 8


# toxicity


def test_toxicity_on_held_out_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    pool = [f"w{''.join(rng.choice(list('abcdefgh'), 5))}" for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        text = list(rng.choice(pool, 60))
        bad = i % 5 == 2
        if bad:
            for at in rng.choice(60, 4, replace=False):
                text[at] = rng.choice(["dolt", "vermin", "nitwit", "lowxabc", "lowxdef"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ["doc_id"]).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == (r.doc_id % 5 == 2) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_toxicity_on_odd_rows(spark, odd, none, small):
    labels = table(spark, small, "labels")
    out = toxicity.score(odd, labels, ["doc_id", "score", "text"]).collect()
    assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
    described = toxicity.describe(odd.union(none), "text", ["doc_id"], {"=same": 2.0}).collect()
    assert [r for r in described if r.doc_id == 1][0].word_density == 0 and [r for r in described if r.doc_id == 5][0].word_odds == 2.0
    assert toxicity.score(none, labels, ["doc_id"]).count() == 0


# segmentations


@pytest.fixture(scope="module")
def vocabulary():
    return segment_sampling.Vocabulary("piece_bpe_32k.model")


def every_segmentation(v, text):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    text, found = "▁" + text.replace(" ", "▁"), []

    def go(at, ids, log):
        if at == len(text):
            found.append((tuple(ids), log))
        for n in range(1, 17):
            i = known.get(text[at : at + n])
            if at + n <= len(text) and i is not None:
                go(at + n, [*ids, i], log + v.score[i])
        if at < len(text) and text[at] not in known:
            ids_ = [v.byte[b] for b in text[at].encode()]
            go(at + 1, [*ids, *ids_], log + v.score[ids_].sum())

    go(0, [], 0.0)
    total = np.logaddexp.reduce([x[1] for x in found])
    return {ids: log - total for ids, log in found}


@pytest.mark.parametrize("text", ["the is", "a☃b\nc", "ab  c"])
def test_samples_follow_the_distribution_without_replacement(vocabulary, text):
    v, n = vocabulary, 6000
    logs = every_segmentation(v, text)
    seeds = mix(np.arange(n, dtype=np.uint64) + np.uint64(17))
    rows = segment_sampling.sample_batch(v, [text] * n, seeds, 3)
    paths = [[tuple(segment_sampling.piece_ids(v, s[0]).tolist()) for s in r] for r in rows]
    p = {ids: math.exp(x) for ids, x in logs.items()}
    assert all(len(set(r)) == len(r) == min(3, len(p)) for r in paths)
    assert all(abs(s[1] - logs[ids]) < 1e-9 for r, ids_ in zip(rows[:200], paths) for s, ids in zip(r, ids_))
    rest = {a: sum(p[b] for b in p if b != a) for a in p}
    second = {b: sum(p[a] * p[b] / rest[a] for a in p if a != b) for b in p}
    for place, want in ((0, p), (1, second)):
        seen = Counter(r[place] for r in paths)
        assert all(abs(seen[x] - n * q) < 5 * math.sqrt(n * q * max(0.0, 1 - q)) + 2 for x, q in want.items())
    if len(p) > 3:  # the inclusion probabilities make sums over a sample unbiased
        share = [sum(math.exp(s[1]) / -math.expm1(-math.exp(s[1] - s[3])) for s in r) for r in rows]
        assert np.mean(share) == pytest.approx(1, abs=0.01)


def test_segmentations_of_odd_rows(spark, odd, none):
    out = segment_sampling.sample_segmentations(odd, k=3).collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.doc_id, []).append(r)
    assert all(r.round_trip for r in out if r.doc_id != 8) and all(r.n_pieces == len(r.ids) for r in out)
    assert len(by_key[1]) == len(by_key[2]) == 1 and by_key[1][0].log_prob == 0 and by_key[1][0].ids == []
    assert len(by_key[4]) == 3 and len(by_key[5]) == 6 and len({(r.sample, r.ids_crc32) for r in by_key[5]}) == 3
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)
    assert all(r.log_inclusion <= 0 for r in out) and segment_sampling.sample_segmentations(none).count() == 0
    again = segment_sampling.sample_segmentations(odd.repartition(3), k=3).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_decode_gives_the_texts_back(spark, odd, none):
    sampled = segment_sampling.sample_segmentations(odd, k=3).withColumn("text", F.lit("old"))
    out = segment_sampling.decode(sampled, ["doc_id", "sample", "text"]).collect()
    assert {(r.doc_id, r.text) for r in out} == {(r.doc_id, r.text or "") for r in odd.collect()}
    pieces = [([], ""), (None, None), ([5, None], None), ([5, 10_000_000], None), ([-1], None)]
    lists = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pieces)], "i int, ids array<int>")
    assert [r.t for r in segment_sampling.decode(lists, ["i"], out="t").orderBy("i").collect()] == [t for _, t in pieces]
    assert segment_sampling.decode(segment_sampling.sample_segmentations(none), ["doc_id"]).count() == 0


def test_segmentations_round_trip(spark, small):
    docs = table(spark, small, "documents")
    out = segment_sampling.sample_segmentations(docs, with_ids=False)
    assert out.where("not round_trip").count() == 0 and out.count() == 2 * docs.count()


# packing


def test_encoder_equals_the_tokenizers_library(spark, small):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder("byte_bpe_50k.json")
    texts = ["", " a", "a  b", "a \n b", "x\n\n y", "it's  1234 don't", "a b  c", "<|endoftext|> a", "\t\ta b ", LONG[:5000]]
    texts += [r.text for r in table(spark, small, "documents").limit(60).collect()]
    for t in texts:
        assert encode(t) == exact.encode(t, add_special_tokens=False).ids, t[:60]


def test_placing_pieces():
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.integers(1, 3000, 500)]
    pieces, still_open, _ = packing.place(lengths, [], 7)
    used, at = Counter(), {}
    for item, start, n, seq, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert offset == used[seq] and n > 0
        used[seq] += n
        at.setdefault(item, []).append((start, n))
    for item, n in enumerate(lengths):
        spans = sorted(at[item])
        assert [s for s, _ in spans] == [0, *np.cumsum([m for _, m in spans])[:-1]] and sum(m for _, m in spans) == n
    assert max(used.values()) <= 1024 and len(used) == -(-sum(lengths) // 1024) and len(still_open) <= 1


def test_packing_whole_table(spark, small, odd, none):
    docs = table(spark, small, "documents").select("doc_id", "text").union(odd.where("doc_id = 4").select(F.lit(77_777).cast("long"), "text"))
    encode = packing.Encoder("byte_bpe_50k.json")
    want = {r.doc_id: np.array([*encode(r.text), 0], "<u4") for r in docs.collect()}
    out = packing.pack(docs).collect()
    seen, used = {}, Counter()
    for r in out:
        cut = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids == cut.tolist() and r.ids_crc32 == zlib.crc32(cut.tobytes()) and r.doc_tokens == len(want[r.doc_id])
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
        used[r.sequence_id] += r.length
    assert seen == {k: len(x) for k, x in want.items()}
    assert len(used) <= -(-sum(used.values()) // 1024) + docs.rdd.getNumPartitions()
    tiny = packing.pack(odd).collect()
    assert Counter(r.doc_id for r in tiny if r.start == 0) == Counter(r.doc_id for r in odd.collect())
    assert packing.pack(none).count() == 0


def test_pieces_go_to_the_cheapest_sequence_with_room():
    """The rule step by step, for random lengths and sequences left open."""
    rng = np.random.default_rng(11)
    for case in range(30):
        capacity = int(rng.choice([16, 100, 1024]))
        lengths = [int(n) for n in rng.integers(1, 2 * capacity, int(rng.integers(1, 300)))]
        open_ = [[float(c), int(t), i] for i, (c, t) in enumerate(zip(rng.integers(0, 50, 3), rng.integers(1, capacity, 3)))]
        state = {s[2]: list(s) for s in open_}
        pieces, _, _ = packing.place(lengths, [list(s) for s in open_], 3, capacity)
        rest = sorted(((n % capacity, i) for i, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
        whole = sum(n // capacity for n in lengths)
        room = sum(capacity - s[1] for s in open_)
        for j in range(max(0, (sum(n for n, _ in rest) - room) // capacity)):
            state[3 + whole + j] = [0.0, 0, 3 + whole + j]
        placed = {}
        for item, start, n, seq, offset in pieces:
            placed.setdefault(item, []).append((start, n, seq, offset))
        homeless = []
        for n, item in rest:
            fits = sorted((s[0], s[2]) for s in state.values() if capacity - s[1] >= n)
            tail = [p for p in placed[item] if p[0] >= lengths[item] - n]
            if not fits:
                homeless.append(item)
                continue
            seq = state[fits[0][1]]
            assert tail == [(lengths[item] - n, n, seq[2], seq[1])]
            seq[1] += n
            seq[0] += packing.LINEAR * n + packing.QUADRATIC * n * n
        for item, parts in placed.items():  # every token once
            assert sum(n for _, n, _, _ in parts) == lengths[item]
            assert item in homeless or len(parts) == lengths[item] // capacity + (lengths[item] % capacity > 0)


def test_packing_encodes_a_text_at_once(monkeypatch):
    encode = packing.Encoder("byte_bpe_50k.json")
    calls = []

    class Fast:
        def encode_ordinary(self, text):
            calls.append(text)
            return fast.encode_ordinary(text)

    fast = encode.fast
    monkeypatch.setattr(encode, "fast", Fast())
    text = " ".join(f"word{i} it's\nnext\t{i}" for i in range(300))
    assert encode(text) == encode.exact.encode(text, add_special_tokens=False).ids and calls == [text]


def test_the_segmentation_query_returns_the_segmentations(spark, small):
    rows = segment_sampling.op4_gumbel_segmentation(spark, small).limit(20).collect()
    assert rows and all(len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
