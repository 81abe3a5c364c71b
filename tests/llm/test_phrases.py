"""Collocations, repaired conversations and license scans against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import compare
import pytest

from softsearch.llm import collocations, conversation_repair, license_scan
from softsearch.llm.queries import ORACLES, QUERIES

NEW = ["op11_phrase_collocation", "op12_conversation_repair", "op13_license_scan"]


@pytest.mark.parametrize("name", NEW)
def test_query_equals_sql(spark, small, name):
    df = QUERIES[name](spark, small)
    got = (df.columns, [tuple(r) for r in df.collect()])
    assert got[1] and compare.differences(got, compare.sql_rows(small, ORACLES[name])) == []


# collocations


def brute_collocations(rows, max_words, min_count, share):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p, a in cand.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= share * a and inside(q) for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out.add((lang, " ".join(p), a, f[p[:k]], f[p[k:]], total[lang], score))
    return out


ODD = "doc_id long, text string, lang string, words string, n string, `key` string, ext string"


def test_collocations_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "THE", "Of", "a", "b\x01", "b", "é", "to", "x\x1fy", "zz"]
    texts = [None, "", " \t", "one two three four " * 3000]
    texts += ["".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", " ", ", ", ".", "\n", "; "]) for _ in range(60)) for _ in range(60)]
    rows = [(t, [None, "en", "d\te"][i % 3]) for i, t in enumerate(texts)] + [("same text here", "en")] * 5
    df = spark.createDataFrame([(i, t, lang, "w", "n", "k", "e") for i, (t, lang) in enumerate(rows)], ODD)
    for max_words, least, share in ((3, 4, 50), (4, 3, 30)):
        found = collocations.collocations(df, max_words=max_words, min_count=least, min_share=share).collect()
        want = brute_collocations(rows, max_words, least, share)
        assert len(found) == len(want) > 20 and {tuple(r) for r in found} == want


def test_collocations_over_many_ranges(spark, monkeypatch):
    """Ranges that begin inside the extensions of one phrase, and blocks of few words."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(f"hot w{i % 40} v{i % 7} tail. hot w{i % 40}", "en") for i in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    monkeypatch.setattr(collocations, "DISTINCT_WORDS", 30)
    spark.conf.set("spark.sql.shuffle.partitions", "29")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = collocations.collocations(df, min_count=2, min_share=60).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {tuple(r) for r in found} == brute_collocations(rows, 3, 2, 60)


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], ODD)
    assert collocations.collocations(none).collect() == []


def test_scores_beyond_64_bits(spark):
    """Scores are taken in integers of any length."""
    a, l, r = 3 * 10**9, 4 * 10**9 + 1, 5 * 10**9 + 3
    assert 10**6 * a * a > 2**63
    row = {"lang": "x", "words": ["p", "q"], "n": a, "heads": [10**10, l], "ends": [10**10, r], "ext": -1}
    collocations._put_in(row, "ends", {})
    assert 10**6 * a * a // (row["heads"][1] * row["ends"][1]) == 449999


# conversations


def brute_repair(rows):
    """All edit strings by increasing cost, over (rows done, state): cheapest, then least."""
    seen, marked = set(), []
    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        marked.append((role, text, blank or (role, text) in seen, not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)))
        seen.add((role, text))
    best = {(0, 0): (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(3):  # insertions
            for s, t, who in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
                if (i, s) in best:
                    c, a, o = best[i, s]
                    best[i, t] = min(best.get((i, t), (10**9,)), (c + 3, a + "I", (*o, f"{who}:")))
        if i == len(rows):
            break
        role, text, gone, cut = marked[i]
        for s in range(4):
            if (i, s) not in best:
                continue
            c, a, o = best[i, s]
            moves = [(s, c + 4, "D", o)]
            if not gone:
                t, who = (3, "assistant") if s == 2 else (2, "user")
                moves.append((t, c + 3 + 3 * cut, "R", (*o, f"{who}:{text}")))
                if role[:1] == who[0] or (s == 0 and role[:1] == "s"):
                    moves.append((1 if role[:1] == "s" else t, c + 3 * cut, "K", (*o, f"{role}:{text}")))
            for t, cost, e, out in moves:
                best[i + 1, t] = min(best.get((i + 1, t), (10**9,)), (cost, a + e, out))
    cost, audit, out = min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def conversations(seed, n):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "ux", "", None], ["Yes.", "no", "Well!", "", " \t", "a?", "b. ", None, "ünd."]
    out = []
    for conv in range(n):
        turns = sorted((rng.choice([None, 0, 1, 2, 3, 5, 9, 12]) for _ in range(rng.randrange(0, 12))), key=lambda t: (t is not None, t))
        out += [(None if conv == 3 else conv, t, rng.choice(roles[: 2 + conv % 6]), rng.choice(texts)) for t in turns]
    return out


def order(row):
    return (row[1] is not None, row[1] or 0, row[2].encode(), row[3].encode())


def test_repair_matches_brute_force(spark):
    for seed, damage in ((1, False), (2, True)):
        rows = conversations(seed, 120) + [("many", i // 3, "user" if i % 3 else "assistant", "same." if i % 2 else f"t{i}.") for i in range(300)]
        rows = [(str(c) if c is not None else None, t, r, x) for c, t, r, x in rows]
        df = spark.createDataFrame([(*r, "e", "p", "k") for r in rows], "conv_id string, turn long, role string, text string, edit string, place string, copies string")
        made = conversation_repair.damaged(df) if damage else conversation_repair.as_rows(df)
        by = defaultdict(list)
        for c, t, role, text in rows:
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
            by[c].extend(
                [] if kind == 0 else [(c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (1 + (kind == 3))
            )
        got = {r.conv: r for r in conversation_repair.reports(conversation_repair.repair(made)).collect()}
        assert set(got) == set(by) and len(by) > 100
        for conv, turns in by.items():
            turns.sort(key=order)
            pairs = [(r, x) for _, _, r, x in turns]
            r = got[conv]
            assert (r.cost, r.audit, r.repaired_sha256) == brute_repair(pairs)
            assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
            known = [t for _, t, _, _ in turns if t is not None]
            assert r.gaps == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
            blank = sum(not x.strip(" \t\n\v\f\r") for _, x in pairs)
            assert r.blank == blank and r.blank + r.duplicate == len(pairs) - len({p for p in pairs if p[1].strip(" \t\n\v\f\r")})


def test_survivors_share_an_ancestor_and_ties_are_compared_whole():
    rng = random.Random(7)
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice(['.', ''])}") for i in range(rng.randrange(0, 14))]
        search, audit = conversation_repair.Survivors(), ""
        for row in rows:
            search.read(row, not row[1].endswith("."))
        cost = search.end()
        audit = "".join(e * n for e, n, _, _ in search.resolved)
        assert (cost, audit) == brute_repair(rows)[:2]
    search = conversation_repair.Survivors()  # a sound conversation is resolved as it comes
    for i in range(5000):
        search.read(("user" if i % 2 == 0 else "assistant", f"{i}."), False)
    assert len(search.resolved) > 4900


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.reports(conversation_repair.repair(conversation_repair.damaged(none))).collect() == []


# licenses


def test_licenses_in_odd_and_planted_texts(spark):
    notice = dict((label, text) for label, text in license_scan.NOTICES)["mit"].split()
    broken = " ".join([*notice[:20], "very", "much", *notice[20:34], *notice[36:]])
    texts = {
        1: (None, "", 0), 2: ("", "", 0), 3: (" \n..", "", 0), 4: ("CC-BY, cc  by; ccby cc é by", "cc-by", 2),
        5: ("GNU General Public License and the GNU general public. License", "gpl", 2), 6: (f"intro {broken} outro", "mit", 0),
        7: (" ".join(notice[:12]) + " something else", "", 0), 8: ("word " * 50_000 + "Apache License " * 3, "apache", 3),
        9: ("CC BY-NC 4.0", "cc-by,cc-by-nc", 1), 10: (" ".join(reversed(notice)), "", 0), 11: ("MIT license MIT license", "mit", 2),
        12: ("apache\u00a0license", "", 0),
    }
    rows = [(k, t, "a", "b", "c") for k, (t, _, _) in texts.items()] + [(4, texts[4][0], "a", "b", "c"), (None, "mit license", "a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, number string, row string, score string")
    out = license_scan.scan(df, ["doc_id", "number", "row", "score"]).collect()
    assert len(out) == len(rows) and out[0].number == "a" and out[0].row == "b"
    for r in out:
        if r.doc_id is not None:
            text, labels, n_base = texts[r.doc_id]
            low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
            starts = [i for _, p in license_scan.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
            assert (r.n_words, r.n_base, r.labels) == (len(words), len(starts), labels) and n_base == r.n_base
            assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
    by = {r.doc_id: r for r in out}
    assert 0.6 <= by[6].score < 1.0 and by[6].base_labels == "" and by[4].score == 1.0 and by[1].score == 0.0
    assert license_scan.scan(df.limit(0), ["doc_id"]).collect() == []


def test_license_scan_stays_in_the_jvm(spark, small):
    plan = license_scan.votes(spark.read.parquet(f"{small}/documents.parquet"), "text", ["doc_id"], license_scan.templates())
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", shown) and shown.count("BroadcastHashJoin") == 1 and "CartesianProduct" not in shown
