"""The named queries again as plain SQL (DuckDB dialect), for comparison.

Shared steps are CTEs joined in front of each query, so a text is as long as what it checks.
"""

from __future__ import annotations

from softsearch.operators.tfidf import STOP_WORDS
from softsearch.plans import catalog as c

# Fixed value: white space in the Unicode sense, as a character class body.
WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Fixed values, as literals: a wrong list in the code under test must not pass.
HEADER_WORDS = (
    "From", "Subject", "Organization", "Lines", "Message-ID", "NNTP-Posting-Host", "Distribution", "Newsgroups", "Path", "Date",
    "Xref", "Article-I.D.", "Reply-To", "Summary", "Keywords", "Expires", "Followup-To", "Sender", "References",
)
QUOTE_MARKS = ("writes in", "writes:", "wrote:", "says:", "said:", "^In article", "^Quoted from", r"^\|", "^>")
NO_RESULT = "No relevant documents found."
_WORDS = "|".join(w.replace(".", r"\.") for w in HEADER_WORDS)


def _headers(x: str) -> str:
    return rf"regexp_replace({x}, '(?im)^(?:{_WORDS})[^\n]*\n', '', 'g')"


def _quotes(x: str) -> str:
    return f"regexp_replace({x}, '(?m)^>[^\\n]*', '', 'g')"


def _emails(x: str) -> str:
    return rf"regexp_replace({x}, '[^{WS}]+@[^{WS}]+\.[^{WS}]+', ' ', 'g')"


def _punct(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_{WS}]', ' ', 'g')"


def _space(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def _clean(x: str = "text") -> str:
    return _space(_punct(_emails(_quotes(_headers(x)))))


_MAIL = r"('SUBJECT: ' || source || chr(10) || '> ' || lang || chr(10) || 'lines ' || n_chars || chr(10) || text)"
_POST = (
    r"('From: ' || source || chr(10) || chr(10) || 'In article ' || lang || chr(10) || '> ' || lang || chr(10)"
    r" || text || chr(10) || ' ---' || chr(10) || 'signed ' || source)"
)
_LABEL = r"regexp_extract(source, '\d+')::INT"

# -- shared steps: each is a list of CTE texts ---------------------------------------

RAW = [f"raw AS (SELECT doc_id AS src_id, text, lang, {_LABEL} AS label, source AS category FROM documents)"]
CLEANED = RAW + [f"cleaned AS (SELECT src_id, {_clean()} AS text, label FROM raw)"]
CORPUS = CLEANED + [
    """corpus AS (
    SELECT substr(sha256(text), 1, 16) AS doc_id, src_id, text, label FROM cleaned
    WHERE length(text) >= 50
    QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY src_id) = 1)"""
]
X = ["x AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)"]


def _fit(src: str, key: str, k: int, m: float, rounds: int, p: str = "") -> list[str]:
    """Rounds of fuzzy c-means: centroids ``{p}c0`` .. ``{p}c{rounds}``, each with the
    distances and memberships it gives, ``{p}u0`` ..., and the objective ``{p}j1`` ..."""
    power = 2.0 / (m - 1.0)
    out = [
        f"""{p}c0 AS (SELECT (row_number() OVER (ORDER BY md5({key}::VARCHAR || '-42'), {key}) - 1)::INT AS cluster,
    {key} AS seed_id, v AS c FROM {src} QUALIFY cluster < {k})"""
    ]
    for i in range(rounds + 1):
        out.append(
            f"""{p}u{i} AS (SELECT {key}, cluster, d2, pow(near / d2, {power}) / sum(pow(near / d2, {power})) OVER (PARTITION BY {key}) AS u
    FROM (SELECT *, min(d2) OVER (PARTITION BY {key}) AS near FROM (
        SELECT {key}, cluster, greatest(2 - 2 * list_dot_product(v, c), 1e-10) AS d2 FROM {src}, {p}c{i})))"""
        )
        if i < rounds:
            out.append(
                f"""{p}m{i} AS (SELECT cluster, list(e ORDER BY dim) AS c FROM (
        SELECT cluster, dim, sum(pow(u, {m}) * e) / sum(pow(u, {m})) AS e FROM (
            SELECT cluster, u, unnest(v) AS e, generate_subscripts(v, 1) AS dim FROM {p}u{i} JOIN {src} USING ({key}))
        GROUP BY cluster, dim) GROUP BY cluster)"""
            )
            out.append(
                f"""{p}c{i + 1} AS (SELECT cluster, list_transform(c, lambda e: e / greatest(sqrt(list_dot_product(c, c)), 1e-8)) AS c FROM {p}m{i})"""
            )
    return out


def _filed(u: str, key: str, name: str, threshold: float = c.BOUNDARY) -> list[str]:
    """Per row: ordered clusters, the dominant, the two largest memberships, buckets."""
    return [
        f"""{name} AS (SELECT {key}, cl[1] AS dominant_cluster, us[1] AS u1, cl[2] AS cluster2, us[2] AS u2, us, cl,
    us[2] > {threshold} AS is_boundary,
    CASE WHEN us[2] > {threshold} THEN [cl[1], cl[2]] ELSE [cl[1]] END AS buckets
    FROM (SELECT {key}, list(cluster ORDER BY u DESC, cluster) AS cl, list(u ORDER BY u DESC, cluster) AS us FROM {u} GROUP BY {key}))"""
    ]


FIT = X + _fit("x", "vec_id", c.K, c.M, c.ROUNDS)
U = f"u{c.ROUNDS}"
CENTROIDS = f"c{c.ROUNDS}"
FILED = FIT + _filed(U, "vec_id", "filed")
VECTOR_ROWS = FILED + CLEANED + [
    """vt AS (SELECT vec_id AS doc_id, cleaned.text AS document, x.v, cleaned.label, raw.category,
    filed.dominant_cluster, filed.is_boundary, round(u1, 4) AS mem_top1, round(u2, 4) AS mem_top2
    FROM x JOIN cleaned ON vec_id = src_id JOIN raw USING (src_id) JOIN filed USING (vec_id))"""
]
PAIRS = X + [
    """pairs AS (SELECT a.vec_id, list_dot_product(a.v, b.v) AS similarity, a.label = b.label AS same_intent
    FROM x a JOIN x b ON b.vec_id = a.vec_id + 1)"""
]


def _sql(ctes: list[str], body: str, recursive: bool = False) -> str:
    seen = list(dict.fromkeys(ctes))
    head = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(seen) + "\n" if seen else ""
    return head + body


def _text(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS text FROM documents"


def _long(src: str, key: str, array: str, pos: str, value: str) -> str:
    return (
        f"SELECT {key}, ({pos} - 1)::INT AS {pos}, round(e, 6) AS {value} FROM "
        f"(SELECT {key}, unnest({array}) AS e, generate_subscripts({array}, 1) AS {pos} FROM {src})"
    )


def _strip_post() -> str:
    head = r"CASE WHEN strpos(t, chr(10) || chr(10)) > 0 THEN substr(t, strpos(t, chr(10) || chr(10)) + 2) ELSE '' END"
    marks = "|".join(QUOTE_MARKS)
    return rf"""WITH p AS (SELECT doc_id, {_POST} AS t FROM documents),
h AS (SELECT doc_id, {head} AS t FROM p),
l AS (SELECT doc_id, t, string_split(regexp_replace(t, '^[{WS}]+|[{WS}]+$', '', 'g'), chr(10)) AS ls FROM h),
r AS (SELECT *, list_max(list_transform(ls, lambda s, i: CASE WHEN regexp_full_match(s, '[{WS}]*-*[{WS}]*') THEN i ELSE 0 END)) AS cut FROM l),
f AS (SELECT doc_id, CASE WHEN cut > 1 THEN array_to_string(ls[1:cut - 1], chr(10)) ELSE t END AS t FROM r)
SELECT doc_id, array_to_string(list_filter(string_split(t, chr(10)), lambda s: NOT regexp_matches(s, '{marks}')), chr(10)) AS text FROM f"""


# -- embedding of words ----------------------------------------------------------------


def _hashed(src: str, key: str, text: str, name: str) -> list[str]:
    """Signed hashing of words into 64 places, unit length, as floats."""
    return [
        rf"""{name}_w AS (SELECT {key}, md5(unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}'))) AS h FROM {src})""",
        f"""{name}_s AS (SELECT {key}, (('0x' || substr(h, 1, 8))::UBIGINT % 64)::INT AS dim,
    sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1.0 ELSE -1.0 END)::DOUBLE AS e FROM {name}_w GROUP BY ALL)""",
        f"""{name}_d AS (SELECT k.{key}, list(coalesce(e, 0.0) ORDER BY d.dim) AS s
    FROM (SELECT {key} FROM {src}) k CROSS JOIN (SELECT unnest(range(64))::INT AS dim) d
    LEFT JOIN {name}_s s ON s.{key} = k.{key} AND s.dim = d.dim GROUP BY k.{key})""",
        f"""{name} AS (SELECT {key}, list_transform(s, lambda e: (e / greatest(sqrt(list_dot_product(s, s)), 1e-8))::FLOAT)::DOUBLE[] AS v FROM {name}_d)""",
    ]


# -- search -----------------------------------------------------------------------------


def _knn(left: str, rows: str, on: str, k: int) -> str:
    """Neighbours of every vector of ``left(query_id, v, ...)`` among ``rows(doc_id, v, ...)``."""
    return f"""SELECT query_id, rank, doc_id, round(sim, 4) AS similarity, round(1 - sim, 6) AS distance FROM (
    SELECT query_id, doc_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id)::INT AS rank FROM (
        SELECT q.query_id, d.doc_id, round(list_dot_product(q.v, d.v), 9) AS sim FROM {left} q JOIN {rows} d ON {on})
    ) WHERE rank <= {k}"""


SEARCH = VECTOR_ROWS + ["q AS (SELECT vec_id AS query_id, v, filed.cl FROM x JOIN filed USING (vec_id))"]
_IN_CLUSTER = "d.dominant_cluster = q.cl[1] AND d.doc_id <> q.query_id"
WITH_FALLBACK = SEARCH + [
    "part_vt AS (SELECT * FROM vt WHERE dominant_cluster NOT IN (3, 7))",
]


def _results(hits: str, rows: str, asked: str) -> str:
    line = "'[' || rank || '] (sim=' || printf('%.3f', similarity) || ') ' || substr(document, 1, 200)"
    return f"""SELECT query_id, coalesce(result, '{NO_RESULT}') AS result FROM (SELECT query_id FROM {asked}) LEFT JOIN (
    SELECT query_id, string_agg({line}, chr(10) || chr(10) ORDER BY rank) AS result
    FROM {hits} JOIN (SELECT doc_id, document FROM {rows}) USING (doc_id) GROUP BY query_id) USING (query_id)"""


# -- cache ------------------------------------------------------------------------------


def _log(cache_id: str) -> list[str]:
    return FILED + [f"log AS (SELECT {cache_id} AS cache_id, vec_id AS seq, v, buckets, label FROM x JOIN filed USING (vec_id))"]


def _replay(threshold: float) -> list[str]:
    """The stored queries of ``log`` one after the other, then every query's best match."""
    return [
        f"""near AS (SELECT b.cache_id, b.seq, a.seq AS entry, round(list_dot_product(a.v, b.v), 9) AS sim,
    CASE WHEN list_contains(a.buckets, b.buckets[1]) THEN 0 ELSE 1 END AS bucket_rank
    FROM log a JOIN log b ON a.cache_id = b.cache_id AND a.seq < b.seq AND list_has_any(a.buckets, b.buckets)
    WHERE sim >= {threshold})""",
        """steps AS (SELECT log.cache_id, log.seq, row_number() OVER (PARTITION BY log.cache_id ORDER BY log.seq) AS n,
    coalesce(e, []) AS e FROM log LEFT JOIN (SELECT cache_id, seq, list(entry) AS e FROM near GROUP BY ALL) USING (cache_id, seq))""",
        """walk AS (SELECT DISTINCT cache_id, 0::BIGINT AS n, []::BIGINT[] AS stored FROM log
    UNION ALL SELECT walk.cache_id, walk.n + 1,
        CASE WHEN list_has_any(stored, e) THEN stored ELSE list_append(stored, seq) END
    FROM walk JOIN steps ON steps.cache_id = walk.cache_id AND steps.n = walk.n + 1)""",
        """entries AS (SELECT cache_id, unnest(stored) AS seq FROM (
    SELECT cache_id, stored FROM walk QUALIFY row_number() OVER (PARTITION BY cache_id ORDER BY n DESC) = 1))""",
        """decisions AS (SELECT log.cache_id, log.seq, entry IS NOT NULL AS cache_hit, entry AS matched_seq, sim AS similarity
    FROM log LEFT JOIN (SELECT near.cache_id, near.seq, entry, sim FROM near JOIN entries ON entries.cache_id = near.cache_id AND entries.seq = entry
        QUALIFY row_number() OVER (PARTITION BY near.cache_id, near.seq ORDER BY sim DESC, bucket_rank, entry) = 1)
    USING (cache_id, seq))""",
        """used AS (SELECT cache_id, entries.seq, greatest(entries.seq, coalesce(last, entries.seq)) AS access_time
    FROM entries LEFT JOIN (SELECT cache_id, matched_seq AS seq, max(seq) AS last FROM decisions WHERE cache_hit GROUP BY ALL) USING (cache_id, seq))""",
    ]


def _replay_lru(threshold: float, max_size: int) -> list[str]:
    """Walk ``log`` in order with at most ``max_size`` entries, the least recently used going."""
    near = _replay(threshold)[0]
    return [
        near,
        """steps AS (SELECT log.cache_id, log.seq, row_number() OVER (PARTITION BY log.cache_id ORDER BY log.seq) AS n,
    coalesce(e, []) AS e FROM log LEFT JOIN (
        SELECT cache_id, seq, list(entry ORDER BY sim DESC, bucket_rank, entry) AS e FROM near GROUP BY ALL) USING (cache_id, seq))""",
        f"""walk AS (SELECT DISTINCT cache_id, 0::BIGINT AS n, NULL::BIGINT AS seq, NULL::BIGINT AS hit,
        []::STRUCT(seq BIGINT, used BIGINT)[] AS held FROM log
    UNION ALL SELECT cache_id, n, seq, hit, CASE
        WHEN hit IS NOT NULL THEN list_transform(held, lambda t: CASE WHEN t.seq = hit THEN {{'seq': hit, 'used': seq}} ELSE t END)
        WHEN len(held) < {max_size} THEN list_append(held, {{'seq': seq, 'used': seq}})
        ELSE list_append(list_filter(held, lambda t: t.used > oldest), {{'seq': seq, 'used': seq}}) END
    FROM (SELECT walk.cache_id, walk.n + 1 AS n, steps.seq, held, list_min(list_transform(held, lambda t: t.used)) AS oldest,
            list_filter(e, lambda s: list_contains(list_transform(held, lambda t: t.seq), s))[1] AS hit
        FROM walk JOIN steps ON steps.cache_id = walk.cache_id AND steps.n = walk.n + 1))""",
        """decisions AS (SELECT walk.cache_id, walk.seq, hit IS NOT NULL AS cache_hit, hit AS matched_seq, sim AS similarity
    FROM walk LEFT JOIN near ON near.cache_id = walk.cache_id AND near.seq = walk.seq AND near.entry = hit WHERE n > 0)""",
    ]


ONE_CACHE = _log("'all'") + _replay(c.THRESHOLD)
BY_LABEL = _log("label::VARCHAR") + _replay(c.THRESHOLD)
LRU_BY_LABEL = _log("label::VARCHAR") + _replay_lru(c.THRESHOLD, c.LRU_SIZE)
_DECISIONS = "SELECT cache_id, seq, cache_hit, matched_seq, round(similarity, 6) AS similarity FROM decisions"

# -- the offline flow and the answers ------------------------------------------------------

EMBEDDED = CORPUS + _hashed("corpus", "doc_id", "text", "emb")
PREPARED = EMBEDDED + _fit("emb", "doc_id", c.K, c.M, c.ROUNDS, "p_") + _filed(f"p_u{c.ROUNDS}", "doc_id", "p_filed") + [
    """pt AS (SELECT doc_id, corpus.text AS document, emb.v, label, 'src' || label AS category, dominant_cluster, is_boundary,
    round(u1, 4) AS mem_top1, round(u2, 4) AS mem_top2 FROM corpus JOIN emb USING (doc_id) JOIN p_filed USING (doc_id))"""
]
ASKED = PREPARED + [
    "asked AS (SELECT 'all' AS cache_id, conv_id * 100000 + turn AS seq, text AS query FROM conversations WHERE role = 'user' AND length(text) >= 1)",
    *_hashed("asked", "seq", "query", "qe"),
    f"""qu AS (SELECT seq, cluster, pow(near / d2, {2 / (c.M - 1)}) / sum(pow(near / d2, {2 / (c.M - 1)})) OVER (PARTITION BY seq) AS u
    FROM (SELECT *, min(d2) OVER (PARTITION BY seq) AS near FROM (
        SELECT seq, cluster, greatest(2 - 2 * list_dot_product(v, c), 1e-10) AS d2 FROM qe, p_c{c.ROUNDS})))""",
    *_filed("qu", "seq", "q_filed"),
    "log AS (SELECT cache_id, asked.seq, v, buckets, dominant_cluster, query FROM asked JOIN qe USING (seq) JOIN q_filed USING (seq))",
    *_replay(c.ANSWER_THRESHOLD),
    "missed AS (SELECT seq AS query_id, v, dominant_cluster FROM log JOIN entries USING (cache_id, seq))",
    "hits AS (" + _knn("missed", "pt", "d.dominant_cluster = q.dominant_cluster OR q.dominant_cluster NOT IN (SELECT dominant_cluster FROM pt)", 5) + ")",
    "results AS (" + _results("hits", "pt", "missed") + ")",
]


_UNIT = "list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))"


def _score(p: str, u: str) -> list[str]:
    """Silhouette ``{p}sil`` and Davies-Bouldin ``{p}db`` of the dominant clusters of ``u``."""
    return [
        *_filed(u, "vec_id", f"{p}f"),
        f"{p}p AS (SELECT vec_id, v, dominant_cluster AS l FROM x JOIN {p}f USING (vec_id))",
        f"""{p}far AS (SELECT a.vec_id, a.l, b.l AS other, sum(1 - {_UNIT}) AS total, count(*) AS n
    FROM {p}p a JOIN {p}p b ON a.vec_id <> b.vec_id GROUP BY ALL)""",
        f"""{p}ab AS (SELECT vec_id, max(CASE WHEN l = other THEN total / n END) AS own, min(CASE WHEN l <> other THEN total / n END) AS away
    FROM {p}far GROUP BY vec_id)""",
        f"{p}sil AS (SELECT round(avg(CASE WHEN own IS NULL THEN 0 ELSE (away - own) / greatest(own, away) END), 6) AS silhouette FROM {p}ab)",
        f"""{p}means AS (SELECT l, list(e ORDER BY dim) AS c FROM (
    SELECT l, dim, avg(e) AS e FROM (SELECT l, unnest(v) AS e, generate_subscripts(v, 1) AS dim FROM {p}p) GROUP BY ALL) GROUP BY l)""",
        f"{p}spread AS (SELECT p.l, avg(list_distance(v, c)) AS s FROM {p}p p JOIN {p}means USING (l) GROUP BY p.l)",
        f"""{p}db AS (SELECT round(avg(worst), 6) AS davies_bouldin FROM (
    SELECT a.l, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS worst FROM {p}means a JOIN {p}means b ON a.l <> b.l
    JOIN {p}spread sa ON sa.l = a.l JOIN {p}spread sb ON sb.l = b.l GROUP BY a.l))""",
    ]


def _select_k() -> str:
    ctes, rows = list(X), []
    for k in c.K_RANGE:
        p = f"k{k}_"
        ctes += _fit("x", "vec_id", k, c.M, c.SWEEP_ROUNDS, p) + _score(p, f"{p}u{c.SWEEP_ROUNDS}")
        rows.append(f"SELECT {k} AS k, silhouette, davies_bouldin FROM {p}sil, {p}db")
    ctes.append("found AS (" + " UNION ALL ".join(rows) + ")")
    return _sql(ctes, "SELECT *, k = (SELECT k FROM found ORDER BY silhouette DESC, k LIMIT 1) AS is_best FROM found")


def _m_sweep() -> str:
    ctes, rows = list(X), []
    for i, m in enumerate(c.FUZZINESS):
        ctes += _fit("x", "vec_id", c.K, m, c.SWEEP_ROUNDS, f"m{i}_")
        rows.append(_metrics(m, f"m{i}_u{c.SWEEP_ROUNDS}"))
    return _sql(ctes, "\nUNION ALL ".join(rows))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _tfidf(src: str) -> list[str]:
    return [
        rf"""tf AS (SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {src})
    WHERE term NOT IN ({_STOP}) GROUP BY ALL)""",
        f"""vocabulary AS (SELECT term, ln((1.0 + (SELECT count(*) FROM {src})) / (1.0 + df)) + 1.0 AS idf FROM (
    SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2))""",
        """weights AS (SELECT doc_id, term, tf, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight
    FROM tf JOIN vocabulary USING (term))""",
    ]


_FLUSHED = "'all#' || (SELECT count(DISTINCT doc_id) FROM labels WHERE toxic = 1 AND doc_id < vec_id)"
_META = "doc_id, label, category, dominant_cluster, is_boundary, mem_top1, mem_top2"


def _converged() -> str:
    n = c.CONVERGENCE_ROUNDS
    rounds = "\nUNION ALL ".join(f"SELECT {i + 1} AS i, sum(pow(u, {c.M}) * d2) AS j FROM u{i}" for i in range(n))
    return _sql(
        X + _fit("x", "vec_id", c.K, c.M, n) + [
            f"js AS ({rounds})",
            f"stops AS (SELECT min(b.i) AS i FROM js a JOIN js b ON b.i = a.i + 1 WHERE abs(a.j - b.j) < {c.CONVERGENCE_TOL})",
        ],
        f"SELECT js.i::INT AS iterations, stops.i IS NOT NULL AS converged, round(j, 6) AS objective FROM stops JOIN js ON js.i = coalesce(stops.i, {n})",
    )


def oracles() -> dict[str, str]:
    found = _of_queries()
    return found | {"analysis_report": _report(found)}


#: of each section of the report the columns that are numbers, and the others
_CELLS = {
    "k_selection": ("silhouette davies_bouldin", "is_best"), "fuzziness": ("boundary_pct mean_entropy mean_top", ""),
    "cluster_terms": ("n_docs score", "term"), "cluster_categories": ("label n", ""),
    "boundary_examples": ("cluster1 mem1 cluster2 mem2", "snippet"),
    "thresholds": ("true_hits n_same false_hits n_diff precision recall f1", ""),
}


def _report(found: dict[str, str]) -> str:
    parts = []
    for section, (source, keys) in c.REPORT.items():
        key = " || '/' || ".join(f"{k}::VARCHAR" for k in keys)
        numbers, texts = (names.split() for names in _CELLS[section])
        for name in numbers + texts:
            value, text = (f"{name}::DOUBLE", "NULL::VARCHAR") if name in numbers else ("NULL::DOUBLE", f"{name}::VARCHAR")
            parts.append(f"SELECT '{section}' AS section, {key} AS key, '{name}' AS name, {value} AS value, {text} AS text FROM {section}")
    ctes = ", ".join(f"{section} AS MATERIALIZED ({found[source]})" for section, (source, _) in c.REPORT.items())
    return f"WITH {ctes}\n" + "\nUNION ALL ".join(parts)


def _of_queries() -> dict[str, str]:
    return {
        "corpus_scan_subset": _sql(RAW, "SELECT src_id, text, label FROM raw WHERE src_id IN (SELECT doc_id FROM labels)"),
        "category_lookup": _sql(RAW, "SELECT src_id, label, category FROM raw"),
        "min_length_filter": _sql(CLEANED, "SELECT src_id, length(text) AS n_chars FROM cleaned WHERE length(text) >= 50"),
        "load_summary": _sql(
            CORPUS,
            """SELECT n_read, n_kept, n_short, n_read - n_short - n_kept AS n_duplicate, n_read - n_kept AS n_dropped FROM (
    SELECT (SELECT count(*) FROM cleaned) AS n_read, (SELECT count(*) FROM corpus) AS n_kept,
    (SELECT count(*) FROM cleaned WHERE length(text) < 50) AS n_short)""",
        ),
        "corpus_from_posts": _sql(
            RAW + [
                f"posts AS ({_strip_post()})",
                f"cleaned AS (SELECT src_id, {_clean('posts.text')} AS text, label FROM posts JOIN raw ON posts.doc_id = src_id)",
                CORPUS[-1],
            ],
            "SELECT doc_id, src_id, text, label FROM corpus",
        ),
        "dedup_exact": _sql(CORPUS, "SELECT doc_id, src_id, text, label FROM corpus"),
        "clean_headers": _text(_headers(_MAIL)),
        "clean_quotes": _text(_quotes(_MAIL)),
        "clean_emails": _text(_emails("text")),
        "clean_punct": _text(_punct("text")),
        "clean_space": _text(_space("text")),
        "truncate_text": _text("substr(text, 1, 512)"),
        "clean_text": _text(f"substr({_clean(_MAIL)}, 1, 512)"),
        "strip_post_parts": _strip_post(),
        "doc_hash_id": _sql(CLEANED, "SELECT src_id, substr(sha256(text), 1, 16) AS doc_id FROM cleaned"),
        "distinct_pair_queries": """SELECT a.text AS query FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
UNION SELECT b.text FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
        "embed_documents": _sql(EMBEDDED, _long("emb", "doc_id", "v", "dim", "value")),
        "l2_normalize": _sql(
            X + ["g AS (SELECT vec_id, list_transform(v, lambda e: e * (label + 2)) AS w FROM x)",
                 "r AS (SELECT vec_id, list_transform(w, lambda e: e / greatest(sqrt(list_dot_product(w, w)), 1e-8)) AS w FROM g)"],
            _long("r", "vec_id", "w", "dim", "value"),
        ),
        "squared_distances": _sql(FIT, f"SELECT vec_id, cluster, round(d2, 6) AS d2 FROM {U}"),
        "fcm_memberships": _sql(FIT, "SELECT vec_id, cluster, round(u, 6) AS u FROM u0"),
        "fcm_centroids": _sql(FIT, _long("c1", "cluster", "c", "dim", "value")),
        "fcm_objective": _sql(
            FIT,
            "\nUNION ALL ".join(
                f"SELECT {i + 1} AS iteration, round(sum(pow(u, {c.M}) * d2), 6) AS objective FROM u{i}" for i in range(c.ROUNDS)
            ),
        ),
        "fcm_convergence": _converged(),
        "model_round_trip": _sql(FIT, _long(CENTROIDS, "cluster", "c", "dim", "value")),
        "pair_similarity": _sql(PAIRS, "SELECT vec_id, round(similarity, 6) AS similarity, same_intent FROM pairs"),
        "sample_fixed_rows": f"SELECT vec_id, label FROM embeddings ORDER BY md5(vec_id::VARCHAR || '-42'), vec_id LIMIT {c.SAMPLE}",
        "fcm_init": _sql(FIT, "SELECT cluster, seed_id AS vec_id FROM c0"),
        "fcm_fit_3iter": _sql(FIT, _long(CENTROIDS, "cluster", "c", "dim", "value")),
        "fcm_predict": _sql(FIT, f"SELECT vec_id, cluster, round(u, 6) AS u FROM {U}"),
        "dominant_cluster": _sql(FILED, "SELECT vec_id, dominant_cluster FROM filed"),
        "boundary_flag": _sql(FILED, "SELECT vec_id, is_boundary FROM filed"),
        "top2_clusters": _sql(
            FILED,
            """SELECT vec_id, 1 AS rank, dominant_cluster AS cluster, round(u1, 6) AS membership FROM filed
UNION ALL SELECT vec_id, 2, cluster2, round(u2, 6) FROM filed""",
        ),
        "cluster_histogram": _sql(
            FILED, f"SELECT cluster, count(vec_id) AS n_docs FROM (SELECT unnest(range({c.K + 2}))::INT AS cluster) LEFT JOIN filed ON dominant_cluster = cluster GROUP BY cluster"
        ),
        "boundary_rate": _sql(
            FILED, "SELECT count(*) AS n_docs, count_if(is_boundary)::BIGINT AS n_boundary, round(100.0 * avg(is_boundary::INT), 1) AS boundary_pct FROM filed"
        ),
        "doc_metadata": _sql(VECTOR_ROWS, f"SELECT {_META} FROM vt"),
        "metadata_filter": _sql(VECTOR_ROWS, f"SELECT {_META} FROM vt WHERE dominant_cluster IN (1, 3, 5) AND is_boundary AND mem_top1 >= 0.3"),
        "get_by_ids": _sql(VECTOR_ROWS, f"SELECT document, {_META} FROM vt WHERE doc_id IN (SELECT doc_id FROM labels)"),
        "store_count": _sql(VECTOR_ROWS, "SELECT count(*) AS n_docs, count(*) > 0 AS is_populated FROM vt"),
        "vector_upsert": _sql(VECTOR_ROWS, _UPSERT),
        "stream_upsert": _sql(VECTOR_ROWS, _UPSERT),
        "artefact_sample": _sql(
            FILED, f"SELECT vec_id, label, dominant_cluster FROM x JOIN filed USING (vec_id) ORDER BY md5(vec_id::VARCHAR || '-42'), vec_id LIMIT {c.SAMPLE}"
        ),
        "prepare_vector_table": _sql(PREPARED, f"SELECT document, {_META} FROM pt"),
        "knn_topk": _sql(X, _knn("(SELECT vec_id AS query_id, v FROM x)", "(SELECT vec_id AS doc_id, v FROM x)", "d.doc_id <> q.query_id", 10)),
        "knn_cluster_filtered": _sql(SEARCH, _knn("q", "vt", _IN_CLUSTER, 5)),
        "knn_with_fallback": _sql(
            WITH_FALLBACK,
            _knn("q", "part_vt", "d.doc_id <> q.query_id AND (d.dominant_cluster = q.cl[1] OR q.cl[1] NOT IN (SELECT dominant_cluster FROM part_vt))", 5),
        ),
        "knn_nprobe2": _sql(SEARCH, _knn("q", "vt", "d.dominant_cluster IN (q.cl[1], q.cl[2]) AND d.doc_id <> q.query_id", 5)),
        "format_results": _sql(SEARCH + ["found AS (" + _knn("q", "vt", _IN_CLUSTER, 5) + ")"], _results("found", "vt", "q")),
        "cache_buckets": _sql(
            _log("'all'"),
            "SELECT cache_id, seq, bucket, (pos - 1)::INT AS bucket_rank FROM (SELECT cache_id, seq, unnest(buckets) AS bucket, generate_subscripts(buckets, 1) AS pos FROM log)",
        ),
        "cache_lookup": _sql(
            _log("'all'"),
            f"""SELECT a.cache_id, a.seq, entry IS NOT NULL AS cache_hit, entry AS matched_seq, round(sim, 6) AS similarity
FROM log a LEFT JOIN (SELECT b.seq, e.seq AS entry, round(list_dot_product(b.v, e.v), 9) AS sim FROM log b JOIN log e
    ON b.label >= 5 AND e.label < 5 AND list_has_any(b.buckets, e.buckets) WHERE sim >= {c.THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY b.seq ORDER BY sim DESC, CASE WHEN list_contains(e.buckets, b.buckets[1]) THEN 0 ELSE 1 END, e.seq) = 1) USING (seq)
WHERE a.label >= 5""",
        ),
        "cache_replay": _sql(ONE_CACHE, _DECISIONS, True),
        "cache_replay_lru": _sql(LRU_BY_LABEL, _DECISIONS, True),
        "stream_cache_decisions": _sql(LRU_BY_LABEL, _DECISIONS, True),
        "cache_touch": _sql(BY_LABEL, "SELECT cache_id, seq, access_time FROM used", True),
        "cache_evict_lru": _sql(
            BY_LABEL, f"SELECT cache_id, seq, access_time FROM used QUALIFY row_number() OVER (PARTITION BY cache_id ORDER BY access_time DESC, seq DESC) <= {c.EVICT_SIZE}", True
        ),
        "cache_stats": _sql(
            BY_LABEL,
            """SELECT (SELECT count(*) FROM entries) AS total_entries, count_if(cache_hit)::BIGINT AS hit_count, count_if(NOT cache_hit)::BIGINT AS miss_count,
round(count_if(cache_hit) / count(*), 4) AS hit_rate FROM decisions""",
            True,
        ),
        "cache_flush": _sql(BY_LABEL, "SELECT 'Cache flushed successfully.' AS message, count(*) AS entries_cleared FROM entries", True),
        "cache_replay_flushed": _sql(
            _log(_FLUSHED) + _replay(c.THRESHOLD), _DECISIONS, True
        ),
        "stream_cache_flushed": _sql(
            _log(_FLUSHED) + _replay(c.THRESHOLD), _DECISIONS, True
        ),
        "index_recall": "SELECT count(*) AS n_queries, true AS recall_reached FROM embeddings WHERE vec_id % 100 = 0",
        "cache_stats_flushed": _sql(
            _log(_FLUSHED) + _replay(c.THRESHOLD) + ["last_one AS (SELECT 'all#' || count(DISTINCT doc_id) AS cache_id FROM labels WHERE toxic = 1)"],
            """SELECT (SELECT count(*) FROM entries WHERE cache_id IN (SELECT cache_id FROM last_one)) AS total_entries,
    coalesce(count_if(cache_hit), 0)::BIGINT AS hit_count, coalesce(count_if(NOT cache_hit), 0)::BIGINT AS miss_count,
    CASE WHEN count(*) = 0 THEN 0.0 ELSE round(count_if(cache_hit) / count(*), 4) END AS hit_rate
    FROM decisions WHERE cache_id IN (SELECT cache_id FROM last_one)""",
            True,
        ),
        "health_summary": _sql(
            BY_LABEL + VECTOR_ROWS,
            f"SELECT 'ok' AS status, (SELECT count(*) FROM vt) AS vector_db_docs, (SELECT count(*) FROM entries) AS cache_entries, {c.THRESHOLD}::DOUBLE AS cache_threshold",
            True,
        ),
        "stream_cache_stats": _sql(
            BY_LABEL, "SELECT cache_id, count_if(cache_hit)::BIGINT AS hit_count, count_if(NOT cache_hit)::BIGINT AS miss_count FROM decisions GROUP BY cache_id", True
        ),
        "query_validation": """SELECT conv_id, turn, reason IS NULL AS accepted, reason FROM (
    SELECT conv_id, turn, CASE role WHEN 'user' THEN CASE WHEN length(text) < 1 THEN 'empty' END WHEN 'system' THEN 'empty' ELSE 'missing' END AS reason FROM conversations)""",
        "answer_queries_log": _sql(
            ASKED,
            """SELECT d.cache_id, d.seq, l.query, d.cache_hit, CASE WHEN d.cache_hit THEN e.query END AS matched_query,
    round(d.similarity, 4) AS similarity_score, r.result, e.dominant_cluster
FROM decisions d JOIN log l USING (cache_id, seq) JOIN log e ON e.cache_id = d.cache_id AND e.seq = coalesce(d.matched_seq, d.seq)
JOIN results r ON r.query_id = e.seq""",
            True,
        ),
        "silhouette_cosine": _sql(FIT + _score("s_", U), "SELECT silhouette FROM s_sil"),
        "davies_bouldin": _sql(FIT + _score("s_", U), "SELECT davies_bouldin FROM s_db"),
        "select_k": _select_k(),
        "m_sweep": _m_sweep(),
        "cluster_quality_degenerate": """SELECT CASE WHEN n_labels < 2 OR n_labels >= n THEN 0.0::DOUBLE END AS silhouette,
    CASE WHEN n_labels < 2 OR n_labels >= n THEN 999.0::DOUBLE END AS davies_bouldin
FROM (SELECT count(DISTINCT 0) AS n_labels, count(*) AS n FROM embeddings)""",
        "text_pair_similarity": _sql(
            ["said AS (SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user')",
             "turns AS (SELECT a.conv_id, a.turn, a.query AS q1, b.query AS q2 FROM said a JOIN said b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2)",
             "texts AS (SELECT q1 AS query FROM turns UNION SELECT q2 FROM turns)", *_hashed("texts", "query", "query", "te")],
            """SELECT conv_id, turn, round(list_dot_product(a.v, b.v), 6) AS similarity FROM turns
JOIN te a ON a.query = q1 JOIN te b ON b.query = q2""",
        ),
        "m_sweep_metrics": _sql(FIT, "\nUNION ALL ".join(_metrics(m) for m in c.FUZZINESS)),
        "tfidf_weights": _sql(CORPUS + _tfidf("corpus"), "SELECT doc_id, term, tf, round(weight, 6) AS weight FROM weights"),
        "cluster_top_terms": _sql(
            VECTOR_ROWS + ["docs AS (SELECT doc_id, document AS text FROM vt)"] + _tfidf("docs") + [
                "member AS (SELECT vec_id AS doc_id, dominant_cluster, u1 FROM filed WHERE vec_id IN (SELECT doc_id FROM vt))",
                "size AS (SELECT dominant_cluster, count(*) AS n_docs FROM member GROUP BY ALL)",
                """score AS (SELECT dominant_cluster AS cluster, n_docs, term, round(sum(u1 * weight) / n_docs, 9) AS score
    FROM weights JOIN member USING (doc_id) JOIN size USING (dominant_cluster) GROUP BY dominant_cluster, n_docs, term)""",
            ],
            """SELECT cluster, n_docs, rank, term, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term)::INT AS rank FROM score) WHERE rank <= 12""",
        ),
        "cluster_top_categories": _sql(
            VECTOR_ROWS,
            """SELECT cluster, label, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label)::INT AS rank FROM (
    SELECT dominant_cluster AS cluster, label, count(*) AS n FROM vt GROUP BY ALL)) WHERE rank <= 3""",
        ),
        "boundary_examples": _sql(
            FILED + CLEANED,
            """SELECT vec_id, dominant_cluster AS cluster1, round(u1, 3) AS mem1, cluster2, round(u2, 3) AS mem2, substr(text, 1, 200) AS snippet
FROM filed JOIN cleaned ON src_id = vec_id ORDER BY u2 DESC, vec_id LIMIT 5""",
        ),
        "threshold_sweep": _sql(
            PAIRS + [
                f"t AS (SELECT unnest([{', '.join(map(str, c.PAIR_THRESHOLDS))}])::DOUBLE AS threshold)",
                """n AS (SELECT threshold, count_if(similarity >= threshold AND same_intent)::BIGINT AS true_hits, count_if(same_intent)::BIGINT AS n_same,
    count_if(similarity >= threshold AND NOT same_intent)::BIGINT AS false_hits, count_if(NOT same_intent)::BIGINT AS n_diff FROM pairs, t GROUP BY threshold)""",
                """r AS (SELECT *, CASE WHEN true_hits + false_hits > 0 THEN true_hits / (true_hits + false_hits) ELSE 1.0 END AS p,
    CASE WHEN n_same > 0 THEN true_hits / n_same ELSE 0.0 END AS q FROM n)""",
            ],
            """SELECT threshold, true_hits, n_same, false_hits, n_diff, round(p, 6) AS precision, round(q, 6) AS recall,
round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END, 6) AS f1 FROM r""",
        ),
    }


_UPSERT = """SELECT doc_id, document, label, category FROM vt WHERE doc_id NOT IN (SELECT src_id FROM raw WHERE lang = 'fr')
UNION ALL SELECT src_id, 'updated ' || cleaned.text, raw.label, raw.category FROM cleaned JOIN raw USING (src_id) WHERE lang = 'fr'"""


def _metrics(m: float, u: str = U) -> str:
    power = 2.0 / (m - 1.0)
    return f"""SELECT {m}::DOUBLE AS m, round(100.0 * avg((us[2] > {c.BOUNDARY})::INT), 4) AS boundary_pct,
    round(avg(list_sum(list_transform(us, lambda e: -e * ln(e + 1e-12)))), 6) AS mean_entropy, round(avg(us[1]), 6) AS mean_top
FROM (SELECT vec_id, list(u ORDER BY u DESC) AS us FROM (
    SELECT vec_id, pow(near / d2, {power}) / sum(pow(near / d2, {power})) OVER (PARTITION BY vec_id) AS u
    FROM (SELECT vec_id, d2, min(d2) OVER (PARTITION BY vec_id) AS near FROM {u})) GROUP BY vec_id)"""
