"""Secret scan with corpus-wide ownership frequency.

Candidates of every text are hashed; for each hash the distinct owners and repositories are
counted over the whole corpus (a repository belongs to its owner, so the counts add up
owner by owner and every step is combined before its shuffle). A value that many owners or
repositories share is a copied example; a value that few hold is taken for a live credential.
Where the rows name no repository, the owners alone decide: one owner with any number of
documents or copies holds a live value.

``found`` has every candidate of every kind with a flag, ``spans`` lists them all: the base kinds
and the further ones, known token formats and other words of high entropy. ``copied_spans``
lists those of any kind that are not live.

Defined results: a null text counts as empty and has no spans; a null owner or repository is
one owner or repository of its own; every row is reported once, repeated rows as often as
they occur; an empty table gives no rows. Spans are in code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import map_texts, saved, table

#: The base kinds in their order, and public token formats.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE = ["assign", "access", "hex"]
FORMATS = {
    "github": ("gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": ("xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    "google": ("AIza", re.compile(r"\bAIza[0-9A-Za-z_-]{35}")),
    "jwt": ("eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "pem": ("-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")),
}
KINDS = [*BASE, *FORMATS, "entropy"]
WORDY = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


def bits_per_char(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, secret)`` of the base kinds, by start and then kind."""
    low, found = text.lower(), []
    if any(word in low for word in ("passw", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


class Taken:
    """Stretches of a text, those of the base kinds joined where they touch, in order."""

    def __init__(self, base: list):
        self.starts, self.ends = [], []
        for start, _, end, _ in base:
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Take a stretch if it is free."""
        at = bisect_left(self.starts, end)  # those before begin before its end
        if at and self.ends[at - 1] > start:
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def further_spans(text: str, base: list) -> list[tuple[int, int, int, str]]:
    """Candidates of the further kinds that do not touch a base span or one another."""
    found = []
    for kind, (mark, pattern) in FORMATS.items():
        if mark in text:
            found += [(m.start(), KINDS.index(kind), m.end(), m[0]) for m in pattern.finditer(text)]
    at = 0
    for word in text.split():
        if len(word) >= 20 and not word.isalpha():
            at = text.index(word, at)
            for m in WORDY.finditer(word):
                value = m[0]
                classes = sum(any(map(test, value)) for test in (str.isupper, str.islower, str.isdigit))
                if classes == 3 and bits_per_char(value) >= 3.5:
                    found.append((at + m.start(), KINDS.index("entropy"), at + m.end(), value))
            at += len(word)
    kept, taken = [], Taken(base)
    for span in sorted(found, key=lambda x: (x[1], x[0])):
        if taken.add(span[0], span[2]):
            kept.append(span)
    return kept


def told(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


def scan(
    df: DataFrame, keep: list[str], owner: str, repo: str | None = None, text: str = "text", *, max_owners: int = 2,
    max_repos: int = 5,
) -> DataFrame:
    """Add to ``keep``: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``,
    ``copied_spans`` and ``found``, an array of (start, kind, end, live, n_owners, n_repos) by
    start and kind.

    A value is live if at most ``max_owners`` owners and ``max_repos`` repositories hold it.
    Without ``repo`` an owner counts as one repository and ``max_owners`` alone decides.
    """

    def make():
        def func(texts):
            rows = []
            for value in texts:
                value = value or ""
                base = base_spans(value)
                all_ = base + further_spans(value, base)
                by_kind = Counter(k for _, k, _, _ in base)
                hashed = [
                    {"start": s, "kind": k, "end": e, "hash": hashlib.blake2b(v.encode("utf-8", "replace"), digest_size=16).hexdigest()}
                    for s, k, e, v in all_
                ]
                rows.append((*(by_kind[k] for k in range(3)), hashlib.sha256(told(base).encode()).hexdigest(), hashed))
            return list(zip(*rows)) if rows else [[]] * 5

        return func

    src = df.withColumn("_owner", F.col(f"`{owner}`").cast("string")).withColumn(
        "_repo", F.lit(None).cast("string") if repo is None else F.col(f"`{repo}`").cast("string")
    )
    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, "
    keep = [c for c in keep if c not in ("n_assign", "n_access", "n_hex", "base_sha256", "found", "spans", "copied_spans")]
    cands = "_cands array<struct<start:int,kind:int,end:int,hash:string>>"
    docs = saved(
        map_texts(src, text, [*keep, "_owner", "_repo"], make, fields + cands).withColumn("_row", F.monotonically_increasing_id()),
        "secret-candidates",
    )
    one = docs.select("_row", "_owner", "_repo", F.explode("_cands").alias("c")).select("_row", "_owner", "_repo", "c.*")
    repos = one.select("hash", "_owner", "_repo").distinct()
    owners = repos.groupBy("hash", "_owner").agg(F.count("*").alias("n"))
    stats = owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))
    live = F.col("n_owners") <= max_owners
    if repo is not None:
        live &= F.col("n_repos") <= max_repos
    by_row = one.join(stats, "hash").withColumn("live", live).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live", "n_owners", "n_repos"))).alias("found")
    )
    kinds = F.array(*map(F.lit, KINDS))

    def listed(wanted):
        chosen = F.filter("found", wanted)
        return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])), ",")

    spans = listed(lambda x: F.lit(True))
    hits = docs.where(F.size("_cands") > 0).join(by_row, "_row", "left")
    none = docs.where(F.size("_cands") == 0).withColumn("found", F.lit(None).cast(by_row.schema["found"].dataType))
    whole = hits.unionByName(none).withColumn("found", F.coalesce("found", F.array().cast(by_row.schema["found"].dataType)))
    whole = whole.withColumn("spans", spans).withColumn("copied_spans", listed(lambda x: ~x["live"]))
    return whole.select(*keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "copied_spans", "found")


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with its live spans, or runs of overlapping ones, replaced by a mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(done, span):
        upto = F.concat(done["out"], F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.lit(mark))
        out = F.when(span["start"] >= done["at"], upto).otherwise(done["out"])
        return F.struct(out.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    def end(done):
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text) - done["at"]))

    live = F.filter(found, lambda x: x["live"])
    return F.when(F.size(live) > 0, F.aggregate(live, start, add, end)).otherwise(text)


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner is the source. The table names no repositories: the owners alone decide."""
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"], owner="source")
    return found.withColumn("n_live", F.size(F.filter("found", lambda x: x["live"])).cast("long")).drop("found")
