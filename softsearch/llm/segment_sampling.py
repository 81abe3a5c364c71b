"""Distinct sampled segmentations of a text over a SentencePiece vocabulary.

The pieces of the vocabulary span a lattice over the characters of a text. A piece has the
log probability ``-log(rank + SHIFT)``, up to a constant, from its rank in the vocabulary, so
no model is trained. ``k`` segmentations are drawn without replacement by Gumbel top-k:

* A node of the search is a set of paths with a common beginning. Its perturbed value is a
  Gumbel variable around its log mass, bounded by the value of the node it was split from.
* The best open node yields the next sample: pieces are drawn onward from it in proportion to
  the mass of what can follow. What the sample leaves of the node is split into the nodes
  "same beginning, another piece here", one for each piece of the path.

This is A-star search with exact bounds, so the samples come in the order of their perturbed
values. The value of the best node left over, ``kappa``, gives the inclusion score of a sample:
the log of the probability ``1 - exp(-exp(log_prob - kappa))`` that its value exceeds it.

Noise depends only on the row's key, the sample, the place in the text and ``seed``. Words do
not share pieces, so lattices are built word by word, and remembered; all rows of a batch are
built, drawn and split together by array operations. Characters outside the vocabulary are
written as their UTF-8 bytes.

Defined results: null and empty texts have one segmentation, the empty one, with log
probability 0; a text with fewer than ``k`` segmentations gives all it has; equal keys get
equal noise, so repeated rows get equal samples; a null key is a key like others; an empty
table gives no rows. A space and U+2581 are one character to such a vocabulary.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.llm.common import table, worker_state
from softsearch.llm.minhash import GOLDEN, chained, mix

#: Added to the rank of a piece.
SHIFT = 2.7
#: Rows that are drawn together, their characters at most (besides one row), and words remembered.
ROWS, CHARS, REMEMBERED = 500, 1_500_000, 150_000
SPACE = "▁"
RUNS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
PRIME = np.uint64(0x100000001B3)
#: Bits of the table of beginnings of pieces.
SLOT_BITS = 20
#: Keeps the noise of nodes apart from that of pieces.
OTHER = np.uint64(0x5851F42D4C957F2D)
#: Places looked at first, and more than the largest Gumbel noise that 53 bits can give.
LOOK, REACH = 64, 40.0


class Growing:
    """An array that grows by doubling."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1 << 18, kind), 0

    def add(self, values) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), self.data.dtype)])
        self.data[self.n : need] = values
        self.n = need


class States(dict):
    """States of words, -1 for a word that has no lattice yet."""

    def __missing__(self, word: str) -> int:
        return -1


class Vocabulary:
    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i] for i in plain):
            raise ValueError("pieces must not reach over a space or a line feed")
        self.byte = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        ranks = np.array([-sp.get_score(i) for i in range(size)])
        ranks[[*self.byte.values()]] = size
        self.score = -np.log(ranks + SHIFT)
        self.raw = [b"" for _ in pieces]
        for i in plain:
            self.raw[i] = pieces[i].replace(SPACE, " ").encode()
        for b, i in self.byte.items():
            self.raw[i] = bytes([b])
        self.raw = pa.array(self.raw, pa.large_binary())
        self.longest = max(len(pieces[i]) for i in plain)
        hashes = {self.hash(pieces[i]): i for i in plain}
        starts = sorted({self.hash(pieces[i][:n]) for i in plain for n in range(1, len(pieces[i]) + 1)})
        self.starts = np.array(starts, np.uint64)  # hashes of all beginnings of pieces
        self.ids = np.array([hashes.get(h, -1) for h in starts], np.int64)  # -1: no piece itself
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[self.slot(self.starts)] = np.arange(len(starts))  # of equal slots the last stays
        self.first, self.many = Growing(np.int32), Growing(np.int32)  # of each state
        self.below, self.log, self.next, self.piece = Growing(float), Growing(float), Growing(np.int32), Growing(np.int32)
        self.reset()

    @staticmethod
    def hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(PRIME) + ord(c) + 1) % (1 << 64)
        return h

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(GOLDEN)) >> np.uint64(64 - SLOT_BITS)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the beginnings that have the hashes ``h``, -1 for none."""
        k = self.slots[self.slot(h)].astype(np.int64)
        other = np.flatnonzero((k >= 0) & (self.starts[k] != h))  # the slot holds another one
        near = np.minimum(np.searchsorted(self.starts, h[other]), len(self.starts) - 1)
        k[other] = np.where(self.starts[near] == h[other], near, -1)
        return k

    def reset(self) -> None:
        """Forget all words. A state is a place in a word; its pieces stand in a row."""
        self.states = States()
        for array in (self.first, self.many, self.below, self.log, self.next, self.piece):
            array.n = 0
        self.others: list[list[int]] = []  # byte pieces of characters that need several

    def add(self, words: list[str]) -> np.ndarray:
        """Lattices of new words: pieces by place, masses from the end of the words; their states."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        word_end = np.repeat(ends, sizes).astype(np.int32)
        at, h = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), np.uint64)
        found, many = [], np.zeros(len(chars), np.int32)  # pieces of each place so far
        for n in range(1, self.longest + 1):
            if n > 1:
                inside = at + n <= word_end[at]
                at, h = at[inside], h[inside]
            h = h * PRIME + chars[at + (n - 1)] + np.uint64(1)
            k = self.find(h)
            more = np.flatnonzero(k >= 0)
            at_more, code = at[more], self.ids[k[more]]
            hit = code >= 0
            src = at_more[hit]
            found.append((src, n, code[hit], many[src]))
            if n == 1:
                whole = np.zeros(len(chars), bool)
                whole[src] = True
                for i in np.flatnonzero(~whole):
                    ids = [self.byte[b] for b in chr(chars[i]).encode("utf-8", "replace")]
                    code = ids[0]
                    if len(ids) > 1:
                        self.others.append(ids)
                        code = -len(self.others)
                    found.append((np.array([i]), 1, np.array([code]), np.array([0])))
                    many[i] = 1
            many[src] += 1
            at, h = at_more, h[more]
            if not len(at):
                break
        # by place, at each place by size, which grows from part to part
        first = np.cumsum(many, dtype=np.int64) - many
        total = int(many.sum())
        src, size, code = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, np.int32)
        for part, n, ids, before in found:
            order = first[part] + before
            src[order], size[order], code[order] = part, n, ids
        score = self.score[np.maximum(code, 0)]
        for i in np.flatnonzero(code < 0):
            score[i] = self.score[self.others[-code[i] - 1]].sum()
        # masses, all words together, from their ends
        mass = np.zeros(len(chars) + len(words))
        slot = np.arange(len(chars)) + np.repeat(np.arange(len(words)), sizes)  # each word has a state for its end
        total, target = np.zeros(len(src)), slot[src] + size
        left = word_end - np.arange(len(chars))
        by_left = np.argsort(left, kind="stable")
        bounds = np.searchsorted(left[by_left], np.arange(1, (left.max() if len(left) else 0) + 2))
        for a, b in zip(bounds[:-1], bounds[1:]):
            places = by_left[a:b]
            counts = many[places]
            starts = np.cumsum(counts) - counts
            edges = np.repeat(first[places] - starts, counts) + np.arange(counts.sum())
            total[edges] = score[edges] + mass[target[edges]]
            mass[slot[places]] = np.logaddexp.reduceat(total[edges], starts)
        log = np.minimum(0.0, total - mass[slot[src]])
        log[many[src] == 1] = 0.0
        share = np.exp(log)
        upto = np.cumsum(share)
        below = upto - np.repeat((upto - share)[first], many)
        below[first + many - 1] = 2.0  # the last piece takes what rounding leaves
        base = self.first.n
        states = base + ends - sizes + np.arange(len(words))
        self.states.update(zip(words, states.tolist()))
        f, m = np.zeros(len(mass), np.int64), np.zeros(len(mass), np.int32)
        f[slot], m[slot] = first + self.below.n, many
        for grown, values in ((self.first, f), (self.many, m), (self.below, below), (self.log, log), (self.next, base + target), (self.piece, code)):
            grown.add(values)
        return states


def spaced(text: str) -> str:
    """The words of a text, with spaces between them; there may be empty words."""
    text = SPACE + text.replace(" ", SPACE)
    if SPACE * 2 in text:
        return " ".join(RUNS.findall(text))
    return text.replace(SPACE, " " + SPACE).replace("\n", " \n ")


def uniform(keys: np.ndarray) -> np.ndarray:
    return ((mix(keys) >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def under(place: np.ndarray, top: float, noise: np.ndarray) -> np.ndarray:
    """Gumbel variables around ``place``, given that they lie below ``top``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(noise)) - place)


def step(n: int) -> np.uint64:
    return np.uint64(n * int(GOLDEN) % (1 << 64))


def node_noise(places: np.ndarray, n: int, seeds: np.ndarray) -> np.ndarray:
    return uniform(chained([places], (seeds ^ OTHER) + step(n)))


def walk(v: Vocabulary, state: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw pieces from states to the ends of their words; edges in order, and edges per state."""
    many, first, below, nxt = v.many.data, v.first.data, v.below.data, v.next.data
    steps, count, at, n = [], np.zeros(len(state), np.int64), np.arange(len(state)), 0
    while True:
        more = many[state] > 0
        at, state, keys = at[more], state[more], keys[more]
        if not len(at):
            break
        # long pieces are likelier and stand last, so the search goes down from them
        u, low = uniform(keys + step(n)), first[state]
        edge = low + many[state] - 1
        on = np.flatnonzero((edge > low) & (u <= below[edge - 1]))
        while len(on):
            edge[on] -= 1
            on = on[(edge[on] > low[on]) & (u[on] <= below[edge[on] - 1])]
        steps.append((at, edge))
        count[at] += 1
        state, n = nxt[edge], n + 1
    start, out = np.cumsum(count) - count, np.zeros(count.sum(), np.int64)
    for i, (at, edge) in enumerate(steps):
        out[start[at] + i] = edge
    return out, count


def sample_batch(v: Vocabulary, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple]]:
    """For each text up to ``k`` samples ``(edges, log_prob, value, kappa)``, kappa that of the row."""
    split = pc.split_pattern(pa.array([spaced(t) if t else "" for t in texts], pa.string()), " ")
    word = split.flatten()
    filled = pc.greater(pc.binary_length(word), 0)
    ends = np.append(0, np.cumsum(filled.to_numpy(zero_copy_only=False)))[split.offsets.to_numpy()]
    coded = word.filter(filled).dictionary_encode()  # a word is looked up once
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    if len(v.states) > REMEMBERED:
        v.reset()
    known = np.fromiter(map(v.states.__getitem__, words), np.int64, len(words))
    fresh = np.flatnonzero(known < 0)
    if len(fresh):
        known[fresh] = v.add(words[fresh].tolist())
    flat = known[coded.indices.to_numpy()]
    at, sizes = ends, np.diff(ends).tolist()
    # where each row goes on: a list of edges to keep, then states to draw from
    heads = [np.zeros(0, np.int64) for _ in texts]
    tails = [flat[at[i] : at[i + 1]] for i in range(len(texts))]
    spots = [np.arange(n, dtype=np.uint64) for n in sizes]
    values = -np.log(-np.log(uniform(chained([np.uint64(0)], seeds))))
    splits: list[tuple] = [(0, ())] * len(texts)  # place that the sample differs from, edges excluded there
    live, open_, out = list(range(len(texts))), [[] for _ in texts], [[] for _ in texts]
    for n in range(k):
        keys = chained([np.concatenate([spots[i] for i in live])], np.repeat(seeds[live] + step(n + 1), [len(spots[i]) for i in live]))
        edges, count = walk(v, np.concatenate([tails[i] for i in live]), keys)
        logs = v.log.data[edges]
        ends = np.cumsum([0, *(len(tails[i]) for i in live)])
        edge_at = np.concatenate([[0], np.cumsum(count)])[ends]
        places = np.array([splits[i][0] for i in live], np.uint64)[:, None] + np.arange(LOOK, dtype=np.uint64)
        noises = node_noise(places.ravel(), n, np.repeat(seeds[live], LOOK)).reshape(-1, LOOK)
        for j, i in enumerate(live):
            path, log = edges[edge_at[j] : edge_at[j + 1]], logs[edge_at[j] : edge_at[j + 1]]
            if len(heads[i]):
                path, log = np.concatenate([heads[i], path]), np.concatenate([v.log.data[heads[i]], log])
            before = np.cumsum(log) - log
            out[i].append((path, float(log.sum()), float(values[i])))
            # what the sample leaves: another piece at each place from the split on
            from_, excluded = splits[i]
            wanted, gumbel, some = k - n + 1, np.zeros(0), np.zeros(0, np.int64)
            for a, b in ((from_, from_ + LOOK), (from_ + LOOK, len(path))):
                if a >= len(path):
                    break
                if a > from_ and len(gumbel) >= wanted:  # beyond the noise's reach of the best so far
                    least = np.partition(gumbel, -wanted)[-wanted]
                    b = a + int(np.searchsorted(-before[a:], REACH - least))
                rest = -np.expm1(log[a:b])
                rest[log[a:b] > -1e-13] = 0.0
                if excluded and a == from_ and len(rest):
                    rest[0] = max(0.0, 1 - np.exp(v.log.data[[*excluded, path[a]]]).sum())
                    if len(excluded) + 1 >= len(_edges(v, path[a])) or rest[0] < 1e-13:
                        rest[0] = 0.0
                spot = np.flatnonzero(rest > 0)
                place = before[a:b][spot] + np.log(rest[spot])
                noise = noises[j, spot] if a == from_ else node_noise((spot + a).astype(np.uint64), n, np.full(len(spot), seeds[i]))
                gumbel, some = np.append(gumbel, under(place, values[i], noise)), np.append(some, spot + a)
            best = np.argpartition(-gumbel, wanted - 1)[:wanted] if len(gumbel) > wanted else np.arange(len(gumbel))
            for b in best:
                p = int(some[b])
                open_[i].append((float(gumbel[b]), n, p, (*(excluded if p == from_ else ()), int(path[p]))))
            open_[i].sort(reverse=True)
        if n + 1 == k:
            break
        live = [i for i in live if open_[i]]
        for i in live:
            value, parent, p, excluded = open_[i].pop(0)
            path = out[i][parent][0]
            choices = [e for e in _edges(v, path[p]) if e not in excluded]
            mass = np.exp(v.log.data[choices])
            u = uniform(chained([np.uint64(p), np.uint64(n)], seeds[i : i + 1] ^ np.uint64(0x2545F4914F6CDD1D)))[0] * mass.sum()
            chosen = choices[min(int(np.searchsorted(np.cumsum(mass), u)), len(choices) - 1)]
            heads[i] = np.append(path[:p], chosen)
            # words that the kept edges have finished
            done = int((v.many.data[v.next.data[path[:p]]] == 0).sum())
            tails[i] = np.concatenate([[v.next.data[chosen]], flat[at[i] + done + 1 : at[i + 1]]])
            spots[i] = np.arange(done, sizes[i], dtype=np.uint64)
            values[i], splits[i] = value, (p, excluded)
        if not live:
            break
    kappa = [rows[0][0] if rows else -np.inf for rows in open_]
    return [[(*s, kappa[i]) for s in rows] for i, rows in enumerate(out)]


def _edges(v: Vocabulary, edge: int) -> range:
    """All edges of the state that an edge leaves: the last one of each state is marked."""
    low = high = int(edge)
    while low > 0 and v.below.data[low - 1] <= 1.5:
        low -= 1
    while v.below.data[high] <= 1.5:
        high += 1
    return range(low, high + 1)


def piece_ids(v: Vocabulary, path: np.ndarray) -> np.ndarray:
    code = v.piece.data[path]
    if len(code) and code.min() < 0:
        code = np.array([x for c in code.tolist() for x in ([c] if c >= 0 else v.others[-c - 1])], np.int64)
    return code


def vocabulary(model: str) -> Vocabulary:
    state = worker_state()
    if ("segments", model) not in state:
        state[("segments", model)] = Vocabulary(model)
    return state[("segments", model)]


def decoded(v: Vocabulary, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """UTF-8 text of piece ids, all together, and where each piece begins in it; at last its end."""
    found = v.raw.take(pa.array(ids, pa.int64()))
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(ids) + 1]
    return memoryview(found.buffers()[2] or b""), ends


def round_trips(v: Vocabulary, rows: list[np.ndarray], wanted: list[bytes]) -> list[bool]:
    """Whether the ids of each row decode to the wanted text, with the space put in front."""
    text, begin = decoded(v, np.concatenate(rows) if rows else np.zeros(0, np.int64))
    ends = begin[np.cumsum([0, *map(len, rows)])].tolist()
    return [bytes(text[a + 1 : b]) == w for a, b, w in zip(ends[:-1], ends[1:], wanted)]


def decode(
    df: DataFrame, keep: list[str], ids: str = "ids", out: str = "text", *, model: str = "piece_bpe_32k.model"
) -> DataFrame:
    """Add ``out``, the text of the piece ids in the column ``ids``, to the columns ``keep``.

    No ids give the empty text; a null list, one that holds a null and one with an id outside the
    vocabulary give null; bytes that are no UTF-8 become U+FFFD.
    """
    keep = [c for c in keep if c != out]
    src = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{ids}`").cast("array<long>").alias("ids"))

    def run(batches):
        v = vocabulary(model)
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            found = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            outside = (found < 0) | (found >= len(v.raw))
            rows = np.repeat(np.arange(len(sizes)), sizes)
            wrong = np.bincount(rows[outside], minlength=len(sizes)) > 0
            text, begin = decoded(v, np.where(outside, 0, found))
            ends = begin[np.cumsum([0, *sizes])].tolist()
            missing = wrong | pc.is_null(lists).to_numpy(zero_copy_only=False)
            texts = [None if m else bytes(text[a + 1 : b]).decode("utf-8", "replace") for a, b, m in zip(ends[:-1], ends[1:], missing)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("text", T.StringType())])
    return src.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`") for c in keep], F.col("text").alias(out))


def sample_segmentations(
    df: DataFrame, key: str = "doc_id", text: str = "text", *, k: int = 2, seed: int = 4, model: str = "piece_bpe_32k.model",
    with_ids: bool = True,
) -> DataFrame:
    """A row for each sample: the key, ``sample`` (from 0, by falling ``gumbel_score``),
    ``n_pieces``, ``log_prob``, ``gumbel_score``, ``log_inclusion``, ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers), ``round_trip`` (the ids decode to the text) and, ``with_ids``, ``ids``."""
    src = df.select(
        F.struct(F.col(f"`{key}`").alias("key")).alias("row"), F.xxhash64(F.col(f"`{key}`").cast("string"), F.lit(seed)).alias("seed"), F.col(f"`{text}`").alias("text")
    )
    names = ["sample", "n_pieces", "log_prob", "gumbel_score", "log_inclusion", "ids_crc32", "round_trip"]
    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]

    def slices(batch):
        texts = [t or "" for t in batch.column(2).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and (i - start >= ROWS or size + len(t) > CHARS):
                yield start, texts[start:i]
                start, size = i, 0
            size += len(t)
        if start < len(texts):
            yield start, texts[start:]

    def run(batches):
        v = vocabulary(model)
        for batch in batches:
            for start, texts in slices(batch):
                seeds = batch.column(1).slice(start, len(texts)).to_numpy().view(np.uint64)
                rows, which, all_ids, wanted = [], [], [], []
                for i, samples in enumerate(sample_batch(v, texts, seeds, k)):
                    want = texts[i].replace(SPACE, " ").encode("utf-8", "replace")
                    for n, (path, log, value, kappa) in enumerate(samples):
                        ids = piece_ids(v, path)
                        gap = log - kappa
                        inclusion = 0.0 if gap > 5 else float(np.log(-np.expm1(-np.exp(gap)))) if gap > -30 else gap
                        rows.append((n, len(ids), log, value, inclusion, zlib.crc32(ids.astype("<u4"))))
                        which.append(start + i)
                        wanted.append(want)
                        all_ids.append(ids.astype(np.int32))
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds[:-1])]
                columns.append(pa.array(round_trips(v, all_ids, wanted), kinds[-1]))
                columns = [batch.column(0).field(0).take(pa.array(which, pa.int64())), *columns]
                if with_ids:
                    ends = np.cumsum([0, *map(len, all_ids)]).astype(np.int32)
                    flat = np.concatenate(all_ids) if all_ids else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=["key", *names, *["ids"] * with_ids])

    fields = [T.StructField("key", src.schema["row"].dataType.fields[0].dataType)]
    fields += T.StructType.fromDDL(
        "sample int, n_pieces long, log_prob double, gumbel_score double, log_inclusion double, ids_crc32 long, round_trip boolean"
        + ", ids array<int>" * with_ids
    ).fields
    return src.mapInArrow(run, T.StructType(fields)).withColumnRenamed("key", key)


def op4_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents"))
