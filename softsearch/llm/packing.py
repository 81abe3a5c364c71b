"""Cost-balanced packing of token sequences.

Documents are tokenised, an end token is added, and the tokens are laid into sequences of
``capacity`` tokens. The cost of a sequence is ``LINEAR * tokens + QUADRATIC * sum(piece ** 2)``:
one part for the layers that are linear in the tokens, one for attention, which stays inside
a piece. Whole ``capacity``-long pieces of long documents fill sequences of their own. What
remains is placed in descending order, each on the sequence of lowest cost that still has
room, over as many sequences as it fills; what fits nowhere whole is cut over the room left.

Sequences are formed inside the tasks that tokenise, window by window (``WINDOW`` tokens, the
bound of memory besides one document), so no tokens are shuffled. The sequence that a window
leaves partly filled is opened again with the next one, so a task ends with one at most.

Defined results: a null or empty text is the end token alone; repeated rows are packed
separately; an empty table gives no rows. Sequence ids are unique, not gapless.
"""

from __future__ import annotations

import base64
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import slices, table, worker_state

CAPACITY = 1024
#: Cost of a token, and of a pair of tokens of a piece (at 1,024 tokens both weigh the same).
LINEAR, QUADRATIC = 1.0, 1 / 1024
#: Tokens that a task packs at a time.
WINDOW = 2_000_000
#: Stands for no sequence in ``Cheapest``.
NONE = (float("inf"), 0, 0)


class Encoder:
    """Token ids of the byte-level BPE vocabulary, as the ``tokenizers`` library gives them.

    Texts are encoded whole; those that hold a special token by ``tokenizers`` itself.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def encoder(name: str) -> Encoder:
    state = worker_state()
    if name not in state:
        state[name] = Encoder(name)
    return state[name]


class Cheapest:
    """Open sequences ``[cost, tokens, id]`` in a heap for each room that is left, under a tree
    of the least (cost, id) by ranges of room: the cheapest with room for n in log(capacity)."""

    def __init__(self, sequences: list[list], capacity: int):
        self.capacity = capacity
        self.heaps: list[list] = [[] for _ in range(capacity + 1)]
        self.size = 1 << capacity.bit_length()
        self.tree: list[tuple] = [NONE] * (2 * self.size)
        for seq in sequences:
            self.add(seq)

    def _renew(self, room: int) -> None:
        heap, at = self.heaps[room], self.size + room
        self.tree[at] = (heap[0][0], heap[0][1], room) if heap else NONE
        while at > 1:
            at >>= 1
            self.tree[at] = min(self.tree[2 * at], self.tree[2 * at + 1])

    def add(self, seq: list) -> None:
        room = self.capacity - seq[1]
        if room:
            heapq.heappush(self.heaps[room], (seq[0], seq[2], seq))
            if self.heaps[room][0][2] is seq:
                self._renew(room)

    def take(self, n: int) -> list | None:
        """The cheapest sequence with room for ``n`` tokens, taken out."""
        best, low, high = NONE, self.size + n, self.size + self.capacity + 1
        while low < high:
            if low & 1:
                best = min(best, self.tree[low])
                low += 1
            if high & 1:
                high -= 1
                best = min(best, self.tree[high])
            low, high = low >> 1, high >> 1
        if best is NONE:
            return None
        seq = heapq.heappop(self.heaps[best[2]])[2]
        self._renew(best[2])
        return seq


def place(lengths: list[int], open_: list[list], new: int, capacity: int = CAPACITY) -> tuple[list, list, int]:
    """Lay pieces of ``lengths`` into sequences; returns pieces ``(item, start, length,
    sequence, offset)``, the sequences still open ``[cost, tokens, id]`` and the next free id."""
    pieces, rest = [], []

    def put(item, start, n, seq):
        pieces.append((item, start, n, seq[2], seq[1]))
        seq[1] += n
        seq[0] += LINEAR * n + QUADRATIC * n * n

    for item, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((item, start, capacity, new, 0))
            new += 1
        if n % capacity:
            rest.append((n % capacity, item))
    rest.sort(key=lambda x: (-x[0], x[1]))
    room = sum(capacity - s[1] for s in open_)
    for _ in range(max(0, (sum(n for n, _ in rest) - room) // capacity)):  # all of them will be full
        open_.append([0.0, 0, new])
        new += 1
    cheapest, homeless = Cheapest(open_, capacity), []
    for n, item in rest:  # descending: a sequence without room for n may have room for later ones
        seq = cheapest.take(n)
        if seq is None:
            homeless.append((n, item))
            continue
        put(item, lengths[item] - n, n, seq)
        cheapest.add(seq)
    free = sorted((s for s in open_ if s[1] < capacity), key=lambda s: (s[1], s[2]))
    at = 0
    for n, item in homeless:
        start = lengths[item] - n
        while n:
            if at == len(free):
                free.append([0.0, 0, new])
                open_.append(free[at])
                new += 1
            take = min(n, capacity - free[at][1])
            put(item, start, take, free[at])
            start, n = start + take, n - take
            if free[at][1] == capacity:
                at += 1
    return pieces, [s for s in open_ if s[1] < capacity], new


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
    capacity: int = CAPACITY, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the key column, ``start``, ``length``, ``ids`` (only ``with_ids``),
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    src = df.select(F.struct(F.col(f"`{key}`").alias("key")).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        encode = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 33
        keys, ids, size, open_, new = [], [], 0, [], first

        def flush():
            nonlocal open_, new, size
            pieces, open_, new = place([len(x) for x in ids], open_, new, capacity)
            items = [p[0] for p in pieces]
            cuts = [ids[i][s : s + n] for i, s, n, _, _ in pieces]
            columns = {
                "key": pa.concat_arrays([k.field(0) for k in keys]).take(pa.array(items, pa.int64())),
                "start": pa.array([p[1] for p in pieces], pa.int64()), "length": pa.array([p[2] for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()),
                "doc_tokens": pa.array([len(ids[i]) for i in items], pa.int64()),
                "sequence_id": pa.array([p[3] for p in pieces], pa.int64()),
                "offset": pa.array([p[4] for p in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(cuts, pa.list_(pa.int32()))
            keys.clear(), ids.clear()
            size = 0
            return pa.RecordBatch.from_pydict(columns)

        for whole in batches:
            for at, n in slices(whole.column(1)):
                batch = whole.slice(at, n)
                keys.append(batch.column(0))
                for value in batch.column(1).to_pylist():
                    ids.append(np.array([*encode(value or ""), end_id], dtype="<u4"))
                    size += len(ids[-1])
                if size >= WINDOW:
                    yield flush()
        if ids:
            yield flush()

    kind = src.schema["row"].dataType.fields[0].dataType.simpleString()
    out = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = src.mapInArrow(run, out + (", ids array<int>" if with_ids else ""))
    return packed.withColumnRenamed("key", key)


def op9_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
