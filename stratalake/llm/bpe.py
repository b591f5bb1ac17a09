"""Byte-level BPE encoding and decoding as a tree reduction.

The encoding of ``a + b`` follows from the encodings of ``a`` and ``b``: only tokens near the seam can change.
:meth:`Codec.join` re-encodes a window of ``k`` tokens on each side of the seam. Once the first token of the
re-encoded window is the old first one, and the last the old last one, every neighbouring pair of the joined list
is one that greedy merging leaves alone, so the list is the encoding of the whole; otherwise ``k`` doubles.
A match of the split pattern is halved down to single bytes and joined upwards; matches never meet.

Texts stay in their rows: no shuffle. A null text counts as empty, an empty text has no tokens, repeated rows give
repeated results, an empty table gives an empty one, and an input column with the name of an output is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Largest rank file that is broadcast; vocabularies do not grow with the data.
MAX_RANK_BYTES = 64 << 20
#: A codec remembers so many matches per worker. Only speed depends on it.
REMEMBERED = 700_000

#: Stands for neighbours that do not merge.
_NEVER = 1 << 62

OUTPUTS = {
    "ids": (pa.list_(pa.int32()), T.ArrayType(T.IntegerType())),
    "n_tokens": (pa.int64(), T.LongType()),
    "ids_sha256": (pa.string(), T.StringType()),
    "decoded": (pa.binary(), T.BinaryType()),
    "decoded_sha256": (pa.string(), T.StringType()),
}


def read_ranks(path: str) -> bytes:
    """The rank file (token in base64, blank, rank), with its size checked."""
    with open(path, "rb") as file:
        data = file.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return data


class _Remembered(dict):
    """What ``make`` gave for a key. When full, one older generation stays, and keys asked for again move up."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Encodes and decodes with one rank table."""

    def __init__(self, rank_file: bytes, remembered: int = REMEMBERED):
        self.rank_file, self.limit = rank_file, remembered
        self._load()

    def __reduce__(self):
        return Codec, (self.rank_file, self.limit)

    def _load(self) -> None:
        pairs = (line.split() for line in self.rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"ranks lack {len(missing)} single bytes")
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        # neighbours that merge: both ids in one number, and the rank of what they make
        find = self.ranks.get
        self.pairs = {
            left << 32 | right: rank
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (left := find(token[:i])) is not None and (right := find(token[i:])) is not None
        }
        self.matches = _Remembered(self._match, self.limit)
        self.nodes = _Remembered(self._node, self.limit)
        self.seams = _Remembered(self._seam, self.limit)

    def _match(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.encode(data)

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Tokens of one match: halves first, then the seam."""
        if len(data) <= 1:
            return (self.ranks[data],) if data else ()
        return self.nodes[data] if len(data) <= 32 else self._node(data)

    def _node(self, data: bytes) -> tuple[int, ...]:
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        width = 1
        while True:
            before, after = left[-width:], right[:width]
            if width == 1:
                window = self.seams[before + after]
            else:
                window = self._seam(before + after)
            settled_left = width >= len(left) or window[0] == before[0]
            settled_right = width >= len(right) or window[-1] == after[-1]
            if settled_left and settled_right:
                return left[: max(0, len(left) - width)] + window + right[width:]
            width *= 2

    def _seam(self, tokens: tuple[int, ...]) -> tuple[int, ...]:
        return self.merge(b"".join([self.tokens[t] for t in tokens]))

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Greedy merging of a window: always the leftmost pair of lowest rank."""
        if len(data) > 64:
            return self._merge_long(data)
        pair = self.pairs.get
        ids = [self.bytes[b] for b in data]
        ranks = [pair(a << 32 | b, _NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != _NEVER:
            at = ranks.index(best)
            # a token's rank is its id, so the pair becomes its rank
            ids[at] = best
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = pair(best << 32 | ids[at + 1], _NEVER)
            if at:
                ranks[at - 1] = pair(ids[at - 1] << 32 | best, _NEVER)
        return tuple(ids)

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap over linked parts, for windows that stay unsettled for long."""
        size = len(data)
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        alive = [True] * size
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := self.ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            if not alive[at] or (middle := end[at]) >= size or end[middle] != stop:
                continue
            alive[middle], end[at] = False, stop
            if stop < size:
                before[stop] = at
                if (rank := self.ranks.get(data[at : end[stop]])) is not None:
                    heapq.heappush(heap, (rank, at, end[stop]))
            if (first := before[at]) >= 0 and (rank := self.ranks.get(data[first:stop])) is not None:
                heapq.heappush(heap, (rank, first, stop))
        return tuple([self.ranks[data[i : end[i]]] for i in range(size) if alive[i]])

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids: blocks of ids, concatenated up the tree."""
        if len(ids) <= 4096:
            return b"".join([self.tokens[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode_texts(
    df: DataFrame,
    ranks: bytes,
    pattern: str,
    outputs: tuple[str, ...] = ("ids", "n_tokens"),
    text: str = "text",
) -> DataFrame:
    """``df`` with the asked outputs of :data:`OUTPUTS`: each match of ``pattern`` is encoded on its own.

    ``ids`` are the tokens, ``decoded`` the bytes that come back from them, the rest are digests of the two
    (lowercase hex; ids in decimal, joined by commas).
    """
    if unknown := set(outputs) - set(OUTPUTS):
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    kept = [f for f in df.schema.fields if f.name not in outputs]
    schema = T.StructType([*kept, *(T.StructField(name, OUTPUTS[name][1]) for name in outputs)])
    shared = df.sparkSession.sparkContext.broadcast(Codec(ranks))
    names = [f.name for f in kept]

    def run(batches):
        import regex

        codec, split = shared.value, regex.compile(pattern)
        for batch in batches:
            made = {name: [] for name in outputs}
            for value in batch.column(batch.schema.get_field_index(text)):
                known = codec.matches
                ids = list(chain.from_iterable([known[m] for m in split.findall(value.as_py() or "")]))
                if "ids" in made:
                    made["ids"].append(ids)
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    back = codec.decode(ids)
                    if "decoded" in made:
                        made["decoded"].append(back)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array(made[n], OUTPUTS[n][0]) for n in outputs]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *outputs])

    return df.mapInArrow(run, schema)
