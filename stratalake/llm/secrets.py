r"""Secrets: fixed patterns, and random strings told by how badly a vocabulary compresses them.

Base kinds: ``assign`` (a keyword, a colon or equals sign, and a value of 8 characters or more), ``access`` (an access
key id of 16 characters or more) and ``hex`` (32 hexadecimal digits or more). They always stay.

``random`` adds strings of ``LEAST`` key characters or more, outside base spans, that a byte-level BPE vocabulary cuts into
tokens of fewer than ``RATIO`` characters on average: words and names compress well, random strings do not. Runs are cut
at equals signs and slashes first, so that a name or path beside a key neither hides it nor is taken along; neighbours
between slashes that are random too (a slash inside a key) join it. Strings of fewer than ``LONG`` characters or of letters alone must
not exceed ``STRICT``; the latter hold no hyphens or underscores, and capitals alone are measured in lower case as well. Known digests
(hexadecimal of the usual lengths, UUIDs), numbers, times and identifiers (words, numbers and version parts joined by
underscores, hyphens or case) are left out before.

Spans are code points, the end is past the last one, and come by start, then kind. Row-local: no shuffle. A null
text counts as empty and has no spans; repeated rows repeat results; an input column with the output's name is
replaced.
"""

from __future__ import annotations

import base64
import bisect
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]

#: Characters per token below which a string counts as random.
RATIO = 2.2
#: The same for strings of fewer than LONG characters, and for those without digits, where words would be caught.
STRICT = 1.85
LEAST, LONG = 16, 20

#: The patterns of the base kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
DIGESTS = (16, 32, 40, 48, 56, 64, 96, 128)

_RUN = re.compile(f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
_PIECE = re.compile("[^/=]+")
_LETTERS = re.compile(f"[A-Za-z]{{{LEAST},}}")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PART = re.compile(r"[A-Za-z]*[0-9]{0,4}|[0-9]+")
_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS[:-1] + "{12,}")
_HEX = re.compile(HEX[:-1] + "{32,}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the base kinds."""
    out = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        # a match is a run to its end, so one that is too short has no longer one inside
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def known(run: str) -> bool:
    """Digests, numbers, times and identifiers; strings without digits are none of them."""
    if not re.search("[0-9]", run):
        return False
    if sum(c.isalpha() for c in run) < 4:
        return True
    if _UUID.fullmatch(run) or (len(run) in DIGESTS and re.fullmatch("[0-9a-fA-F]+", run)):
        return True
    parts = [p for piece in re.split("[-_/+=]+", run) for p in re.findall("[A-Z]?[a-z]+[0-9]*|[A-Z]+[0-9]*|[0-9]+", piece)]
    return all(_PART.fullmatch(p) and (len(p) > 3 or p.isdigit()) for p in parts)


def _random_parts(run: str, tokens) -> list[tuple[int, int, float]]:
    """(start, stop, characters per token) of the random strings of a run without base spans."""

    def ratio(value: str) -> float:
        most = len(value) / max(1, tokens(value))
        return max(most, len(value) / max(1, tokens(value.lower()))) if value.isupper() else most

    found: list[tuple[int, int, float]] = []
    for piece in _PIECE.finditer(run):
        value = piece[0]
        if not re.search("[0-9]", value):
            for m in _LETTERS.finditer(value):
                if (r := ratio(m[0])) <= STRICT:
                    found.append((piece.start() + m.start(), piece.start() + m.end(), r))
        elif len(value) >= LEAST and not known(value):
            r = ratio(value)
            if r < RATIO and (len(value) >= LONG or r <= STRICT):
                found.append((*piece.span(), r))
    out: list[tuple[int, int, float]] = []
    for start, stop, r in found:
        low, high = start, stop
        while low and run[low - 1] == "/" and (m := re.search("[^/=]+$", run[: low - 1])) and _mixed(m[0]) and ratio(m[0]) <= STRICT:
            low = m.start()
        while high < len(run) and run[high] == "/" and (m := _PIECE.match(run, high + 1)) and _mixed(m[0]) and ratio(m[0]) <= STRICT:
            high = m.end()
        if out and low < out[-1][1]:
            low = out[-1][0]
            out.pop()
        out.append((low, high, r if (low, high) == (start, stop) else ratio(run[low:high])))
    return out


def _mixed(piece: str) -> bool:
    """Whether a short piece between slashes may be part of a key: two kinds of characters or more."""
    return len(piece) >= 4 and sum(bool(re.search(k, piece)) for k in ("[a-z]", "[A-Z]", "[0-9]")) > 1


def random_spans(text: str, base: list[tuple[int, int, int]], tokens) -> list[tuple[int, int, int, float]]:
    """(start, kind, stop, characters per token) of strings that ``tokens`` cuts small, outside base spans."""
    out = []
    merged: list[list[int]] = []
    for start, _, stop in base:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    for match in _RUN.finditer(text):
        start, stop = match.span()
        after = bisect.bisect_left(merged, [stop])
        if after and merged[after - 1][1] > start:
            continue
        out += [(start + a, 3, start + b, r) for a, b, r in _random_parts(match[0], tokens)]
    return out


def find(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with all spans: array of (kind, start, stop, ratio); the ratio is null for base kinds."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
            T.StructField("ratio", T.DoubleType()),
        ]
    )
    arrow = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("ratio", pa.float64())])
    )
    base = docs.drop(name)
    names = base.columns

    def run(batches):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in shared.value.splitlines() if x.strip())}
        vocabulary = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

        def tokens(value: str) -> int:
            return len(vocabulary.encode_ordinary(value))

        for batch in batches:
            made = []
            for value in batch.column(batch.schema.get_field_index(text)):
                whole = value.as_py() or ""
                fixed = base_spans(whole)
                every = [(*s, None) for s in fixed] + random_spans(whole, fixed, tokens)
                every.sort(key=lambda s: s[:3])
                made.append([{"kind": KINDS[k], "start": a, "stop": b, "ratio": r} for a, k, b, r in every])
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, arrow)], names=[*names, name])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(name, T.ArrayType(span))]))


def counted(spans: Column, kind: str) -> Column:
    """The number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
