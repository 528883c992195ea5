"""Fill-in-the-middle: texts cut in three and put together in another order.

Cuts are given in units (code points, words or lines), texts are stored as
bytes. A rolling hash parts each text into chunks by their content, so texts
that share passages share chunks. What a chunk adds to the units before it is
remembered by the chunk's content; the sums over a text's chunks tell which
chunk holds a cut, and only that one is looked into.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a chunk: least, most, and about as many as the rolling hash adds to the least.
LEAST, MOST, USUAL = 256, 8192, 1024
#: Bytes that the rolling hash sees: two to the power of this.
WINDOW_POWER = 5
#: Bytes of chunks that a Python worker remembers in each of two generations.
REMEMBERED = 32 << 20

_MULTIPLIER = 0x9E3779B1
_SPACES = np.isin(np.arange(256), [32, *range(9, 14)])

#: Whether a unit begins at a byte, from the byte before it and itself. Every text begins with a unit.
UNITS: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "char": lambda before, byte: (byte & 0xC0) != 0x80,
    "word": lambda before, byte: _SPACES[before] & ~_SPACES[byte],
    "line": lambda before, byte: before == 10,
}


def _byte_values() -> np.ndarray:
    """A number for each byte value, from its digest."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "big") for b in range(256)], np.uint32)


_VALUES = _byte_values()


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text end.

    The hash of the bytes before a place decides whether a chunk ends there,
    so equal passages are cut alike after their first chunks. The hash of
    twice as many bytes is made of two hashes, once per power of two.
    """
    size = len(data)
    if size <= LEAST:
        return [size]
    rolled = _VALUES[np.frombuffer(data, np.uint8)]
    factor = np.uint32(_MULTIPLIER)
    for power in range(WINDOW_POWER):
        width = 1 << power
        older = rolled[:-width] * factor
        rolled = rolled.copy()
        rolled[width:] += older
        factor = np.uint32(int(factor) ** 2 & 0xFFFFFFFF)
    marks = np.flatnonzero((rolled >> np.uint32(12)) % np.uint32(USUAL) == 0) + 1
    ends, begin = [], 0
    while size - begin > LEAST:
        at = int(np.searchsorted(marks, begin + LEAST))
        end = min(int(marks[at]) if at < len(marks) else size, begin + MOST, size)
        ends.append(end)
        begin = end
    if begin < size:
        ends.append(size)
    return ends


class Chunks:
    """Units inside chunks by the chunks' bytes; the dictionary compares whole contents, not hashes alone."""

    def __init__(self, unit: str, most: int = REMEMBERED):
        self.rule, self.most = UNITS[unit], most
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.held = 0

    def begins(self, chunk: bytes) -> np.ndarray:
        """The places after the first byte at which a unit begins."""
        bytes_ = np.frombuffer(chunk, np.uint8)
        return np.flatnonzero(self.rule(bytes_[:-1], bytes_[1:])) + 1

    def inside(self, chunk: bytes) -> int:
        """How many units begin after the chunk's first byte, which does not depend on its neighbours."""
        count = self.known.get(chunk)
        if count is None:
            count = self.older.get(chunk)
            if count is None:
                count = len(self.begins(chunk))
            if self.held + len(chunk) > self.most:  # chunks in use move on, the others are forgotten
                self.known, self.older, self.held = {}, self.known, 0
            self.known[chunk] = count
            self.held += len(chunk)
        return count

    def first(self, data: bytes, at: int) -> bool:
        """Whether a unit begins with the chunk at a place of the text."""
        return at == 0 or bool(self.rule(np.array([data[at - 1]], np.uint8), np.array([data[at]], np.uint8))[0])


class Text:
    """Units of one text by chunk."""

    def __init__(self, data: bytes, chunks: Chunks):
        self.data, self.chunks = data, chunks
        self.edges = [0, *chunk_ends(data)] if data else [0]
        counts = [chunks.inside(data[a:b]) + chunks.first(data, a) for a, b in zip(self.edges, self.edges[1:])]
        self.upto = np.cumsum([0, *counts])
        self.n = int(self.upto[-1])

    def place(self, units: int) -> int:
        """The byte behind so many units."""
        if units >= self.n:
            return len(self.data)
        at = int(np.searchsorted(self.upto, units, side="right")) - 1
        begin, end = self.edges[at], self.edges[at + 1]
        left = units - int(self.upto[at])
        if self.chunks.first(self.data, begin):
            if left == 0:
                return begin
            left -= 1
        return begin + int(self.chunks.begins(self.data[begin:end])[left])


def _draws(seed: int, key) -> list[int]:
    """Four numbers of 32 bits from the key's digest; a null key counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, unit: str = "char"
) -> DataFrame:
    """Add `n` (units), `form`, `prefix_units`, `middle_units` and `output`.

    Both cuts come from the digest of seed and key, so repeated rows get the
    same result. A text stays `plain`, with null lengths, if it is empty, holds
    a marker, or its third draw is `plain_from` or more of a hundred; otherwise
    the fourth draw decides between suffix first (`spm`, below `spm_below` of a
    hundred) and prefix first (`psm`). Null texts count as empty. Texts of any
    length are cut whole, in time proportional to their length; a task holds a
    few megabytes of texts, or one longer text. Other columns pass through; one
    named like a new column gives way. An empty table stays empty.
    """
    fields = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_units", T.LongType()),
              T.StructField("middle_units", T.LongType()), T.StructField("output", T.StringType())]
    new = {f.name for f in fields}
    kept = [i for i, f in enumerate(docs.schema.fields) if f.name.lower() not in new]
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], *fields])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(data: bytes, name, chunks: Chunks) -> tuple:
        whole = Text(data, chunks)
        one, two, three, four = _draws(seed, name)
        if not data or three % 100 >= plain_from or any(m in data for m in marks):
            return whole.n, "plain", None, None, data
        ends = sorted(draw % (whole.n + 1) for draw in (one, two))
        a, b = map(whole.place, ends)
        prefix, middle, suffix = data[:a], data[a:b], data[b:]
        p, s, m = marks
        if four % 100 < spm_below:
            form, made = "spm", (s, suffix, p, prefix, m, middle)
        else:
            form, made = "psm", (p, prefix, s, suffix, m, middle)
        return whole.n, form, ends[0], ends[1] - ends[0], b"".join(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(unit)
        for batch in batches:
            for part in slices(batch, text, 8 << 20):
                texts = part.column(text).cast(pa.binary()).to_pylist()
                rows = [cut(x or b"", name, chunks) for x, name in zip(texts, part.column(key).to_pylist())]
                columns = list(zip(*rows)) if rows else [()] * 5
                made = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that was cut, from its new form alone. A text that is cut holds no marker, so the first of each are its own."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    rest = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    first = F.split(rest, f"{SUFFIX}|{MIDDLE}", 3)  # prefix, suffix, middle
    last = F.split(rest, f"{PREFIX}|{MIDDLE}", 3)  # suffix, prefix, middle
    return (
        F.when(form == "psm", F.concat(first[0], first[2], first[1]))
        .when(form == "spm", F.concat(last[1], last[2], last[0]))
        .otherwise(output)
    )
