"""Byte-pair encoding with word ends, and decoding.

A word's bytes start as symbols of a doubly linked list. A priority queue
holds the ranks of adjacent pairs; the lowest rank merges first, and entries
whose symbols have changed meanwhile are skipped when they surface.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

from rivulet.llm.common import adding

#: Bytes of words and ids that a Python worker remembers in each of two generations, and the longest such word.
REMEMBERED, LONGEST = 40 << 20, 64
#: Bytes that an entry takes beside its characters and ids: two headers and a place in the table.
ENTRY = 240

# The end-of-word mark of the vocabulary format, and rules of letter case.
WORD_END = "</w>"
#: Control characters that part words for str.split() but are no white space in the word pattern.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Lower case of capitals that are newer than Python's tables: first, last, step, distance to the small letter.
NEWER_CAPITALS = [
    (0x1C89, 0x1C89, 1, 1), (0xA7CB, 0xA7CB, 1, 0x264 - 0xA7CB), (0xA7CC, 0xA7CE, 2, 1), (0xA7D2, 0xA7D4, 2, 1),
    (0xA7DA, 0xA7DA, 1, 1), (0xA7DC, 0xA7DC, 1, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 1, 0x20), (0x16EA0, 0x16EB8, 1, 0x1B),
]
LOWER = {c: c + far for first, last, step, far in NEWER_CAPITALS for c in range(first, last + 1, step) if not chr(c).islower() and chr(c).lower() == chr(c)}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable Latin-1 characters stand for themselves, all other bytes in
    order for the characters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and word pattern of one tokenizer file's text."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("the file must hold a BPE model with word ends")
        self.ids: dict[str, int] = model["vocab"]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        ids = self.ids
        self.size = max(ids.values()) + 1
        self.ranks = {ids[a] * self.size + ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.wholes = [ids[a + b] for a, b in pairs]
        letters = byte_symbols()
        self.inner, self.last = [ids[c] for c in letters], [ids[c + WORD_END] for c in letters]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_ids = special
        self.strings = [""] * (max([*ids.values(), *special.values()]) + 1)
        for symbol, i in [*ids.items(), *special.items()]:
            self.strings[i] = symbol
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.room = REMEMBERED

    def merged(self, word: str) -> list[int]:
        """Ids of one word."""
        data = (word if word.isascii() else word.translate(LOWER)).encode("utf-8", "surrogatepass")
        symbols = list(map(self.inner.__getitem__, data))
        symbols[-1] = self.last[data[-1]]
        n, size = len(symbols), self.size
        rank_of, whole_of, push, pop = self.ranks.get, self.wholes, heapq.heappush, heapq.heappop
        # the rank of the pair that now starts at each symbol; queue entries are rank << 32 | position
        ranks = [rank_of(a * size + b, -1) for a, b in zip(symbols, symbols[1:])]
        queue = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
        if not queue:
            return symbols
        ranks.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            rank = entry >> 32
            if ranks[i] != rank:
                continue  # stale: one side was merged meanwhile
            j = after[i]
            symbols[i] = whole = whole_of[rank]
            symbols[j] = ranks[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                ranks[i] = rank = rank_of(whole * size + symbols[k], -1)
                if rank >= 0:
                    push(queue, rank << 32 | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rank_of(symbols[h] * size + whole, -1)
                if rank >= 0:
                    push(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        """Packed ids of a word or of a run of words that no white space parts."""
        packed = self.older.get(word)
        if packed is None:
            parts = self.words.findall(word)
            if len(parts) == 1 and parts[0] == word:
                packed = array("i", self.merged(word)).tobytes()
            else:
                packed = b"".join([self.known.get(w) or self._word(w) for w in parts])
        if len(word) <= LONGEST:
            if self.room <= 0:  # words in use move on, the others are forgotten
                self.known, self.older, self.room = {}, self.known, REMEMBERED
            self.room -= ENTRY + len(word) + len(packed)
            self.known[word] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        # Capitals are lowered one by one, so a sigma that ends a word is like any other. The pattern never
        # matches white space, so it need not be evened out first.
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        words = self.words.findall(text) if any(c in text for c in SEPARATORS) else text.split()
        known, more = self.known, self._word
        found = []
        for word in words:
            packed = known.get(word)
            if packed is None:
                packed = more(word)
                known = self.known
            found.append(packed)
        return b"".join(found)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens become their ids."""
        if not text:
            return np.empty(0, np.int32)
        found, begin = [], 0
        for match in self.special.finditer(text) if self.special else ():
            found += [self._plain(text[begin : match.start()]), np.int32(self.special_ids[match[0]]).tobytes()]
            begin = match.end()
        return np.frombuffer(b"".join([*found, self._plain(text[begin:])]), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings of the ids, joined by a space each, as for a file that names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def vocabulary_text(path: str) -> str:
    """The tokenizer file as text: a few megabytes at most, whatever the corpus."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _flat(arrays: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """One Arrow list per array, and all numbers behind them."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())), values


def encode(docs: DataFrame, content: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of the whole text as `ids`, an array of ints.

    `content` is the text of a tokenizer file (see `vocabulary_text`); it goes
    to the tasks as a broadcast. Null texts count as empty and get no ids.
    Texts of any length are encoded whole. Every row keeps its other columns;
    repeated rows get the same ids. An empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def encoded(texts: list) -> list[pa.Array]:
        vocabulary = _vocabulary(shared.value)
        return [_flat([vocabulary.encode(x) for x in texts])[0]]

    return adding(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], encoded)


def decode(docs: DataFrame, content: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that the ids stand for: their vocabulary strings joined by spaces. Null ids give null.

    The other columns pass through; one named like the new column gives way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() != text.lower()]
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], T.StructField(text, T.StringType())])

    def run(batches):
        vocabulary = _vocabulary(shared.value)
        for batch in batches:
            column = batch.column(ids)
            for begin, count in _runs(column):
                part, rest = column.slice(begin, count), batch.slice(begin, count)
                lengths = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
                numbers, ends = part.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
                made = [vocabulary.decode(numbers[end - n : end]) if there else None for end, n, there in zip(ends, lengths, part.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*[rest.column(i) for i in kept], pa.array(made, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _runs(column: pa.Array, most: int = 1 << 20):
    """(first row, rows) of runs with at most `most` list items, or one row."""
    begin = total = 0
    for row, n in enumerate(pc.fill_null(pc.list_value_length(column), 0).to_pylist()):
        if row > begin and total + n > most:
            yield begin, row - begin
            begin, total = row, 0
        total += n
    if begin < len(column):
        yield begin, len(column) - begin
