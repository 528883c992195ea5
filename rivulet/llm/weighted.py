"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: runs of words and how often they occur.
For each sample every term gets two gamma numbers and a uniform one from its
hash; with the term's weight they make its arrival time, and the term that
arrives first, with its rounded weight, is the sample. Two texts agree in a
sample with a probability of their generalised Jaccard similarity: the sum of
the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rivulet.llm.common import adding
from rivulet.llm.words import ODD, U, mixed

#: Samples of a fingerprint, and words of a term.
SAMPLES, WORDS = 128, 1
#: Bytes of a text that are parted into words at once, terms that arrive at once, terms that are drawn for at once,
#: and terms whose numbers a worker keeps.
BLOCK, TERMS, DRAWN, KEPT = 1 << 20, 1024, 64, 1 << 17
#: Words up to which those of a text arrive at once, and how many such texts are read before numbers are drawn.
SHORT, GROUP = 1 << 15, 16

#: Exponential quantiles; sums of two are gamma numbers of shape two. A table, so that all machines draw alike.
_EXPONENTIAL = (-np.log((np.arange(1 << 16) + 0.5) / (1 << 16))).astype(np.float32)


def _blocks(data: bytes) -> Iterator[bytes]:
    """The text in blocks that end with a white space, or else with the text."""
    begin = 0
    while len(data) - begin > BLOCK:
        end = max(data.rfind(space, begin, begin + BLOCK) for space in (b" ", b"\n", b"\t"))
        if end < 0:
            found = [at for space in (b" ", b"\n", b"\t") if (at := data.find(space, begin + BLOCK)) >= 0]
            if not found:
                break
            end = min(found)
        yield data[begin : end + 1]
        begin = end + 1
    yield data[begin:]


def terms(text: str, words: int = WORDS) -> dict[bytes, int]:
    """The text's runs of so many words, joined by spaces, and how often each occurs. Shorter texts are one run.

    White space parts words; A-Z count as a-z.
    """
    found: Counter[bytes] = Counter()
    carried: list[bytes] = []
    for block in _blocks(text.encode("utf-8", "surrogatepass").lower()):
        carried += block.split()
        if words > 1:
            found.update(map(b" ".join, zip(*[carried[i:] for i in range(words)])))
            carried = carried[max(0, len(carried) - words + 1):]
        else:
            found.update(carried)
            carried = []
    if not found and carried:
        found[b" ".join(carried)] = 1
    return found


class _Places(dict):
    """Rows of terms, in order; a term that is asked for gets the next row."""

    def __missing__(self, name: bytes) -> int:
        self[name] = row = len(self)
        return row


class Sampler:
    """Draws samples of weighted terms. The numbers of the terms used most are kept, in a table of bounded size."""

    def __init__(self, samples: int = SAMPLES, kept: int = KEPT):
        self.salts = mixed(np.arange(1, samples + 1, dtype=np.uint64) * ODD[0])
        self.kept = kept
        self.places = _Places()
        # rows of the terms of the last draws: few, so that terms met again at once are found without a walk through memory
        self.recent: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}
        self.uses, self.names = np.zeros(kept, np.int64), np.zeros(kept, np.uint64)
        self.rate, self.shift, self.start = (np.empty((kept, samples), np.float32) for _ in range(3))

    def _rows(self, names: list[bytes], again: bool = False) -> np.ndarray:
        """Where the table has the numbers of these terms, after drawing for those that it lacks."""
        places = self.places
        if again:
            found = list(map({**self.before, **self.recent}.get, names))
            if None in found:
                found = [places.get(name) if row is None else row for name, row in zip(names, found)]
        else:
            found = list(map(places.get, names))
        if None in found:
            new = [name for name, row in zip(names, found) if row is None]
            begin, end = len(places), len(places) + len(new)
            if end > self.kept:
                self._forget()
                return self._rows(names)
            places.update(zip(new, range(begin, end)))
            self._add(begin)
            found = [places[name] if row is None else row for name, row in zip(names, found)]
        at = np.array(found, np.int64)
        if not again:
            self.uses[at] += 1
            self.before, self.recent = self.recent, dict(zip(names, found))
        return at

    def _add(self, begin: int) -> None:
        """Draw for the terms from this row on, which have places only."""
        end = len(self.places)
        new = list(islice(reversed(self.places), end - begin))
        self.names[begin:end] = list(map(xxhash.xxh64_intdigest, reversed(new)))
        self.uses[begin:end] = 0
        for some in range(begin, end, DRAWN):
            self._fill(some, min(some + DRAWN, end))

    def _forget(self) -> None:
        """Leave the half of the table that was used most."""
        names, size = list(self.places), self.kept // 2
        left = np.sort(np.argsort(-self.uses[: len(names)], kind="stable")[:size])
        for table in (self.rate, self.shift, self.start, self.names):
            table[: len(left)] = table[left]
        self.uses[: len(left)] = self.uses[left] // 2
        self.places = _Places({names[row]: i for i, row in enumerate(left.tolist())})
        self.recent, self.before = {}, {}

    def _fill(self, begin: int, end: int) -> None:
        """Draw the gamma numbers, as sums of exponential ones, and the uniform number of some rows."""
        bits = mixed(self.names[begin:end, None] ^ self.salts)
        parts = _EXPONENTIAL.take(bits.view(np.uint16).reshape(*bits.shape, 4), mode="clip")
        rate = parts[..., 0] + parts[..., 1]
        # in double precision, so that machines whose logarithms differ in the last place still round alike
        lead = np.log(parts[..., 2].astype(np.float64) + parts[..., 3])
        bits *= ODD[0]
        bits >>= U(40)
        shift = bits.astype(np.float32)
        shift *= np.float32(1 / (1 << 24))
        self.rate[begin:end], self.shift[begin:end] = rate, shift
        self.start[begin:end] = lead.astype(np.float32) - rate * (np.float32(1) - shift)

    def draw(self, weights: dict[bytes, int], again: bool = False) -> np.ndarray:
        """The samples in 16 bits each, never 0; all 0 if there are no terms. Of equal arrivals the first term in order counts.

        `again` tells that most terms are those of the two draws before; the samples are the same with and without it.
        """
        best = np.full(len(self.salts), np.inf, np.float32)
        chosen = np.zeros(len(self.salts), np.uint64)
        terms, step = list(weights), min(TERMS, self.kept // 2)
        if len(terms) > step:
            terms.sort()
        for at in range(0, len(terms), step):
            part = terms[at : at + step]
            counts = np.fromiter(map(weights.__getitem__, part), np.float64, len(part))
            earlier, some = self._first(self._rows(part, again), counts)
            sooner = earlier < best
            best[sooner], chosen[sooner] = earlier[sooner], some[sooner]
        return self._short(chosen) if terms else np.zeros(len(self.salts), np.uint16)

    def _first(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """When the first of some terms arrives, for each sample, and what it gives."""
        arrival = self.start.take(rows, axis=0, mode="clip")
        often = np.flatnonzero(counts > 1)
        if len(often):
            rate = self.rate.take(rows[often], axis=0, mode="clip")
            level = np.log(counts[often, None]).astype(np.float32) / rate
            level += self.shift.take(rows[often], axis=0, mode="clip")
            np.floor(level, out=level)
            rate *= level
            arrival[often] -= rate
        # the least arrivals and then their places, which takes a fraction of what places at once take
        earlier = arrival.min(axis=0)
        least = arrival == earlier
        holds = np.flatnonzero(least.any(axis=1))
        place, column = least[holds].nonzero()
        place = holds[place]
        if len(column) > len(self.salts):
            names = list(self.places)
            order = sorted(range(len(place)), key=lambda i: names[rows[place[i]]], reverse=True)
            place, column = place[order], column[order]
        first = np.empty(len(self.salts), np.int64)
        first[column] = place
        levels = np.zeros(len(self.salts), np.uint64)
        if len(often):
            place = np.minimum(np.searchsorted(often, first), len(often) - 1)
            has = np.flatnonzero(often[place] == first)
            levels[has] = level[place[has], has].astype(np.uint64)
        return earlier, mixed(self.names[rows[first]] + levels * ODD[0])

    @staticmethod
    def _short(chosen: np.ndarray) -> np.ndarray:
        return np.maximum(chosen >> U(48), U(1)).astype(np.uint16)

    def _of(self, rows: np.ndarray) -> np.ndarray:
        """The samples of a text's words, given by their rows."""
        if not len(rows):
            return np.zeros(len(self.salts), np.uint16)
        return self._short(self._first(*np.unique(rows, return_counts=True))[1])

    def signed(self, group: list[tuple[str, str, bytes, bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The samples of short texts, of their edits and of the next texts, as `sign` draws them of single words.

        An edit is given by the bytes of its two parts, which begin the text
        and the next one: all words but those at the cuts are known from there.
        """
        # the next text of one pair is mostly the text of the pair after it
        room = sum(_room("" if i and text is group[i - 1][1] else text, following) for i, (text, following, _, _) in enumerate(group))
        if len(self.places) + room > self.kept:
            self._forget()
        begin, row, read = len(self.places), self.places.__getitem__, []
        before = rows_before = None
        for text, following, head, tail in group:
            words = rows_before if text is before else self._words(text)
            after = self._words(following)
            before, rows_before = following, after
            left, right = head.lower().split(), tail.lower().split()
            cut = left[-1:] + right[:1]
            if len(cut) == 2 and not head[-1:].isspace() and not tail[:1].isspace():
                cut = [cut[0] + cut[1]]
            cut += right[1:][-1:]
            edited = np.concatenate([words[: max(0, len(left) - 1)], after[1 : max(1, len(right) - 1)], np.array(list(map(row, cut)), np.int64)])
            read.append((words, edited, after))
        self._add(begin)
        signs, before, sign_before = [], None, None
        for words, edited, after in read:
            sign = sign_before if words is before else self._of(words)
            before, sign_before = after, self._of(after)
            signs.append((sign, self._of(edited), sign_before))
            self.uses[after] += 1
        return signs

    def _words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def sign(self, text: str | None, words: int = WORDS, again: bool = False) -> np.ndarray:
        return self.draw(terms(text or "", words), again)


def written(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint", samples: int = SAMPLES, words: int = WORDS) -> DataFrame:
    """Add the fingerprint of the whole text: four hexadecimal digits per sample.

    Equal texts have equal fingerprints, and so have texts with the same words
    in another order. Null and empty texts, and those of white space, have only
    zeros. Texts of any length are taken whole, a megabyte at a time. Other
    columns pass through; one named like the new column gives way. An empty
    table stays empty.
    """
    def signed(texts: list) -> list[pa.Array]:
        sampler = Sampler(samples)
        return [pa.array([written(sampler.sign(x, words)) for x in texts], pa.string())]

    return adding(docs, text, [T.StructField(into, T.StringType())], signed)


def likeness(a: str | Column, b: str | Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints, an estimate of the generalised Jaccard similarity of their texts."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    piece = lambda c, i: F.substring(c, i * 4 + 1, F.lit(4))
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: piece(a, i) == piece(b, i))
    return F.size(same) / F.lit(samples)


#: What a document and the next one give.
_FIELDS = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
])


def _compared(pairs: Iterable[tuple], schema: pa.Schema, samples: int, words: int) -> Iterator[pa.RecordBatch]:
    """Rows of `along` for (key, text, next text), a few hundred at a time."""
    sampler = Sampler(samples)
    held, last, last_sign = [], None, None

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    # a quarter of the table is room for a group: after forgetting, half of it is free
    for group, short in _groups(pairs, sampler.kept // 4 if words == 1 else 0):
        cut = []
        for _, text, following in group:
            half = len(text) // 2
            cut.append([x.encode("utf-8", "surrogatepass") for x in (text[: len(text) - half], following[:half])])
        if short:
            signs = sampler.signed([(text, following, *parts) for (_, text, following), parts in zip(group, cut)])
        else:
            (_, text, following), = group
            # the next text of one row is the text of the row after it
            sign = last_sign if text is last else sampler.sign(text, words)
            last, last_sign = following, sampler.sign(following, words)
            half = len(text) // 2
            signs = [(sign, sampler.sign(text[: len(text) - half] + following[:half], words, again=True), last_sign)]
        for (key, text, _), parts, (sign, edited_sign, next_sign) in zip(group, cut, signs):
            digest = hashlib.sha256(b"".join(parts)).hexdigest()
            held.append((key, len(text), digest, written(sign), written(edited_sign),
                         float((sign == edited_sign).mean()), float((sign == next_sign).mean())))
        if len(held) >= 500:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _room(text: str, following: str) -> int:
    """Words of both texts at most, and those at the cuts of an edit."""
    return (len(text) + len(following)) // 2 + 6


def _groups(pairs: Iterable[tuple], most: int) -> Iterator[tuple[list[tuple], bool]]:
    """Runs of pairs of short texts with so many words at most, and pairs of others alone; and whether they are short."""
    group: list[tuple] = []
    total = 0
    for pair in pairs:
        room = _room(*pair[1:])
        short = room <= min(SHORT, most)
        if group and (not short or len(group) == GROUP or total + room > most):
            yield group, True
            group, total = [], 0
        if short:
            group.append(pair)
            total += room
        else:
            yield [pair], False
    if group:
        yield group, True


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def along(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES, words: int = WORDS) -> DataFrame:
    """Each document beside the next one by key, and beside an edit of it that ends with the start of the next.

    Gives the key, `n_chars`, `edited_sha256`, `fingerprint`,
    `edited_fingerprint`, and the likeness of the fingerprint to the edited
    text's and to the next document's. The edited text is the text with its
    last half (rounded down) replaced by as many first code points of the next
    text, or all of it. Null keys come first; of equal keys, texts follow each
    other by hash; the last document's next is the first one. Null texts count
    as empty; repeated rows stay. Other columns are left out. An empty table
    stays empty.

    Texts move once, into ranges of keys, which are walked in order with two
    texts in memory. A range's last document is left to a second, small step,
    which meets it with the first one of the next range.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    # a given number of ranges: both walks below see the same ones, through one exchange
    rows = rows.repartitionByRange(ranges, "key", "h").sortWithinPartitions("key", "h", "text")
    rows = rows.select("key", "text", F.spark_partition_id().alias("range"))
    kept = rows.schema["key"]
    schema = T.StructType([T.StructField(key, kept.dataType), *_FIELDS])
    arrow = to_arrow_schema(schema)

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple]:
            before = None
            for name, content, _ in _walked(batches):
                if before is not None:
                    yield (*before, content)
                before = name, content

        yield from _compared(pairs(), arrow, samples, words)

    edge_schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("last", T.BooleanType()), kept, rows.schema["text"]])
    edge_arrow = to_arrow_schema(edge_schema)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1).to_pylist()[0]
                last = batch.slice(batch.num_rows - 1).to_pylist()[0]
        if first:
            found = [(row["range"], row is last, row["key"], row["text"]) for row in (first, last)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), edge_arrow)], schema=edge_arrow)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _compared(_walked(batches), arrow, samples, words)

    ends = rows.mapInArrow(edges, edge_schema)
    firsts, lasts = ends.where("not last"), ends.where("last")
    # one row per range, without texts
    numbers = firsts.select("range")
    order = Window.orderBy("range")
    following = numbers.select(
        "range", F.coalesce(F.lead("range").over(order), F.first("range").over(order)).alias("after"))
    met = lasts.join(following, "range").join(firsts.select(F.col("range").alias("after"), F.col("text").alias("following")), "after")
    return rows.mapInArrow(inner, schema).unionByName(met.select("key", "text", "following").mapInArrow(outer, schema))
