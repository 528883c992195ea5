"""Collocations: phrases whose words occur together more often than their parts let expect.

Counts of word runs are streams, one per number of words. Tasks count their
texts in sorted blocks, whose counts meet in an exchange. In prefix order (by
all words but the last) a stream runs in step with the stream of runs one word
shorter and takes over the counts of all its beginnings; in suffix order (by
all words but the first) it takes over the counts of its ends. Both orders
also give the highest count among a run's extensions. These are merge joins of
sorted streams; no hash table holds a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rivulet.llm.common import stored
from rivulet.llm.words import ODD, U, mixed, word_hashes
from rivulet.operators.ordered import latest_per_key, top_per_group

#: Bytes of text that a task counts at once.
BLOCK = 4 << 20
#: Frequent runs are marked in a table of two to the power of this many bits, whatever the corpus.
BITS = 27

# The characters that part pieces, and those that part words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
_EVEN = bytes(10 if b in BREAKS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))

_COUNTS = "lang string, words int, phrase string, f long"


def _parted(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in order, the number of each word in the text, and its piece."""
    letters = np.frombuffer(data, np.uint8)
    inside = (letters != 32) & (letters != 10)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    offsets = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]).dictionary_encode()
    order = pc.array_sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pieces = np.searchsorted(np.flatnonzero(letters == 10), starts)
    return words.dictionary.take(pa.array(order)), rank[words.indices.to_numpy()], pieces


def _counted(data: bytes, skip: int, first: int, last: int, lang: str, bits: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, runs in order, counts) of a block for runs of `first` to `last` words.

    Runs that end in the first `skip` words belong to the block before. With
    `bits`, runs of `last` words count only if the shorter ones at both of
    their ends are marked there.
    """
    words, codes, pieces = _parted(data)
    size, n = len(words), len(codes)
    if first == 0 and n > skip:
        yield 0, pa.array([b""], pa.large_binary()), np.array([n - skip])
    phrases, run = words, codes
    if bits is not None:
        letters = word_hashes(b" ".join(words.to_pylist()))
        hashes = mixed(np.full(size, _named(lang)) * ODD[0] + letters)
    for count in range(1, last + 1):
        if count == 1:
            at, here, found = np.arange(n), codes, np.arange(size)
        else:
            fits = (run[:-1] >= 0) & (run[1:] >= 0)
            if count == 2:
                fits &= pieces[:-1] == pieces[1:]
            at = np.flatnonzero(fits)
            found, here = np.unique(run[at] * size + codes[at + count - 1], return_inverse=True)
            before, after = pa.array(found // size), pa.array(found % size)
            phrases = pc.binary_join_element_wise(phrases.take(before), words.take(after), pa.scalar(b" ", pa.large_binary()))
        if count >= first:
            totals = np.bincount(here, minlength=len(found)) - np.bincount(here[at < skip - count + 1], minlength=len(found))
            some = np.flatnonzero(totals)
            yield count, phrases.take(pa.array(some)), totals[some]
        run = np.full(max(0, n - count + 1), -1)
        run[at] = here
        if bits is not None and count < last:
            if count > 1:
                hashes = mixed(hashes[found // size] * ODD[0] + letters[found % size])
            if count == last - 1:
                marked = _marked(bits, hashes)
                run[at[~marked[here]]] = -1


def _named(lang: str) -> np.uint64:
    return U(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - BITS)).astype(np.int64)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = _places(hashes)
    return (bits[places >> 6] >> (places & 63).astype(np.uint64)) & U(1) == 1


def _blocks(text: bytes, most: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """A text in blocks, and how many words at the start of each were the last ones of the block before.

    Blocks end between pieces; a piece that is longer than a block is cut
    between words, and its next block repeats `overlap` of them.
    """
    begin, carried = 0, []
    while begin < len(text):
        end, limit = len(text), begin + most
        if limit < len(text):
            end = text.rfind(b"\n", begin + 1, limit)
            if end < 0:
                end = text.rfind(b" ", begin + 1, limit)
            if end < 0:  # a word longer than a block
                end = min((at for at in (text.find(b"\n", limit), text.find(b" ", limit)) if at >= 0), default=len(text))
        block = b" ".join([*carried, text[begin:end]])
        yield block, len(carried)
        carried = []
        if overlap and text[end : end + 1] == b" ":
            carried = block[block.rfind(b"\n") + 1 :].rsplit(None, overlap)[-overlap:]
        begin = end


def _block_counts(docs: DataFrame, first: int, last: int, least: int, bits=None, most: int = BLOCK) -> DataFrame:
    """`lang`, `words`, `phrase`, `f` of the runs of `first` to `last` words that occur `least` times."""
    schema = docs.sparkSession.createDataFrame([], _COUNTS).schema
    arrow = to_arrow_schema(schema)

    def rows(lang: str, data: bytes, skip: int) -> Iterator[pa.RecordBatch]:
        for words, phrases, totals in _counted(data, skip, first, last, lang, bits.value if bits is not None else None):
            for at in range(0, len(phrases), 100_000):
                part = phrases.slice(at, 100_000)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(lang, arrow.field("lang").type), len(part)), pa.repeat(pa.scalar(words, pa.int32()), len(part)),
                    part.cast(pa.binary()).cast(arrow.field("phrase").type), pa.array(totals[at : at + 100_000], pa.int64()),
                ], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = text.translate(_EVEN)
                if len(text) > most:
                    for data, skip in _blocks(text, most, last - 1):
                        yield from rows(lang, data, skip)
                    continue
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= most:
                    for name, texts in held.items():
                        yield from rows(name, b"\n".join(texts), 0)
                    held, size = {}, 0
        for name, texts in held.items():
            yield from rows(name, b"\n".join(texts), 0)

    counts = docs.mapInArrow(run, schema).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return counts.where((F.col("f") >= least) | (F.col("words") == 0))


def _bits(frequent: DataFrame, words: int):
    """A broadcast table of the bits of all runs of so many words; its size does not depend on them."""
    schema = "cell long, bits long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column(0), batch.column(1)
            if not len(phrases):
                continue
            letters = word_hashes("\n".join(phrases.to_pylist()).encode("utf-8", "surrogatepass")).reshape(-1, words)
            hashes = np.array([_named(x) for x in langs.to_pylist()], np.uint64)
            for i in range(words):
                hashes = mixed(hashes * ODD[0] + letters[:, i])
            places = _places(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places >> 6), pa.array((U(1) << (places & 63).astype(np.uint64)).view(np.int64))], names=["cell", "bits"])

    cells = frequent.where(F.col("words") == words).select("lang", "phrase").mapInArrow(run, schema).groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    found = cells.toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(table)


def run_counts(docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 3, least: int = 10) -> list[DataFrame]:
    """The streams: `lang`, `phrase`, `f` of runs of 0 (all words of the language), 1, 2 .. `most_words` words.

    Runs of one word and more are those that occur `least` times. A run is as
    frequent as its parts at most, so runs of three words and more are counted
    only where the shorter runs at both ends may be frequent.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text <> ''")
    counted = stored(_block_counts(rows, 0, min(2, most_words), least))
    frames = {words: counted for words in range(3)}
    for words in range(3, most_words + 1):
        frames[words] = stored(_block_counts(rows, words, words, least, _bits(frames[words - 1], words - 1)))
    return [frames[words].where(F.col("words") == words).select("lang", "phrase", "f") for words in range(most_words + 1)]


def _head(words: int) -> Column:
    return F.substring_index("phrase", " ", words - 1)


def _tail() -> Column:
    return F.expr("substr(phrase, instr(phrase, ' ') + 1)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 3, least: int = 10, share: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's best phrases: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    Words are parted by blanks and tabs within pieces, pieces by punctuation
    and line breaks; A-Z count as a-z. `n` is the number of words of the
    language (null: `und`), `a` the phrase's occurrences, at least `least`,
    overlaps included. Cut in two, a phrase scores a million times a * a / (l * r)
    with the occurrences of its parts; the cut with the lowest score counts, of
    equal ones the first. A phrase within a phrase one word longer that has at
    least `share` percent of its occurrences is left out. Ranks go by score, `a`
    and phrase, so they have no ties.

    Null and empty texts hold no words; repeated rows count as often as they
    occur; other columns are not read; an empty table gives an empty one. Texts
    of any length are counted whole, a few megabytes at a time. Counts are
    whole numbers below 10^15, and scores are computed with 38 digits.
    """
    streams = run_counts(docs, text, lang, most_words, least)
    total = streams[0].select("lang", F.col("f").alias("n"))
    with_parts = streams[1].select("lang", "phrase", F.array("f").alias("begins"), F.array("f").alias("ends"))
    found = None
    for words in range(2, most_words + 1):
        runs = streams[words].select("lang", "phrase", F.col("f").alias("a"), _head(words).alias("head"), _tail().alias("tail"))
        begins = with_parts.select("lang", F.col("phrase").alias("head"), "begins").hint("merge")
        ends = with_parts.select("lang", F.col("phrase").alias("tail"), "ends").hint("merge")
        joined = runs.join(begins, ["lang", "head"]).join(ends, ["lang", "tail"])
        with_parts = stored(joined.select(
            "lang", "phrase", "a", F.concat("begins", F.array("a")).alias("begins"), F.concat("ends", F.array("a")).alias("ends")))
        candidates = with_parts
        if words < most_words:
            longer = streams[words + 1].select("lang", "f", _head(words + 1).alias("head"), _tail().alias("tail"))
            for side in ("head", "tail"):
                best = latest_per_key(longer.select("lang", F.col(side).alias("phrase"), F.col("f").alias(side)), ["lang", "phrase"], [F.desc(side)])
                candidates = candidates.join(best.hint("merge"), ["lang", "phrase"], "left")
            most = F.coalesce(F.greatest("head", "tail"), F.lit(0))
            candidates = candidates.where(100 * most < share * F.col("a"))
        wide = lambda c: c.cast("decimal(15,0)")
        cuts = F.array(*[_cut(wide, k, words) for k in range(1, words)])
        scored = candidates.select("lang", "phrase", "a", F.array_min(cuts).alias("cut"))
        found = scored if found is None else found.unionByName(scored)
    ranked = top_per_group(
        found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _cut(wide, k: int, words: int) -> Column:
    """Score, place and part counts of the cut after `k` words."""
    a, l, r = F.col("a"), F.col("begins")[k - 1], F.col("ends")[words - k - 1]  # noqa: E741
    above, below = wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(l) * wide(r)
    return F.struct(F.call_function("div", above, below).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
