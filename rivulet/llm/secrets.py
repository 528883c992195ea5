"""Secret scans: fixed patterns, and strings that pass a battery of randomness tests.

All of it is Spark SQL expressions. A text is split at a pattern's matches, so
running lengths of pieces and matches give every match's place.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import stored

# The patterns of the base scan with the least length of what they find, in the order of their kinds.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]
SECRET_LENGTH = 12

#: Runs of these characters that hold a digit and a letter are tested for randomness.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
#: Alphabets by inferred encoding, in the order in which they are tried.
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", string.digits + "abcdef"),
    "base32": (r"^[A-Z2-7]+$", string.ascii_uppercase + "234567"),
    "base64": (r"^", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"),
}
#: Share of false finds that is accepted, bins of the p-values, the share of them that counts as null, and least bits.
FALSE_SHARE, BINS, NULL_FROM, BITS = 0.05, 50, 0.5, 80
BANDS = 12


SPANS = "array<struct<start:int,end:int,found:string>>"


def _let(value: Column, then) -> Column:
    """`then` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _places(text: Column, pattern: str, group: int, least: int) -> Column:
    """(start, end, found) of the matches whose group has at least `least` characters."""
    step = f"struct<at:int,spans:{SPANS}>"
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), value.alias("value"))  # the last piece has no match behind it
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")).cast(step)

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["piece"]
        end = begin + F.length(x["whole"])
        spans = F.when(F.length(x["value"]) >= least, F.concat(acc["spans"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), x["whole"].alias("found"))))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans")).cast(step)

    return F.when(text.rlike(pattern), F.aggregate(found, zero, add, lambda acc: acc["spans"])).otherwise(F.array().cast(SPANS))


def _normal_tail(z: Column) -> Column:
    """Probability above z of the standard normal distribution, from 0 on up."""
    # The rational approximation 26.2.17 in Abramowitz and Stegun, error below 1e-7
    series = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]

    def poly(t: Column) -> Column:
        value = F.lit(series[-1])
        for factor in reversed(series[:-1]):
            value = F.lit(factor) + t * value
        return t * value

    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * _let(1 / (1 + 0.2316419 * z), poly)


def _cube_tail(root: Column, df: int) -> Column:
    """Probability above a chi-squared value, given the cube root of its share of the degrees, by the normal approximation."""
    z = (root - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return _let(z, lambda x: F.when(x >= 0, _normal_tail(x)).otherwise(1 - _normal_tail(-x)))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _let(F.abs(z), _normal_tail))


def _tested(found: Column, encoding: str) -> Column:
    """Combined p-value of uniformity, runs and serial correlation under the hypothesis of random characters."""
    alphabet = ENCODINGS[encoding][1]
    size, half, floor = len(alphabet), len(alphabet) / 2, F.lit(1e-12)
    token = F.lower(found) if encoding == "hex" else F.translate(found, "-_", "+/")
    characters = F.filter(F.split(token, ""), lambda c: c != "")
    values = F.transform(characters, lambda c: F.position(c, F.lit(alphabet)).cast("double") - 1)
    # bins of like characters: half a class of letters at a time where there are classes, else runs of the alphabet
    edges = [0, 13, 26, 39, 52, 64] if encoding == "base64" else [round(i * size / 8) for i in range(9)]

    def sums(v: Column) -> Column:
        n = F.size(v).cast("double")
        chi = sum(
            F.pow(F.size(F.filter(v, lambda x: (x >= low) & (x < high))) - n * ((high - low) / size), F.lit(2)) / (n * ((high - low) / size))
            for low, high in zip(edges, edges[1:])
        )
        ahead = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.struct(
            v.alias("v"), n.alias("n"), chi.alias("chi"), ahead.alias("ahead"),
            (F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n).alias("mean"),
            F.size(F.filter(v, lambda x: x >= half)).cast("double").alias("upper"),
        )

    def spread(s: Column) -> Column:
        expected = 2 * s["upper"] * (s["n"] - s["upper"]) / s["n"] + 1
        return F.struct(
            s["n"].alias("n"), s["chi"].alias("chi"), expected.alias("expected"),
            ((expected - 1) * (expected - 2) / (s["n"] - 1)).alias("variance"),
            (1 + F.size(F.filter(s["ahead"], lambda p: (p["a"] >= half) != (p["b"] >= half)))).alias("runs"),
            F.aggregate(s["v"], F.lit(0.0), lambda t, x: t + (x - s["mean"]) * (x - s["mean"])).alias("spread"),
            F.aggregate(s["ahead"], F.lit(0.0), lambda t, p: t + (p["a"] - s["mean"]) * (p["b"] - s["mean"])).alias("along"),
        )

    def fisher(s: Column) -> Column:
        uniform = F.greatest(_let(F.pow(s["chi"] / (len(edges) - 2), F.lit(1 / 3)), lambda c: _cube_tail(c, len(edges) - 2)), floor)
        # a string on one side of the middle, or of one character, has no runs or correlation to test: it is not random
        run = F.when(s["variance"] > 0, F.greatest(_let((s["runs"] - s["expected"]) / F.sqrt(s["variance"]), _two_sided), floor)).otherwise(floor)
        serial = F.when(s["spread"] > 0, F.greatest(_let(s["along"] / s["spread"] * F.sqrt(s["n"]), _two_sided), floor)).otherwise(floor)
        return -(F.log(uniform) + F.log(run) + F.log(serial))  # half of Fisher's statistic, six degrees of freedom

    half_statistic = _let(_let(_let(values, sums), spread), fisher)
    return _let(half_statistic, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _judged(span: Column) -> Column:
    """A candidate with its encoding, length band and bin of the p-value."""
    names = list(ENCODINGS)
    number, p = F.lit(len(names) - 1), _tested(span["found"], names[-1])
    for i in reversed(range(len(names) - 1)):
        fits = span["found"].rlike(ENCODINGS[names[i]][0])
        number, p = F.when(fits, F.lit(i)).otherwise(number), F.when(fits, _tested(span["found"], names[i])).otherwise(p)
    band = F.least(F.floor(2 * F.log2(F.length(span["found"]) / 20.0)), F.lit(BANDS)).cast("int")
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), (number * (BANDS + 1) + band).alias("stratum"),
        F.least(F.floor(p * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
    )


def _enough(found: Column) -> Column:
    """Characters for the least number of random bits."""
    bits = F.lit(6.0)
    for pattern, alphabet in (ENCODINGS["base32"], ENCODINGS["hex"]):
        bits = F.when(found.rlike(pattern), F.lit(math.log2(len(alphabet)))).otherwise(bits)
    return F.length(found) * bits >= BITS


def cutoffs(counts: list[tuple[int, int, int]], share: float = FALSE_SHARE) -> dict[int, int]:
    """The lowest bin that counts as random per stratum, from (stratum, bin, count).

    Random strings have uniform p-values, others pile up near zero. The upper
    bins tell how many random strings there are; what exceeds their expected
    number above a cut-off is false. The lowest cut-off whose false share is
    accepted is taken; strata without one have no entry. The lowest bin never
    counts as random.
    """
    by: dict[int, list[int]] = {}
    for stratum, bin_, n in counts:
        by.setdefault(stratum, [0] * BINS)[bin_] += n
    found = {}
    for stratum, bins in by.items():
        null = sum(bins[int(BINS * NULL_FROM) :]) / (1 - NULL_FROM)
        for cut in range(1, BINS):
            above = sum(bins[cut:])
            if above and above - null * (1 - cut / BINS) <= share * above:
                found[stratum] = cut
                break
    return found


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", share: float = FALSE_SHARE) -> DataFrame:
    """One row per document: `key`, `found` (array of start, end, kind), sorted by start and kind.

    Kinds are `assign`, `access` and `hex` of the base patterns, and `random`:
    runs of 20 or more encoded characters that overlap no base span and look
    random by uniformity, runs and serial correlation over their inferred
    encoding, at a false share controlled per encoding and band of lengths
    over all documents. Places are code points, ends exclusive. Null and empty
    texts give an empty array, repeated rows the same array each; other
    columns are not read; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def kind(number: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))

    base = F.array_sort(F.concat(
        F.transform(_places(whole, ASSIGN, 1, SECRET_LENGTH), kind(0)),
        F.transform(_places(whole, ACCESS, 0, 0), kind(1)),
        F.transform(_places(whole, HEX, 0, 0), kind(2)),
    ))
    candidates = F.transform(F.filter(_places(whole, CANDIDATE, 0, 0), lambda s: _enough(s["found"])), _judged)
    first = stored(docs.select(F.col(key).alias("key"), base.alias("base"), candidates.alias("candidates")))
    counts = first.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.bin").count()
    cuts = cutoffs([tuple(row) for row in counts.collect()], share)  # at most encodings x bands x bins rows
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]) if cuts else F.lit(None).cast("map<int,int>")
    random = F.filter("candidates", lambda c: (c["bin"] >= cut[c["stratum"]]) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    spans = F.array_sort(F.concat("base", F.transform(F.coalesce(random, F.array().cast(first.schema["candidates"].dataType)), kind(3))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return first.select(F.col("key").alias(key), F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), names[s["kind"]].alias("kind"))).alias("found"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
