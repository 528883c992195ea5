"""Local text analysis: tokens, sentences, personal data, language, sentiment, phrases, summaries, moderation, vectors."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from rivulet.functions.text import WHITESPACE, counted, rows_of, words
from rivulet.operators.ordered import top_per_group
from rivulet.records import unnest
from rivulet.session import settle

SPAN = T.StructType([T.StructField("text", T.StringType()), T.StructField("begin", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
FIND = T.StructType([T.StructField("type", T.StringType()), T.StructField("begin", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
_SPACES = re.escape(WHITESPACE)


#: A sentence with its end mark, or the rest of the text; a run of letters.
SENTENCE = "[^.!?]*[.!?]|[^.!?]+"
LETTERS = r"[^\W\d_]+"


def _trimmed(pattern: str, text: str) -> Iterator[tuple[str, int, int]]:
    """Matches without white space at their ends, where anything is left, and where they lie."""
    for m in re.finditer(pattern, text):
        own = m.group().strip(WHITESPACE)
        if own:
            begin = m.start() + m.group().index(own)
            yield own, begin, begin + len(own)


def _whole(pattern: str, text: str) -> Iterator[tuple[str, int, int]]:
    return ((m.group(), *m.span()) for m in re.finditer(pattern, text))


def _exploded(df: DataFrame, text_col: str, pattern: str, name: str, trim: bool) -> DataFrame:
    kept = [c for c in df.columns if c != text_col]
    find = _trimmed if trim else _whole
    found = rows_of(df, kept, F.col(text_col), lambda text: find(pattern, text), SPAN, "__spans")
    out = unnest(found, kept, "__spans", "index", "__span")
    return out.select(*kept, "index", F.col("__span.text").alias(name), "__span.begin", "__span.end")


def tokenize(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per token: a run of letters, digits and underscores, or one other sign."""
    return _exploded(df, text_col, f"\\w+|[^\\w{_SPACES}]", "token", trim=False)


def sentences(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per sentence; `.`, `!` and `?` each end one."""
    return _exploded(df, text_col, SENTENCE, "sentence", trim=True)


# Personal data patterns, applied in this order (fixed values).
PII = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "SECRET": r"\b[0-9a-f]{32,64}\b",
    "IP_ADDRESS": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "CARD": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "PHONE": r"\+[0-9]{1,3} ?\(?[0-9]{3}\)?[ -]?[0-9]{3}[ -]?[0-9]{4}\b",
}


_MAY_HOLD_PII = "[0-9@]|[a-f]{32}"


def pii_redact(df: DataFrame, text_col: str = "text", types: Sequence[str] = tuple(PII), into: str = "redacted") -> DataFrame:
    """The text with each find replaced by its type in brackets."""
    text = F.col(text_col)
    for name in types:
        text = F.regexp_replace(text, PII[name], f"[{name}]")
    return df.withColumn(into, F.when(F.col(text_col).rlike(_MAY_HOLD_PII), text).otherwise(F.col(text_col)))


def pii_spans(df: DataFrame, text_col: str = "text", types: Sequence[str] = tuple(PII)) -> DataFrame:
    """One row per find: type, score, begin, end. A text claimed by one type is not offered to the next."""
    patterns = {name: PII[name] for name in types}

    def finds(text: str):
        out, rest = [], text
        for name, pattern in patterns.items():
            compiled = re.compile(pattern, re.ASCII)
            found = [m.span() for m in compiled.finditer(rest)]
            out += [(name, a, b) for a, b in found]
            if found:
                # same length, so later offsets stay true
                rest = compiled.sub(lambda m: "\0" * len(m.group()), rest)
        return sorted(out, key=lambda f: f[1])

    # texts without digits or @ hold none of these, and never reach Python
    kept = [c for c in df.columns if c != text_col]
    candidates = df.where(F.col(text_col).rlike(_MAY_HOLD_PII))
    out = unnest(rows_of(candidates, kept, F.col(text_col), finds, FIND, "__spans"), kept, "__spans", "__at", "__span")
    return out.select(*kept, "__span.type", F.lit(1.0).alias("score"), "__span.begin", "__span.end")


# The most common function words of each language (fixed values).
STOP_WORDS = {
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "ist", "nicht", "dem", "ein", "eine", "als"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "by", "as", "this", "are"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "del", "las", "por", "un", "con", "una", "su", "para", "es", "al"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur"],
}


def detect_language(df: DataFrame, text_col: str = "text", profiles: Mapping[str, Sequence[str]] = STOP_WORDS,
                    into: str = "languages") -> DataFrame:
    """Candidate languages with scores, best first: the share of a language among all stop words found.

    Counting is a map over the document's own words; nothing is exchanged.
    """
    staged = df.withColumn("__words", words(F.col(text_col)))
    staged = staged.withColumns({f"__{code}": counted(F.col("__words"), list(profile)) for code, profile in profiles.items()})
    total = sum((F.col(f"__{code}") for code in profiles), F.lit(0))
    scored = [F.struct((-F.col(f"__{code}") / total).alias("order"), F.lit(code).alias("language")) for code in sorted(profiles)]
    ranked = F.transform(
        F.array_sort(F.filter(F.array(*scored), lambda s: s["order"] < 0)),
        lambda s: F.struct(s["language"].alias("language"), (-s["order"]).alias("score")),
    )
    found = F.when(total > 0, ranked).otherwise(F.array().cast("array<struct<language:string,score:double>>"))
    return staged.withColumn(into, found).drop("__words", *[f"__{code}" for code in profiles])


# A small default lexicon (fixed values); jobs pass their own.
LEXICON = {
    "good": 1, "great": 1, "excellent": 1, "happy": 1, "love": 1, "best": 1, "nice": 1, "wonderful": 1,
    "bad": -1, "poor": -1, "terrible": -1, "sad": -1, "hate": -1, "worst": -1, "awful": -1, "horrible": -1,
}


def sentiment(df: DataFrame, lexicon: Mapping[str, int] = LEXICON, text_col: str = "text", by_sentence: bool = False) -> DataFrame:
    """Label and scores from the positive and negative words of each document, or of each sentence."""
    rows = sentences(df, text_col) if by_sentence else df
    source = "sentence" if by_sentence else text_col
    tokens = F.col("__words")
    staged = rows.withColumn("__words", words(F.col(source))).withColumns({
        "__good": counted(tokens, [w for w, v in lexicon.items() if v > 0]),
        "__bad": counted(tokens, [w for w, v in lexicon.items() if v < 0]),
        "__all": F.size(tokens),
    })
    good, bad, total = F.col("__good"), F.col("__bad"), F.greatest(F.col("__all"), F.lit(1))
    label = (
        F.when((good == 0) & (bad == 0), "NEUTRAL").when((good > 0) & (bad > 0) & (F.abs(good - bad) * 4 <= good + bad), "MIXED")
        .when(good >= bad, "POSITIVE").otherwise("NEGATIVE")
    )
    return staged.withColumns({
        "sentiment": label, "positive": good / total, "negative": bad / total, "neutral": (total - good - bad) / total,
    }).drop("__words", "__good", "__bad", "__all")


TERM = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType()),
                     T.StructField("offset", T.IntegerType())])


def term_frequencies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 3) -> DataFrame:
    """(document, term, tf, offset of the first use). A document is one row, so its terms are
    counted where it is read and nothing is exchanged."""

    def count(text: str):
        found: dict[str, list[int]] = {}
        for m in re.finditer(LETTERS, text.lower()):
            if m.end() - m.start() >= min_length:
                found.setdefault(m.group(), [0, m.start()])[0] += 1
        return [(term, n, first) for term, (n, first) in found.items()]

    rows = unnest(rows_of(df, [id_col], F.col(text_col), count, TERM, "__terms"), [id_col], "__terms", "__at", "__term")
    return rows.select(id_col, "__term.*")


def inverse_frequencies(tf: DataFrame, documents: int) -> DataFrame:
    """(term, idf): the logarithm of documents over documents holding the term."""
    return tf.groupBy("term").agg(F.log(F.lit(documents) / F.count(F.lit(1))).alias("idf"))


def weighted(tf: DataFrame, documents: int) -> DataFrame:
    """Term frequencies with their TF-IDF `weight`.

    Rows made from documents are estimated far below their real size, so the
    join is asked to exchange and sort both sides and never to broadcast one.
    """
    joined = tf.join(inverse_frequencies(tf, documents).hint("merge"), "term")
    return joined.withColumn("weight", F.col("tf") * F.col("idf"))


def key_phrases(df: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The `n` terms of each document with the highest TF-IDF, ties by term, with their first offset."""
    tf = settle(term_frequencies(df, id_col, text_col))  # read twice, costly to make
    weighed = weighted(tf, df.count()).withColumn("score", F.round("weight", 12))
    best = top_per_group(weighed, [id_col], [F.desc("score"), F.asc("term")], n)
    return best.select(id_col, F.col("term").alias("phrase"), "score", "rank", "offset")


RANKED = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("sentence", T.StringType()),
                       T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()),
                       T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])


def summarize(df: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The `n` sentences of each document with the highest mean TF-IDF, ties by text order, with their rank.

    The weights of a document's terms are gathered into its row, which is no
    larger than its text, so sentences are cut and scored where they are.
    """
    tf = settle(term_frequencies(df, id_col, text_col))  # read twice, costly to make
    pairs = F.collect_list(F.struct("term", "weight"))
    weights = weighted(tf, df.count()).groupBy(id_col).agg(pairs.alias("__weights"))
    # sentences of documents without such terms score 0
    rows = df.select(id_col, text_col).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).join(weights, id_col, "left")

    def best(row: dict) -> list[tuple]:
        weight = dict(zip(row["terms"] or (), row["weights"] or ()))
        scored = []
        for index, (sentence, begin, end) in enumerate(_trimmed(SENTENCE, row["text"])):
            terms = re.findall(LETTERS, sentence.lower())
            if terms:
                score = round(math.fsum(weight.get(t, 0.0) for t in terms) / len(terms), 12)
                scored.append((-score, index, sentence, begin, end))
        chosen = heapq.nsmallest(n, scored)
        return [(index, sentence, -score, rank, begin, end) for rank, (score, index, sentence, begin, end) in enumerate(chosen, 1)]

    given = F.struct(F.col(text_col).alias("text"), F.col("__weights.term").alias("terms"), F.col("__weights.weight").alias("weights"))
    found = unnest(rows_of(rows, [id_col], given, best, RANKED, "__ranked"), [id_col], "__ranked", "__at", "__best")
    return found.select(id_col, "__best.*")


# Categories with the words that raise them and the share of words that flags (fixed values).
RULES = {
    "harassment": (["idiot", "moron", "clown", "loser", "stupid", "scum", "trash", "worthless"], 0.0),
    "violence": (["kill", "murder", "attack", "shoot", "stab"], 0.01),
}


def moderate(df: DataFrame, rules: Mapping[str, tuple[Sequence[str], float]] = RULES, text_col: str = "text") -> DataFrame:
    """Per category the share of its words (`score`) and a flag once it passes the threshold; `flagged` if any does."""
    staged = df.withColumn("__words", words(F.col(text_col)))
    total = F.greatest(F.size("__words"), F.lit(1))
    staged = staged.withColumns({f"{c}_score": counted(F.col("__words"), list(v)) / total for c, (v, _) in rules.items()})
    flags = {f"{c}_flag": F.col(f"{c}_score") > t for c, (_, t) in rules.items()}
    anywhere = F.lit(False)
    for c in rules:
        anywhere |= F.col(f"{c}_flag")
    return staged.withColumns(flags).withColumn("flagged", anywhere).drop("__words")


def embed(df: DataFrame, dim: int = 256, text_col: str = "text", into: str = "embedding") -> DataFrame:
    """Feature-hashed word counts at unit length; a map over documents."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    staged = df.withColumn("__words", words(F.col(text_col)))
    hashed = HashingTF(numFeatures=dim, inputCol="__words", outputCol="__tf").transform(staged)
    unit = Normalizer(p=2.0, inputCol="__tf", outputCol="__unit").transform(hashed)
    return unit.withColumn(into, vector_to_array(F.col("__unit"))).drop("__words", "__tf", "__unit")
