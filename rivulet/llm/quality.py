"""Quality classifier: weak labellers, their accuracies by EM, and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on each document. Their
accuracies and the share of good documents are estimated from how often each
combination of votes occurs in all documents, without any true label. The
posterior labels of a bounded sample train a linear scorer over hashed
features, which then scores every whole text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivulet.llm.common import adding, fresh, stored

#: Documents that train the scorer: those with the smallest hashes.
SAMPLE = 2000
FEATURES = 1 << 15
ACCEPT = 0.5
#: Weight of the character features' mean against the measures'.
SCALE = 10.0
SYMBOLS = "#*%&$|{}<>=~^\\_@+"

UNSEEN = 2
#: Letters of the votes -1, 0, 1 and UNSEEN in a combination.
SIGNS = "-0+ "
#: Labellers: measure, fewest words to vote on, good from and bad from. None: no vote on that side.
LABELLERS = [
    ("repeats", 5, None, 0.25),
    ("capitals", 5, None, 0.6),
    ("shouts", 5, None, 0.4),
    ("symbols", 5, None, 0.06),
    ("decorated", 5, None, 0.4),
    ("loose", 5, None, 0.2),
    ("distinct", 30, 0.4, 0.2),
    ("sentences", 20, 0.03, 0.01),
]


def measures(text: str | None) -> tuple[int, list[float]]:
    """Number of words, and one number per labeller."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return 0, [0.0] * len(LABELLERS)
    letters = sum(map(len, words))
    lower = text.lower()
    changed = 0 if lower == text else sum(a != b for a, b in zip(text, lower))
    return n, [
        sum(map(eq, words, words[1:])) / n,
        changed / letters,
        text.count("!") / n,
        sum(map(text.count, SYMBOLS)) / letters,
        sum(not (w.isalnum() or w[-2:].isalnum() or w[:-1].isalnum()) for w in words) / n,
        sum(len(w) < 3 and not w.isalnum() for w in words) / n,
        len(set(words)) / n,
        sum(w[-1] in ".?!" for w in words) / n,
    ]


def votes(n: int, measured: list[float]) -> list[int]:
    """1 for good, -1 for bad, 0 for neither, UNSEEN if the text is too short for the labeller to look at."""
    found = []
    for value, (_, fewest, good, bad) in zip(measured, LABELLERS):
        if n < fewest:
            found.append(UNSEEN)
        elif good is None:
            found.append(-1 if value >= bad else 0)
        else:
            found.append(1 if value >= good else -1 if value <= bad else 0)
    return found


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and rates [vote (neither, good, bad), labeller, class] of each vote, by EM.

    Voting neither counts as an outcome of its own, as most labellers know one
    kind of bad document only; what a labeller did not look at counts for
    nothing. The start calls a document bad that has any bad vote; each rate
    has one pseudo-vote. Without documents all rates are even.
    """
    if not counts.sum():
        return 0.5, np.full((3, len(LABELLERS), 2), 1 / 3)
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    outcomes = np.stack([patterns == 0, patterns == 1, patterns == -1]).astype(float)
    share = rates = None
    for _ in range(rounds):
        weight = np.stack([good, 1 - good], axis=1) * counts[:, None]
        share = (weight[:, 0].sum() + 1) / (counts.sum() + 2)
        cast = np.einsum("opl,pc->olc", outcomes, weight) + 1
        rates = cast / cast.sum(axis=0)
        after = posterior(patterns, share, rates)
        if np.abs(after - good).max() < 1e-9:
            break
        good = after
    return float(share), rates


def posterior(patterns: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """Probability of good for each row of votes."""
    seen = np.where(patterns == UNSEEN, 0, patterns)
    each = np.log(rates[seen, np.arange(patterns.shape[1])]) * (patterns != UNSEEN)[:, :, None]
    logs = np.log([share, 1 - share]) + each.sum(axis=1)
    return 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -700, 700)))


def _named(n: int, measured: list[float]) -> list[int]:
    """Hashed features of the measures: the vote on each, and its nearest tenth."""
    found = []
    for (name, *_), value, vote in zip(LABELLERS, measured, votes(n, measured)):
        found += [f"{name}:{vote}", f"{name}~{min(10, int(value * 10 + 0.5))}"]
    return [zlib.crc32(x.encode()) % FEATURES for x in found]


def _characters(text: str | None) -> np.ndarray:
    """Hashed features of every three neighbouring bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    return (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features."""
    n, measured = measures(text)
    chars = _characters(text)
    places, counts = np.unique(chars, return_counts=True)
    named = _named(n, measured) if n else []
    values = counts * (SCALE / max(1, len(chars)))
    return np.concatenate([places, np.array(named, dtype=np.uint32)]), np.concatenate([values, np.ones(len(named))])


def train(texts: list, targets: np.ndarray, rounds: int = 150, rate: float = 0.3, shrink: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias of a logistic scorer for soft labels, by full-batch adaptive gradient steps."""
    weights = np.zeros(FEATURES + 1)
    if not len(texts):
        return weights
    found = [features(t) for t in texts]
    rows = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
    places, values = np.concatenate([p for p, _ in found]), np.concatenate([v for _, v in found])
    seen = np.full(FEATURES + 1, 1e-8)
    for _ in range(rounds):
        score = np.bincount(rows, weights[places] * values, minlength=len(texts)) + weights[-1]
        error = (1 / (1 + np.exp(-score)) - targets) / len(texts)
        step = np.append(np.bincount(places, error[rows] * values, minlength=FEATURES), error.sum())
        step[:-1] += shrink * weights[:-1]
        seen += step * step
        weights -= rate * step / np.sqrt(seen)
    return weights


def score(text: str | None, weights: np.ndarray) -> float:
    """Probability of good by the linear scorer."""
    n, measured = measures(text)
    chars = _characters(text)
    total = weights[-1] + (SCALE * weights[chars].mean() if len(chars) else 0.0) + (weights[_named(n, measured)].sum() if n else 0.0)
    return float(1 / (1 + math.exp(-max(-700.0, min(700.0, total)))))


def _row(key: Column, text: Column) -> Column:
    return F.xxhash64(key, text)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """The scorer's weights. Votes of all documents are counted; `sample` bounds the texts that train the scorer.

    The sample is the documents with the smallest hashes of key and text;
    rows that repeat both count once in it. It is the only part that one task
    holds. What reaches the driver are the counts of vote combinations (at
    most 4 to the number of labellers) and the weights.
    """
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def vote(texts: list) -> list[pa.Array]:
        return [pa.array(["".join(SIGNS[v + 1] for v in votes(*measures(t))) for t in texts], pa.string())]

    voted = adding(plain, "text", [T.StructField("votes", T.StringType())], vote)
    counted = stored(voted.select(_row(F.col("key"), F.col("text")).alias("row"), "votes"))
    found = counted.groupBy("votes").count().collect()
    patterns = np.array([[SIGNS.index(c) - 1 for c in r["votes"]] for r in found], dtype=np.int64).reshape(-1, len(LABELLERS))
    share, rates = fit_labellers(patterns, np.array([r["count"] for r in found], dtype=np.float64))
    last = counted.select("row").distinct().orderBy("row").limit(sample).agg(F.max("row")).first()[0]
    if last is None:
        return train([], np.empty(0))
    chosen = plain.where(_row(F.col("key"), F.col("text")) <= last).dropDuplicates(["key", "text"]).select("text")

    def fitted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [t for frame in frames for t in frame["text"]]
        texts.sort(key=lambda t: (t is not None, t or ""))  # rows arrive in any order
        targets = posterior(np.array([votes(*measures(t)) for t in texts], dtype=np.int64).reshape(-1, len(LABELLERS)), share, rates)
        yield pd.DataFrame({"weights": [train(texts, targets)]})

    return np.array(chosen.repartition(1).mapInPandas(fitted, "weights array<double>").first()["weights"])


def classify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", column: str = "quality", accepted: str = "accepted", sample: int = SAMPLE
) -> DataFrame:
    """Add the probability that each document is good, and whether it is accepted (at least one half).

    Texts are scored whole. Null, empty and very short texts get no votes, so
    little speaks against them. Repeated rows get the same score. Other columns
    pass through; an empty table stays empty. Without any evidence all
    documents are accepted.
    """
    weights = fit(docs, key, text, sample)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of weights

    def scored(texts: list) -> list[pa.Array]:
        found = [score(t, shared.value) for t in texts]
        return [pa.array(found, pa.float64()), pa.array([x >= ACCEPT for x in found], pa.bool_())]

    return adding(docs, text, [T.StructField(column, T.DoubleType()), T.StructField(accepted, T.BooleanType())], scored)


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The accepted documents, with their own columns."""
    column, accepted = fresh(docs, "quality", "accepted")
    return classify(docs, key, text, column, accepted, sample).where(F.col(accepted)).select(*docs.columns)
