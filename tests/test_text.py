"""Chunkers and text analysis on small cases."""

import math
import random

import pytest
from pyspark.sql import functions as F, types as T

from rivulet.functions.text import HELD, rows_of
from rivulet.operators import chunking as K, enrichment as N, language as L


def chunked(spark, text, **options):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return [(r.chunk, r.start_offset, r.end_offset) for r in K.chunk(df, **options).orderBy("chunk_index").collect()]


def texts(spark, text, **options):
    return [c[0] for c in chunked(spark, text, **options)]


def test_characters(spark):
    assert texts(spark, "QWERTYUIOPASDFGHJKL", size=8, overlap=2) == ["QWERTYUI", "UIOPASDF", "DFGHJKL", "L"]
    assert [c[1:] for c in chunked(spark, "zyxwvutsrqpon", size=8, overlap=0)] == [(0, 8), (8, 13)]
    assert texts(spark, "  a b　   ", size=100, overlap=0) == ["a b"]
    assert texts(spark, "ab\n😀cd", size=4, overlap=0) == ["ab\n😀", "cd"]


def test_words(spark):
    assert chunked(spark, "red fox saw nine tall elms", size=3, overlap=1, unit="words") == [
        ("red fox saw", 0, 11), ("saw nine tall", 8, 21), ("tall elms", 17, 26)]
    assert chunked(spark, " a\t\tb ", size=5, overlap=0, unit="words") == [("a b", 1, 5)]


def test_sentences(spark):
    text = "Rain fell. Nobody left home. Tea was made. Night came on."
    assert texts(spark, text, strategy="sentence", size=30, overlap=0) == ["Rain fell. Nobody left home.", "Tea was made. Night came on."]
    assert texts(spark, "Doors shut. then nothing more", strategy="sentence", size=100, overlap=0) == ["Doors shut. then nothing more"]
    assert texts(spark, "a...", strategy="sentence", size=1, overlap=0) == ["a.", ".", "."]
    assert texts(spark, "Ann went up. Bob went up. Cleo.", strategy="sentence", size=26, overlap=5) == [
        "Ann went up. Bob went up.", "Bob went up. Cleo."]


def test_paragraphs(spark):
    text = "Frogs croaked.\n\nOwls answered.\n\nFoxes kept still\n\nThen it rained."
    assert texts(spark, text, strategy="paragraph", size=50, overlap=25) == [
        "Frogs croaked.\n\nOwls answered.\n\nFoxes kept still", "Owls answered.\n\nFoxes kept still\n\nThen it rained."]
    assert texts(spark, "Oh\n\nNobody had seen it coming.", strategy="paragraph", size=100, overlap=0, min_size=10) == ["Nobody had seen it coming."]


def test_recursive(spark):
    words = "alpha bravo crane delta eagle fjord"
    assert texts(spark, words, strategy="recursive", size=20, overlap=0, compat=True) == ["alphabravocranedelta", "eaglefjord"]
    assert texts(spark, words, strategy="recursive", size=20, overlap=0) == ["alpha bravo crane", "delta eagle fjord"]
    assert texts(spark, "ab", strategy="recursive", size=10, overlap=0, min_size=5) == []
    assert all(len(t) <= 8 for t in texts(spark, "x" * 50 + "\n\n" + "y z" * 9, strategy="recursive", size=8, overlap=2))


@pytest.mark.parametrize("strategy", K.STRATEGIES)
@pytest.mark.parametrize("text", ["", None])
def test_nothing(spark, strategy, text):
    assert chunked(spark, text, strategy=strategy) == []


def test_empty_documents_pass_on_request(spark):
    assert texts(spark, "", skip_empty=False) == [""]


def test_bad_settings(spark):
    for options in ({"size": 0}, {"size": 5, "overlap": 5}, {"strategy": "other"}, {"overlap": -1}):
        with pytest.raises(ValueError):
            chunked(spark, "x", **options)


def test_windows_cover_the_text(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("ab .\n") for _ in range(500))
    for overlap in (0, 7):
        found = chunked(spark, text, size=40, overlap=overlap, trim=False)
        assert "".join(t[: 40 - overlap] for t, _, _ in found)[: len(text)] == text
        assert all(text[a:b] == t for t, a, b in found)
    kept = chunked(spark, text, strategy="recursive", size=40, overlap=0, trim=False)
    assert "".join(t for t, _, _ in kept) == text


def walked(pieces, size, overlap):
    """The packing rule, one piece at a time."""
    out, held = [], []
    for p in pieces:
        if held and sum(map(len, held)) + len(p) > size:
            out.append(held)
            keep = []
            if overlap and len(held) > 1:
                target = min(overlap, sum(map(len, held)))
                while sum(map(len, keep)) < target:
                    keep.insert(0, held[len(held) - len(keep) - 1])
            held = keep
        held = held + [p]
    return out + [held] if held else out


def test_packing_matches_a_walk():
    rng = random.Random(4)
    for _ in range(300):
        pieces = ["x" * rng.randint(1, 12) for _ in range(rng.randint(0, 15))]
        size, overlap = rng.randint(1, 25), rng.choice([0, 3, 9, 40])
        got = [pieces[a:b] for a, _, b in K._groups([len(p) for p in pieces], size, overlap, keep_single=False)]
        assert got == walked(pieces, size, overlap)


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_spans_of_personal_data(spark):
    text = "mail a.b@c.org, card 4111 1111 1111 1111, ip 10.0.0.1, call +1 (663) 555-6869 now"
    found = {r.type: text[r.begin : r.end] for r in L.pii_spans(docs(spark, text, "none")).collect()}
    assert found == {"EMAIL": "a.b@c.org", "CARD": "4111 1111 1111 1111", "IP_ADDRESS": "10.0.0.1", "PHONE": "+1 (663) 555-6869"}
    redacted = L.pii_redact(docs(spark, text)).first().redacted
    assert redacted == "mail [EMAIL], card [CARD], ip [IP_ADDRESS], call [PHONE] now"


def test_language_candidates(spark):
    rows = L.detect_language(docs(spark, "the cat and the dog", "der Hund und die Katze", "xyz", "que la luz de la casa")).orderBy("doc_id").collect()
    assert [r.languages[0].language if r.languages else None for r in rows] == ["en", "de", None, "es"]
    assert rows[0].languages[0].score == 1.0 and {c.language for c in rows[3].languages} == {"es", "fr"}


def test_sentiment_labels(spark):
    rows = L.sentiment(docs(spark, "good good day", "bad", "good bad", "plain")).orderBy("doc_id").collect()
    assert [r.sentiment for r in rows] == ["POSITIVE", "NEGATIVE", "MIXED", "NEUTRAL"]
    assert abs(sum((rows[0].positive, rows[0].negative, rows[0].neutral)) - 1) < 1e-9
    assert [r.sentiment for r in L.sentiment(docs(spark, "So good. So bad!"), by_sentence=True).orderBy("index").collect()] == ["POSITIVE", "NEGATIVE"]


def test_moderation_thresholds(spark):
    rows = L.moderate(docs(spark, "you idiot", "kill the lights " + "word " * 300, "fine")).orderBy("doc_id").collect()
    assert [(r.harassment_flag, r.violence_flag, r.flagged) for r in rows] == [(True, False, True), (False, False, False), (False, False, False)]


def test_embeddings_are_unit_length_and_alike_for_alike_texts(spark):
    rows = L.embed(docs(spark, "a b c", "c b a", "x"), 32).orderBy("doc_id").collect()
    assert rows[0].embedding == rows[1].embedding != rows[2].embedding
    assert abs(sum(x * x for x in rows[0].embedding) - 1) < 1e-9 and len(rows[0].embedding) == 32


def test_enrichment_errors_and_output(spark):
    def make():
        def fn(batch):
            if "bad" in batch:
                raise RuntimeError("cannot")
            return [{"n": len(t)} for t in batch]

        return fn

    rows = [("t", 0, i, '{"text":"%s","keep":1}' % t) for i, t in enumerate(["abc", "bad", "x"])] + [("t", 0, 3, "plain")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string").coalesce(1)
    got = N.enrich(df, make, "text", retries=1, backoff=0).orderBy("offset").collect()
    assert [r.error for r in got] == [None, "RuntimeError: cannot", None, None]
    assert got[0].value == '{"text":"abc","keep":1,"enrichment":{"n":3},"_metadata":{"topic":"t","partition":0,"offset":0,"mode":"enrich"}}'
    assert '"value":"plain"' in got[3].value and '"n":5' in got[3].value
    alone = N.enrich(df.where("offset = 0"), make, "text", output="separate").first().value
    assert alone.startswith('{"enrichment":{"n":3}')
    assert N.enrich(df, make, "text", retries=0, backoff=0).where(F.col("error").isNull()).count() == 3


def test_summaries_take_the_heaviest_sentences(spark):
    rows = docs(spark, "Rare zebra words. Common line here!  Common line here? 12 34.", "Common line here.", "", None)
    found = [tuple(r) for r in L.summarize(rows, 2).orderBy("doc_id", "rank").collect()]
    first = rows.first().doc_id
    mine = [f for f in found if f[0] == first]
    assert [(i, s, k, b, e) for _, i, s, _, k, b, e in mine] == [(0, "Rare zebra words.", 1, 0, 17), (1, "Common line here!", 2, 18, 35)]
    assert mine[0][3] == pytest.approx(math.log(4)) and mine[1][3] == pytest.approx(2 * math.log(2))
    assert len(found) == 3


def test_summaries_of_short_words(spark):
    rows = docs(spark, "Rare zebra words.", "Up we go. He is in it! 12.", "你好。 大家")
    found = {}
    for r in L.summarize(rows, 2).collect():
        found.setdefault(r.doc_id, []).append((r["rank"], r.sentence, r.score, r["index"]))
    ids = [r.doc_id for r in rows.orderBy("doc_id").collect()]
    assert sorted(found[ids[1]]) == [(1, "Up we go.", 0.0, 0), (2, "He is in it!", 0.0, 1)]
    assert sorted(found[ids[2]]) == [(1, "你好。 大家", 0.0, 0)]


def test_scores_in_tiles_find_the_same(spark, monkeypatch):
    import numpy as np

    from rivulet.operators import vectors as V

    rng = np.random.default_rng(5)
    queries, entries = rng.normal(size=(23, 4)), rng.normal(size=(40, 4))
    ids = np.arange(40)

    def found():
        best = V._Best(range(23), list(queries), 3, 0.0, "cosine")
        best.add(ids, [*entries[:30], *[np.ones(3)] * 10])
        return best.rows().values.tolist()

    whole = found()
    monkeypatch.setattr(V, "SCORES", 100)
    assert found() == whole


def test_finds_are_held_a_few_at_a_time(spark):
    class Counted(tuple):
        alive = 0

        def __new__(cls, values):
            cls.alive += 1
            return super().__new__(cls, values)

        def __del__(self):
            type(self).alive -= 1

    def find(text):
        for i in range(int(text)):
            yield Counted((Counted.alive, str(i)))

    fields = T.StructType([T.StructField("alive", T.IntegerType()), T.StructField("text", T.StringType())])
    # one batch, with rows of many finds, of none and of a few; one column passes through
    texts = ["1000"] * 300 + ["100000", "", None, "0", "3"]
    rows = spark.createDataFrame([(i, t, {"k": t}) for i, t in enumerate(texts)], "id int, text string, own map<string,string>").coalesce(1)
    found = rows_of(rows, ["id", "own"], F.col("text"), find, fields, "found").select(
        "id", "own", F.size("found").alias("n"), F.array_max("found.alive").alias("most"),
        (F.col("found.text") == F.transform(F.sequence(F.lit(0), F.size("found") - 1), lambda i: i.cast("string"))).alias("right")).collect()
    assert [(r.id, r.own["k"], r.n) for r in sorted(found)] == [(i, t, int(t or 0)) for i, t in enumerate(texts)]
    assert all(r.right for r in found if r.n) and max(r.most or 0 for r in found) < 3 * HELD


# column functions hand a whole batch to Python and back, however much is found in it
STEPS = {
    "summaries": lambda d: L.summarize(d, id_col="id"),
    "term_frequencies": lambda d: L.term_frequencies(d, "id"),
    "chunk_recursive": lambda d: K.chunk(d, strategy="recursive", size=500, overlap=50, compat=True),
    "chunk_sentences": lambda d: K.chunk(d, strategy="sentence", size=500, overlap=0),
    "tokens": lambda d: L.tokenize(d),
}


@pytest.mark.parametrize("step", STEPS)
def test_finds_come_in_batches_of_bounded_size(spark, step):
    rows = spark.createDataFrame([(1, "One two. Three four!")], "id int, text string")
    plan = STEPS[step](rows)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
