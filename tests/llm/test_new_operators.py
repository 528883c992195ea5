"""Fill-in-the-middle, fingerprints and collocations against brute force on small tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import collocations, infill, kdtree, licences, line_dedup, weighted

ODD = [None, "", " ", "a", "é", "日本語 テキスト 😀", "a<P>b", "x <S> y", "tail <", "<P", ">S<", "one two\nthree\tfour  five", "\n\n", "a" * 5000]


def documents(spark, texts, **more):
    rows = [(i, t, *[v for v in more.values()]) for i, t in enumerate(texts)]
    names = ", ".join(f"{c} string" for c in more)
    return spark.createDataFrame(rows, "doc_id long, text string" + (", " + names if names else ""))


def plain_cut(key, text):
    """The cuts by the letter of the contract."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= 90:
        return n, "plain", None, None, text
    parts = text[:a], text[a:b], text[b:]
    if four % 100 < 20:
        return n, "spm", a, b - a, f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return n, "psm", a, b - a, f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"


def test_cuts_and_restored_texts(spark):
    rng = random.Random(3)
    shared = ["".join(rng.choice("abc é漢😀\n") for _ in range(rng.choice([300, 2000, 9000]))) for _ in range(5)]
    texts = ODD + ["".join(rng.sample(shared, 3)) for _ in range(40)] + ["x" * 40_000, " " * 3000]
    texts += texts[:5]  # repeated texts under other ids
    got = infill.transform(documents(spark, texts, n="taken", output="taken")).withColumn("back", infill.restored())
    assert got.columns[:2] == ["doc_id", "text"] and [c for c in got.columns if c.lower() == "n"] == ["n"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == plain_cut(i, text), i
        assert r.back == (text or "")
    assert {r.form for r in rows.values()} == {"plain", "psm", "spm"}


def test_cuts_of_null_keys_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "some text here")] * 2, "doc_id long, text string")
    got = infill.transform(rows).collect()
    assert [(r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in got] == [plain_cut(None, "some text here")] * 2
    empty = infill.transform(rows.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n", "form", "prefix_units", "middle_units", "output"]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_units_of_chunks_add_up(unit):
    rng = random.Random(5)
    chunks = infill.Chunks(unit, most=20_000)  # forgets often
    spaces = set(b" \t\n")
    for _ in range(150):
        data = "".join(rng.choice("abé漢 \n\t😀") for _ in range(rng.choice([1, 5, 300, 3000, 12_000]))).encode()
        begins = [i for i in range(len(data)) if i == 0 or {
            "char": data[i] & 0xC0 != 0x80, "line": data[i - 1] == 10, "word": data[i - 1] in spaces and data[i] not in spaces}[unit]]
        text = infill.Text(data, chunks)
        assert text.n == len(begins)
        for units in {0, len(begins), *(rng.randint(0, len(begins)) for _ in range(6))}:
            assert text.place(units) == ([*begins, len(data)][units])


def test_chunks_follow_content():
    rng = random.Random(6)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(30_000))
    ends = [set(infill.chunk_ends(bytes(rng.choice(b"xyz ") for _ in range(n)) + passage)) for n in (0, 700, 5000)]
    cuts = [{e - n for e in found if e > n} for found, n in zip(ends, (0, 700, 5000))]
    assert len(cuts[0] & cuts[1] & cuts[2]) > 0.8 * len(cuts[0])
    for data in (b"", b"a", passage, b"a" * 100_000):
        found = infill.chunk_ends(data)
        assert found[-1] == len(data) and all(b - a <= infill.MOST for a, b in zip([0, *found], found))


def bag(text, words=1):
    found = re.findall(r"[^ \t-\r]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return collections.Counter(zip(*[found[i:] for i in range(words)]))


def jaccard(a, b):
    least = sum(min(a[x], b[x]) for x in a)
    most = sum(a.values()) + sum(b.values()) - least
    return least / most if most else 1.0


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", f"w{rng.randint(0, 150)}", f"W{rng.randint(0, 150)}"]) for _ in range(n))


@pytest.mark.parametrize("words", [1, 3])
def test_terms_are_the_words_with_their_counts(words, monkeypatch):
    rng = random.Random(7)
    text = prose(rng, 3000) + "\n\t x" + "y" * 300
    whole = weighted.terms(text, words)
    assert {tuple(k.decode().split(" ")): n for k, n in whole.items()} == bag(text, words)
    monkeypatch.setattr(weighted, "BLOCK", 97)
    assert weighted.terms(text, words) == whole


def test_samples_estimate_generalised_jaccard():
    rng = random.Random(8)
    sampler = weighted.Sampler(1024, kept=3000)
    errors = []
    for _ in range(25):
        a, b = prose(rng, 400), prose(rng, 300)
        b = a[: rng.randint(0, len(a))] + " " + b
        true = jaccard(bag(a), bag(b))
        errors.append(float((sampler.sign(a) == sampler.sign(b)).mean()) - true)
    assert abs(np.mean(errors)) < 0.015 and np.sqrt(np.mean(np.square(errors))) < 0.03


def test_samples_do_not_depend_on_what_is_remembered():
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(1, 500)) for _ in range(40)]
    roomy, tight = weighted.Sampler(64), weighted.Sampler(64, kept=40)
    assert all((roomy.sign(t) == tight.sign(t)).all() for t in texts * 2)


def test_fingerprint_column(spark):
    texts = [*ODD, "The cat  sat", "sat the\nCAT", "The cat sat"]
    rows = weighted.fingerprint(documents(spark, texts, Fingerprint="taken"), samples=16).collect()
    by = {i: r.fingerprint for i, r in enumerate(sorted(rows, key=lambda r: r.doc_id))}
    assert by[0] == by[1] == by[2] == by[12] == "0" * 64 and len(set(by.values())) == len(texts) - 3 - 2
    n = len(texts)
    assert by[n - 1] == by[n - 2] == by[n - 3]
    two = spark.createDataFrame([(by[n - 1], by[n - 2], by[0])], "a string, b string, c string")
    assert two.select(weighted.likeness("a", "b", 16), weighted.likeness("a", "c", 16)).first()[:] == (1.0, 0.0)
    assert weighted.fingerprint(documents(spark, texts).limit(0)).count() == 0


def along_by_hand(rows):
    sampler = weighted.Sampler()
    found = {}
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = sampler.sign(text), sampler.sign(edited), sampler.sign(after)
        found[key] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), weighted.written(a), weighted.written(b),
                      float((a == b).mean()), float((a == c).mean()))
    return found


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_documents_along_their_keys(spark, ranges):
    rng = random.Random(10)
    texts = [*ODD, *[prose(rng, rng.randint(0, 60)) for _ in range(30)]]
    rows = [(i * 7 % 97 - 5, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, fingerprint string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        along = weighted.along(frame)
        got = {r.doc_id: tuple(r)[1:] for r in along.collect()}
        plan = along._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == along_by_hand(sorted((k, t or "") for k, t in rows))
    assert ranges == 1 or "ReusedExchange" in plan  # the texts move once


def test_along_on_odd_tables(spark):
    one = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    r = weighted.along(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest()
    assert weighted.along(one.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "x y"), (1, None), (1, None), (1, "z")], "doc_id long, text string")
    rows = weighted.along(twice).collect()
    assert sorted((r.doc_id is not None, r.n_chars) for r in rows) == [(False, 3), (True, 0), (True, 0), (True, 1)]


def phrases_by_hand(rows, most_words, least, share, top):
    counts = collections.defaultdict(lambda: [collections.Counter() for _ in range(most_words + 1)])
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = [w for w in re.split("[ \t]+", piece) if w]
            c = counts[lang if lang is not None else "und"]
            c[0][()] += len(words)
            for n in range(1, most_words + 1):
                c[n].update(zip(*[words[i:] for i in range(n)]))
    found = []
    for lang, c in counts.items():
        ranked = []
        for n in range(2, most_words + 1):
            for p, a in c[n].items():
                if a < least:
                    continue
                longer = [b for m in range(n + 1, most_words + 1) for q, b in c[m].items()
                          if b >= least and any(q[i : i + n] == p for i in range(m - n + 1))]
                if any(100 * b >= share * a for b in longer):
                    continue
                cuts = [(1_000_000 * a * a // (c[k][p[:k]] * c[n - k][p[k:]]), k, c[k][p[:k]], c[n - k][p[k:]]) for k in range(1, n)]
                score, _, left, right = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, i, phrase.decode(), -a, left, right, c[0][()], -score))
    return sorted(found)


def talk(rng, n):
    words = ["a", "b", "New", "york", "city", "é", "\x01", "c\x02", "日", "x y"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", "!"]) for _ in range(n))


@pytest.mark.parametrize("most_words, block", [(3, 1 << 20), (3, 60), (2, 200), (4, 90)])
def test_phrases_by_language(spark, monkeypatch, most_words, block):
    rng = random.Random(11)
    rows = [(talk(rng, rng.randint(0, 80)), rng.choice(["en", "de", None, "und", ""])) for _ in range(60)]
    rows += [("new york city " * 200, "en"), ("b" * 500 + " c " * 300, "de"), (None, "en"), ("", "fr"), ("the end " * 9, "fr")] + rows[:6]
    frame = spark.createDataFrame([(t, g, 1, 2) for t, g in rows], "text string, lang string, phrase int, n int")
    counted = collocations._block_counts
    monkeypatch.setattr(collocations, "_block_counts", lambda *a: counted(*a, most=block))
    got = collocations.collocations(frame, most_words=most_words, least=5, share=50, top=40).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(rows, most_words, 5, 50, 40)


def test_phrases_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, None), ("", "en"), (" . ", "en"), ("one", "en")], "text string, lang string")
    got = collocations.collocations(frame)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0
    assert collocations.collocations(frame.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    frame = spark.createDataFrame([(big, [big + 5], [big + 7])], "a long, begins array<long>, ends array<long>")
    r = frame.select(collocations._cut(lambda c: c.cast("decimal(15,0)"), 1, 2).alias("cut")).first().cut
    assert r.score == 1_000_000 * big * big // ((big + 5) * (big + 7)) and (r.l, r.r) == (big + 5, big + 7)


def test_least_counts_are_exact(spark):
    """A run that occurs just often enough, spread over documents, is found; one occurrence less is not."""
    rows = [(f"red fox {i}", "en") for i in range(10)] + [(f"blue fox {i}", "en") for i in range(9)]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    got = collocations.collocations(frame).select("phrase", "a", F.col("l"), F.col("r")).collect()
    assert [tuple(r) for r in got] == [("red fox", 10, 10, 19)]


def test_repeated_rows_are_results_each(spark):
    rows = [(1, [3, 1]), (1, [3, 1]), (1, [3, 1]), (2, [2, 2]), (3, [1, 0]), (3, [0, 5]), (100, [1, 1]), (100, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    asked = df.where("vec_id = 100").selectExpr("vec_id AS query_id", "v")
    got = [(r["rank"], r.vec_id, r.score) for r in kdtree.top_k(df, asked, 5, shard=2, leaf=1).orderBy("rank").collect()]
    assert got == [(1, 3, 5), (2, 1, 4), (3, 1, 4), (4, 1, 4), (5, 2, 4)]


def test_many_notices_in_one_text_are_found_in_proportion():
    index = licences._index(tuple((n, tuple(t)) for n, t in licences.TEMPLATES.items()), licences.SIMILARITY)
    lines = ["words between them" if i % 2 else "Licensed under the MIT License." for i in range(3000)]
    found = licences.spans("\n".join(lines), index)
    assert [(name, first, last) for name, _, first, last, *_ in found] == [("MIT", i, i) for i in range(0, 3000, 2)]
    rng = random.Random(12)
    text = "\n".join(rng.choice(["Licensed under the MIT License.", "a b c", "", "Licensed under the Apache License, Version 2.0"]) for _ in range(400))
    for _, _, first, last, begin, end in licences.spans(text, index):
        assert text.count("\n", 0, begin) == first and text.count("\n", 0, end - 1) == last


def test_terms_met_again_draw_the_same():
    texts = [" ".join(f"w{(i * 37 + k * k) % 900}" for k in range(250)) for i in range(12)]
    sampler, plain = weighted.Sampler(64, kept=700), weighted.Sampler(64)
    for a, b in zip(texts, texts[1:]):
        sampler.sign(a), sampler.sign(b)
        # also with terms that neither text has, and once the table has forgotten some
        for text in (a[: len(a) // 2] + b[: len(b) // 2], f"{a} new {b[:9]}", "", texts[0]):
            assert (sampler.sign(text, again=True) == plain.sign(text)).all()
    met = weighted.Sampler(64)
    met.sign(texts[0]), met.sign(texts[1])
    # a walk through the large table would miss: it is asked for new terms only
    met.places.clear()
    assert (met.sign(texts[0], again=True) == plain.sign(texts[0])).all()


def test_texts_read_in_groups_are_signed_alike(monkeypatch):
    rng = random.Random(12)
    texts = ["", " ", "a", "one", "\u00e4\u20ac\U0001f600 x", "No end", " begins", "ends ", "UPPER upper\n\tUpper", "same same same"]
    texts += [prose(rng, rng.randint(0, 90)) for _ in range(60)] + [" ".join(f"n{rng.randint(0, 400)}" for _ in range(200)) for _ in range(30)]
    texts.insert(40, " ".join(f"long{i % 700}" for i in range(5000)))
    rng.shuffle(texts)
    plain = weighted.Sampler(64)
    for kept in (40, 3000, weighted.KEPT):
        sampler, got, grouped = weighted.Sampler(64, kept=kept), [], 0
        pairs = [(i, *x) for i, x in enumerate(zip(texts, texts[1:]))]
        for group, short in weighted._groups(pairs, kept // 4):
            got += [i for i, _, _ in group]
            if not short:
                continue
            grouped += len(group)
            halves = [(a[: len(a) - len(a) // 2], b[: len(a) // 2]) for _, a, b in group]
            signs = sampler.signed([(a, b, *[x.encode() for x in h]) for (_, a, b), h in zip(group, halves)])
            for (_, a, b), h, (x, edited, y) in zip(group, halves, signs):
                assert (x == plain.sign(a)).all() and (edited == plain.sign("".join(h))).all() and (y == plain.sign(b)).all()
        assert got == [i for i, _, _ in pairs] and (grouped > 90 or kept < 4000)
    # of equal arrivals the first term in order counts, wherever the table has it
    for order in (["b", "a"], ["a", "b"]):
        tied = weighted.Sampler(64)
        rows = np.array([tied.places[x.encode()] for x in order])
        tied._add(0)
        tied.start[:2] = 1.0
        assert (tied._of(rows) == tied._short(weighted.mixed(np.full(64, tied.names[tied.places[b"a"]])))).all()


def test_lines_are_masked_by_compiled_steps(spark):
    texts = ["a  b\tc ", "one 2 three four five six", "x1 y2 z3", " \t\r", "", None, "no digits at all", "\u00a0", "a 1b c d e f g h\nlast <*> 7 eight nine ten"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = line_dedup._lines(docs, "doc_id", "text", 3)
    got = {(r.key, r.pos): (r.line, r.digits) for r in lines.collect()}
    assert got == {
        (0, 0): ("a b c", False), (1, 0): ("one <*> three four five six", False), (2, 0): ("x1 y2 z3", True), (6, 0): ("no digits at all", False),
        (7, 0): ("\u00a0", False), (8, 0): ("a <*> c d e f g h", False), (8, 1): ("last <*> 7 eight nine ten", True)}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    # in a lambda the patterns would be run uncompiled and the spaces told twice; a filter on the result would mask again
    assert "lambda" not in plan and plan.count("<*>, 1)") == 1


@pytest.mark.parametrize("words", [12, 20])
def test_patterns_of_lone_tokens_are_not_built(spark, monkeypatch, words):
    """Lines of one leaf that agree in little take no patterns; those that agree but for a few places still do."""
    sizes, real = [], line_dedup.stored

    def stored(df):
        made = real(df)
        if {"h", "sig"} <= set(made.columns):
            sizes.append(made.select("h").distinct().count())
        return made

    monkeypatch.setattr(line_dedup, "stored", stored)
    draw = random.Random(words)
    name = lambda: "".join(draw.choice("abcdefghij") for _ in range(12))
    apart = [" ".join(["one", "two", "three", *(name() for _ in range(words - 3))]) for _ in range(30)]
    same = [name() for _ in range(words - 3)]
    alike = [" ".join(["one", "two", "three", *same[:4], name(), *same[5:]]) for _ in range(4)]
    got = line_dedup.dedup_lines(documents(spark, apart + alike)).collect()
    assert sorted(r["doc_id"] for r in got if r["dropped_lines"]) == [31, 32, 33]
    assert sizes and set(sizes) == {len(alike)}  # lines that patterns were kept of
