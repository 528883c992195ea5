"""Every operator against brute force, and on nulls, empties, ties, repeats, long texts and clashing columns."""

import hashlib
import html
import math
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import bpe, components, html_text, kdtree, lattice, licences, line_dedup, mixing, quality, secrets, simhash
from rivulet.llm.queries import CHECKS, QUERIES, tokenizer_text

LONG = "lorem ipsum dolor " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid string, n int, key int, copy int, ids int, fingerprint int"
ODD = [
    (1, None, "en", "s", None, "x", 1, 1, 1, 1, 1), (2, "", "en", "s", 0, None, 1, 1, 1, 1, 1), (3, "a b c", None, None, 5, "x", 1, 1, 1, 1, 1),
    (3, "a b c", None, None, 5, "x", 1, 1, 1, 1, 1), (None, "a b c", "en", "s", 5, "x", None, None, None, None, None),
    (4, LONG, "en", "s", len(LONG), "x", 1, 1, 1, 1, 1), (5, " \t\n ", "en", "t", 4, "x", 1, 1, 1, 1, 1), (6, "a b c d", "en", "t", 7, "x", 1, 1, 1, 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def db(data):
    return oracle.connect(data)


@pytest.fixture(scope="module")
def texts(db):
    return db.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, data, db, name):
    assert oracle.compare(spark, db, data, QUERIES[name], CHECKS[name]) is None


# byte-pair encoding


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found.no_truncation()
    found.no_padding()
    return found


def test_bpe_like_the_library(spark, data, texts, library):
    got = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, data).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("text", [
    "", "  a  b", "x <|endoftext|> y<|startoftext|><|ENDOFTEXT|>", "İstanbul ΑΣ ΣΑΣ. ς straße ẞ ǅ ﬁ", "don't I'll WE'VE 's's 1234 ½ ² ٣ 五 !!!...??",
    "é     ​ x\x1cy\x85z\x1e", "a" * 3000, "ſ K Å Ⅷ ⓐ Ᲊ Ƛ", "日本語テキスト 한국어 👩‍👩‍👧", "﻿bom line", "##\x00\x01", "aaa bbb " * 500,
])
def test_bpe_odd_texts(text, library):
    vocabulary = bpe.Vocabulary(tokenizer_text())
    want = library.encode(text, add_special_tokens=False).ids
    assert vocabulary.encode(text).tolist() == want
    assert vocabulary.encode(text).tolist() == want  # from memory
    assert vocabulary.decode(vocabulary.encode(text)) == library.decode(want, skip_special_tokens=False)


def test_bpe_forgets_words(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    vocabulary = bpe.Vocabulary(tokenizer_text())
    text = "one two three four five six one two seven's eight one!"
    assert [vocabulary.encode(text).tolist() for _ in range(3)] == [library.encode(text, add_special_tokens=False).ids] * 3


def test_bpe_odd_rows(spark, odd):
    content = tokenizer_text()
    coded = bpe.decode(bpe.encode(odd, content), content, text="n")
    rows = coded.select("doc_id", "text", "ids", "n").collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert (len(row["ids"]) == 0) == (not (row["text"] or "").strip())
        assert row["n"] is not None
    assert bpe.encode(odd.limit(0), content).count() == 0


# licences


def test_licences_of_planted_lines(spark, data, texts):
    got = {r["doc_id"]: r["licences"] for r in QUERIES["op2_licences"](spark, data).collect()}
    short = {t for ts in licences.TEMPLATES.values() for t in ts if len(t) < 90}
    for doc, text in texts:
        planted = [i for i, line in enumerate(text.split("\n")) if line in short]
        assert [x["first_line"] for x in got[doc] if x["dice"] == 1.0] == planted


def test_licences_pruning_changes_nothing():
    index = licences.Index(licences.TEMPLATES, 0.8)
    long = licences.TEMPLATES["MIT"][2]
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", long)
    text = "Some words before it.\n" + wrapped + "\nReleased under the  mit license\nMore of the same, and the end."

    def brute(value):
        lines, finds = value.split("\n"), []
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if not all(index.words & set(licences.normalised(lines[i])) for i in (a, b)):
                    continue
                words = Counter(licences.bigrams([w for line in lines[a : b + 1] for w in licences.normalised(line)]))
                best = max(((licences.dice(words, t), -i, name) for i, (_, name, t) in enumerate(index.all)), default=(0, 0, ""))
                if best[0] >= 0.8:
                    finds.append((-best[0], a - b, a, b, best[2]))
        chosen = []
        for v, _, a, b, name in sorted(finds):
            if all(b < c or d < a for _, _, c, d in chosen):
                chosen.append((name, -v, a, b))
        return sorted(chosen, key=lambda x: x[2])

    for value in (text, "Licensed under CC BY 4.0.", "", "the\nof\nthe", "Licensed under the Apache License Version 2.0\n\nthe License"):
        assert licences.licences(value, index) == brute(value)
    assert [x[0] for x in licences.licences(text, index)] == ["MIT", "MIT"]


@pytest.mark.parametrize("text", [
    "Copyright 2020 Foo Inc. Licensed under the MIT License.", "Licensed under the MIT License. See LICENSE for details.",
    "words of all kinds go here " * 200 + "Licensed under the MIT License. " + "and go on without any line break " * 200,
    "İ" * 5 + " x\ny Licensed under\nthe MIT License, z",
])
def test_licences_inside_lines(text):
    found, = licences.spans(text, licences.Index(licences.TEMPLATES, 0.8))
    assert found[:2] == ("MIT", 1.0) and re.fullmatch(r"Licensed under\sthe MIT License", text[found[4] : found[5]])


GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by the "
    "Free Software Foundation; either version {2} of the License, or (at your option) any later version.\n\nThis {0} is distributed in the hope "
    "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU {1} Public License for more details.")


@pytest.mark.parametrize("text, name", [
    (GNU.format("program", "General", "2"), "GPL-2.0"), (GNU.format("program", "General", "3"), "GPL-3.0"),
    (GNU.format("library", "Lesser General", "2.1"), "LGPL-2.1"), (GNU.format("program", "Lesser General", "3"), "LGPL-3.0"),
    (GNU.format("library", "Library General", "2"), "LGPL-2.0"), (GNU.format("program", "Affero General", "3"), "AGPL-3.0"),
    ("Licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"), ("Licensed under the GNU General Public License, version 3.0.", "GPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC-ND 2.5.", "CC-BY-NC-ND-2.5"),
    (licences._BSD + " Neither the name of Foo Inc. nor the names of its staff may be used to endorse or promote products derived "
     "from this software without specific prior written permission. " + licences._BSD_END, "BSD-3-Clause"),
    (licences._BSD + "\n" + licences._BSD_END, "BSD-2-Clause"),
])
def test_licences_that_are_alike(text, name):
    index = licences.Index(licences.TEMPLATES, 0.8)
    assert [x[0] for x in licences.spans("Some words of mine. " + text + " More words of mine.", index)] == [name]


def test_licences_odd_rows(odd):
    rows = licences.scan(odd).collect()
    assert len(rows) == len(ODD) and not any(r["licences"] for r in rows)


# mixing


def test_mixing_meets_weights(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('s', id % 5)) AS source", "'t' AS text")
    weights = {"hot": 1, "s0": 2, "s1": 1}
    mixed = mixing.mix(docs, weights, total=40_000)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == set(weights)
    for name, weight in weights.items():
        assert abs(counts[name] - 10_000 * weight) < 5 * math.sqrt(10_000 * weight)
    again = mixing.mix(docs.repartition(5), weights, total=40_000, small=0, slices=3)  # the other join
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


def test_mixing_large_means(spark):
    docs = spark.createDataFrame([(i, "few") for i in range(3)] + [(i, "many") for i in range(3, 1003)], "doc_id long, source string")
    counts = {r["source"]: r["count"] for r in mixing.mix(docs).groupBy("source").count().collect()}
    assert all(abs(n - 501.5) < 5 * math.sqrt(501.5) for n in counts.values())


def test_mixing_odd_rows(odd):
    mixed = mixing.mix(odd, total=4000)
    assert mixed.columns == [*odd.columns, "copy_"]
    # equal weights over the sources s, t and null
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"s", "t", None} and min(counts.values()) > 1000
    assert mixing.mix(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd, {"s": -1})


# quality


def test_quality_against_labels(spark, data, db):
    truth = dict(db.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = {r["doc_id"]: r["accepted"] for r in QUERIES["op4_quality"](spark, data).collect()}
    good, bad = [got[d] for d, q in truth.items() if q == 1], [got[d] for d, q in truth.items() if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_labeller_accuracies_are_found():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    fires = np.array([0.6, 0.5, 0.4, 0.5, 0.3, 0.5, 0.7, 0.6])
    rows = np.where(truth[:, None], (rng.random((20_000, 8)) < 0.02) * -1, (rng.random((20_000, 8)) < fires) * -1)
    patterns, counts = np.unique(rows, axis=0, return_counts=True)
    share, rates = quality.fit_labellers(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.02
    assert np.abs(rates[2, :, 1] - fires).max() < 0.04


def test_quality_odd_rows(odd):
    rows = quality.classify(odd, column="n", accepted="key").collect()
    assert len(rows) == len(ODD) and all(0 <= r["n"] <= 1 for r in rows)
    assert quality.keep_good(odd.limit(0)).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


# line dedup


def brute_lines(rows, depth=line_dedup.DEPTH, constant=line_dedup.CONSTANT):
    """What `dedup_lines` keeps, from sets of whole lines."""
    def mask(line):
        tokens = re.findall(r"[^ \t\n\r\f\x0b]+", line)
        return tuple("<*>" if re.search("[0-9]", t) else t for t in tokens)

    lines = [(key, text, pos, mask(line)) for key, text in set(rows) for pos, line in enumerate((text or "").split("\n")) if mask(line)]
    leaves = defaultdict(set)
    for *_, m in lines:
        leaves[len(m), m[:depth]].add(m)
    template = {}
    for members in leaves.values():
        seen = Counter((i, t) for m in members for i, t in enumerate(m))
        for m in members:
            alone = {i for i, t in enumerate(m) if seen[i, t] == 1}
            fits = len(members) > 1 and alone and len(alone) <= (1 - constant) * len(m)
            template[m] = tuple("<*>" if i in alone else t for i, t in enumerate(m)) if fits else m
    docs, first = defaultdict(set), {}
    for key, text, pos, m in lines:
        t = template[m]
        docs[t].add((key, text))
        digest = hashlib.md5(("=%s" % key if key is not None else "0").encode() + b"\x01" + (("=" + text) if text is not None else "0").encode()).digest()
        place = (key is None, key or 0, digest, pos)
        first[t] = min(first.get(t, place), place)
    gone = defaultdict(set)
    for key, text, pos, m in lines:
        t = template[m]
        f = first[t]
        if len(docs[t]) > 1 and not (f[0] == (key is None) and f[1] == (key or 0) and f[3] == pos and f[2] == hashlib.md5(
                ("=%s" % key if key is not None else "0").encode() + b"\x01" + (("=" + text) if text is not None else "0").encode()).digest()):
            gone[key, text].add(pos)
    return Counter(
        (key, text if not gone[key, text] else "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[key, text]), len(gone[key, text]))
        for key, text in rows
    )


def test_lines_against_brute_force(spark, data, texts):
    got = QUERIES["op5_line_dedup"](spark, data).select("doc_id", "text", "dropped_lines").collect()
    assert Counter(map(tuple, got)) == brute_lines(texts)


@pytest.mark.parametrize("sent", [0, line_dedup.SENT])
def test_lines_with_fields(spark, monkeypatch, sent):
    monkeypatch.setattr(line_dedup, "SENT", sent)
    rows = [
        (1, "login of user 17 at 10:05 from host a\nown first line\n\nx"), (2, "login of user 9 at 11:00 from host a\nown second line\n\nx"),
        (3, "the report of the board was sent to all members by mail today\n  spaced   out\tline "),
        (4, "the report of the board was sent to all partners by mail today\nspaced out line"),
        (5, "the report of the house is not like any line that is here above"), (6, None), (7, ""), (8, "x\nx"), (8, "x\nx"), (None, "x\ny"),
    ]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, got)) == brute_lines(rows)
    kept = {r["doc_id"]: r["text"] for r in got}
    assert kept[2] == "own second line\n" and kept[4] == "" and kept[5] == rows[4][1] and kept[6] is None


def test_lines_odd_rows(odd):
    got = line_dedup.dedup_lines(odd, dropped="n")
    assert got.columns == [*odd.columns, "n_"] and got.count() == len(ODD)
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_lines_with_recurring_fields(spark):
    names, kinds = ["Ann", "Bob", "Cid", "Dora"], ["sports", "local", "travel"]
    story = "This story was posted by {} in our {} pages and may not be copied"
    rows = [(i, story.format(n, k) + f"\nonly {'abcdefghijkl'[i]} has this") for i, (n, k) in enumerate((n, k) for n in names for k in kinds)]
    rows += [(20, "the page was red"), (21, "all texts here are red"), (22, "all texts here are blue"), (23, "all texts here were red again")]
    long = "we send a weekly letter from {} about {} to all the readers of {} who did ask us for it some time ago"
    rows += [(30 + 4 * a + 2 * b + c, long.format(x, y, z)) for a, x in enumerate(("Rome", "Oslo")) for b, y in enumerate(("art", "food"))
             for c, z in enumerate(("north", "south"))]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def alike(a, b):  # by the pair, without signatures: the rows make no chains
        a, b = a.split(), b.split()
        return len(a) == len(b) and a[:3] == b[:3] and 5 * sum(x != y for x, y in zip(a, b)) <= len(a)

    seen = []
    for key, text in rows:
        kept = [x for x in text.split("\n") if not any(alike(x, y) for y in seen)]
        seen += text.split("\n")
        assert got[key]["text"] == "\n".join(kept), key
    assert sum(r["dropped_lines"] for r in got.values()) == 11 + 1 + 7


def test_lines_of_numbers(spark):
    import corpus_pipeline as pipeline

    tables = [(1, "2019 412 7.5\n1:30 200 x1"), (2, "3 4 5\n2020 17 8"), (3, "3 4 5\nBerlin 12 13 15 16"), (4, "Berlin 12 13 15 17"), (5, "7 8 9 10 11 12"),
              (6, "on page 4 we list all of the sources"), (7, "on page 9 we list all of the sources")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in tables], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {**dict(tables), 3: "Berlin 12 13 15 16", 7: ""}
    assert {r["doc_id"] for r in pipeline.new_lines(spark, docs, "").collect()} == {1, 2, 3, 4, 5, 6}


# pages


def test_pages_of_one_article(spark, data, db):
    got = {r["page_id"]: r for r in QUERIES["op6_main_text"](spark, data).collect()}
    pages = db.execute("SELECT page_id, html FROM pages").fetchall()
    assert len(got) == len(pages)
    for page, source in pages:
        found = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
        body = re.sub(r"<[^<>]*$", "", found[1]) if found else ""
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", body)]
        want = "\n".join(b for b in blocks if b)
        assert (got[page]["text"], got[page]["n_chars"]) == (want, len(want))


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<script>var a='<p>no</p>'</script><style>p{}</style>", ""),
    ("<p>a<!-- x -->b &amp; c&nbsp;&lt;d&gt;</p><p", "ab & c <d>"),
    ("<body><header>Site name</header><nav><ul><li>Home<li>About</ul></nav><main><h1>T</h1><p>One <b>two</b>\n three.</p><ul><li>x<li>y</ul>"
     "<aside>Side</aside></main><footer>Foot</footer></body>", "T\nOne two three.\nx\ny"),
    ("<div class='page'><div class='cookie-notice'>We use cookies to serve all of you a very much better site.</div><div id=content><p>" + "Long text. " * 20
     + "</p><p>Short.</p></div><div class='comments'><p>I read all of this and I liked it very much, thank you.</p></div></div>",
     ("Long text. " * 20).strip() + "\nShort."),
])
def test_page_cases(source, want):
    assert html_text.main_text(source) == want


LINES = ["A first long line of the story with many words in it.", "A second one that is just as long as the first line."]
STORY = "".join(f"<p>{line}</p>" for line in LINES)
SIDE = "<div class=widget><p>Buy this now.</p></div>"


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "comments-open", "overflow-hidden", "with-ads", "search-page", "sidebar", "widget"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_pages_in_marked_wrappers(name, tag):
    page = f"<body><div class='{name}'><{tag}>{STORY}</{tag}>{SIDE}</div><div class='comments'><p>Nice.</p></div></body>"
    assert html_text.main_text(page) == "\n".join(LINES)


def test_pages_of_several_blocks():
    long = "<p>" + "Long text of the body. " * 30 + "</p>"
    body = ("Long text of the body. " * 30).strip()
    page = f"<body><div>Site</div><div id=c><h1>Title</h1><div class=lead><p>The lead.</p></div><div class=body>{long}{long}</div></div></body>"
    assert html_text.main_text(page) == f"Title\nThe lead.\n{body}\n{body}"
    nested = f"<div><h1>T</h1><div>By me</div><div><h2>Sub</h2><div>{long}{long}</div><ul><li>One</ul></div></div><div><ul><li><a>Home</a></ul></div>"
    assert html_text.main_text(nested) == f"T\nBy me\nSub\n{body}\n{body}\nOne"
    assert html_text.main_text(f"<article>{long}</article><article><p>Short.</p></article><p>Out</p>") == f"{body}\nShort."


TEXT = "\n".join(LINES)
COMMENT = "<p>I have read all of this and I liked it very much, thank you for it.</p>"


@pytest.mark.parametrize("page", [
    f"<div class='entry-content'>{STORY}</div><div id=comments class=comments-area><article class=comment-body>{COMMENT}</article></div>",
    f"<div class='entry-content'>{STORY}</div><div id=comments><article>{COMMENT}</article></div>",
    f"<div class='entry-content'>{STORY}</div><div><article class=card><p>Another story.</p></article><article class=card><p>A third.</p></article></div>",
    f"<article>{STORY}</article><article class=comment-item>{COMMENT}</article>",
    f"<article>{STORY}<article>{COMMENT}</article></article>",
    f"<article>{STORY}</article><section id=comments>{COMMENT * 9}</section>",
    f"<main>{STORY}<section id=discussion>{COMMENT}</section></main>",
    f"<main><article>{STORY}</article><article class=teaser><p>Another story.</p></article></main>",
    f"<form id=aspnetForm><input name=state><div>{STORY}</div><button>Go</button></form>",
    f"<article>{STORY}<form><p>Your address</p><input></form></article>",
    f"<article>{STORY.replace('<p>', '<p class=social-sciences>')}<p class='share'>Share this</p></article>",
])
def test_pages_whose_articles_are_not_the_story(page):
    assert html_text.main_text(f"<body><nav>Home</nav>{page}<footer>End</footer></body>") == TEXT


def test_page_clusters_decide(monkeypatch):
    page = f"<body><div><p><a>One</a> <a>Two</a></p></div><div>{STORY}</div></body>"
    assert html_text.main_text(page) == TEXT
    monkeypatch.setattr(html_text, "high", lambda values: np.zeros(len(values), bool))
    assert html_text.main_text(page) != TEXT


def test_page_headline_beside_its_article():
    assert html_text.main_text(f"<body><main><h1>Title</h1><article>{STORY}</article></main></body>") == "Title\n" + TEXT


def test_page_methods(odd):
    flat = html_text.smoothed(np.ones(7))
    assert np.allclose(flat, 1)
    assert html_text.high(np.array([1.0, 2, 30, 40])).tolist() == [False, False, True, True]
    assert html_text.high(np.array([5.0])).tolist() == [True]
    got = html_text.extract(odd, html="text", text="n").collect()
    assert len(got) == len(ODD) and all(r["n"] is not None for r in got)
    assert html_text.extract(odd.limit(0), html="text", text="text").count() == 0


# secrets


def base_spans(text):
    assign = re.compile(
        "(?:" + "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_against_brute_force(spark, data, texts):
    rng = np.random.default_rng(1)
    alphabet = secrets.ENCODINGS["base64"][1]
    tokens = ["".join(rng.choice(list(alphabet), 40)) for _ in range(60)]
    planted = {10_000 + i: f"é words 👩 before {t} and after it" for i, t in enumerate(tokens)}
    planted |= {20_000 + i: f"see the CamelCaseIdentifierOfModule{i}AndItsVersion here" for i in range(40)}
    planted |= {30_000: "secret=token:abcdefghijklmnop", 30_001: "PASSWORD = 'aaaaaaaaaaa' API-key apiKey:\"0123456789ab\"", 30_002: "AKIAAKIA0123456789 deadbeefdeadbeef0",
                30_003: "tokenſ ſecret=abcdefghijklmnop ApI_KEY  :  x.y-z/aaaaaaaaaa", 30_004: "a" * 40 + " " + "1" * 40}
    rows = [*texts, *planted.items(), (40_000, None), (40_001, ""), (None, "token=abcdefghijklmnop"), (30_000, planted[30_000])]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: [tuple(s) for s in r["found"]] for r in got}
    for doc, text in rows:
        spans = [(a, b, k) for a, b, k in by_id[doc]]
        assert spans == sorted(spans, key=lambda s: (s[0], secrets.KINDS.index(s[2])))
        assert [(a, secrets.KINDS.index(k), b) for a, b, k in spans if k != "random"] == base_spans(text or "")
    hits = sum(any(k == "random" for *_, k in by_id[10_000 + i]) for i in range(60))
    false = sum(any(k == "random" for *_, k in by_id[20_000 + i]) for i in range(40))
    assert hits >= 50 and false <= 4
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string, found int")).count() == 0


def test_secrets_cutoffs():
    uniform = [(0, b, 10) for b in range(secrets.BINS)]
    assert secrets.cutoffs(uniform)[0] == 1
    piled = [(0, b, 10 + (500 if b < 5 else 0)) for b in range(secrets.BINS)]
    assert secrets.cutoffs(piled)[0] >= 5
    assert secrets.cutoffs([(3, 0, 100)]) == {}


# top k


def brute_top(vectors, queries, k):
    found = []
    for q, x in queries:
        scores = sorted(((-sum(a * b for a, b in zip(x, v)), i) for i, v in set(vectors) if i != q and i is not None and v and len(v) == len(x)))[:k]
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(found)


def test_top_k_with_ties_and_shards(spark):
    rng = np.random.default_rng(5)
    points = [(int(i), tuple(map(int, rng.integers(-3, 4, 5)))) for i in range(600)]
    points += [(700 + i, (2, 2, 2, 2, 2)) for i in range(300)] + [(5, (1, 1))] * 2 + [(6, (1, 2)), (9001, None), (None, (1, 1, 1, 1, 1))]
    queries = [(i, v) for i, v in points[::37] if v]
    df = spark.createDataFrame(points, "vec_id long, v array<long>")
    asked = spark.createDataFrame(queries, "query_id long, v array<long>")
    want = brute_top([p for p in points if p[0] is not None], queries, 10)
    for shard, block, leaf in ((64, 7, 4), (8192, 2048, 128)):
        got = kdtree.top_k(df, asked, 10, shard=shard, block=block, leaf=leaf).collect()
        assert sorted(map(tuple, got)) == want
    assert kdtree.top_k(df.limit(0), asked).count() == 0


def test_top_k_whole_numbers(spark):
    rows = [(1, [0.5, -0.0001]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, None), (5, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", kdtree.whole_numbers(F.col("e")).alias("v"))
    assert {r[0]: r[1] for r in df.collect()} == {1: [512, -1], 2: None, 3: None, 4: None, 5: None}
    exact = spark.createDataFrame([(1, [3_000_000_000, 1]), (2, [3_000_000_000, 2]), (3, [1, 1])], "vec_id long, v array<long>")
    got = kdtree.top_k(exact, exact.selectExpr("vec_id AS query_id", "v"), 1).where("query_id = 1").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 9_000_000_000_000_000_002)]


# near-duplicates


def brute_components(keys, linked):
    label = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(200)]
    got = components.components(spark.createDataFrame([*edges, *edges[:5], (None, 3)], "a long, b long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in got} == brute_components(nodes, edges) and len(got) == len(nodes)
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, data, texts):
    got = {r["doc_id"]: r for r in QUERIES["op9_simhash"](spark, data).collect()}
    prints = {d: brute_fingerprint(t) for d, t in texts}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    label = brute_components(prints, linked)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {d: (f"{prints[d]:016x}", label[d]) for d in prints}


@pytest.mark.parametrize("bucket", [1, 3, 32])
def test_fingerprint_links_of_crowded_buckets(spark, bucket):
    rng = np.random.default_rng(4)
    centres = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 6)]
    prints = {c ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False)) for c in centres for _ in range(60)} | {0, -1, 1, 3}
    found = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in prints], "fp long"), bucket=bucket).collect()
    differ = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(differ(a, b) <= 2 for a, b in found)
    linked = [(a, b) for a in prints for b in prints if a < b and differ(a, b) <= 2]
    assert brute_components(prints, [tuple(r) for r in found]) == brute_components(prints, linked)


def test_simhash_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter([(1, 1), (2, 1), (5, 1), (3, 3), (3, 3), (None, 3), (4, 4), (6, 6)])
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 3, 4, 6]
    assert simhash.keep_one(odd.limit(0)).count() == 0


def test_lattice_decoding():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 8)) * 2
    points = lattice.decode_e8(x)
    twice = points * 2
    assert (twice == np.rint(twice)).all() and (points.sum(axis=1) % 2 == 0).all() and len(set(map(tuple, (twice % 2 == 0)))) <= 2
    away = ((x - points) ** 2).sum(axis=1)
    for step in lattice._shortest():
        assert (away <= ((x - points - step) ** 2).sum(axis=1) + 1e-9).all()


def embedding_links(rows, threshold=0.9):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = []
    for n, (a, x) in enumerate(usable):
        for b, y in usable[n + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((a, b))
    return links


@pytest.mark.parametrize("rows", [3, lattice.ROWS])
def test_lattice_links(spark, rows):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((6, 32))
    data = [(i, (centres[i % 6] + 0.08 * rng.standard_normal(32)).tolist()) for i in range(90)] + [(100 + i, rng.standard_normal(32).tolist()) for i in range(60)]
    data += [(200 + i, data[0][1]) for i in range(25)] + [(300, None), (301, [0.0] * 32), (302, [float("nan")] * 32), (303, [None, 1.0]), (304, []), (305, [1.0, 2.0])]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>"), rows=rows).collect()}
    links = embedding_links(data)
    degree = Counter(x for link in links for x in link)
    assert {i: r["n_links"] for i, r in got.items()} == {i: degree[i] for i, _ in data}
    label = brute_components([i for i, _ in data], links)
    assert {i: (r["component_id"], r["kept"]) for i, r in got.items()} == {i: (label[i], label[i] == i) for i in label}


def test_lattice_recall(spark, data, db):
    """Links of the given table, and of pairs at the threshold itself."""
    rows = db.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op10_lattice"](spark, data).collect()}
    degree = Counter(x for link in embedding_links(rows) for x in link)
    assert set(got) == {i for i, _ in rows} and all(got[i] <= degree[i] for i in got)
    assert sum(got.values()) >= 0.9 * sum(degree.values())
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal((2, 400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    mates = [(2 * i, x.tolist()) for i, x in enumerate(a)] + [(2 * i + 1, (0.901 * x + math.sqrt(1 - 0.901**2) * y).tolist()) for i, (x, y) in enumerate(zip(a, b))]
    near = lattice.near_duplicates(spark.createDataFrame(mates, "vec_id long, embedding array<double>"))
    assert near.where("n_links > 0").count() >= 0.9 * len(mates)


def test_lattice_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (4, [1e300, 0.0]), (5, [1e-300, 0.0])]
    got = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter(map(tuple, got)) == Counter({(1, 4, 1, True): 2, (None, 4, 1, False): 1, (None, 0, None, True): 1, (4, 4, 1, False): 1, (5, 4, 1, False): 1})
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# the pipeline


def test_pipeline_stages(spark, data, texts):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    results = []
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, data).persist()
        results.append([r.asDict() for r in docs.collect()])
        if len(results) < len(pipeline.STAGES):
            assert docs.columns == columns
    good, lined, single, mixed, coded = results
    accepted = {r["doc_id"] for r in quality.classify(spark.read.parquet(f"{data}/documents.parquet")).where("accepted").collect()}
    assert {r["doc_id"] for r in good} == accepted
    kept = {(d, t) for d, t, n in brute_lines([(r["doc_id"], r["text"]) for r in good]) if not n or t.strip()}
    assert {(r["doc_id"], r["text"]) for r in lined} == kept and all(r["n_chars"] == len(r["text"]) for r in lined)
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in lined}
    label = brute_components(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert {r["doc_id"] for r in single} == {d for d in prints if label[d] == d}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single} and 0.6 < len(mixed) / len(single) < 1.5
    assert Counter(r["doc_id"] for r in coded) == Counter(r["doc_id"] for r in mixed)
    vocabulary = bpe.Vocabulary(tokenizer_text())
    by_id = {r["doc_id"]: r["text"] for r in mixed}
    assert all(r["ids"] == vocabulary.encode(by_id[r["doc_id"]]).tolist() and r["n_tokens"] == len(r["ids"]) for r in coded)


def test_pipeline_of_nothing(spark, odd):
    import corpus_pipeline as pipeline

    for start in (odd, odd.limit(0)):
        docs = start
        for _, stage in pipeline.STAGES:
            docs = spark.createDataFrame((made := stage(spark, docs, "")).collect(), made.schema)
        assert "text" not in docs.columns
