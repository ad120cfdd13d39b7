"""Text operators: held-out accuracy, exact round trips and brute force."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from halfspace.llm import licenses, page_text, quality_crf, quality_rules, sentence_pieces, toxicity
from halfspace.llm.common import labelled_sample

SCHEMA = "doc_id BIGINT, text STRING"
LARGER = "/root/testdata/sf0.1"


def labelled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.mark.parametrize(
    ("query", "label", "least"),
    [(toxicity.op1_toxicity, "toxic", 0.9), (quality_crf.op2_quality_classifier, "quality", 0.95)],
)
def test_held_out_accuracy(spark, query, label, least):
    _, labels = labelled(spark, LARGER)
    rows = query(spark, LARGER)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    held = rows.where("held_out").join(labels, "doc_id").collect()
    right = {0: [], 1: []}
    for row in held:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
        right[row[label]].append(row.predicted == row[label])
    balanced = (np.mean(right[0]) + np.mean(right[1])) / 2
    assert balanced > least


def test_toxicity_learns_stems_and_ignores_the_rest():
    dice = random.Random(4)
    clean = [f"w{dice.randint(0, 400)}" for _ in range(4000)]
    sample = []
    for i in range(600):
        words = dice.choices(clean, k=dice.randint(3, 60))
        if i % 3 == 0:
            words.insert(dice.randrange(len(words) + 1), f"grumblor{dice.choice('abcdefghij')}")
        sample.append((i, " ".join(words), int(i % 3 == 0)))
    scorer = toxicity.Scorer(toxicity.train(sample))
    texts = ["w1 w2 GRUMBLORz!", "w1 w2 w3", "", None, " \n", "x " * 60_000, "x " * 60_000 + "grumblora"]
    scores = scorer(texts)
    assert (scores >= toxicity.DECISION).tolist() == [True, False, False, False, False, False, True]
    assert scores[2] == scores[3] == scores[4]
    assert scorer([]).size == 0


@pytest.mark.parametrize("module", [toxicity, quality_crf])
def test_classifiers_without_labels_and_on_odd_rows(spark, module):
    schema = f"{SCHEMA}, score STRING, label INT, predicted INT"
    empty = spark.createDataFrame([], schema)
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT, quality INT")
    model = module.learn(empty, none, module.learnable())
    assert module.score(empty, model).count() == 0
    rows = [(1, "a\nb"), (1, "a\nb"), (None, None), (2, ""), (3, "y" * 200_000), (4, "\n" * 5000)]
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], schema)
    found = module.score(docs, model).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 1, 1, 2, 3, 4]
    keep = module.keep_clean if module is toxicity else module.keep_good
    kept = keep(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() >= 2


def test_sample_is_bounded_and_takes_an_id_once(spark):
    rows = [(1, "b"), (1, "a"), (None, "x"), (2, None), (3, "y" * 60_000), (5, "e")]
    rows += [(4, "hot")] * 500 + [(100 + i, f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    known = [(i, 0) for i in (1, 2, 3, 4, None)] + [(4, 1), (5, 1), (5, None), (9, 1)]
    known += [(100 + i, i % 2) for i in range(50)]
    labels = spark.createDataFrame(known, "doc_id BIGINT, toxic INT")
    sample = labelled_sample(docs, labels, "toxic", F.col("doc_id") < 100, 100)
    assert sample == [(1, "a", 0), (4, "hot", 0), (5, "e", 1)]
    few = labelled_sample(docs, labels, "toxic", F.col("doc_id") >= 100, 7)
    assert [sum(label == v for *_, label in few) for v in (0, 1)] == [7, 7]


def test_forward_backward_agrees_with_all_paths():
    random_ = np.random.default_rng(0)
    field = quality_crf.Field(
        np.zeros(1), np.ones(1), np.zeros(1), random_.normal(size=(2, 2))
    )
    for n in (1, 2, 5):
        scores = random_.normal(size=n) * 3
        total, good = 0.0, np.zeros(n)
        for path in range(2**n):
            y = [path >> i & 1 for i in range(n)]
            weight = math.exp(
                sum(s for s, v in zip(scores, y, strict=True) if v)
                + sum(field.transitions[a, b] for a, b in zip(y, y[1:], strict=False))
            )
            total += weight
            good += weight * np.array(y)
        assert np.allclose(field.good(scores), good / total)
        there = np.ones((1, n), bool)
        padded, _ = quality_crf._posteriors(scores[None], there, field.transitions)
        assert np.allclose(padded[0], good / total)


def test_a_bad_line_among_good_ones_lowers_the_share():
    dice = random.Random(6)
    prose = lambda: " ".join(dice.choices("some plain words of prose here".split(), k=12)) + "."
    junk = lambda: " ".join(w + "###" for w in dice.choices("ab cd ef gh".split(), k=12))
    sample = []
    for i in range(300):
        lines = [prose() for _ in range(5)]
        if i % 3 == 0:
            lines[dice.randrange(5)] = junk()
            lines.append(junk())
        sample.append((i, "\n".join(lines), int(i % 3 != 0)))
    field = quality_crf.train(sample)
    good, mixed = "\n".join(prose() for _ in range(4)), "\n".join([prose(), junk(), prose(), junk()])
    assert field.score(good) >= quality_crf.DECISION > field.score(mixed)
    assert field.share(mixed) > field.share("\n".join([junk(), junk()]))
    assert field.score("") == field.score(None) < 0.1


@pytest.fixture(scope="module")
def codec():
    return sentence_pieces.Codec(sentence_pieces.public_model(), block=32)


def test_pieces_agree_with_the_library_and_decode_back(codec):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=codec.path)
    dice = random.Random(7)
    letters = "abcdeéß \n\t  𐍈中文theing.,!012<s>的_-\x00"
    texts = ["".join(dice.choices(letters, k=dice.randint(0, 300))) for _ in range(400)]
    texts += [" " * n + "a" + " " * n for n in range(40)]
    texts += ["the" * 4000, "a" * 9000, "的" * 500, "=-" * 900, "\n" * 90, "<0x0A>", "x" * 47 + " ."]
    texts += ["".join(dice.choices("abcdefghijklmnop", k=5000)) for _ in range(5)]
    for text in texts:
        ids = sentence_pieces.unpacked(codec.encode(text))
        assert ids.tolist() == library.encode(text)
        assert codec.decode(ids) == text
    assert codec.decode(library.encode("▁")) == " "
    assert codec.decode([codec.pieces.byte[0xFF]]) == "�"


def test_search_commits_before_the_end_and_keeps_a_bounded_window(codec):
    search = sentence_pieces.Search(codec.pieces)
    text = "".join(random.Random(3).choices("thequickbrownfoxjumps", k=6000))
    ids, widest = [], 0
    for at in range(0, len(text), 50):
        ids += search.push(text[at : at + 50])
        widest = max(widest, len(search.tail))
    committed = len(ids)
    ids += search.finish()
    assert committed > 0.95 * len(ids)
    assert widest < 50 + 4 * codec.pieces.longest
    assert "".join(codec.pieces.text[i] for i in ids) == text


def test_encode_and_decode_tables(spark):
    model = sentence_pieces.public_model()
    schema = f"{SCHEMA}, ids STRING, n_ids STRING"
    assert sentence_pieces.encode(spark.createDataFrame([], schema), model).count() == 0
    rows = [(1, "a  b\n"), (1, "a  b\n"), (None, "x"), (2, None), (3, ""), (4, "long word " * 20_000)]
    docs = spark.createDataFrame([(*r, "i", "n") for r in rows], schema)
    coded = sentence_pieces.encode(docs, model)
    texts = sorted((r.doc_id or 0, r.text) for r in sentence_pieces.decode(coded, model).collect())
    assert texts == sorted((i or 0, t or "") for i, t in rows)


def brute_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {
        i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)
    }
    lines = [line for line in text.split("\n") if re.sub(r"[\x20\x09-\x0D]", "", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


def test_counts_agree_with_brute_force():
    dice = random.Random(9)
    for _ in range(300):
        text = "".join(dice.choices("ab#é \n\t|𐍈\x0b\x1f\xa0", k=dice.randint(0, 60)))
        assert quality_rules.counts(text.encode())[:5] == brute_counts(text)
    many = " ".join(map(str, range(1_100_000))) + " 1 2 3"
    assert quality_rules.counts(many.encode())[4] == 6


def test_upper_bound_is_the_exact_binomial_one():
    def at_most(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for k, n, error in [(0, 50, 0.05), (3, 200, 0.01), (40, 60, 0.1), (0, 1, 0.5)]:
        bound = quality_rules.upper_bound(k, n, error)
        assert at_most(k, n, bound) == pytest.approx(error, rel=1e-6)
    assert quality_rules.upper_bound(5, 5, 0.1) == 1.0
    assert quality_rules.upper_bound(0, 1000, 0.05) == pytest.approx(1 - 0.05 ** (1 / 1000))


def test_cutoffs_are_certified_in_order():
    lenient_first = [(0.9, 0, 5), (0.5, 1, 80), (0.3, 2, 81), (0.1, 90, 99), (0.05, 90, 100)]
    assert quality_rules.certified(5000, lenient_first, 0.01, 0.01) == 0.3
    assert quality_rules.certified(5000, lenient_first[:2], 0.01, 0.01) == 0.5
    assert quality_rules.certified(20, lenient_first, 0.01, 0.01) is None  # too few labels
    assert quality_rules.certified(0, lenient_first, 0.01, 0.01) is None
    assert quality_rules.certified(5000, [(0.9, 0, 0)], 0.01, 0.01) is None  # rejects nothing


def test_rules_reject_in_certified_strata_only(spark):
    prose = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"word{i}###" for i in range(60))
    rows = [(i, prose if i % 4 else junk, "en") for i in range(4000)]
    rows += [(9000, junk, "xx"), (9001, junk, None), (9002, None, "en"), (9003, "", "en"),
             (None, prose, "en"), (9004, prose, "en"), (9004, prose, "en")]
    docs = spark.createDataFrame([(*r, 0, "r") for r in rows], f"{SCHEMA}, lang STRING, n_words INT, kept STRING")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(4000)], "doc_id BIGINT, quality INT")
    found = quality_rules.apply_rules(docs, labels).collect()
    kept = {r.doc_id: r.kept for r in found}
    assert len(found) == len(rows)
    assert not kept[0] and kept[1] and kept[9000] and kept[9001] and kept[None] and kept[9004]
    assert not kept[9002] and not kept[9003]
    assert quality_rules.apply_rules(docs.limit(0), labels.limit(0)).count() == 0


def test_a_few_hundred_labels_certify_a_language(spark):
    """Four languages with 240 good labels each: rules that one risk is not shared by."""
    dice = random.Random(2)
    prose = lambda: " ".join("".join(dice.choices("abcdefgh", k=5)) for _ in range(60))
    rows, labels = [], []
    for lang in ("en", "de", "fr", "es"):
        for i in range(300):
            bad = i >= 240
            text = prose().replace("a", "#$").replace("b", "C") if bad and i % 2 else prose() + " same" * 25 * bad
            rows.append((len(rows), text, lang))
            labels.append((rows[-1][0], int(not bad)))
        rows += [(len(rows) + n, prose(), lang) for n in range(60)]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, lang STRING")
    known = spark.createDataFrame(labels, "doc_id BIGINT, quality INT")
    measures = quality_rules.measured(docs)
    cutoffs = quality_rules.learn_cutoffs(measures, known)
    assert {stratum for stratum, *_ in cutoffs} == {"en", "de", "fr", "es"}
    # Brute force: the rules of a stratum together lose at most RISK of its good texts.
    counted = {r.doc_id: r for r in measures.collect()}
    lost, caught = Counter(), Counter()
    for doc_id, good in labels:
        row = counted[doc_id]
        if row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words:
            continue
        value = lambda rule: eval(quality_rules.RULES[rule], {}, row.asDict())
        hit = any(s == row.stratum and value(rule) > cutoff for s, rule, cutoff in cutoffs)
        (lost if good else caught)[row.stratum] += hit
    for stratum in ("en", "de", "fr", "es"):
        assert quality_rules.upper_bound(lost[stratum], 240, quality_rules.ERROR / 4) <= quality_rules.RISK
        assert caught[stratum] >= 25


def test_paths_are_nested():
    above = {"en": {rule: sorted(random.Random(rule).sample(range(900), 49)) for rule in quality_rules.RULES}}
    path = quality_rules.paths(above, {"en": 1000})["en"]
    assert len(path) > 5
    for before, after in zip(path, path[1:], strict=False):
        assert all(after[rule] <= before[rule] for rule in quality_rules.RULES) and after != before


ARTICLE = """<!doctype html><html><head><title>T</title><style>p{}</style></head>
<body class="with-sidebar"><form id="all"><header><h1>Site</h1><nav><a href="/">Home</a></nav></header>
<div class="cookie-notice"><p>We use cookies to make this site better for all who read it.</p></div>
<main><article class="post"><header><h1>News &amp; more</h1></header>
<p>First&nbsp;paragraph with <a href="x">a link</a>,\n\n <b>bold</b> words.<br>Next &#x41; line.
<p hidden>not this</p><!-- nor <p>this</p> --><script>var p="</p><p>no</p>";</script>
<aside>Advert in the text</aside><ul><li>One</li><li>Two words</li></ul>
<div class="share-buttons"><a>Tweet</a></div><p>Short.</p><footer>By me</footer></article>
<section id="comments"><article><p>I liked this and say so at some length, as readers do.</p></article>
</section></main><div id="sidebar"><p>Sidebar text that is long enough to look like an article.</p></div>
</form><footer>&copy; all</footer></body></html>"""


def test_main_text_of_a_page():
    tree = page_text.train()
    expected = "News & more First paragraph with a link, bold words. Next A line. One Two words Short."
    found = page_text.main_text(ARTICLE, tree)
    assert found.replace(" not this", "") == expected
    assert page_text.main_text(ARTICLE[: ARTICLE.index("</article>")], tree).startswith("News & more")


def test_pages_without_marked_content():
    tree = page_text.train()
    long = " ".join(["word"] * 60)
    page = f"<div><a>A</a> <a>B</a> <a>C</a></div><p>{long}</p><p>tiny bit</p><p>{long}</p><p><a>next</a></p>"
    assert page_text.main_text(page, tree) == f"{long} tiny bit {long}"
    for page in (None, "", " ", "<p", "<a href='", "<!-- x", "<script>x", "</article>", "<p>" * 3000):
        assert page_text.main_text(page, tree) == ""
    assert page_text.main_text("<article>a < b &lt;p&gt; c</article>", tree) == "a < b <p> c"
    deep = "<div>" * 20_000 + "x" * 10 + " words" * 30
    assert page_text.main_text(deep, tree).startswith("xxxxxxxxxx words")


@pytest.mark.parametrize(("markup", "text"), [
    ('<p>one <svg width="1" height="1"/> two</p><p>three four</p>', "one two three four"),
    ("<p>one <math/> two</p>", "one two"),
    ("<p>one <iframe src=x/> two</p><p>three</p>", "one two three"),
    ("<p>one <iframe src=http://x.org/>lost</iframe> two</p>", "one two"),
    ("<p>one <button>lost</p><p>two</p><button>lost</button><p>three</p>", "one two three"),
    ("<p>one <select><option>lost<option>lost</p><p>two</p>", "one two"),
    ("<p>one<!--> two</p><!---><p>three</p><!-- lost --!><p>four</p>", "one two three four"),
    ("<svg><svg><text>lost</text></svg><text>lost</text></svg><p>one</p>", "one"),
    ("<p>one</p><noscript><p>lost</p></noscript><p>two</p>", "one two"),
    ("<p>one <button>lost <script>'<p>'</script> lost<p>two</p>", "one two"),
    ("<p>one <svg>lost<!-- </svg> --> lost</svg> two</p>", "one two"),
])
def test_dropped_elements_end(markup, text):
    assert page_text.main_text(f"<article>{markup}</article>", page_text.train()) == text


@pytest.mark.parametrize("opening", [
    "article class='post type-post category-social'", "article class='post tag-login'",
    "article class='category-social'", "article class='post comments-open'", "main class='menu-open'",
    "div id='content' class='content-with-sidebar'", "div class='content-with-sidebar'",
    "div id='content' class='search-results'", "div class='layout-sidebar'><article",
    "div class='layout-sidebar'><div role='main'",
])
def test_parts_of_names_do_not_outweigh_content(opening):
    page = f"<html><body><{opening}><p>one two three</p><p>four five</p>"
    assert page_text.main_text(page, page_text.train()) == "one two three four five"


@pytest.mark.parametrize("opening", [
    "div class='sidebar'><article", "article class='comment-body'", "article id='comment-12'",
    "div class='related-posts'><article class='post'", "div class='cookie-banner'><div class='content'",
    "div class='post-sidebar'", "nav class='post main-nav'", "article class='teaser'",
    "div class='content comment-content'", "div hidden><article",
])
def test_boilerplate_stays_boilerplate(opening):
    page = f"<body><main><p>one two</p><{opening}><p>three four five six</p>"
    assert page_text.main_text(page, page_text.train()) == "one two"


def test_a_teaser_is_not_the_article():
    tree = page_text.train()
    prose = " ".join(f"word{i}" for i in range(60))
    page = f"<div><p>{prose}</p><p>{prose}</p></div><article><p>see also</p></article>"
    assert page_text.main_text(page, tree) == f"{prose} {prose}"
    links = "".join(f"<p><a href=x>{prose}</a></p>" for _ in range(5))
    assert page_text.main_text(f"<div>{links}</div><article><p>{prose}</p></article>", tree) == prose
    assert page_text.main_text(f"<div><p>{prose}</p></div><article><p>{prose} end</p></article>", tree) == f"{prose} end"


def test_references_end_at_tags():
    tree = page_text.train()
    words = " ".join(f"w{i}" for i in range(30))
    assert page_text.main_text(f"<article><p>a &am<b>p;</b> b &amp;amp; &lt;i&gt; {words}</p></article>", tree) == f"a &amp; b &amp; <i> {words}"


def test_dropped_elements_take_linear_time():
    tree = page_text.train()
    for many in ("<button>", "<svg><button>", "<svg/>", "<iframe></p><svg>", "</svg>"):
        started = time.perf_counter()
        page_text.main_text("<article>" + many * (400_000 // len(many)), tree)
        assert time.perf_counter() - started < 10


def test_unfinished_tags_and_their_cost():
    tree = page_text.train()

    def inside(markup):
        return page_text.main_text(f"<article><p>{markup}</p></article>", tree)

    assert inside("if x<y or i<n then <b>z</b>") == "if x<y or i<n then z"
    assert inside('one <div class="x" <p title="a>b">two</p>') == "one two"
    assert inside('<p data-x="a<b">q</p> <script src="a>b">if (a<b) c</script>r') == "q r"
    n = 100_000
    for page in (
        "a<b " * n, "<p" * n, '<p "' * n, "<p '\"" * n, "<script " * n, "<!--" * n, "</" * n,
        "<div>" * n + "</section>" * n, "<div " + "a= " * n + ">", "&amp" * n,
    ):
        start = time.perf_counter()
        page_text.main_text(page, tree)
        assert time.perf_counter() - start < 10


def test_tree_learns_its_table_and_never_takes_boilerplate():
    table = np.array(page_text.TABLE, float)
    tree = page_text.train()
    assert (tree(table[:, :-1]) == table[:, -1]).all()
    random_ = np.random.default_rng(1)
    rows = random_.integers(0, 100, (500, 7)) * np.array([1, 0.01, 1, 0.01, 1, 0.01, 0])
    for place in (page_text.BOILERPLATE, page_text.OUTSIDE_MAIN):
        assert not tree(np.column_stack([rows[:, :6], np.full(500, place)])).any()


def test_extract_tables(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = page_text.op8_page_text(spark, sf_dir)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    texts = {r.page_id: r.text for r in found.collect()}
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.DOTALL)[1]
        import html

        assert texts[row.page_id] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
    schema = "page_id BIGINT, url STRING, html STRING, text INT, n_chars STRING"
    rows = [(1, None, None, 0, ""), (1, "u", "", 0, ""), (None, "u", "<main>x</main>", 0, "")]
    odd = page_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.text for r in odd) == ["", "", "x"]
    assert page_text.extract(spark.createDataFrame([], schema)).count() == 0


def scanned(spark, files):
    df = licenses.scan_licenses(spark.createDataFrame(files, "path STRING, text STRING"))
    return {r.path: (r.license, r.origin, r.from_directory) for r in df.collect()}


def test_licenses_are_found_and_inherited(spark):
    mit = "Released under the MIT License."
    gpl = "This work is licensed under the GNU General Public License, version 3."
    files = [
        ("LICENSE", licenses.TEMPLATES["MIT"][1]),
        ("src/a.txt", "plain words"),
        ("src/deep/er/b.txt", None),
        ("src/deep/COPYING.md", gpl),
        ("src/deep/own.txt", f"Some prose first.\n{licenses.TEMPLATES['Apache-2.0'][0]} More prose."),
        ("src/deeper/c.txt", "not below deep"),
        ("top.txt", ""),
        (None, mit),
        ("src/deep/twice.txt", "x"),
        ("src/deep/twice.txt", mit),
    ]
    assert scanned(spark, files) == {
        "LICENSE": ("MIT", "own", None),
        "src/a.txt": ("MIT", "inherited", ""),
        "src/deep/er/b.txt": ("GPL-3.0", "inherited", "src/deep"),
        "src/deep/COPYING.md": ("GPL-3.0", "own", None),
        "src/deep/own.txt": ("Apache-2.0", "own", None),
        "src/deeper/c.txt": ("MIT", "inherited", ""),
        "top.txt": ("MIT", "inherited", ""),
        None: (None, "none", None),
        "src/deep/twice.txt": ("MIT", "own", None),
    }
    assert scanned(spark, []) == {}
    assert scanned(spark, [("a/b", "the word license alone does not license it")])["a/b"][1] == "none"


def test_licence_files_headers_and_identifiers(spark):
    files = []
    for name, (text,) in licenses.full_texts().items():
        files += [(f"{name}/COPYING", text), (f"{name}/src/a.py", "pass")]
    mpl = ("/* This Source Code Form is subject to the terms of the Mozilla Public\n"
           " * License, v. 2.0. If a copy was not distributed, get one. */\nint main;")  # fmt: skip
    gpl = ("# This program is free software: you can redistribute it and/or modify\n"
           "# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation.\n#\n# Other words follow here")  # fmt: skip
    files += [("h/mpl.c", mpl), ("h/gpl.py", gpl), ("i/mit.c", "// SPDX-License-Identifier: MIT\nint x;")]
    files += [("i/apache.c", "/* SPDX-License-Identifier: (Apache-2.0) */"), ("i/zlib.c", "// SPDX-License-Identifier: Zlib")]
    files += [("i/gpl.c", "# SPDX-License-Identifier: GPL-3.0-or-later."), ("c/LICENSE", "Copyright 2019 Acme Inc. All rights reserved.")]
    files += [("p/LICENSE", "One reads the words of this page, or of all of them, as a tale by night.")]
    found = scanned(spark, files)
    for name in licenses.full_texts():
        assert found[f"{name}/COPYING"] == (name, "own", None)
        assert found[f"{name}/src/a.py"] == (name, "inherited", name)
    names = {path: found[path][0] for path, _ in files[-8:]}
    assert names == {
        "h/mpl.c": "MPL-2.0", "h/gpl.py": "GPL", "i/mit.c": "MIT", "i/apache.c": "Apache-2.0",
        "i/zlib.c": None, "i/gpl.c": "GPL-3.0", "c/LICENSE": "proprietary", "p/LICENSE": None,
    }


LGPL = """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version {} of the License, or (at your option) any later version.
 */
int main;"""
GPL = """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version."""
HEADERS = {
    "GNU Lesser General Public License, version 2.1": (LGPL.format("2.1"), "LGPL-2.1"),
    "a library's, version 3": (LGPL.format("3"), "LGPL-3.0"),
    "a program's, version 2 or later": (GPL.format("2"), "GPL-2.0"),
    "a program's, version 3 or later": (GPL.format("3"), "GPL-3.0"),
    "one line, version 2": ("Licensed under the GNU General Public License v2.0.", "GPL-2.0"),
    "one line, no version": ("This work is licensed under the GNU General Public License.", "GPL"),
    "a version of something else": ("Parser version 2.1 is here.\nThis work is licensed under the GNU General Public License.", "GPL"),
    "Affero": (GPL.format("3").replace("GNU General", "GNU Affero General"), "AGPL-3.0"),
    "Mozilla 1.1": ('The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); '
                    "you may not use this file except in compliance with the License.", "MPL-1.1"),
    "BSD-style": ("// Copyright 2009 The Authors. All rights reserved.\n// Use of this source code is governed by a "
                  "BSD-style\n// license that can be found in the LICENSE file.\npackage x", "BSD-3-Clause"),
    "rights reserved": ("Copyright 2019 Acme. All rights reserved.", "proprietary"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice appear in all copies.", "ISC"),
}


def test_headers_of_each_version(spark):
    files = [(f"src/{i}", text) for i, (text, _) in enumerate(HEADERS.values())]
    found = scanned(spark, files)
    assert {name: found[f"src/{i}"][0] for i, name in enumerate(HEADERS)} == {n: want for n, (_, want) in HEADERS.items()}


def test_pairs_are_found_by_their_halves(spark):
    """A notice in two sentences, each of them too far from the template."""
    first, second = "This program is free software under terms; of the", "GNU General Public License as published by the Free Software Foundation."
    text = f"Words here. You can redistribute it and/or modify it. {first} {second} And more."
    found = licenses.passages(spark.createDataFrame([("a", text)], "path STRING, text STRING")).collect()
    sentences = re.split(r"(?<=[.!?;]) +", text)
    want = {f"{a} {b}" for a, b in zip(sentences, sentences[1:], strict=False)}
    close = {r.passage for r in licenses.closest_templates(spark, spark.createDataFrame([(t,) for t in want], "passage STRING")).collect()}
    assert close and close <= {r.passage for r in found if r.cut == licenses.PAIRS}


def test_files_with_clashing_columns_and_long_texts(spark):
    schema = "path STRING, text STRING, license STRING, passage INT, n INT, cut INT, directory STRING"
    long = "plain words and others " * 60_000 + "\nReleased under the MIT License.\n"
    rows = [("a/b", long, "x", 1, 1, 1, "y"), ("a/LICENSE", licenses.full_texts()["ISC"][0], "x", 1, 1, 1, "y"), ("a/c", "", None, None, None, None, None)]
    found = {r.path: r.license for r in licenses.scan_licenses(spark.createDataFrame(rows, schema)).collect()}
    assert found == {"a/b": "MIT", "a/LICENSE": "ISC", "a/c": "ISC"}


def test_prefilter_skips_nothing_close(spark):
    dice = random.Random(6)
    vocabulary = sorted({t for ts in licenses.TEMPLATES.values() for x in ts for t in licenses._tokens(x)})
    texts = {t for ts in licenses.TEMPLATES.values() for t in ts}
    for _ in range(3000):  # templates with words left out, repeated and added
        words = licenses._tokens(dice.choice(sorted(t for ts in licenses.TEMPLATES.values() for t in ts)))
        words = dice.choices(words, k=dice.randint(1, 12)) + dice.choices([*vocabulary, "foo", "bar", "baz"], k=dice.randint(0, 4))
        texts.add(" ".join(words))
    found = spark.createDataFrame([(t,) for t in sorted(texts)], "passage STRING")
    reaches = licenses.reaching()
    kept = {r.passage for r in found.where(reaches(F.col("passage"), licenses.LEAST_COSINE)).collect()}
    reach = {r.passage for r in licenses.closest_templates(spark, found).collect()}
    assert len(reach) > 300 and reach <= kept
    # What it lets through beyond them repeats a token.
    assert all(len(set(text.split())) < len(text.split()) for text in kept - reach)


def test_cosines_agree_with_brute_force(spark):
    dice = random.Random(11)
    vocabulary = sorted({t for ts in licenses.TEMPLATES.values() for x in ts for t in licenses._tokens(x)})
    texts = ["license " + " ".join(dice.choices([*vocabulary, "foo", "bar"], k=6)) for _ in range(60)]
    texts += [t for ts in licenses.TEMPLATES.values() for t in ts]
    rows, unknown = licenses.template_vectors()
    idf = {t: i for _, _, t, _, i in rows}
    expected = {}
    for text in texts:
        vector = {t: c * idf.get(t, unknown) for t, c in Counter(licenses._tokens(text)).items()}
        length = math.sqrt(sum(w * w for w in vector.values()))
        cosines = Counter()
        for name, number, token, weight, _ in rows:
            cosines[name, number] += vector.get(token, 0) * weight / length
        best = max(round(c, 9) for c in cosines.values())
        if best >= licenses.LEAST_COSINE:
            expected[text] = (min(n for (n, _), c in cosines.items() if round(c, 9) == best), best)
    found = spark.createDataFrame([(t,) for t in texts], "passage STRING")
    ours = {r.passage: (r.license, r.similarity) for r in licenses.closest_templates(spark, found).collect()}
    assert ours.keys() == expected.keys()
    for text, (name, cosine) in expected.items():
        assert ours[text][0] == name and ours[text][1] == pytest.approx(cosine, abs=2e-9)


def test_words_that_come_again_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MEMO", 3)
    codec = sentence_pieces.Codec(sentence_pieces.public_model())
    searched, plain = [], codec._stretch
    monkeypatch.setattr(codec, "_stretch", lambda text: (searched.append(text), plain(text))[1])
    texts = ["some common words", "common words again", "more common words"]
    ids = [codec.encode(text) for text in texts]
    assert len(searched) == len(set(searched)) == 5
    fresh = [sentence_pieces.Codec(codec.path).encode(text) for text in texts]
    assert ids == fresh and len(codec.words) <= 3 + 3
