"""Trained operators by held-out accuracy, and the extraction of main texts."""

import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetable.llm import boosting, html_text, langid, quality_model
from facetable.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_boosting_learns_and_is_flat():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 4))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(int)
    forest = boosting.train(rows[:2000], labels[:2000])
    assert ((forest.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.97
    # The arrays say the same as a walk from node to node.
    for row in rows[2000:2050]:
        total = forest.start
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + (row[f[k]] > t[k])
            total += leaf[k - len(f)]
        assert total == pytest.approx(forest.raw(row[None])[0])


def test_boosting_over_a_table_equals_that_of_its_rows(spark):
    """Rows with a count are as many rows; more values than bins, and features of one value."""
    rng = np.random.default_rng(4)
    rows = np.column_stack([rng.integers(0, 5, 400), rng.integers(0, 300, 400), np.ones(400), rng.integers(0, 2, 400)])
    rows = rows.astype(float)
    labels = ((rows[:, 0] > 2) ^ (rows[:, 1] > 140)) & (rows[:, 3] == 1) | (rng.random(400) < 0.05)
    times = rng.integers(1, 4, 400)
    some = [(r.tolist(), bool(y), int(n) * boosting.UNIT) for r, y, n in zip(rows, labels, times, strict=True)]
    table = spark.createDataFrame(some, "x array<double>, y boolean, units bigint")
    want = boosting.train(np.repeat(rows, times, 0), np.repeat(labels, times), trees=3, depth=3)
    got = boosting.train_over(table, 4, trees=3, depth=3)
    assert got.start == pytest.approx(want.start) and got.raw(rows) == pytest.approx(want.raw(rows), abs=1e-6)
    assert got.leaf.std() > 0
    again = boosting.train_over(table.repartition(5).orderBy("units"), 4, trees=3, depth=3)
    assert np.array_equal(again.leaf, got.leaf) and np.array_equal(again.threshold, got.threshold)


@pytest.mark.parametrize("labels", [[], [True, True], [False]])
def test_boosting_over_a_table_without_two_labels(spark, labels):
    table = spark.createDataFrame([([0.0, 1.0], y, boosting.UNIT) for y in labels], "x array<double>, y boolean, units bigint")
    assert boosting.train_over(table, 2).start == boosting.train(np.zeros((len(labels), 2)), np.array(labels)).start


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 0]])
def test_boosting_without_two_labels(labels):
    forest = boosting.train(np.zeros((len(labels), 3)), np.array(labels))
    assert 0 < forest.score(np.zeros((2, 3)))[0] < 1


def test_statistics_equal_those_by_hand(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts += [None, "", " \n ", "A", "a b\na b\n\nC! é🙂 1,2 {x} \u2028 y\x1cz", "x" * 5000, "\t\x0b", "WORD WORD word."]
    for text in texts:
        assert quality_model.statistics(text) == pytest.approx(brute.statistics(text), rel=1e-12)


def test_quality_scores_equal_a_walk_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    forest = quality_model.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for r in quality_model.score(docs, forest).limit(80).collect():
        row, total = brute.statistics(r.text), forest.start
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + (row[f[k]] > t[k])
            total += leaf[k - len(f)]
        assert r.score == pytest.approx(1 / (1 + np.exp(-total))) and r.predicted == (r.score >= 0.3)


def test_languages_equal_those_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = langid.fit(docs, F.col("doc_id") % 5 == 0, per_lang=20)
    texts = [r.text for r in docs.where("length(text) < 900").limit(12).collect()]
    texts += [None, "", "123 4!", "é", "x" * langid.WINDOW, "ab " * 100]
    langs, scores = langid.identify_batch(texts, network)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        expected = brute.language(text, network, langid.WINDOW)
        assert lang == expected[0] and score == pytest.approx(expected[1], rel=1e-3)


def test_repeated_ids_do_not_enlarge_the_samples(spark, monkeypatch):
    """A thousand rows of one id reach the driver as one."""
    docs = [(1, f"one id and text {k} of it", "en") for k in range(1000)]
    docs += [(k, f"other words {k} here", "en" if k % 2 else "de") for k in range(2, 40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id bigint, quality int")
    sizes = []
    monkeypatch.setattr(boosting, "train", lambda x, y, **k: sizes.append(len(x)))
    monkeypatch.setattr(langid, "train", lambda windows, *a, **k: sizes.append(len(windows)))
    quality_model.fit(frame, labels)
    langid.fit(frame, F.lit(True))
    assert sizes[0] <= 39 and sizes[1] <= 39 * langid.WINDOWS


def test_quality_on_held_out_documents(spark):
    rows = QUERIES["op2_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows.count() == docs.count()
    assert rows.where("score < 0 OR score > 1 OR (score >= 0.3) <> (predicted = 1)").count() == 0
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    assert rows.where(F.col("held_out") != fold).count() == 0
    held = rows.where("held_out").join(labels, "doc_id")
    right = held.where("predicted = quality").count() / held.count()
    assert right > 0.95


def test_language_on_held_out_documents(spark):
    rows = QUERIES["op3_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    assert rows.where(F.col("held_out") != fold).count() == 0
    held = rows.where("held_out").join(docs, "doc_id")
    assert held.where("lang = lang_pred").count() / held.count() > 0.97
    assert rows.where("score < 0 OR score > 1").count() == 0


def test_language_looks_at_the_whole_text():
    windows = langid.windows_of(b"x" * 300)
    assert windows.shape == (3, langid.WINDOW) and (windows != 0).sum() == 300


def test_language_gradient_reduces_the_loss():
    rng = np.random.default_rng(1)
    a = rng.integers(97, 105, (200, 32)).astype(np.uint8)
    b = rng.integers(105, 113, (200, 32)).astype(np.uint8)
    network = langid.train(np.concatenate([a, b]), np.repeat([0, 1], 200), ["a", "b"], epochs=3)
    p = network.probabilities(np.concatenate([a, b]))
    assert (p.argmax(1) == np.repeat([0, 1], 200)).mean() > 0.98
    # By filters instead of tables.
    x = network.embedding[a[0]]
    pooled = []
    for f, bias in zip(network.filters, network.biases, strict=True):
        out = [np.einsum("wd,wdf->f", x[i : i + len(f)], f) for i in range(len(x) - len(f) + 1)]
        pooled.append(np.maximum(np.max(out, axis=0) + bias, 0))
    logits = np.concatenate(pooled) @ network.out + network.out_bias
    e = np.exp(logits - logits.max())
    assert p[0] == pytest.approx(e / e.sum(), rel=1e-3)


def test_language_of_odd_texts(spark):
    docs = [(i, f"the and of {i} thing", "en") for i in range(40)] + [(100 + i, f"der die das {i}", "de") for i in range(40)]
    docs += [(500, None, "en"), (501, "", None), (502, "123 !!", "en"), (503, "the and of 77 thing", None), (None, "das", "de")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    network = langid.fit(frame, F.col("doc_id").isNotNull())
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame.drop("lang"), network).collect()}
    assert got[500] == got[501] == got[502] == ("und", 0.0)
    assert got[503][0] == "en" and got[1][0] == "en" and got[101][0] == "de"
    nothing = langid.fit(frame, F.lit(False))
    assert nothing is None
    assert {r.lang_pred for r in langid.identify(frame.drop("lang"), nothing).collect()} == {"und"}


def test_quality_without_labels(spark, none):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    forest = quality_model.fit(docs, labels)
    assert {r.score for r in quality_model.score(docs, forest).collect()} == {0.5}
    assert quality_model.score(none, forest).count() == 0


# Main texts


def article(page):
    """The text of the article element, for pages built like those of the table."""
    inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_main_text_of_the_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op4_html_text"](spark, SF).collect()
    assert {r.page_id: r.text for r in got} == {k: article(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<nav><ul><li><a href=/>Home</a></ul></nav>", ""),
        ("<p>a&nbsp;b &amp; &eacute;&#233; &lt;c<br>d</p>\n <p> e\n\tf</p>", "a b & éé <c d\n\ne f"),
        ("<main><h1>T</h1><p>x<script>if (a<b) {}</script>y</p><style>p{}</style></main>", "T\n\nxy"),
        ("<main><p>text</p><form>Name <input></form><div class='cookie-notice'>ok?</div></main>", "text"),
        ("<header>Site</header><article><header><h1>T</h1></header><p>text</p>"
         "<section id=comments><p>first!</p></section></article><aside>more</aside>", "T\n\ntext"),
        ("<div class='ad'>buy</div><div class=content><h2>A</h2><p>Long enough text</p></div><footer>f</footer>",
         "A\n\nLong enough text"),
        ("<article><p>one<p>two<ul><li>three<li>four</ul>five", "one\n\ntwo\n\nthree\n\nfour\n\nfive"),
        ("<article><!-- note --><p>a<b>b</b>c <i>d</i></article", "abc d"),
        ("<body class='with-sidebar'><p>kept here</p></body>", "kept here"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_smoothing_keeps_a_constant():
    assert html_text.smooth(np.full(9, 3.0)) == pytest.approx(np.full(9, 3.0))


LONG = "A paragraph of the text that goes on for quite a while, so that it has many characters for each tag."
TEXT = [f"{LONG} {k}" for k in range(4)]


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # The text in a plain div beside the teaser of another article.
        (f"<div><h1>T</h1>{paragraphs(*TEXT)}</div><div><article><h3><a href=/>Other</a></h3><p>Short</p></article></div>",
         ["T", *TEXT]),
        # A list of links, a notice and a teaser in the main element, without any mark.
        (f"<main><h1>T</h1>{paragraphs(*TEXT)}<ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></main>", ["T", *TEXT]),
        (f"<main><div><p>Soon</p><p>We move</p><p>in May</p></div><div>{paragraphs(*TEXT)}</div></main>", TEXT),
        (f"<main><div>{paragraphs(*TEXT)}</div><div><h3>Next</h3><p>Some more</p><p>by us</p><a href=/c>Read</a></div></main>",
         TEXT),
        # Short parts of an article, single links among them, stay.
        (f"<article>{paragraphs(*TEXT)}<section><h2>End</h2><p>Bye.</p><p>See</p><p><a href=/>this report</a></p></section></article>",
         [*TEXT, "End", "Bye.", "See", "this report"]),
        (f"<article><div><h1>T</h1></div><div>{paragraphs(*TEXT)}</div></article>",
         ["T", *TEXT]),
    ],
)
def test_ratios_decide_on_pages_with_an_article(page, text):
    assert html_text.main_text(page).split("\n\n") == text


@pytest.mark.parametrize(
    "name",
    ["ad-container", "comment-body", "comment-content", "reply-content", "sidebar-content", "cookie-container",
     "newsletter-wrapper", "promo-row", "nav-wrapper", "container comments", "post-comments", "main-nav", "ad_row"],
)
def test_names_that_begin_with_a_mark_are_no_content(name):
    page = f"<article>{paragraphs(*TEXT)}<div class='{name}'>{paragraphs(LONG)}</div></article>"
    assert html_text.main_text(page).split("\n\n") == TEXT


@pytest.mark.parametrize(
    "name",
    ["with-sidebar", "has-ads", "no-comments", "layout-with-sidebar", "main-sidebar", "content-sidebar-wrap",
     "post comments-open", "without_nav"],
)
def test_names_of_frames_are_content(name):
    page = f"<article><div class='{name}'>{paragraphs(*TEXT)}</div></article>"
    assert html_text.main_text(page).split("\n\n") == TEXT


@pytest.mark.parametrize(
    "part",
    [
        f"<section id='related-work'><h2>Related work</h2>{paragraphs(LONG)}</section>",
        f"<section id='tags'>{paragraphs(LONG)}</section>",
        f"<h2 id='search'>Search</h2>{paragraphs(LONG)}",
        f"<h2 id='comments'>Comments</h2>{paragraphs('Few.')}",
        f"<div class='notice-and-consent'><h2>Notice and consent</h2>{paragraphs(LONG)}</div>",
        f"<p>Of <span id='search'>search</span> {LONG}</p>",
    ],
)
def test_ids_made_of_headings_drop_nothing(part):
    page = f"<article>{paragraphs(*TEXT)}{part}{paragraphs(LONG)}</article>"
    parts = [" ".join(re.sub("<[^>]*>", " ", x).split()) for x in re.split("</(?:p|h2)>", part)]
    assert html_text.main_text(page).split("\n\n") == [*TEXT, *filter(None, parts), LONG]


@pytest.mark.parametrize(
    "part",
    [
        "<section id='comments'><p>first!</p><p>me too</p></section>",
        "<section id='share'><h2>Share</h2><p><a href=/>by mail or in any other way</a></p></section>",
        f"<section id='comments' class='comments'><h2>Comments</h2>{paragraphs(LONG)}</section>",
    ],
)
def test_ids_with_another_sign_drop_their_part(part):
    assert html_text.main_text(f"<article>{paragraphs(*TEXT)}{part}</article>").split("\n\n") == TEXT


ITEMS = "".join(f"<li>item {k}</li>" for k in range(12))
ITEM_TEXTS = [f"item {k}" for k in range(12)]
LINKED = "".join(f"<li><a href=/{k}>A report of the year {k}</a></li>" for k in range(3))
LINK_TEXTS = [f"A report of the year {k}" for k in range(3)]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='elementor-widget'>{paragraphs(*TEXT)}</div>", TEXT),
        (f"<div class='page-widget-wrap'><div class='elementor-widget'>{paragraphs(*TEXT)}</div></div>", TEXT),
        (f"<article><div class='widget-text'>{paragraphs(*TEXT)}</div></article>", TEXT),
        (f"<div class='social-science-article'>{paragraphs(*TEXT)}</div>", TEXT),
        (f"<article class='x'><div class='social-science-article'>{paragraphs(*TEXT)}</div></article>", TEXT),
        # Compounds that end with a mark empty no page.
        (f"<div class='layout-promo'>{paragraphs(*TEXT)}</div>", TEXT),
        (f"<div class='all-comments'>{paragraphs(*TEXT)}</div><p>x</p>", ["x"]),
        (f"<article>{paragraphs(*TEXT)}<div><ul>{ITEMS}</ul></div></article>", [*TEXT, *ITEM_TEXTS]),
        (f"<article>{paragraphs(*TEXT)}<ul>{ITEMS}</ul></article>", [*TEXT, *ITEM_TEXTS]),
        (f"<article><div>{paragraphs(*TEXT)}</div><div><ul>{ITEMS}</ul></div></article>", [*TEXT, *ITEM_TEXTS]),
        (f"<article>{paragraphs(*TEXT)}<h2>References</h2><ul>{LINKED}</ul></article>", [*TEXT, "References", *LINK_TEXTS]),
        (f"<article>{paragraphs(*TEXT)}<div><h2>References</h2><ol>{LINKED}</ol></div></article>",
         [*TEXT, "References", *LINK_TEXTS]),
        (f"<article>{paragraphs(*TEXT)}<ul>{LINKED}</ul></article>", TEXT),
        (f"<article>{paragraphs(*TEXT)}<pre>run <span class='tags'>important code</span> now</pre></article>",
         [*TEXT, "run important code now"]),
        (f"<article><p class='byline'>By A. Writer</p>{paragraphs(*TEXT)}</article>", ["By A. Writer", *TEXT]),
        (f"<article>{paragraphs(*TEXT)}<p><label>Figure</label> one: <math><mi>x</mi></math></p>"
         "<p><object data=a>the words of the chart</object></p></article>",
         [*TEXT, "Figure one: x", "the words of the chart"]),
        (f"<article>{paragraphs(*TEXT)}<p style='display: none'>{LONG}</p><p hidden>{LONG}</p></article>", TEXT),
        (f"<article>{paragraphs(*TEXT)}<p>Word <span class='ad'>buy</span> {LONG}</p></article>", [*TEXT, f"Word {LONG}"]),
    ],
)
def test_marks_empty_no_page_and_lists_stay(page, text):
    assert html_text.main_text(page).split("\n\n") == text


@pytest.mark.parametrize("opened", ["<div class='widget-area'>", "<p><b>", "<div>", "<p><div>", "<ul><li>"])
def test_deep_nesting_takes_time_in_proportion(opened):
    tags = opened.count("<")
    page = opened * (10_000 // tags) + LONG
    start = time.perf_counter()
    html_text.main_text(f"<p>{LONG}</p>{page}")
    assert time.perf_counter() - start < 1.0
