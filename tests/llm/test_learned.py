"""Language mixture, quality score and page extraction: held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
import pytest

from tests.llm.fixtures import DOCUMENTS, documents, with_clashes
from tillbook.llm import boosting, extract, langid, quality
from tillbook.llm.dom import FEATURES, Page, features

SF_DIR = "/root/testdata/sf0.01"


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_languages_held_out(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    true = {r.doc_id: (r.lang, r.text) for r in rows.collect()}
    found = langid.identify_held_out(rows).collect()
    assert sorted(r.doc_id for r in found) == sorted(true)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == true[r.doc_id][0] for r in held]) >= 0.97


def test_only_learning_rows_teach(spark):
    """A language that only held-out rows have is never predicted."""
    held, other = ([i for i in range(90) if (remainder(i, 3) == 1) == h] for h in (True, False))
    rows = [(i, "zzxx qqyy xxqq " * 5, "zz", "s", 0) for i in held] + [(i, "the house and river", "en", "s", 0) for i in other]
    found = langid.identify_held_out(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert {r.lang_pred for r in found} == {"en"}


def test_mixture_of_two_languages(model):
    rows = {"en": "the that there ing of and then with her this are was " * 12, "de": "der die das und nicht schie einen lich zu keit ung " * 12}
    both, = langid.infer(model, [rows["en"] + rows["de"]])[0]
    chosen = {model.languages[k] for k in np.flatnonzero(both)}
    assert chosen == {"en", "de"} and both.sum() == pytest.approx(1)
    for lang, text in rows.items():
        one, = langid.infer(model, [text])[0]
        assert [model.languages[k] for k in np.flatnonzero(one)] == [lang]


def test_mixture_equals_plain_expectation_maximisation(model):
    buckets, counts = langid.trigram_counts("the river und der Fluss le fleuve")
    pi = np.full(len(model.languages), 1 / len(model.languages))
    for _ in range(langid.ROUNDS):
        new = np.zeros_like(pi)
        for b, c in zip(buckets, counts):
            share = pi * model.table[b]
            new += c * share / share.sum()
        pi = new / counts.sum()
    assert langid.infer(model, ["the river und der Fluss le fleuve"])[1][0] == pytest.approx(pi)


def test_language_edge_cases(spark, model):
    texts = [None, "", "123 !? \n", "a", "the and of " * 20000, "the and of", "the and of"]
    df = with_clashes(documents(spark, texts, [0, 1, 2, 3, None, 5, 5]))
    found = langid.identify(df, model).collect()
    assert [(r.lang_pred, r.score, r.languages) for r in found if r.doc_id in (0, 1, 2)] == [("und", 0.0, {})] * 3
    assert len(found) == 7 and {r.lang_pred for r in found if r.doc_id in (None, 5)} == {"en"}
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == 4
    none = spark.createDataFrame([], DOCUMENTS)
    assert langid.identify(none, model).collect() == [] == langid.identify_held_out(none).collect()
    untaught = documents(spark, ["text without language", "12", None])
    assert [r.lang_pred for r in langid.identify_held_out(untaught).collect()] == ["und"] * 3
    assert [r.doc_id for r in langid.keep_identified(untaught, langid.learn(untaught)).collect()] == [0]


def test_quality_held_out(spark):
    rows, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    true = {r.doc_id: r.quality for r in labels.collect()}
    found = quality.score_held_out(rows, labels).collect()
    assert len(found) == rows.count()
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0) for r in found)
    held = [(r.score, true[r.doc_id]) for r in found if r.held_out and r.doc_id in true]
    good, bad = ([s for s, q in held if q == v] for v in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.95
    assert np.mean([s >= 0.3 for s in good]) >= 0.97


def test_quality_edge_cases(spark):
    schema = "doc_id long, quality int, toxic int"
    df = with_clashes(documents(spark, [None, "", "  ", "word", "a b " * 50000, "x", "x"], [0, 1, 2, 3, None, 5, 5]))
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (3, 1, 0), (None, 1, 0), (5, None, 0), (1, 0, 0), (77, 1, 1)], schema)
    model = quality.learn(df, labels)
    assert len(quality.score(df, model).collect()) == 7
    assert quality.keep_good(df, model).columns == df.columns
    none = spark.createDataFrame([], schema)
    assert quality.learn(df, none) is None
    assert {r.score for r in quality.score(df, None).collect()} == {0.5}
    assert quality.keep_good(df, None).count() == 7
    assert quality.score_held_out(spark.createDataFrame([], DOCUMENTS), labels).collect() == []


def test_partition_sums_give_the_ridge_solution(spark):
    rows, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(rows, labels)
    texts = {r.doc_id: r.text for r in rows.collect()}
    from pyspark.sql import functions as F

    fits = [r.doc_id for r in labels.select("doc_id").where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) > 0).collect()]
    good = {r.doc_id: r.quality for r in labels.collect()}
    z = model.features(np.array([quality.statistics(texts[i]) for i in fits]))
    y = np.array([good[i] for i in fits], float)
    n = len(good)
    w = np.linalg.solve(z.T @ z / n + quality.RIDGE * np.eye(z.shape[1]), z.T @ y / n)
    assert z @ w == pytest.approx(model.raw(np.array([quality.statistics(texts[i]) for i in fits])), abs=1e-6)


def test_isotonic():
    values, shares = quality.isotonic(np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.0]), np.ones(6))
    assert list(shares) == sorted(shares) and shares[0] == 0 and len(shares) < 6
    assert list(values) == sorted(values)


def test_kernel_is_approximated():
    random_ = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    model = quality.Model(np.zeros(d), np.ones(d), random_.normal(size=(d, 4000)) / quality.BANDWIDTH, random_.uniform(0, 2 * np.pi, 4000), None, None, None)
    x = random_.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert z @ z.T == pytest.approx(np.exp(-far / (2 * quality.BANDWIDTH**2)), abs=0.08)


@pytest.fixture(scope="module")
def trees(spark):
    return extract.learn(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


ARTICLE = "<h1>A &lt;title&gt;</h1><p>First&nbsp;paragraph of\n the <b>story</b>, with <a href=x>a link</a>.<br>Same block, and some more words to read.<p>Second one, without an end tag, also of some length."


def test_parts_in_other_markup(trees):
    other = '<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>'
    comments = '<section id="comments"><h3>2 comments</h3><p>What a story, I have read it twice, thank you for it.</p></section>'
    expected = "A <title>\n\nFirst paragraph of the story, with a link. Same block, and some more words to read.\n\nSecond one, without an end tag, also of some length."
    for before, main, after in (
        (other, f"<article>{ARTICLE}</article>", "<footer>&copy; site</footer>"),
        (f'<div class="cookie-notice"><p>We use cookies. Accept.</p></div>{other}', f'<div class="post-content">{ARTICLE}</div>', f"{comments}<footer>&copy; site</footer>"),
        (f"<header><p>The Site</p></header>{other}", f"<main>{ARTICLE}</main>", '<aside class="sidebar"><h3>Related</h3><ul><li><a href=1>Other</a></li></ul></aside><form><input name=q><button>Go</button></form>'),
    ):
        html = f"<html><head><title>t</title><style>p{{}}</style></head><body><script>var t='</p>';</script>{before}<!-- x -->{main}{after}</body></html>"
        assert extract.main_text(html, trees) == expected, html


def test_pages_own_articles(spark, trees):
    import re
    from html import unescape

    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = {r.page_id: r for r in extract.extract(with_clashes(rows), trees).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r.html, re.S)[1]
        assert found[r.page_id].text.split() == unescape(re.sub(r"<[^>]+>", " ", inner)).split()
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_page_edge_cases(spark, trees):
    htmls = [None, "", "plain text only", "<", "<p", "a < b", "<p title='x>y", "<div>" * 3000 + "deep" + "</div>" * 10, "<script>never closed", "&#x110000;&bogus;&amp", "<p>" + "long " * 200_000, "</p></div>"]
    schema = "page_id long, url string, html string, text string"
    df = spark.createDataFrame([(None if i == 3 else i % 9, None, h, "x") for i, h in enumerate(htmls)], schema)
    found = extract.extract(df, trees).collect()
    assert len(found) == len(htmls) and all(r.n_chars == len(r.text) for r in found)
    assert found[0].text == found[1].text == "" and found[2].text == "plain text only" and found[5].text == "a < b"
    assert extract.extract_main_text(spark.createDataFrame([], schema)).collect() == []
    assert len(extract.extract_main_text(df).collect()) == len(htmls)


def test_nothing_inside_a_dropped_element_is_kept():
    from tillbook.llm.dom import decode

    choose = random.Random(4)
    for _ in range(50):
        html = "".join(choose.choice(("<div>", "</div>", "<section>", "</section>", "<p>", f"t{k} ")) for k in range(25))
        page = Page(html)
        p = np.array([choose.random() for _ in page.tag[1:]])
        kept = list(decode(page, p))
        # the likeliest choice of all that keep the rule, by trying each
        best, texts = -1.0, None
        n = len(page.tag)
        if n > 12:
            continue
        for mask in range(1 << (n - 1)):
            keep = [True, *((mask >> k) & 1 == 1 for k in range(n - 1))]
            if all(keep[page.parent[k]] or not keep[k] for k in range(1, n)):
                value = float(np.prod([p[k - 1] if keep[k] else 1 - p[k - 1] for k in range(1, n)]))
                if value > best:
                    best, texts = value, [t for k, t, _ in page.blocks if keep[k]]
        assert kept == texts


def test_trees_learn_a_rule():
    random_ = np.random.default_rng(0)
    rows = random_.normal(size=(2000, 4)).astype(np.float32)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 2] > 0.5)).astype(float)
    trees = boosting.fit(rows[:1500], labels[:1500], np.ones(1500))
    assert ((trees.probability(rows[1500:]) > 0.5) == labels[1500:]).mean() > 0.93
    assert boosting.fit(rows[:5], np.ones(5), np.ones(5)).probability(rows[:3]) == pytest.approx([0.999] * 3)


@pytest.mark.parametrize("paragraphs", [63, 64, 500])
def test_sibling_statistics_of_wide_articles(paragraphs):
    """An advert in the middle and comments at the end are seen among their neighbours in any article."""
    advert, comments = "<aside><a href=x>Buy now</a></aside>", "<section>first comment</section>"
    body = [f"<p>{'w' * (k + 1)}</p>" for k in range(paragraphs)]
    body = [*body[: paragraphs // 2], advert, *body[paragraphs // 2 :], comments]
    page = Page(f"<html><body><article>{''.join(body)}</article></body></html>")
    rows = [dict(zip(FEATURES, row)) for row in features(page)]
    at = page.tag.index("article")
    family = [k for k in range(len(page.tag)) if page.parent[k] == at]
    assert len(family) == paragraphs + 2
    chars = [rows[k - 1]["all_chars"] for k in family]
    for place, k in enumerate(family):
        row = rows[k - 1]
        assert (row["rank"], row["siblings"]) == (place, paragraphs + 2)
        assert row["same_siblings"] == sum(all(rows[c - 1][f] == row[f] for f in FEATURES if f.startswith("is_")) for c in family)
        assert row["before_chars"] == (chars[place - 1] if place else 0) and row["after_chars"] == (chars[place + 1] if place + 1 < len(family) else 0)
    middle = family.index(page.tag.index("aside"))
    assert rows[family[middle + 1] - 1]["before_links"] == rows[family[middle - 1] - 1]["after_links"] == 1


@pytest.mark.parametrize("html, text", [
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p>", "Let x=1 be."),
    ("<p>a</p><svg width=1><path d='M0'/><p>b</p>", "a b"),
    ("<p>a<select><option>b</p><p>c</p>", "a b c"),
    ("<p>a <object data=x>shown instead</object> b</p>", "a shown instead b"),
    ("<p>a</p><object data=x><p>b</p>", "a b"),
    ("<p>a</p><math><p>b</p>", "a b"),
    ("<p>a<svg><text>drawn</text></svg>b</p><canvas>no<p>c</p>", "ab no c"),
    ("<p>a<script>if (x) {}</script>b</p>", "ab"),
])
def test_no_text_is_lost(html, text):
    assert " ".join(block[1] for block in Page(html).blocks) == text


def test_a_column_that_is_no_language_is_refused(spark):
    rows = spark.createDataFrame([(i, "the house", f"lang{i}", "s", 0) for i in range(40)], DOCUMENTS)
    with pytest.raises(ValueError, match="more than 30 different values"):
        langid.learn(rows, most_languages=30)
    assert len(langid.learn(rows, most_languages=40).languages) == 40
