"""HTML extraction, quality classifier, toxicity and the pipeline."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from papyra.llm import html_text, quality_classifier, toxicity
from papyra.llm.html_text import Page, extract_text
from tests.llm.test_neardup import brute_force

ARTICLE = "<h1>Title &amp; more</h1><p>A first   paragraph with a <a href=x>link</a> in it.<p>Second &lt;one&gt;.</p>"
TEXT = "Title & more\nA first paragraph with a link in it.\nSecond <one>."
AROUND = (
    "<html><head><title>T</title><script>var a='<p>no</p>'</script><style>p{}</style></head><body>"
    "<header><p>Site name and slogan</p></header><nav><ul><li><a href=1>One</a></li></ul></nav>"
    "<div class='cookie-notice'><p>We use cookies, and this is a long notice about all of them.</p></div>"
    "%s<aside><p>Side</p></aside><form><p>Mail</p><input></form>"
    "<div id=comments><article><p>A reader's comment that is longer than the text, by far and wide.</p></article></div>"
    "<footer><p>&copy; us</p></footer></body></html>"
)


@pytest.mark.parametrize("wrapped", [
    f"<article>{ARTICLE}</article>", f"<main><div>{ARTICLE}</div></main>", f"<div class=text>{ARTICLE}</div>",
    f"<div class='page with-sidebar'><article><header>{ARTICLE}</header></article></div>",
])
def test_main_text(wrapped):
    assert Page(AROUND % wrapped).main_text() == TEXT


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<!-- c --><p>x</p>", "x"), ("<script>x", ""),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"), ("a < b &lt; c", "a < b < c"), ("<p>cut <a hre", "cut"),
    ("<div>" * 5000 + "deep", "deep"), ("<p hidden>no</p><p>yes", "yes"), ("x<br>y", "x y"), ("<p>&nbsp;a&#233;</p>", "aé"),
])
def test_odd_sources(source, text):
    assert Page(source).main_text() == text


@pytest.mark.parametrize("source, text", [
    ("<p>I </3 it. <p>more</p>", "I more"), ("<p>a</>b</p><p>c", "ab\nc"), ("<p>a</ >b", "ab"),
    ("<p>a<img alt=Bob's>b</p><p>c", "ab\nc"), ("<p>a<img alt=Bob's>b</p><p>it's c", "ab\nit's c"),
    ("""<p class="a"">b</p><p>c""", "b\nc"), ("""<p>a<a href="x>b</a></p><p>c""", "ab\nc"),
    ("<p class = 'a>b'>c", "c"),
    ("<p title=a=\"b>c</p><p>d\"", 'c\nd"'), ("a <é b", "a <é b"), ("a </", "a </"), ("<!--><p>a", "a"),
    ("İ<script>x</SCRIPT ><p>a", "İ\na"), ("<p>İ<style>x</Style>a</p>" + "İ" * 9, "İa\n" + "İ" * 9),
    ("<script>x</ſcript></script>a", "a"), ("<script>'</scripts>'</script>a", "a"),
    ("<p>a<svg class=x />b</p>", "ab"), ("<p>a<svg><path>b</p>", "ab"), ("<p>a <math><mi>x</mi></math> b", "a x b"),
])
def test_broken_tags_cut_nothing(source, text):
    assert Page(source).main_text() == text


def test_broken_tags_take_linear_time():
    page = Page("""<a x="><b" y=\"""" * 100_000)
    assert len(page.tags) >= 100_000


BODY = "<h1>Title</h1>" + "".join(f"<p>Paragraph {i} of a text, longer than all that stands beside it.</p>" for i in range(9))
LINES = "\n".join(["Title"] + [f"Paragraph {i} of a text, longer than all that stands beside it." for i in range(9)])


@pytest.mark.parametrize("page", [
    *[f"<div class='{name}'><div>{BODY}</div></div>" for name in (
        "with-sidebar", "page has-sidebar", "share-enabled", "page-search", "sidebar", "search", "siteHeader",
        "comments-open", "related", "notice",
    )],
    f"<div><div class='entry-header'>{BODY[:14]}</div><div class=entry>{BODY[14:]}</div></div>",
    f"<form id=aspnetForm><div>{BODY}</div></form>", f"<form><article>{BODY}</article></form>",
    f"<form><fieldset><div>{BODY}</div></fieldset><div class=sidebar><p>Side</p></div></form>",
    f"<div title='a hidden gem' data-id=menu>{BODY}</div>",
])
def test_layout_around_the_text_is_no_extra(page):
    beside = (
        "<nav><a href=1>One</a></nav><div class='site-footer'><p>Us</p></div><div class='sidebar widget-list'><p>Side</p></div>"
        "<div class=related-posts><p>Others</p></div><form><p>Mail</p></form><div class='cookie-bar'><p>Cookies</p></div>"
    )
    assert Page(f"<body>{page}{beside}</body>").main_text() == LINES


def test_long_notices_and_comments_are_extras():
    long = "<p>Words of others, more than the text has.</p>" * 20
    for name in ("comments", "comment-list", "cookie-notice", "newsletter-signup"):
        assert Page(f"<body><div>{BODY}</div><div class={name}>{long}</div></body>").main_text() == LINES


def test_pages_of_the_table(spark, sf_dir):
    """Here every article is marked, and holds nothing else."""
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in extract_text(pages).collect()}
    for row in pages.collect():
        inner = re.search("<article>(.*)</article>", row.html, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inner.replace("<br>", " ")))
        lines = [" ".join(html.unescape(block).split()) for block in blocks]
        assert found[row.page_id] == "\n".join(line for line in lines if line)


def test_page_edges(spark):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p>x"), (2, "v", "<p>" + "word " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("z"))
    found = sorted((str(r.page_id), str(r.url), len(r.text)) for r in extract_text(pages).collect())
    assert found == [("1", "u", 0), ("1", "u", 0), ("2", "v", 249999), ("None", "None", 1)]
    assert extract_text(pages.limit(0)).collect() == []


def test_density_prefers_text_to_links():
    page = Page("<body><div><a>one two three</a><a>four five six</a></div><div><p>one two three four five six</p></div></body>")
    density = dict(zip(page.tags[-6:], page.densities()[-6:]))
    assert density["p"] > density["a"]


# --- toxicity ---

DOCS = "doc_id long, text string, lang string, source string"


def toxic_rows():
    """Toxic are texts with both an insult and a group; one alone is not."""
    rows, labels = [], []
    for i in range(1200):
        insult, group = i % 2 == 0, i % 4 < 2 and i % 3 == 0 or i % 5 == 0
        words = [f"word{(i * 7 + j) % 50}" for j in range(8)] + ["brute"] * insult + ["tribe"] * group
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(insult and group)))
    return rows, labels


def test_pairwise_interaction_is_learned(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, DOCS)
    machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.score(docs, machine).collect()}
    held = [i for i, _ in labels if found[i].held_out]
    assert len(held) > 200
    assert sum(found[i].predicted == label for i, label in labels if found[i].held_out) >= 0.98 * len(held)


def test_terms_that_count_only_in_pairs(spark):
    """Group words are as common in clean texts, and of two words that excuse an insult neither is toxic."""
    import random

    rng = random.Random(3)
    name = lambda n: "".join(chr(97 + n // 26**k % 26) for k in (2, 1, 0)) * 2
    insults, groups, excuses, plain = ([name(n) for n in span] for span in (
        range(3), range(10, 22), range(30, 33), range(100, 1100)
    ))
    rows, labels = [], []
    for i in range(3000):
        kind = rng.randrange(10)
        words = rng.choices(plain, k=40) + [rng.choice(insults)] * (kind < 4)
        words += [rng.choice(groups)] * (kind in (0, 1) or kind > 3) + [rng.choice(excuses)] * (kind in (1, 9))
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(kind == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.score(docs, machine).collect()}
    held = [(found[i].predicted, label) for i, label in labels if found[i].held_out]
    hits, toxic, said = sum(a and b for a, b in held), sum(b for _, b in held), sum(a for a, _ in held)
    assert toxic > 50 and hits >= 0.9 * toxic and hits >= 0.9 * said


def test_held_out_rows_of_the_table(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right >= 0.9


def test_toxicity_edges(spark):
    rows = [(1, None, "en", "s"), (None, "x", "en", "s"), (2**60 + 1, "", "en", "s"), (2**60 + 1, "a " * 90000, "en", "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("z"))
    for labels in ([], [(1, 1)], [(None, 1), (3, 0)]):
        machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        found = toxicity.score(docs, machine).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(docs.limit(0), machine).collect() == []


# --- quality classifier ---


def test_sparse_sites_shrink(spark):
    """Equal texts: a site with many bad documents lowers the score, one bad document hardly does."""
    text = " ".join(f"w{j}" for j in range(40))
    rows = [(i, text, "p", f"site{i % 10}") for i in range(1000)]
    rows += [(2000 + i, text, "p", "poor") for i in range(200)] + [(3000 + i, text, "p", "tiny") for i in range(2)]
    rows += [(4000, None, None, None), (None, "", "p", "poor"), (4000, "x", None, None)]
    labels = [(i, 1) for i in range(0, 1000, 2)] + [(2000 + i, 0) for i in range(150)] + [(3000, 0), (None, 1), (1, 7)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("host", F.lit(1)).withColumn("p", F.lit(2))
    found = quality_classifier.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(found) == len(rows)
    score = {r.doc_id: r.score for r in found}
    assert score[2199] < score[3001] < score[999]
    assert not any(r.kept for r in found if r.doc_id is not None and 2150 <= r.doc_id < 2200)


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "p", "s"), (2, None, "p", "s")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [round(r.score, 6) for r in quality_classifier.classify(docs, none).collect()] == [0.5, 0.5]
    assert quality_classifier.classify(docs.limit(0), none).collect() == []


# --- pipeline ---


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], sf_dir).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_scans", "packing"
    ]
    assert all(stage.columns == columns for stage in kept[:-1])
    rows = [[(r.doc_id, r.text) for r in stage.collect()] for stage in kept[:-1]]
    expected = {n for n, (_, c) in brute_force(rows[1]).items() if n == c}
    assert {n for n, _ in rows[2]} == expected and len(rows[2]) == len(expected)
    assert len(rows[0]) > len(rows[1]) > len(rows[2]) >= len(rows[3]) == len(rows[4])
    assert not any(re.search("[0-9a-f]{16}|AKIA[A-Z0-9]{14}", text) for _, text in rows[4])
    packed = kept[-1].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r.doc_id for r in packed} == {n for n, _ in rows[4]} and all(r.n == r.m for r in packed)
