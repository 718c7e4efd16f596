"""Main text of pages: labelled elements, broken markup, templates of hosts without an article element."""

import random

import pytest
from pyspark.sql import functions as F

from barloom.llm import templates
from tests.llm.brute import page_text

SCHEMA = "page_id long, url string, html string"
SEMANTIC = """<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var t="</article><p>no</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=/a>One<li><a href=/b>Two</ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>{0}</h1><p><b>Fir</b>st &amp; &#233;t&eacute;<br>line<p>{1}<aside>See also</aside><div class='ad'>Buy</div><form>Mail <input></form>
<section id=comments><article>I disagree</article></section></article><footer>&copy; me</footer>"""


def text_of(source, template=(), container=None):
    return templates.main_text(templates.read_page(source), set(template), container)


def test_labels_entities_and_blocks():
    assert text_of(SEMANTIC.format("A  title", "Second\n para")) == "A title First & été line Second para"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>one<p>two", "one two"),
        ("a < b <i>c</i>d", "a < b cd"),
        ("<nav><ul><li>menu<article>body</article>", "body"),
        ("<article>x</div></p>y<!-- gone", "xy"),
        ("<article><p hidden>no</p><p style='display: none'>no</p>yes</article>", "yes"),
        ("<main><p>kept</p></main><div>not</div>", "kept"),
        ("<article>short</article><article>the longer article</article>", "the longer article"),
        ("<div class='headerless'>stays</div>", "stays"),
        ("<article>unclosed <a href=\"x>quote", "unclosed quote"),
        ("<textarea><article>no</article></textarea><p>yes", "yes"),
    ],
)
def test_broken_and_odd_markup(source, text):
    assert text_of(source) == text


def soup(k, words):
    """A page of plain divs, without article, labels or semantic elements."""
    body = "".join(f"<p>{' '.join(words.choices('alpha beta gamma delta epsilon zeta eta theta'.split(), k=30))} {k}</p>" for _ in range(words.randint(2, 6)))
    menu = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(words.randint(2, 5)))
    return (
        f"<html><body><div class=top><ul>{menu}</ul></div><div class=wrap><div class=left><p>Written by the staff</p></div>"
        f"<div class=story><p>All rights are with us</p>{body}</div><div class=right><p>Call us now</p></div></div></body></html>",
        body,
    )


def test_template_of_a_host_without_article_elements(spark):
    words = random.Random(4)
    made = {k: soup(k, words) for k in range(12)}
    rows = [(k, f"https://u:p@Host.example:80/{k}", source) for k, (source, _) in made.items()]
    found = templates.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in found:
        assert r.text == " ".join(made[r.page_id][1].replace("<p>", " ").replace("</p>", " ").split())
    known = templates.host_templates(spark.createDataFrame([("h", *r[1:]) for r in rows], "host string, url string, html string")).first()
    staff = templates.read_page(made[0][0]).blocks
    assert set(next(b.keys for b in staff if b.text == "All rights are with us")) <= set(known.template)
    assert known.container == next(b.within[-2][0] for b in staff if "alpha" in b.text or "beta" in b.text)


def test_classes_equal_a_plain_count_of_vectors(spark):
    words = random.Random(5)
    sources = [soup(k, words)[0] for k in range(7)]
    pages = [templates.read_page(s).tokens for s in sources]
    vectors = {}
    for key in {t for p in pages for t in p}:
        vectors.setdefault(tuple(p.count(key) for p in pages), set()).add(key)
    plain = {frozenset(v) for k, v in vectors.items() if sum(map(bool, k)) >= 3.5 and len(v) >= 3 and any(t for _, t in v)}
    rows = spark.createDataFrame([("h", str(k), s) for k, s in enumerate(sources)], "host string, url string, html string")
    found = templates.classes(templates.page_tokens(rows)).first().classes
    assert {frozenset((m.key, m.tag) for m in c.members) for c in found} == plain


def test_a_host_of_copies_keeps_its_article(spark):
    source = SEMANTIC.format("Copy", "the same on all")
    rows = [(k, f"http://h/{k}", source) for k in range(9)] + [(9, "http://h/9", "<article><h1>Other</h1>text</article>")]
    found = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {found[k] for k in range(9)} == {"Copy First & été line the same on all"}


def test_every_page_of_a_table_equals_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r.page_id: r.text for r in templates.extract(pages).collect()}
    assert found == {r.page_id: page_text(r.html) for r in pages.collect()}


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, None, None), (None, "http://h/", "<p>x"), (2, "http://h/", ""), (2, "http://h/", ""), (3, "not a url", "<p>" + "long word " * 50000)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("host", "template", "container", "text", "key")})
    found = templates.extract(pages).collect()
    assert sorted((str(r.page_id), r.text[:9]) for r in found) == [("1", ""), ("2", ""), ("2", ""), ("3", "long word"), ("None", "x")]
    assert len(next(r.text for r in found if r.page_id == 3)) == 499_999
    empty = templates.extract(pages.limit(0))
    assert empty.columns == ["page_id", "url", "text"] and empty.isEmpty()
