import html
import re

import pytest
from llm.helpers import CLASHES
from pyspark.sql import functions as F

from clientgrain.llm import html_text
from clientgrain.llm.html_blocks import blocks

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def field():
    return html_text.trained()


def test_held_out_accuracy(field):
    right = total = 0
    for seed in range(50_000, 50_200):
        features, labels = html_text.labelled(seed)
        right += sum(a == b for a, b in zip(field.labels(features), labels))
        total += len(labels)
    assert right >= 0.985 * total


def test_articles_of_the_given_pages(spark):
    """The pages hold one article element each, which a pattern finds as well."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", page.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        row = got[page.page_id]
        assert " ".join(row.text.split()) == want and row.n_chars == len(row.text) and row.url == page.url


def test_blocks_of_broken_markup():
    page = ("<P>one <b>two<p>three &amp; four&nbsp;&#x41;&copy<!-- <p>no</p> --><script>if (a<b) '</p>'</script>five<li>six<br>seven"
            "<div title='a>b'>eight</div></ul></p>nine <a href=x>ten</a><style>no</style><unknown>eleven</unknown><p")
    assert [t for t, _ in blocks(page)] == ["one two", "three & four A©", "five", "six", "seven", "eight", "nine ten", "eleven"] or \
        [t for t, _ in blocks(page)] == ["one two", "three & four A©five", "six", "seven", "eight", "nine ten", "eleven"]


def test_reading_is_linear(field):
    for page in ("<" * 200_000, "<a " * 100_000, '<p title="' * 50_000, "<!--" * 50_000, "<div>" * 3_000 + "x", "&" * 100_000, "<p>" + "word " * 200_000 + "</p>"):
        html_text.main_text(field, page)


def test_awkward_rows(spark, field):
    text = "Some words of an article, long enough to be one. It has sentences, and a second line of thought."
    good = f"<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Title of it</h1><p>{text}</p></article><footer>© nobody</footer>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, "u", good), (4, "u", good), (4, "u", good), (5, "u", f"<article><p>{'word and word, ' * 60_000}.</article>")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(c).alias(c) for c in (*CLASHES, "text", "n_chars")])
    out = sorted((str(r.page_id), r.text, r.n_chars) for r in html_text.extract(df, field=field).collect())
    want = f"Title of it\n{text}"
    assert [o for o in out if o[0] != "5"] == [("1", "", 0), ("2", "", 0), ("3", "", 0), ("4", want, len(want)), ("4", want, len(want)), ("None", want, len(want))]
    assert [o[2] for o in out if o[0] == "5"] == [len(" ".join(f"{'word and word, ' * 60_000}.".split()))]
    assert html_text.extract(spark.createDataFrame([], SCHEMA), field=field).collect() == []


def test_exact_sums_and_decoding():
    """Marginals and Viterbi against the sum and the best over all label sequences."""
    import itertools
    import math
    field = html_text.ChainField()
    field.moves = [[0.3, -0.7], [-0.2, 0.9]]
    field.weights = {"a": 1.2, "b": -0.8}
    features = [["a"], ["b"], [], ["a", "b"], ["b"]]
    s = field.scores(features)

    def score(labels):
        return sum(field.moves[x][y] + (v if y else 0) for x, y, v in zip((0, *labels), labels, s))
    every = list(itertools.product((0, 1), repeat=5))
    total = sum(math.exp(score(y)) for y in every)
    ones, moved = field.marginals(s)
    for t in range(5):
        assert abs(ones[t] - sum(math.exp(score(y)) for y in every if y[t]) / total) < 1e-9
    want = sum(math.exp(score(y)) * sum(a == 0 and b == 1 for a, b in zip((0, *y), y)) for y in every) / total
    assert abs(moved[0][1] - want) < 1e-9
    assert tuple(field.labels(features)) == max(every, key=score)


SENTENCES = [f"Sentence {w} of an article says something, and then says a little more about it." for w in ("one", "two", "three")]


@pytest.mark.parametrize("tag", ["svg", "object", "noscript", "math", "iframe", "canvas", "template", "textarea", "select", "title"])
def test_unclosed_elements_lose_nothing_behind_them(field, tag):
    page = f"<nav><ul><li><a href=/>Home</a></ul></nav><article><p>{SENTENCES[0]}</p><{tag}><p>{SENTENCES[1]}</p><p>{SENTENCES[2]}</p></article><footer>© nobody</footer>"
    assert html_text.main_text(field, page) == "\n".join(SENTENCES)


def test_formulas_drawings_and_objects_stay_in_their_sentence(field):
    for shown, text in (("<math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math>", "x=2"), ("<svg class='nav'><title>no</title><path d='M0'/><text>mark</text></svg>", "mark"),
                        ("<noscript>plain</noscript>", "plain"), ("<object data=a><b>drawn</b></object>", "drawn"), ("<svg/>", ""), ("<canvas></canvas>", "")):
        page = f"<article><p>{SENTENCES[0]} We see {shown} in the text.</p><p>{SENTENCES[1]}</p></article>"
        want = f"{SENTENCES[0]} We see {text} in the text.\n{SENTENCES[1]}".replace("  ", " ")
        assert html_text.main_text(field, page) == want


def test_text_in_place_of_scripts_and_linked_items_of_an_article(field):
    items = ["The first work that the article names", "A second work", "Another long work that is named in it"]
    page = (f"<div class='menu'><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><article><h1>Title of it</h1><p>{SENTENCES[0]}</p><noscript><p>{SENTENCES[1]}</p></noscript>"
            f"<ul>{''.join(f'<li><a href=/{i}>{t}</a></li>' for i, t in enumerate(items))}</ul><p>{SENTENCES[2]}</p></article>"
            "<footer><ul><li><a href=/i>Imprint</a></ul></footer>")
    assert html_text.main_text(field, page).split("\n") == ["Title of it", *SENTENCES[:2], *items, SENTENCES[2]]
