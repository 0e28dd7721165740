from opslog.llm.html_blocks import blocks
from opslog.llm.html_extract import default_model, extract_pages, features, labelled_pages, main_text, mark, viterbi

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div class="cookie-banner"><p>We use cookies, and we tell you so in a long sentence.</p></div>
<header><h1>Site</h1></header><nav class=menu><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>
<article><h1>A title</h1><p>First &amp; foremost,   a
line<br>of text.<p>Second <b>bold.<aside class="related"><p>Read also this long story about something else.</p></aside>
<p>Third one.</p></article>
<section id="comments"><p>I think this is a great article, thank you.</p></section>
<form><label>Mail</label><p>Sign up for more.</p></form><footer>&copy; Us</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text(PAGE, default_model()) == "A title\nFirst & foremost, a line of text.\nSecond bold.\nThird one."


def test_held_out_pages():
    right = wrong = missed = 0
    model = default_model()
    for source, main in labelled_pages(200, 991):
        found = blocks(source)
        truth = mark(found, main)
        assert sum(truth) == len(main)
        got = viterbi(model.emissions(features(found)), model.step, model.first)
        right += sum(a and b for a, b in zip(truth, got, strict=True))
        wrong += sum(b and not a for a, b in zip(truth, got, strict=True))
        missed += sum(a and not b for a, b in zip(truth, got, strict=True))
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_viterbi_is_the_best_of_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    for n in range(1, 8):
        score, step, first = rng.normal(size=(n, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
        total = lambda p: first[p[0]] + sum(score[i, y] for i, y in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert viterbi(score, step, first) == list(best)


def test_broken_markup_loses_no_text():
    got = [b.text for b in blocks("a<p>b<p>c</div>d<b>e</p>f<!-- x --><![CDATA[g]]><p>h<")]
    assert "".join("".join(got).split()) == "abcdefgh<"


def test_hidden_and_raw_elements_say_nothing():
    page = "<p>a</p><div hidden><p>b</p></div><script>c<p>d</p></script><template><p>e</p></template><p style='display:none'>f</p><p>g"
    assert [b.text for b in blocks(page)] == ["a", "g"]


def test_only_attributes_hide():
    page = ('<p title="a hidden gem in Rome">a</p><p data-note="display: none">b</p><p alt=\'aria-hidden="true"\'>c</p>'
            '<p HIDDEN>d</p><p hidden="until-found">e</p><p aria-hidden=true>f</p><p style="color:red; display : NONE">g</p>'
            '<p data-class="menu" class="Main storyText">h</p>')
    found = blocks(page)
    assert [b.text for b in found] == ["a", "b", "c", "h"]
    assert found[-1].names == ("main", "story", "text")


def test_formulas_and_objects_are_text():
    page = ("<p>Let <math><semantics><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></semantics></math> be.</p>"
            "<object data=f><p>Inside.</p></object>")
    assert [b.text for b in blocks(page)] == ["Let x2 be.", "Inside."]


def test_open_elements_without_text():
    for tag in ("noscript", "iframe", "textarea", "video", "template", "svg"):
        assert [b.text for b in blocks(f"<p>a</p><{tag}><p>b</p><p>c</p>")] == ["a", "b", "c"], tag
    assert [b.text for b in blocks("<p>a</p><noscript><p>b</p><noscript>x</noscript><p>c</p>")] == ["a", "b", "c"]
    assert [b.text for b in blocks("<p>a</p><svg><svg>x</svg><p>b</p>")] == ["a", "b"]
    assert [b.text for b in blocks("<p>a</p><script>x<p>b</p>")] == ["a"]
    assert len(blocks("<p>a</p><noscript>" * 20_000)) == 20_000


def test_article_with_all_of_these():
    page = """<html><body><nav><a href=/>Home</a> <a href=/b>More</a></nav><article><h1>A walk through the city</h1>
<p title="a hidden gem in Rome">The first paragraph tells of a small square behind the market.</p>
<p>The second has a formula, <math><mi>a</mi><mo>=</mo><mi>b</mi></math>, in the middle of a sentence.</p>
<noscript><p>The third paragraph stands behind an element that nobody closed.</p></article>
<footer>&copy; Us</footer></body></html>"""
    assert main_text(page, default_model()).split("\n") == [
        "A walk through the city", "The first paragraph tells of a small square behind the market.",
        "The second has a formula, a=b, in the middle of a sentence.",
        "The third paragraph stands behind an element that nobody closed."]


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p></p>"), (3, "u", PAGE), (3, "u", PAGE),
            (4, "u", "<article>" + "<p>Some words in a row, and more.</p>" * 5000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract_pages(df).collect())
    assert got[0] == (0, "", 0) and got[1] == (1, "", 0) and got[2] == (2, "", 0)
    assert got[3] == got[4] and got[5][1].count("\n") == 4999
    assert all(n == len(t) for _, t, n in got)
    assert extract_pages(df.limit(0)).count() == 0
