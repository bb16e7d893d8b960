import pytest
from helpers import SF, frame

from changevault.llm import html, queries

CASES = {
    "": "",
    "plain": "plain",
    "<p>One<p>Two &amp; three<br>line": "One\n\nTwo & three\nline",
    "<h1>A <b>b</b></h1><div>c</div><div>d</div>": "A b\n\nc\nd",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=3><li>x</li><li>y</li></ol>after": "3. x\n4. y\n\nafter",
    "<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>": "Name      | Qty\napple pie | 3",
    "<table><thead><tr><td colspan=2>wide<tbody><tr><td>a<td>b</table>": "wide |\na    | b",
    "<table><tr><td>a<table><tr><td>in<td>ner</table></table>": "a in | ner",
    "<p hidden>no</p><div style='DISPLAY : none'>no<p>no</div>yes": "yes",
    "<script>var t='</p>';</script><style>p{}</style><!-- no -->yes<noscript>no</noscript>": "yes",
    "<pre>a  b\n  c</pre>": "a  b\n  c",
    "a<span> b</span> <i>c</i>d": "a b cd",
    "<p>a</i></div></p>b": "a\n\nb",
    "a</p>b": "a\n\nb",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\nd\nu",
    "<title>no</title><body>yes": "yes",
    "&lt;b&gt; &#169; &nbsp; x": "<b> © x",
    "<td>stray</td>": "stray",
    "<a href='x'>cut off": "cut off",
    "<a href='": "",
    "<select><option>no<option>no</select>yes": "yes",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A | B\n  | C",
    "<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>": "a | b | c\nd |   | e\nf |   | g",
    "<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>": "ab |   | c\n   |   | d\ne  | f | g",
    "<table><tr><td><ul><li>a<li>b</ul><td>x<tr><td>c<td>y</table>": "- a | x\n- b |\nc   | y",
    "<ul><li>o<table><tr><td><ol><li>a<ul><li>in</ul></ol><td>x</table></ul>": "- o\n\n  1. a   | x\n    - in |",
    "<table><tr><td><p>one<p>two<td>x</table>": "one | x\ntwo |",
    "<p style='visibility:hidden'>no<b style='Visibility: visible'>yes</b>no</p>": "yes",
    "<div style='display:none'><b style='visibility:visible'>no</b></div>x": "x",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert html.render(page) == CASES[page]


def test_deep_and_broken_pages():
    assert html.render("<div>" * 50_000 + "x") == "x"
    assert html.render("<b><table><td>" * 1000 + "x").strip(" |") == "x"
    assert html.render("<p>a<li>b" * 5000).count("a") == 5000
    assert html.render("</div>" * 5000 + "x") == "x"
    long = "word " * 100_000
    assert html.render(f"<table><tr><td>{long}<td>b<tr><td>c<td>d</table>").endswith("d")


def test_extract_keeps_rows_and_columns(spark):
    pages = frame(spark, [(1, None, "u"), (2, "", "v"), (3, "<p>x", "w"), (3, "<p>x", "w"), (None, "y", None)],
                  "page_id long, html string, text string")
    got = [(r.doc.page_id, r.doc.text, r.text) for r in html.extract(pages).collect()]
    assert got == [(1, "u", ""), (2, "v", ""), (3, "w", "x"), (3, "w", "x"), (None, None, "y")]
    assert html.extract(pages.limit(0)).count() == 0


def test_query_keeps_all_words_that_are_seen(spark):
    import re

    rows = {r.page_id: r.text for r in queries.op10_html_extract(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        body = re.sub(r"(?s)<(script|style|title|noscript)\b.*?</\1>|<!--.*?-->", " ", page.html)
        seen = re.sub(r"<[^>]*>", " ", body)
        import html as entities

        want = "".join(entities.unescape(seen).split())
        got = re.sub(r"\s|^- |\|", "", "\n".join(re.sub(r"^\s*(?:-|\d+\.) ", "", x) for x in rows[page.page_id].split("\n")))
        assert sorted(want.replace("|", "")) == sorted(got) or abs(len(want) - len(got)) <= 0.02 * len(want) + 20


@pytest.mark.parametrize("page, text", [
    ("<head><title>T</title><p>Hello", "Hello"),
    ("<html><head><meta charset=utf-8><link href=x>\n<style>a{}</style>\n<script>b</script>text<p>more", "text\n\nmore"),
    ("<head><title>T</title><noscript><p>no</noscript><template><p>no</template><b>x</b></head>y", "xy"),
    ("<head><title>T</title></head><body>x", "x"),
])
def test_head_ends_where_it_must(page, text):
    assert html.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p>a<![x[y]]>b", "ab"), ("<p>a<![ y]>b", "ab"), ("a<![CDATA[ b > text", "a text"), ("a<![CDATA[b]]>c", "ac"),
    ("a<![if !IE]>b<![endif]>c", "abc"), ("a<![", "a"), ("<svg><![CDATA[ > ]]></svg>z", "z"),
])
def test_marked_sections_are_comments(page, text):
    assert html.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "x=2"),
    ("<svg><title>no</title><defs><text>no</text></defs><path/> no <text>yes</text></svg>z", "yesz"),
    ("<svg><defs/><text>a</text></svg><svg/>b", "ab"),
    ("<textarea>a  b\nc</textarea>", "a  b\nc"),
])
def test_formulas_drawn_text_and_prefilled_text_are_seen(page, text):
    assert html.render(page) == text
