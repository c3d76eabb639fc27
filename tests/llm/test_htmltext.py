import time

import pytest
from conftest import SF_SMALL

from seclake.llm import htmltext, queries

CASES = {
    None: "", "": "", "  \n ": "", "plain  text": "plain text", "a < b & c": "a < b & c", "a &lt; b&nbsp;&eacute;": "a < b é",
    "<p>one<p>two": "one\n\ntwo", "<div>one</div><div>two</div>": "one\ntwo", "a<br>b<br/>c": "a\nb\nc", "a<br><br>b": "a\n\nb",
    "<p>a <b> bold</b> <i>it</i>\n x</p>": "a bold it x", "x<span>y</span>z": "xyz",
    "<h1>T</h1>text<h2>U</h2><p>v</p>": "T\n\ntext\n\nU\n\nv",
    "<ul><li>one<li>two<ul><li>in</ul><li>three</ul>after": "- one\n- two\n  - in\n- three\n\nafter",
    "<ol start=3><li>a<li>b<p>c</ol>": "3. a\n4. b\n\n   c", "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "<blockquote>q<br>r</blockquote>s": "  q\n  r\n\ns",
    "<pre>\n a  b\n\n  c</pre>d": " a  b\n\n  c\n\nd",
    "<table><tr><th>name<th>n<tr><td>x<td>100</table>": "name  n\nx     100",
    "<table><tr><td colspan=2>wide title<tr><td>a<td>b</table>z": "wide title\na  b\n\nz",
    "<td>a<td>b<tr><td>ccc<td>d": "a    b\nccc  d",
    "<table><caption>cap</caption><thead><tr><td>h</thead><tbody><tr><td>" + "w " * 50 + "</table>": "cap\nh\n" + ("w " * 50).strip(),
    "<table><tr><td><table><tr><td>1<td>2<tr><td>3<td>4</table><td>x</table>": "1  2\n3  4\nx",
    "<head><title>t</title><style>s</style></head><body>b<script>if(a<b)'</p>'</script>c</body>": "bc",
    "<script>var t=\"</p>\";x</script>ok": "ok", "<script>never closed": "", "a<!-- <p>b --> c<!-- open": "a c", "a<!doctype x>b<?pi?>c": "abc",
    "<p hidden>no</p><p style='DISPLAY : none'>no<b>no</b></p><div style=\"visibility:hidden\">no</div>yes<noscript>no</noscript><template>no</template>": "yes",
    "<input type=text value=x>y<textarea> a <b>\n</textarea><select><option>o1<option selected>o2</select>": "y a <b>\no1\no2",
    "<dialog>no</dialog><dialog open>yes</dialog>": "yes", "<a title=\"x > y\" href='>'>t</a>": "t", "<a title=\"open>text": "text", "<a href=x'y>t</a>": "t",
    "<p>a</div></span>b</p></p>c": "ab\n\nc", "<b><p>x</b>y": "xy", "</br>x": "x", "<x-y>custom</x-y> <>": "custom <>", "<a": "", "a</": "a</", "<div/>x": "x",
}


@pytest.mark.parametrize("html", list(CASES))
def test_layout(html):
    assert htmltext.text_of(html) == CASES[html]


#: Content that may not stand where it does in a table, and all words that browsers show.
MISPLACED = {
    "<table><tr>text<td>a</table>": "text\na", "<table><tr><td>a</td><b>x</b></tr></table>": "x\na", "<table><tr><td>a</td>one<td>b</td>two</table>": "one\ntwo\na  b",
    "<table><tr><table><tr><td>in</table></tr></table>": "in", "<table><tbody><div>x</div><tr><td>a</table>": "x\na", "<table><thead>h<tfoot>f</table>": "h\nf",
    "<table><tr><form><td>a</td><td>b</td></form></tr><tr><td>c</table>": "a  b\nc", "<table><tbody><form><tr><td>a</td></tr></form><tr><td>b</table>": "a\nb",
    "<table><form hidden><tr><td>a</form></table>z": "a\n\nz", "<table><tr><div><td>a</div><span><td>b</table>": "a  b", "<table><div><tr><td>a</div></table>": "a",
    "<table><colgroup><col>x<tr><td>a</table>": "x\na", "<table><tr><caption>cap</caption><td>a</table>": "cap\na", "<table><tr><td>a<tr><caption>cap</caption></table>": "cap\na",
    "pre<table>one <b>two</b> <i>three</i><tr><td>a</table>": "pre\none two three\n\na", "<table><tr>a < b<td>c</table>": "a < b\nc",
    "<table><tr><textarea>t</textarea><td>a</table>": "t\na", "<table><tr>x<br>y<td>a</table>": "x\ny\na", "<table><tr><script>no</script><td>a<tr style='display:none'>yes<td>no</table>": "yes\na",
    "<table><tr><td>a<table>x<tr><td>b</table></table>": "a\nx\n\nb", "<table><tr><ul><li>i<li>j</ul><td>a</table>": "- i\n- j\n\na",
}


@pytest.mark.parametrize("html", list(MISPLACED))
def test_misplaced_content_of_tables(html):
    squeezed = lambda text: [x for x in text.split("\n") if x]
    assert squeezed(htmltext.text_of(html)) == squeezed(MISPLACED[html])


@pytest.mark.parametrize("levels", [150, 196, 197, 198, 199, 200, 300])
@pytest.mark.parametrize("html", ["<table>a<tr>b<td>c</td>d<tr><form><td>e</form><caption>f</caption></table>g", "<table><colgroup>a<tbody>b<tr><b>c</b><td>d<table>e<tr>f<td>g</table></table>h"])
def test_no_word_is_lost_at_any_depth(levels, html):
    import re
    want = sorted(re.sub("<[^>]*>", "", html))
    assert sorted("".join(htmltext.text_of("<div>" * levels + html).split())) == want


def test_large_and_deep_pages_take_linear_time():
    began = time.time()
    n = 60_000
    for html in ("<div>" * n + "x", "<b>" * n + "</i>" * n, "<p>" * n, "<li>" * n, "<table><tr><td>" * n + "x", "<" * n, "<a b=\"" * n, "<!--" * n, "<a '" * n, "<ul><li>" * n + "x", "</p>" * n,
                 "<script>" * n, "&" * n, "<td colspan=99999>" * 2000 + "y", "<select>" + "<option>" * n):
        htmltext.text_of(html)
    assert time.time() - began < 60
    assert htmltext.text_of("<div>" * n + "deep") == "deep"
    assert htmltext.text_of("word " * 400_000).count("word") == 400_000


def test_pages_table_keeps_every_visible_word(spark):
    """Against the markup with everything between tags kept and scripts, styles, head and comments cut out."""
    import html as lib
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op2(spark, SF_SMALL).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        plain = re.sub(r"(?is)<(script|style|title|noscript)\b.*?</\1>|<!--.*?-->", "", page)
        words = lib.unescape(re.sub(r"(?s)<[^>]*>", " ", plain)).split()
        assert re.sub(r"^(- |\d+\. )", "", got[k], flags=re.M).split() == words or "".join(re.sub(r"(?m)^\s*(- |\d+\. )", "", got[k]).split()) == "".join(words)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (1, "<p>a", "x"), (None, "", "x")], "page_id long, html string, text string")
    assert sorted(map(tuple, htmltext.extract(pages).collect()), key=repr) == [(1, ""), (1, "a"), (None, "")]
    assert htmltext.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("html,want", [("<p>one</p><!--><p>two</p>", "one\n\ntwo"), ("<p>one</p><!---><p>two</p>", "one\n\ntwo"), ("<p>one<!-- x --!>two", "onetwo"), ("<p>one<!-- -- > x -->two", "onetwo"),
                                       ("<p>one<!-- a <!--> two", "one two"), ("one<!--!>gone-->two", "onetwo"), ("one<!---->two", "onetwo"), ("one<!-- never ends <p>two", "one")])
def test_comments_end_as_in_browsers(html, want):
    assert htmltext.text_of(html) == want
