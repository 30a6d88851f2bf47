import pyarrow as pa
import pytest

from feedloom.functions import html
from feedloom.functions.html import clean_html, html_text


@pytest.mark.parametrize("html, want", [
    ("Ren text\nandra raden", "Ren text\nandra raden"),
    ("<i>Titel</i>Ett<br/>Två", "TitelEtt\nTvå"),
    ("<p>Ett<p>Inre</p>efter</p><p>Två</p>", "Ett\nInre\nefter\nTvå"),
    ("<p>Ett</p><p>Två</p>", "Ett\nTvå"),
    ("<p><b>Roll:</b></p><ul><li>Ett</li><li>Två</li></ul>Slut", "Roll:\nEtt\nTvå\nSlut"),
    ("<h4>Titel</h4>Text", "Titel\nText"),
    ("<div>Utan slut", "Utan slut"), ("Utan start</div>", "Utan start"),
    ("<h1>Fel slut</h3>", "Fel slut"), ("a<br>b</br>c", "a\nbc"),
    ("<script>if (a < b) { x('</p>') }</script>", ""),
    ("Ett. <script>1</script>Två.", "Ett. Två."),
    ("<p>A</p><script>1</script><p>B</p>", "A\nB"),
    ("<p>A</p><style>p {}</style><p>B</p>", "A\n\nB"),
    ("<b>Före</b><p>Stycke", "Före\nStycke"), ("Före<p>Stycke", "Före\nStycke"),
    ("<!-- nej --><!DOCTYPE html><p>ja</p>", "ja"),
    ("a &amp; b &lt;c&gt; &aring;&#228;&#xf6; &#150; &nbsp;", "a & b <c> åäö –"),
    ("<p>a</p>\n   \n<p>b</p>", "a\n\nb"), ("<pre>a\n   \n</pre>b", "a\n   \nb"),
    ("x<![CDATA[ y ]]>z", "x y z"), (None, ""), ("", ""),
])
def test_line_break_rule(html, want):
    assert html_text(html) == want


def test_unknown_entities_lose_only_their_mark():
    assert html_text("<p>R&D and &unknown; x") == "R&D and &unknown x"


def test_column_equals_function(values):
    given = ["<p>a</p>b", "  utan märkning  ", None, "a & b", "<br>" * 3, " x\x1c"]
    assert values(clean_html, given) == [html_text(v) for v in given]


def test_deep_and_long_pages_take_linear_time():
    assert html_text("<div>" * 3000 + "x") == "x"
    assert html_text("<p>y</p>" * 20_000).count("y") == 20_000


def test_a_batch_of_pages_is_held_in_pieces():
    given = [f"<p>{i}</p>" if i % 7 else None for i in range(10 * html.PIECE + 1)]
    pieces = list(html._clean_html.func(iter([pa.array(given), pa.array([], pa.string())])))
    assert max(map(len, pieces)) <= html.PIECE
    assert [v for piece in pieces for v in piece.to_pylist()] == [
        None if v is None else html_text(v) for v in given]
