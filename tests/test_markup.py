import pytest
from pyspark.sql import functions as F

from foliant.functions import gate, markup, rtf
from foliant.functions import markup_tree as t
from foliant.functions.markup_tree import parse

ITEM = '<div style="margin-left: 32px; text-indent: -17px;">{}&#160;{}</div>'
STRIKE = '<span style="text-decoration: line-through;">{}</span>'


def row(item, marker="&#8226;", spacer=" "):
    return f'<tr><td width="24">{marker}</td><td width="8">{spacer}</td><td><div>{item}</div></td></tr>'


def table(*rows):
    return f"<table><tbody>{''.join(rows)}</tbody></table>"


def item(text, marker="&#8226;"):
    return ITEM.format(marker, text)


SAME = object()
CASES = [
    ("bullet_tables_to_paragraphs", table(row("a"), row("b")), item("a") + item("b")),
    ("bullet_tables_to_paragraphs", table(row("a", "&bull;", "&nbsp;")), item("a")),
    ("bullet_tables_to_paragraphs", table(row("a", "o")), item("a")),
    ("bullet_tables_to_paragraphs", table(row(table(row("in")))), item(item("in"))),
    ("bullet_tables_to_paragraphs", "<table><tr><td>left</td><td></td><td>right</td></tr></table>", SAME),
    ("bullet_tables_to_paragraphs", '<table><tr><td>&#9642;</td><td rowspan=3>wide cell</td><td>z</td></tr></table>', SAME),
    ("bullet_tables_to_paragraphs", f"<table>{row('first')}<caption>below</caption></table>", SAME),
    ("bullet_tables_to_paragraphs", f"<table>{row('<table><tr><td>x</td></tr></table>')}</table>", SAME),
    ("lists_to_paragraphs", "<ul><li>a</li><li> b </li></ul>", item("a") + item("b")),
    ("lists_to_paragraphs", '<ul style="list-style-type: circle"><li>a</li></ul>', item("a", "&#9702;")),
    ("lists_to_paragraphs", '<ul style="list-style: square inside;"><li>a</li></ul>', item("a", "&#9642;")),
    ("lists_to_paragraphs", "<ul><li>o<ul><li>i</li></ul></li></ul>", item("o" + item("i"))),
    ("lists_to_paragraphs", '<ul style="list-style-type: none;"><li>a</li></ul>', SAME),
    ("lists_to_paragraphs", "<ul>before<li>x1</li></ul>", SAME),
    ("lists_to_paragraphs", "<ul><hr><li>x2</li></ul>", SAME),
    ("keep_ancestor_strike", STRIKE.format('<i style="text-decoration: underline">x</i>'), STRIKE.format('<i style="text-decoration: underline"><s>x</s></i>')),
    ("keep_ancestor_strike", STRIKE.format('<i style="text-decoration: none">x</i>'), STRIKE.format('<i style="text-decoration: none"><s>x</s></i>')),
    ("keep_ancestor_strike", STRIKE.format("x"), SAME),
    ("keep_ancestor_strike", '<p><img style="text-decoration: line-through"><i style="text-decoration: underline">x</i></p>', SAME),
    ("keep_ancestor_strike", STRIKE.format('<i style="text-decoration: underline">x'), SAME),
    ("remove_empty_anchors", '<div>k<a id=m1 ></a><A NAME=m2 />l</div>', "<div>kl</div>"),
    ("remove_empty_anchors", '<td><a data-href="/q" id="m3">\n</a>u</td>', "<td>u</td>"),
    ("remove_empty_anchors", '<li><a href=/w></a><a id="m4">w</a><!--<a id=m5></a>--></li>', SAME),
]


@pytest.mark.parametrize(("name", "given", "want"), CASES)
def test_tree_pass(name, given, want):
    out = getattr(t, name)(given)
    assert out == (given if want is SAME else want)
    assert getattr(t, name)(out) == out


def test_styled_elements():
    f = lambda x: t.remove_styled_elements(x, "display:none")
    assert f('a<div style="DISPLAY : none"><div>x</div></div>b<span style=\'display:none\'/>c') == "abc"
    assert f('a<div style="display:none">open') == 'a<div style="display:none">open'
    assert t.remove_styled_elements("<div style='x'>a</div>", " ") == "<div style='x'>a</div>"


def test_native_passes_agree_with_tree_passes(spark):
    texts = [c[1] for c in CASES] + ["", "<a/ >", '<a title="href =x"></a>', '<html xmlns="a" xmlns:b=c d="e"><p xmlns="k">']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    rows = df.select("t", markup.remove_empty_anchors(F.col("t")).alias("a"), markup.remove_root_namespaces(F.col("t")).alias("n"), markup.remove_scripts(F.col("t")).alias("s")).collect()
    for r in rows:
        assert r.a == t.remove_empty_anchors(r.t)
        assert r.n == t.remove_root_namespaces(r.t)
        assert r.s == t.SCRIPT.sub("", r.t)


def test_a_bad_reference_fails_only_its_document(spark):
    bad = table(row("x", "&#xD800;"))
    df = spark.createDataFrame([(1, bad), (2, table(row("a"))), (3, None)], "i int, t string")
    out = {r.i: r.n for r in df.select("i", t.normalize(F.col("t")).alias("n")).collect()}
    assert out[1].error == "ValueError"
    assert out[2].text == item("a")
    assert out[3].text is None


def test_long_attributes_do_not_overflow_the_stack(spark):
    x = "<p " + "x" * 200_000 + '><a name="q"></a>z</p>'
    df = spark.createDataFrame([(x,)], "t string")
    assert df.select(markup.remove_empty_anchors(F.col("t")).alias("o")).first().o == x.replace('<a name="q"></a>', "")


def test_gate(spark):
    cases = {"": "empty", "   ": "empty", "plain text": "no element", "2 < 3 and 4 > 1": "no element", "<p>x": None, "prose <div>": None, "<ns:body>": None, "\x01" * 50 + "<p>": "binary"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for r in df.select("t", gate.content_error(F.col("t")).alias("e")).collect():
        want = cases[r.t]
        assert (r.e is None) if want is None else want in r.e.message


def test_rtf():
    out = rtf.to_rtf('<p>Übermorgen, {y}: 7½ £ — na gut.</p><ul><li>a</li></ul><a name="q"></a>')
    assert out.startswith("{\\rtf") and out.isascii()
    assert "\\u220?" in out and "\\u189?" in out and "\\u163?" in out and "\\{y\\}" in out and "\\u8226?" in out
    assert "HYPERLINK" not in out
    assert "\\strike " in rtf.to_rtf(STRIKE.format("x"))
    assert "\\u-10179?\\u-8704?" in rtf.to_rtf("😀")


ODD_MARKUP = [
    "<p>a<p>b</p>c</p></p><p>", "</b><b><i></b></i><b/><b>x</b>", "<!-- <p> --><p title='a>b'>\U0001f600<br/></p><![CDATA[<p>]]></p>", "no tags < at > all", "", "<a><b><a></a></b></a><a>", None, "<P></p\n><x:y></x:y><?pi <p> ?><p/></p>",
]


def test_closes_and_offsets_equal_the_parser(spark):
    """Matching by running depths against the parser's stack, on odd markup and on documents for each pass."""
    from foliant.plans import catalog

    shaped = [r.text for r in catalog.faulty_documents(spark, "/root/testdata/sf0.001").collect()]
    texts = ODD_MARKUP + shaped
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(5)
    got: dict = {}
    for r in markup.matching_closes(markup.token_offsets(df, "i"), "i").collect():
        got.setdefault(r.i, {})[r.open] = (r.name, r.close, r.open_offset, r.open_length, r.close_offset, r.close_length)
    for i, text in enumerate(texts):
        tags = parse(text or "")
        want = {}
        for k, tag in enumerate(tags):
            if tag.opens:
                m = tags[tag.match] if tag.match >= 0 else None
                want[k] = (tag.name, tag.match if m else None, tag.start, tag.end - tag.start, m and m.start, m and m.end - m.start)
        assert got.get(i, {}) == want, text


def test_tables_as_rtf():
    row = lambda *edges: "\\trowd\\trgaph108" + "".join(f"\\cellx{e}" for e in edges) + "\n"
    body = lambda html: rtf.to_rtf(html)[len(rtf.HEAD) + 1 : -1]
    assert body("<table><tr><td>a<td>b</table>") == "a\\tab b\\par\n"  # cells that aren't closed: no rows to be sure of
    two = body("<table><tr><td>a</td><td><b>b</b></td></tr></table>x")
    assert two == row(4500, 9000) + "\\intbl a\\cell\n\\intbl {\\b b}\\cell\n\\row\n\\pard\nx"
    spans = body('<table><tr><td colspan="2">w</td><td>x</td></tr><tr><td>1</td><td>2</td><td></td></tr><tr></tr></table>')
    assert spans.startswith(row(6000, 9000) + "\\intbl w\\cell") and row(3000, 6000, 9000) in spans and spans.count("\\row") == 2 and "\\intbl \\cell" in spans
    assert "\\trowd" not in body("<table><tr><td>o<table><tr><td>i</td></tr></table></td></tr></table>").split("\\intbl i")[0].replace(row(9000), "", 1)
    assert body("<table></table>") == "" and body("<table><tr><td colspan=9999999>x</td></tr></table>").count("\\cellx") == 1
    styled = body('<table><tr><td style="color:#ff0000">r</td></tr></table>')
    assert "\\intbl {\\cf1 r}\\cell" in styled
    # elements that the table is in stay open behind it, those of a cell don't
    assert body("<i>p<table><tr><td><u>c</td></tr></table>q</i>").endswith("\\intbl {\\ul c}\\cell\n\\row\n\\pard\nq}")


def test_long_documents_are_not_handed_over_by_thousands(spark):
    """Arrow batches hold ten thousand documents, whatever their length."""
    rows = spark.createDataFrame([("<p style='text-decoration: line-through'>a</p>",)], "text string")
    chain, pass_, rtf_ = t.normalize(F.col("text"))["text"], t.apply_pass(F.col("text"), "keep_ancestor_strike"), rtf.render_rtf(F.col("text"))["rtf"]
    for column in (chain, pass_, rtf_):
        plan = rows.select(column)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
