from pyspark.sql import functions as F

from huddle.sources import html

PAGE = """<html><body><table id="x">
<thead>
 <tr><th></th><th colspan="2">Rushing</th><th colspan="2">Fantasy per Game</th></tr>
 <tr><th>Rk</th><th>Tm</th><th>Att</th><th>FantPt</th><th>FantPt</th></tr>
</thead>
<tbody>
 <tr><th scope="row">1</th><td> New York Jets </td><td>30</td><td>400.5</td><td><b>26.3</b></td></tr>
 <tr><th>2</th><td>Detroit Lions</td><td>28</td><td>380.0</td><td>23.3</td></tr>
 <tr><th>2</th><td>Detroit Lions</td><td>28</td><td>380.0</td><td>23.3</td></tr>
 <tr><th>3</th><td>Tampa Bay &amp; Co</td><td>20</td><td>10</td><td>n/a</td></tr>
</tbody></table>
<table><thead><tr><th>Other</th></tr></thead><tbody><tr><td>ignored</td></tr></tbody></table>
</body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "u", PAGE, 2021, "RB"), (2, "v", "<p>no table</p>", 2021, "QB")],
                                 "page_id long, url string, html string, season int, position string")


def test_header_drops_group_labels_but_keeps_repeats(spark):
    h = {r.page_id: r.headers for r in html.header_labels(pages(spark)).collect()}
    assert h[1] == ["Rk", "Tm", "Att", "FantPt", "FantPt"]


def test_body_rows_trim_and_dedupe(spark):
    rows = html.body_rows(pages(spark)).filter(F.col("page_id") == 1).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == [0, 1, 3]  # repeated row kept once
    assert rows[0].cells == ["1", "New York Jets", "30", "400.5", "26.3"]
    assert rows[2].cells[1] == "Tampa Bay & Co"


def test_position_table_takes_second_fantpt(spark):
    out = {r.Tm: r for r in html.position_table(pages(spark)).collect()}
    assert out["New York Jets"].value == 26.3 and out["Detroit Lions"].value == 23.3
    assert out["Tampa Bay & Co"].value is None  # not a number
    assert out["New York Jets"].Season == 2021 and out["New York Jets"].position == "RB"
    assert len(out) == 3


def test_markup_that_pages_really_use(spark):
    page = "<TABLE><THEAD><TR><TH> Tm\n</TH></TR></THEAD><TBODY><Tr><TD>\n Dallas&#160;Cowboys&nbsp;\n</TD><td>&#x41;&amp;#66;&#38;lt;</td></tr></TBODY></TABLE>"
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert html.header_labels(df).first().headers == ["Tm"]
    assert html.body_rows(df).first().cells == ["Dallas\u00a0Cowboys", "A&#66;&lt;"]


def test_nested_tables_and_missing_closing_tags(spark):
    inner = "<table><thead><tr><th>in</th></tr></thead><tbody><tr><td>x</td><td>y</td></tr><tr><td>z</td></tr></tbody></table>"
    page = f"""<table><thead><tr><th>Tm</th></tr></thead><tbody>
      <tr class="a"><td>1</td><td>{inner} tail</td></tr>
      <tr><td>2</td><td>b</td></tr></tbody></table><table><tbody><tr><td>no</td></tr></tbody></table>"""
    loose = "<table><tbody><tr><td>1<td>a<tr><th>2<TD>b</table><table><tbody><tr><td>no"
    lists = "<ul><li><a href=1>one</a><ul><li><a>deep</a></li></ul></li><li><a>two</a> <a>three</a></ul>"
    df = spark.createDataFrame([(1, page), (2, loose), (3, "<tbodyx><tr><td>no"), (4, None)], "page_id long, html string")
    rows = {(r.page_id, r.row_index): r.cells for r in html.body_rows(df).collect()}
    assert rows == {(1, 0): ["1", "inxyz tail"], (1, 1): ["2", "b"], (2, 0): ["1", "a"], (2, 1): ["2", "b"]}
    df = spark.createDataFrame([(1, lists)], "page_id long, html string")
    rows = {r.row_index: r.cells for r in html.body_rows(df, container="ul", row_tag="li", cell_tags="a").collect()}
    assert rows == {0: ["one", "deep"], 1: ["two", "three"]}


def test_a_team_listed_twice_keeps_both_rows(spark):
    def page(rows):
        body = "".join(f"<tr><td>{t}</td><td>1</td><td>{v}</td></tr>" for t, v in rows)
        return f"<table><thead><tr><th>Tm</th><th>FantPt</th><th>FantPt</th></tr></thead><tbody>{body}</tbody></table>"

    data = [(1, page([("A", 2.5), ("B", 1.5), ("A", 9.5)]), 2021, "RB"), (2, page([("A", 4.5), ("C", 7.5)]), 2021, "QB")]
    out = html.defense_points_table(spark.createDataFrame(data, "page_id long, html string, season int, position string"), ["RB", "QB"])
    assert sorted(map(tuple, out.collect()), key=repr) == [("A", 2021, 2.5, 4.5), ("A", 2021, 9.5, None), ("B", 2021, 1.5, None), ("C", 2021, None, 7.5)]
