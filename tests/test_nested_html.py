"""Tables in tables and lists in lists, closed and not."""

from recolith.sources import html as ht


def rows_of(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    return {(r["id"], r["row"]): r["cells"] for r in ht.table_cells(df, "id").collect()}


def test_a_table_in_a_cell(spark):
    got = rows_of(
        spark,
        "<table><tr><td>a<table><tr><td>in1</td><td>in2</td></tr></table></td><td>b</td></tr></table>",
        "<p>x<table><tr><th>h<td>1<tr><td>2<td>3</table><table><tr><td>4</td></tr></table>",
        "no table <td>x</td>",
        "<TABLE><tr><td><!-- <td>no</td> -->a<script>'<td>'</script></td></tr><tr></tr></TABLE>",
        None,
        "<table><tr><td>1<table><tr><td>2<table><tr><td>3</td></tr></table>2b</td></tr></table>1b</td><td>4</td></tr><tr><td>5</td></tr></table>",
    )
    assert got == {
        (0, 0): ["a", "b"], (0, 1): ["in1", "in2"], (1, 0): ["h", "1"], (1, 1): ["2", "3"], (1, 2): ["4"], (3, 0): ["a"], (3, 1): [],
        (5, 0): ["1 1b", "4"], (5, 1): ["2 2b"], (5, 2): ["3"], (5, 3): ["5"],
    }


def test_what_is_around(spark):
    page = "<ul><li>a<ol><li>a1</li><li>a2<ul><li>deep</li></ul></li></ol></li><li>b</ul><ul><li>c</li></ul>"
    rows = ht.nested_texts(spark.createDataFrame([(1, page)], "id int, html string"), "id", ht.LIST).collect()
    text = {r["text"]: r for r in rows}
    assert set(text) == {"a", "a1", "a2", "deep", "b", "c"} and {t: text[t]["depth"] for t in text} == {"a": 1, "a1": 2, "a2": 2, "deep": 3, "b": 1, "c": 1}
    assert text["a"]["up"] is None and text["a1"]["up"] == text["a"]["box"] and text["deep"]["up"] == text["a1"]["box"] and text["c"]["box"] != text["a"]["box"] == text["b"]["box"]
    assert [(text[t]["l1"]) for t in ("a", "b", "a1", "a2")] == [1, 2, 1, 2]


def test_officers_in_a_table_with_tables(spark):
    page = "<h3>Commissioners</h3><p>x</p><table><tr><td>1A01<table><tr><td>note</td></tr></table></td><td>Ann <em>Chair</em></td></tr></table><table><tr><td>1A99</td><td>Other</td></tr></table>"
    got = [(r["seat"], r["name"], r["roles"]) for r in ht.officers(spark.createDataFrame([(1, "u", page)], "id int, url string, html string"), "id", "Commissioners").orderBy("row").collect()]
    assert got[0] == ("1A01", "Ann", "Chair") and all(g[0] != "1A99" for g in got)
