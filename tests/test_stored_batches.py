"""Batches under names that look alike, spans of HTML tables, content checks of copies."""

import pytest

from tierwell.sources.html_tables import parse_tables
from tierwell.sources.store import read_batches, write_batch

from conftest import rows


def test_names_that_look_alike_keep_their_rows(spark, tmp_path):
    names = ["a/b", "a:b", "a b", "a%2Fb", "007", "7", "é", "x=1", "2024-01-01 00:00:00"]
    for i, name in enumerate(names):
        write_batch(spark.createDataFrame([(i,)], "n long"), str(tmp_path), "t", name)
    write_batch(spark.createDataFrame([(100,)], "n long"), str(tmp_path), "t", "a:b")
    assert rows(read_batches(spark, str(tmp_path), "t"), "batch", "n") == sorted(
        (n, 100 if n == "a:b" else i) for i, n in enumerate(names))
    with pytest.raises(ValueError):
        write_batch(spark.createDataFrame([(1,)], "n long"), str(tmp_path), "t", "")


def cells(html):
    return [r for _, r in parse_tables(html)[0]]


def test_row_spans_to_the_end_of_their_section():
    assert cells("<table><tr><td rowspan=0>a<td>1<tr><td>2<tr><td>3</table>") == [["a", "1"], ["a", "2"], ["a", "3"]]
    two = "<table><tbody><tr><td rowspan=0>a<td>1<tr><td>2</tbody><tbody><tr><td>b<td>3</tbody></table>"
    assert cells(two) == [["a", "1"], ["a", "2"], ["b", "3"]]
    assert cells("<table><thead><tr><th rowspan=9>h<th>x</thead><tr><td>1<td>2</table>") == [["h", "x"], ["1", "2"]]


def test_long_spans():
    html = "<table><tr><td rowspan=5000>a<td>0" + "".join(f"<tr><td>{i}" for i in range(1, 1500)) + "</table>"
    got = cells(html)
    assert len(got) == 1500 and all(r == ["a", str(i)] for i, r in enumerate(got))
    assert len(cells("<table><tr><td colspan=4000>w</table>")[0]) == 1000
    assert cells("<table><tr><td colspan=-1>w<td rowspan='²'>x</table>") == [["w", "x"]]


def test_a_changed_cell_is_reported(spark, tmp_path):
    from pyspark.sql import functions as F
    from tierwell.sources.copy import content_of, copy_tables_checked
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "", "b|c")], "i long, s string, t string")
    df.write.parquet(f"{src}/t.parquet")
    df.where("false").write.parquet(f"{src}/none.parquet")
    got = copy_tables_checked(spark, ["t", "none"], src, dst)
    assert rows(got) == [("none", 0, 0, True), ("t", 4, 4, True)]
    whole = content_of(spark, f"{dst}/t", df.schema)
    changed = [df.withColumn("t", F.when(F.col("i") == 3, "b|d").otherwise(F.col("t"))),
               df.select("i", F.col("t").alias("s"), F.col("s").alias("t")), df.limit(3), df.union(df.limit(1)),
               df.withColumn("s", F.when(F.col("s") == "", None).otherwise(F.col("s")))]
    for k, other in enumerate(changed):
        other.write.parquet(f"{dst}/changed{k}")
        assert content_of(spark, f"{dst}/changed{k}", df.schema) != whole, k
    df.repartition(3, "s").write.parquet(f"{dst}/moved")
    assert content_of(spark, f"{dst}/moved", df.schema) == whole
    # a copy that loses the difference of null and empty text is found out
    csv = copy_tables_checked(spark, ["t"], src, str(tmp_path / "csv"), dst_fmt="csv",
                              dst_options={"header": "true", "emptyValue": "", "nullValue": ""})
    assert rows(csv) == [("t", 4, 4, False)]
