"""How the headers of CSV files are found: one entry per file, whatever the number of lines."""

from holdfast.sources import feeds


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 500)
    (tmp_path / "b.csv").write_text('y,x\n1,"two\nlines"\n3,"a \\" b"\n')
    (tmp_path / "c.csv").write_text("x,y\n")
    plans, collect = [], type(spark.range(1)).collect

    def noted(df):
        rows = collect(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(type(spark.range(1)), "collect", noted)
    found = feeds.csv_layouts(spark, str(tmp_path))
    by_header = {r["header"]: (r["torn"], r["slashed"], sorted(f[-5:] for f in r["files"])) for r in found}
    assert by_header == {"x,y": (False, False, ["a.csv", "c.csv"]), "y,x": (True, True, ["b.csv"])}
    text_pass = plans[0][plans[0].index("file_path"):]
    assert "ObjectHashAggregate(keys=[file_path" in text_pass and "SortAggregate(keys=[file_path" not in text_pass
