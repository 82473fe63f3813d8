"""Queries that use a costly step several times work it out once."""

import __spark_entry__ as entry
from holdfast.plans import valuation
from holdfast.sources import market

FOLDER = "/root/testdata/sf0.001"


def test_upsert_composite_reads_lineitem_for_one_write_only(spark, monkeypatch):
    """All that follows the landed fact reads that; before, each of its uses valued the holdings again."""
    seen, fact = [], valuation.fact

    def noted(*args):
        df = fact(*args)
        write = type(df.write).parquet
        monkeypatch.setattr(type(df.write), "parquet", lambda self, path, *a, **k: seen.append(
            "lineitem" in " ".join(self._df.inputFiles())) or write(self, path, *a, **k))
        return df

    monkeypatch.setattr(valuation, "fact", noted)
    rows = entry.queries()["upsert_composite"](spark, FOLDER)
    assert seen.count(True) == 1 and len(seen) == 3 and rows.count() > 0


def test_rescue_csv_header_groups_holdings_once(spark, monkeypatch):
    plans, holdings = [], market.holdings
    monkeypatch.setattr(market, "holdings", lambda *a: plans.append(holdings(*a)) or plans[-1])
    writer = type(spark.range(1).write)
    csv, sources = writer.csv, []
    monkeypatch.setattr(writer, "csv", lambda self, path, *a, **k: sources.extend(self._df.inputFiles()) or csv(self, path, *a, **k))
    got = entry.queries()["rescue_csv_header"](spark, FOLDER)
    assert sources and not any("lineitem" in f for f in sources)
    assert got.count() == plans[0].count()
