"""CSV feeds bound by the header of each file: any width, any order, on a stream and in a batch."""

import json

import pytest

from holdfast.sources import feeds
from holdfast.sources.schemas import FORMATS, SCHEMAS
from holdfast.streaming import ingest

HOLDINGS = "investment_holdings_snapshot"
CSV_FEEDS = [f for f in SCHEMAS if FORMATS[f] == "csv"]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def land(spark, root, feeds_):
    ingest.ingest_all(spark, f"{root}/raw", f"{root}/t", f"{root}/c", "ts", feeds_)


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw" / HOLDINGS).mkdir(parents=True)
    return tmp_path / "raw" / HOLDINGS


def test_stream_of_three_runs_with_other_headers(spark, raw, tmp_path):
    (raw / "1.csv").write_text("portfolio_id,as_of_date,investment_asset_id,quantity\nP1,2024-01-01,A,1\n")
    land(spark, tmp_path, [HOLDINGS])
    (raw / "2.csv").write_text("quantity,note,portfolio_id,as_of_date,investment_asset_id\n2,x,P2,2024-01-02,B\n")
    land(spark, tmp_path, [HOLDINGS])
    (raw / "3 {a}.csv").write_text("investment_asset_id,portfolio_id\nC,P3\n")
    (raw / "4.csv").write_text("")
    land(spark, tmp_path, [HOLDINGS])
    land(spark, tmp_path, [HOLDINGS])
    table = ingest.landed(spark, HOLDINGS, f"{tmp_path}/t")
    assert rows_of(table, "portfolio_id", "as_of_date", "investment_asset_id", "quantity", "_rescued_data", "_source_file") == [
        ("P1", "2024-01-01", "A", 1.0, None, "1.csv"),
        ("P2", "2024-01-02", "B", 2.0, '{"note":"x"}', "2.csv"),
        ("P3", None, "C", None, None, "3 {a}.csv"),
    ]
    assert table.columns == [*SCHEMAS[HOLDINGS].names, "_rescued_data", "_ingest_ts", "_source_file", "_batch_id"]


def test_file_that_arrives_after_the_stream_is_planned(spark, raw):
    (raw / "1.csv").write_text("portfolio_id,quantity\nP1,1\n")
    names = feeds.stream_files(spark, str(raw))
    (raw / "2.csv").write_text("quantity,portfolio_id\n2,P2\n")
    got = []
    query = names.writeStream.foreachBatch(
        lambda batch, _: got.extend(
            rows_of(feeds.read_csv(batch.sparkSession, SCHEMAS[HOLDINGS], [r.path for r in batch.collect()]), "portfolio_id", "quantity")
        )
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(got) == [("P1", 1.0), ("P2", 2.0)]


def test_backlog_is_read_in_bounded_batches(spark, raw):
    for i in range(5):
        (raw / f"{i}.csv").write_text(f"portfolio_id\nP{i}\n")
    sizes = []
    feeds.stream_files(spark, str(raw), max_files=2).writeStream.foreachBatch(
        lambda batch, _: sizes.append(batch.count())
    ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(sizes) == [1, 2, 2]


def test_repeated_batch_replaces_its_rows(spark, raw, tmp_path):
    (raw / "1.csv").write_text("portfolio_id\nP1\n")
    land(spark, tmp_path, [HOLDINGS])
    # The batch ran, its commit was lost: the stream runs it again
    (tmp_path / "c" / HOLDINGS / "commits" / "0").unlink()
    (tmp_path / "c" / HOLDINGS / "commits" / ".0.crc").unlink(missing_ok=True)
    land(spark, tmp_path, [HOLDINGS])
    assert ingest.landed(spark, HOLDINGS, f"{tmp_path}/t").count() == 1


def test_every_csv_feed_lands(spark, tmp_path):
    for feed in CSV_FEEDS:
        folder = tmp_path / "raw" / feed
        folder.mkdir(parents=True)
        names = SCHEMAS[feed].names[::-1]
        (folder / "a.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    land(spark, tmp_path, CSV_FEEDS)
    for feed in CSV_FEEDS:
        row = ingest.landed(spark, feed, f"{tmp_path}/t").first()
        assert row["_rescued_data"] is None and row["_batch_id"] == f"{feed}__ts"
        assert [str(row[c])[0] for c in SCHEMAS[feed].names] == ["1"] * len(SCHEMAS[feed].names)


def test_thousand_columns(spark, raw):
    names = [f"n{i}" for i in range(998)] + ["quantity", "portfolio_id"]
    (raw / "w.csv").write_text(",".join(names) + "\n" + ",".join(str(i) for i in range(999)) + ",P,more,,last\n")
    row = feeds.read_feed(spark, HOLDINGS, str(raw)).first()
    rescued = json.loads(row._rescued_data)
    assert (row.portfolio_id, row.quantity) == ("P", 998.0)
    assert rescued["n997"] == "997" and rescued["_extra_1001"] == "more" and rescued["_extra_1003"] == "last"
    assert len(rescued) == 998 + 2


def test_values_with_line_ends_quotes_and_commas(spark, raw):
    (raw / "q.csv").write_text('note,portfolio_id,"as_of_date"\n"two\nlines, ""said""",P1,x\nshort\nplain,P2,"a,b",more,"x,\ny"\n')
    got = rows_of(feeds.read_feed(spark, HOLDINGS, str(raw)), "portfolio_id", "as_of_date", "_rescued_data")
    assert [(p, d) for p, d, _ in got] == [("P1", "x"), ("P2", "a,b"), (None, None)]
    first, second, short = (json.loads(r) for *_, r in got)
    assert first == {"note": 'two\nlines, "said"'}
    assert second == {"note": "plain", "_extra_4": "more", "_extra_5": "x,\ny"} and short == {"note": "short"}


def test_quotes_marked_by_a_backslash(spark, raw):
    (raw / "b.csv").write_text('portfolio_id,note\n"P ""1\\"","x\\"y",z\n')
    (raw / "s.csv").write_text('portfolio_id,note\nP2,"x\\"y","\\"z"\n')
    got = rows_of(feeds.read_feed(spark, HOLDINGS, str(raw)), "portfolio_id", "_rescued_data")
    assert got[-1] == ("P2", json.dumps({"note": 'x"y', "_extra_3": '"z'}, separators=(",", ":")))


def test_headers_with_empty_repeated_and_marked_names(spark, raw):
    (raw / "h.csv").write_text("﻿portfolio_id,,quantity,quantity,_extra_9\nP,a,1,2,c\nportfolio_id,,quantity,quantity,_extra_9\n", encoding="utf-8")
    got = rows_of(feeds.read_feed(spark, HOLDINGS, str(raw)), "portfolio_id", "quantity", "_rescued_data")
    assert got[0] == ("P", 1.0, '{"_extra_2":"a","_extra_4":"2","_extra_5":"c"}')
    # A data row that reads like the header is a row
    assert got[1][0] == "portfolio_id" and len(got) == 2


def test_header_with_a_line_end(spark, raw):
    (raw / "t.csv").write_text('"a\nb",portfolio_id\n1,P\n')
    assert rows_of(feeds.read_feed(spark, HOLDINGS, str(raw)), "portfolio_id", "_rescued_data") == [("P", '{"a\\nb":"1"}')]


def test_no_files_and_only_headers(spark, raw):
    (raw / "e.csv").write_text("")
    assert feeds.read_feed(spark, HOLDINGS, str(raw)).count() == 0
    (raw / "h.csv").write_text("portfolio_id,quantity\n")
    table = feeds.read_feed(spark, HOLDINGS, str(raw))
    assert table.count() == 0 and table.columns == [*SCHEMAS[HOLDINGS].names, "_rescued_data"]
