"""Every pipeline stage on nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import pytest

import corpus_pipeline
from holdfast.llm.common import written

STAGES = dict(corpus_pipeline.STAGES)


def ids(df):
    return sorted((-1 if r.doc_id is None else r.doc_id) for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def all_edges(edge, make):
    rows, df = edge
    good = " ".join(f"token{i} word{i * 7 % 13}" for i in range(60))
    more = [(20, good, "a"), (20, good, "a"), (21, good + " and more", None), (None, good.replace("token", "other"), "b")]
    return [*rows, *more], written(df.unionByName(make(*more)), "edges")


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_keeps_columns_and_takes_any_row(spark, folder, all_edges, name):
    rows, df = all_edges
    out = STAGES[name](spark, df, folder)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    got = ids(out)
    every = sorted(-1 if i is None else i for i, *_ in rows)
    blank = [i for i, t, _ in rows if not (t or "").strip()]
    if name == "quality rules":
        # Document 4 holds a word of 70,000 characters
        assert set(got) == {20, 21, -1} and got.count(20) == 2
    elif name == "line dedup":
        assert got == every
    elif name == "near-duplicates":
        # One of the equal texts stays; texts without words are linked with nothing
        assert got.count(20) == 1 and got.count(6) == 1 and 7 not in got and 21 not in got
        assert all((-1 if i is None else i) in got for i in blank)
    elif name == "mixing":
        assert set(got) <= set(every) and not {1, 2, 3} & set(got)
    else:
        assert got == every
    empty = STAGES[name](spark, df.filter("false"), folder)
    assert empty.count() == 0 and (name == "bpe" or empty.columns == df.columns)
