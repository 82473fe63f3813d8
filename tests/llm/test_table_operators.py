"""Archives, mixing, metric search and the pipeline."""

import gzip
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import lines, mixing, mtree, neardup, quality, warc
from holdfast.llm.common import body, held, written


def record(number, payload):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    digest = "sha1:" + hashlib.sha1(block).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{number}>\r\nWARC-Block-Digest: {digest}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


PAYLOADS = [b"first", b"text with WARC/1.0\r\n inside", b"third" * 50, b"", b"last"]


def damage(parts, how):
    parts = list(parts)
    if how == "flipped byte":
        parts[1] = parts[1][:-8] + bytes([parts[1][-8] ^ 1]) + parts[1][-7:]
    elif how == "cut":
        parts[1] = parts[1][: len(parts[1]) // 2]
    elif how == "junk before":
        parts.insert(1, b"\x00junk WARC/1. not a record\r\n")
    elif how == "broken length":
        parts[1] = parts[1].replace(b"Content-Length: ", b"Content-Length: 9")
    elif how == "end lost":
        parts[-1] = parts[-1][:-5]
    return b"".join(parts)


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("how", ["none", "flipped byte", "cut", "junk before", "broken length", "end lost"])
def test_salvage_recovers_later_records(how, packed):
    parts = [record(i, p) for i, p in enumerate(PAYLOADS)]
    if packed and how == "broken length":
        pytest.skip("the length is inside the member")
    if packed:
        parts = [warc.member(p) for p in parts]
    data = damage(parts, how)
    found = list(warc.salvage(data))
    ids = [r.headers["warc-record-id"] for r in found if not r.reason]
    lost = {"none": [], "junk before": [], "end lost": [4]}.get(how, [1])
    assert ids == [f"<urn:{i}>" for i in range(5) if i not in lost]
    gaps = [r for r in found if r.reason]
    assert bool(gaps) == (how != "none")
    assert all(data[g.start : g.end] == g.block for g in gaps)
    covered = sorted({(r.start, r.end) for r in found})
    assert covered[0][0] == 0 and covered[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))


def good_ids(data):
    return [r.headers["warc-record-id"] for r in warc.salvage(data) if not r.reason]


@pytest.mark.parametrize("start", ["flipped", "junk"])
def test_salvage_of_members_behind_a_bad_start(start):
    data = b"".join(warc.member(record(i, p)) for i, p in enumerate(PAYLOADS))
    data = b"\xff" + data[1:] if start == "flipped" else b"junk" + data
    assert good_ids(data) == [f"<urn:{i}>" for i in range(1 if start == "flipped" else 0, 5)]


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("how", ["first", "middle", "tail", "flipped", "cut before a member"])
def test_salvage_of_a_member_with_many_records(how, level):
    rng = np.random.default_rng(7)
    parts = [record(i, rng.integers(97, 123, 5000, dtype=np.uint8).tobytes()) for i in range(40)]
    lost = {"first": [0], "middle": [20]}.get(how, [])
    for i in lost:
        parts[i] = parts[i][:-10] + b"#" + parts[i][-9:]
    data = gzip.compress(b"".join(parts), level)
    if how == "tail":
        data = data[: len(data) // 2]
    elif how == "flipped":
        at = len(data) // 2
        data = data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]
    elif how == "cut before a member":
        data = data[: len(data) // 2] + warc.member(record(99, b"behind")) + record(100, b"plain behind")
    ids = good_ids(data)
    assert len(ids) == len(set(ids))
    if how in ("first", "middle"):
        assert ids == [f"<urn:{i}>" for i in range(40) if i not in lost]
    else:
        assert set(ids) >= {f"<urn:{i}>" for i in range(18)}
    if how == "cut before a member":
        assert ids[-2:] == ["<urn:99>", "<urn:100>"]
    covered = sorted({(r.start, r.end) for r in warc.salvage(data)})
    assert covered[0][0] == 0 and covered[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))


def test_archives_round_trip_with_damage(spark, tmp_path):
    html = "<p>" + "x" * 1200 + "é</p>"
    pages = spark.createDataFrame(
        [(1, "http://a/ b\n", html, "r"), (2, None, html, "r"), (2, "u", html, "r"), (None, "u", html, "r"), (4, "u", None, "r"), (5, "u", "short", "r"), (6, "u", "short", "r")],
        "page_id bigint, url string, html string, row_id string",
    )
    for gzipped in (True, False):
        path = str(tmp_path / f"archives-{gzipped}")
        warc.write(warc.planned(pages), path, gzipped=gzipped)
        got = warc.read(spark, path).collect()
        assert all(r.reason is None for r in got)
        assert Counter(r.record_type for r in got) == {"response": 4, "revisit": 3}
    rows = warc.round_trip(pages).collect()
    by_type = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes > 1000)
    assert by_type == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "revisit", 2)]
    assert {r.payload_digest for r in rows if r.payload_bytes > 1000} == {hashlib.sha1(html.encode()).hexdigest()}
    assert warc.round_trip(pages.filter("false")).count() == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "a.warc").write_bytes(damage([record(i, p) for i, p in enumerate(PAYLOADS)], "cut"))
    (broken / "empty.warc").write_bytes(b"")
    log = warc.gap_log(warc.read(spark, str(broken))).collect()
    assert len(log) == 1 and log[0].reason and log[0].end > log[0].start


def test_archives_keep_ids_of_all_64_bits(spark):
    html = "<p>" + "x" * 1200
    ids = [10**18, 2**63 - 1, -(2**63), -(10**18)]
    pages = spark.createDataFrame([(i, "u", html + str(i % 2)) for i in ids], "page_id bigint, url string, html string")
    rows = warc.round_trip(pages).collect()
    assert sorted(r.page_id for r in rows) == sorted(ids)
    assert {r.page_id: r.refers_to for r in rows if r.record_type == "revisit"} == {-(2**63): 10**18, -(10**18): 10**18}


def test_archives_are_cut_by_bytes(spark, tmp_path):
    rng = np.random.default_rng(4)
    text = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    sizes = [100] * 40 + [5000] * 20 + [30_000] * 4 + [90_000]
    pages = spark.createDataFrame(
        [(i, "u", text(n)) for i, n in enumerate(sizes)], "page_id bigint, url string, html string"
    ).coalesce(1)
    path = tmp_path / "archives"
    warc.write(warc.planned(pages), str(path), records_per_archive=50, gzipped=False, archive_bytes=50_000)
    got = warc.read(spark, str(path)).collect()
    assert sorted(r.page_id for r in got) == list(range(len(sizes))) and not any(r.reason for r in got)
    files = [f.stat().st_size for f in path.glob("part-*")]
    assert sum(n > 70_000 for n in files) == 1 and len(files) < len(sizes)


def test_mix_edges(edge, make):
    rows, df = edge
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(rows)
    assert all(r.taken <= 2 * r.size for r in plan)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(
        i for r in plan for i in [r.doc_id] * (r.taken // r.size if r.size else 0)
    )
    assert mixing.mix_plan(make((1, "a", "a")).filter("false")).count() == 0
    assert mixing.mix(make((1, None, "a"))).count() == 0


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    """One draw for all rows: they are cut into ranges by what follows it, and taken as if in one."""
    df = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("s").alias("source"),
                                  F.repeat(F.lit("w "), F.pmod("id", F.lit(7)).cast("int") + 1).alias("text"))
    seen = []
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 300)
    monkeypatch.setattr(mixing, "written", lambda frame, label: seen.append((label, out := written(frame, label))) or out)
    plan = mixing.mix_plan(df).collect()
    sizes = [r["count"] for r in dict(seen)["mix-order"].groupBy("bucket").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1500
    whole = sum(r.size for r in plan)
    assert 1.5 * whole - 7 <= sum(r.taken for r in plan) <= 1.5 * whole


def test_mix_comes_near_its_targets(spark, folder, documents):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.mix_plan(docs).collect()
    again = {r.doc_id: r.taken for r in mixing.mix_plan(docs.repartition(5)).collect()}
    assert {r.doc_id: r.taken for r in rows} == again
    source = {i: name for i, _, name in documents}
    taken, target, most = Counter(), {}, Counter()
    for r in rows:
        name = source[r.doc_id]
        taken[name] += r.taken
        target[name], most[name] = r.target, max(most[name], r.size)
    budget = sum(target.values())
    spare = 1 + sum(most.values()) / budget
    assert sum(taken.values()) <= budget
    assert all(t - most[n] <= taken[n] <= t * spare + most[n] for n, t in target.items())


@pytest.mark.parametrize("kind", ["random", "clusters", "ties", "zeros"])
def test_mtree_is_exact(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 8))
    if kind == "clusters":
        x = x * 0.05 + rng.normal(size=(7, 8))[np.arange(700) % 7] * 4
    elif kind == "ties":
        x = np.round(x[np.arange(700) % 20])
    elif kind == "zeros":
        x = np.zeros((700, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in mtree.nearest(df, 50).collect())
    q = np.floor(x * 256).astype(np.int64)
    want = []
    for i in range(0, 700, 50):
        s = q @ q[i]
        best = sorted((-int(s[j]), j) for j in range(700) if j != i)[:5]
        want += [(i, k + 1, j, -n) for k, (n, j) in enumerate(best)]
    assert got == want


def test_mtree_leaves_bad_vectors_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [2.0, 1.0]), (6, [1.0, 1.0, 1.0]),
            (None, [1.0, 1.0]), (7, []), (5, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, width string")
    got = [(r.query_id, r["rank"], r.vec_id) for r in mtree.nearest(df, 50).collect()]
    # Row 5 stands twice and takes two ranks
    assert got == [(0, 1, 5), (0, 2, 5)]
    assert mtree.nearest(df.filter("false"), 50).count() == 0


@pytest.mark.parametrize("k", [3, 7])
@pytest.mark.parametrize("large", [False, True])
def test_mtree_counts_every_row(spark, k, large):
    """Repeated rows, ids with several vectors and a repeated query, against all pairs of rows in whole numbers."""
    rows = [(1, [2.0, 2.0])] * 9 + [(0, [2.0, 2.0])] * 8 + [(i, [2.0, 2.0]) for i in range(2, 5)]
    rows += [(5, [3.0, 1.0]), (5, [1.0, 3.0])] + [(i, [1.0, 1.0]) for i in range(6, 9)] + [(0, [1.0, 1.0])] * 2 + [(50, [2.0, -1.0])]
    if large:
        # Inner products near 2**57, which doubles round
        rows = [(i, [v * 2.0**20 + i / 256.0 for v in x]) for i, x in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.nearest(df, 50, k).collect())
    whole = [(i, [int(np.floor(256 * v)) for v in x]) for i, x in rows]
    want = []
    for query in (0, 50):
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), j) for i, x in whole if i == query for j, y in whole if j != query]
        want += [(query, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    assert got == sorted(want)


def test_mtree_refuses_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(0, [2.0**30]), (1, [2.0**30])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="do not fit in 64 bits"):
        mtree.nearest(df, 50).collect()


def test_tree_prunes():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(2000, 3))
    nodes = mtree.build_nodes(points)
    assert max(len(n["rows"]) for n in nodes if n["leaf"]) <= mtree.PAGE
    assert sum(len(n["rows"]) for n in nodes if n["leaf"]) == 2000
    for n in nodes:
        if n["leaf"]:
            assert (n["distance"] <= n["radius"] + 1e-9).all()


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-duplicates", "mixing", "bpe"]
    kept = written(corpus_pipeline.quality_rules(spark, docs, folder), "t")
    ids = {r.doc_id for r in quality.ledger(docs).filter("_ledger.failed_bits = 0").select("doc_id").collect()}
    assert {r.doc_id for r in kept.collect()} == ids and kept.columns == columns
    cleaned = written(corpus_pipeline.line_dedup(spark, kept, folder), "t")
    texts = {r.row_id: r.text for r in lines.cleaned(body(held(kept, "t"))).collect()}
    assert sorted(r.text for r in cleaned.collect()) == sorted(t for t in texts.values() if t.split())
    assert all(r.n_chars == len(r.text) for r in cleaned.collect()) and cleaned.columns == columns
    single = written(corpus_pipeline.near_duplicates(spark, cleaned, folder), "t")
    stays = neardup.near_duplicates(body(held(cleaned, "t"))).filter("stays")
    assert Counter(r.doc_id for r in single.collect()) == Counter(r.doc_id for r in stays.collect())
    mixed = written(corpus_pipeline.mix_sources(spark, single, folder), "t")
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_plan(single).collect() if r.taken}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(taken) and mixed.columns == columns
    final = corpus_pipeline.encode(spark, mixed, folder).collect()
    text = {r.doc_id: r.text for r in mixed.collect()}
    assert len(final) == mixed.count()
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in final)
    assert public_tokenizers.PATTERN
