"""Every word before has a restaurant of its own, and what the parts hear of it is the sum over all parts."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from holdfast.llm import hpylm
from holdfast.llm.shingles import text_chunks, word_hashes


def _hash(word):
    (raw, offsets), = text_chunks(pa.array([word]))
    return int(word_hashes(raw, offsets)[0][0])


def test_two_words_of_one_old_bucket_are_two_contexts(spark):
    """Words whose hashes were one of 4,096 restaurants before: what follows one says nothing of what follows the other."""
    seen = defaultdict(list)
    for i in range(400):
        seen[(_hash(f"w{i}") >> 40) % 4096].append(f"w{i}")
    a, b = next(v for v in seen.values() if len(v) > 1)[:2]
    rows = [(i, True, f"{a} left end {b} right end") for i in range(40)]
    rows += [(100, False, f"{a} left end"), (101, False, f"{a} right end"), (102, False, f"{b} left end"), (103, False, f"{b} right end")]
    _, sums = hpylm.score(spark.createDataFrame(rows, "row_id bigint, train boolean, text string"))
    score = {r.row_id: r.score for r in sums.collect()}
    assert score[100] > score[101] + 1 and score[103] > score[102] + 1


def test_contexts_are_whole_hashes_of_the_word_before():
    (token, context, of), = hpylm.token_chunks(pa.array(["one two", None, "three"]))
    end = int(hpylm._END)
    assert token.tolist() == [_hash("one"), _hash("two"), end, end, _hash("three"), end]
    assert context.tolist() == [end, _hash("one"), _hash("two"), end, end, _hash("three")]
    assert of.tolist() == [0, 0, 0, 1, 2, 2]


def test_parts_hear_the_sums_over_all_parts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).select("doc_id", "text").collect()
    rows = [(i, r.doc_id % 5 != 1, r.text) for i, r in enumerate(docs)]
    model, table = hpylm.fit(spark.createDataFrame(rows, "row_id bigint, train boolean, text string"))
    customers, kinds = Counter(), defaultdict(set)
    for _, train, text in rows:
        words = [_hash(w) for w in (text or "").split()]
        for before, word in zip([int(hpylm._END), *words], [*words, int(hpylm._END)], strict=True):
            customers[before] += train
            kinds[before].add(word) if train else None
    heard, told = Counter(), Counter()
    for row in table.toArrow().to_pylist():
        part = hpylm.Part(row, model)
        own, = hpylm._unpacked(row["customers"], np.int64)
        assert len(own) == part.in_shard.sum() == len(part.heard[0]) == len(part.heard[1])
        # In the order of the contexts' hashes; a context of several parts has the same totals in each
        for n, t in zip(own.tolist(), part.heard[0].tolist(), strict=True):
            heard[n, t] += 1
        tables, *_ = next(part.replay())
        told.update({"tables": int(tables.sum()), "customers": int(part.counts.sum())})
    assert told["customers"] == sum(customers.values())
    assert {n for n, _ in heard} == set(customers.values())
    assert sum(model.sweeps[hpylm.SWEEPS + 1 - hpylm.SAMPLES].tables) == told["tables"]
    # At least a table for each word behind a context, and no more than customers
    least = min(len(kinds[c]) for c, n in customers.items() if n == max(customers.values()))
    assert all(t <= n for n, t in heard) and all(t >= least for n, t in heard if n == max(customers.values()))


def test_a_shard_adds_up_what_parts_tell():
    rng = np.random.default_rng(5)
    parts = {p: np.sort(rng.choice(1 << 40, 30, replace=False) % 97 + 5).astype(np.uint64) for p in (3, 8, 11)}
    parts = {p: np.unique(c) for p, c in parts.items()}
    n = {p: rng.integers(1, 9, len(c)) for p, c in parts.items()}
    rows = [{"shard": 2, "part": p, "data": hpylm._packed(c, n[p])} for p, c in parts.items()]
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])
    routes = hpylm._routed(pa.Table.from_pylist(rows, schema)).to_pylist()
    want = Counter()
    for p, c in parts.items():
        for context, k in zip(c.tolist(), n[p].tolist(), strict=True):
            want[context] += k
    told = [{"part": r["part"], "at": r["at"], "is_rank": True, "data": r["ranks"]} for r in routes]
    told += [{"part": p, "at": 2, "is_rank": False, "data": hpylm._packed(n[p])} for p in parts]
    schema = pa.schema([("part", pa.int32()), ("at", pa.int32()), ("is_rank", pa.bool_()), ("data", pa.binary())])
    answers = {r["part"]: r for r in hpylm._answer(pa.Table.from_pylist(told, schema)).to_pylist()}
    for r in routes:
        sums = [want[c] for c in parts[r["part"]].tolist()]
        assert hpylm._unpacked(r["customers"], np.int64)[0].tolist() == sums
        assert hpylm._unpacked(answers[r["part"]]["data"], np.int64)[0].tolist() == sums and answers[r["part"]]["at"] == 2


def test_a_part_counts_what_was_dealt_whether_contexts_are_common_or_not():
    rng = np.random.default_rng(7)
    texts = pa.array([" ".join(f"w{w}" for w in rng.integers(0, 50, 20)) for _ in range(100)])
    batch = pa.RecordBatch.from_arrays([pa.array(rng.permutation(1000)[:100]), pa.array([True, False] * 50), texts], ["row_id", "train", "text"])
    model = hpylm.Model(1, np.zeros(0, np.uint64), common=np.sort(np.array([_hash(f"w{i}") for i in range(0, 50, 2)], np.uint64)))
    plain = hpylm.Model(1, np.zeros(0, np.uint64))
    gathered = [hpylm._gather(pa.Table.from_batches(list(hpylm._deal(m)(iter([batch])))), m.common).to_pylist() for m in (model, plain)]
    assert gathered[0] == gathered[1]
    found = Counter()
    words, contexts = (np.frombuffer(gathered[0][0][c], np.uint64) for c in ("words", "contexts"))
    types, places, counts = (np.frombuffer(gathered[0][0][c], t) for c, t in (("word_types", np.int32), ("places", np.int64), ("counts", np.int64)))
    for w, c, k in zip(np.repeat(words, types).tolist(), contexts[places].tolist(), counts.tolist(), strict=True):
        found[w, c] = k
    want = Counter()
    for text, train in zip(texts.to_pylist(), [True, False] * 50, strict=True):
        ws = [_hash(w) for w in text.split()]
        for c, w in zip([int(hpylm._END), *ws], [*ws, int(hpylm._END)], strict=True):
            want[w, c] += train
    assert found == want and set(found) == set(want)
