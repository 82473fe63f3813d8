"""Personal data, near-duplicates, language model, tokens: against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from holdfast.llm import hpylm, lines, neardup, pii, quality, secrets, shingles, tokens
from holdfast.llm.common import body, held
from holdfast.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda g: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda g: all(int(p) <= 255 for p in g.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda g: 14 <= len(digits(g)) <= 19 and luhn(digits(g))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda g: 10 <= len(digits(g)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m.group()))


def test_personal_data_base_and_digest(spark, folder, documents):
    got = {r.doc_id: r for r in QUERIES["op1_contextual_pii"](spark, folder).collect()}
    assert len(got) == len(documents)
    for doc_id, text, _ in documents:
        spans = base_spans(text or "")
        joined = ",".join(f"{pii.BASE[k]}:{s}:{e}" for s, k, e in spans)
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))


@pytest.mark.parametrize("text", [
    "a@b", "x@y.z_d@e.f", "a@b@c.d", "..@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.4", "1" * 6000 + ".1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "+1 (234) 567-8901", "+12345678901234567", "+1(((((", "é4111111111111111é",
])
def test_base_patterns_on_awkward_texts(text):
    if len(text) < 5000:
        assert pii.base_spans(text) == base_spans(text)
    else:
        assert [s[1] for s in pii.base_spans(text)] == []


def test_contexts_find_unseen_identifiers(make):
    seeds = [(i, f"Hello there, reach me under +1 (20{i}) 555-120{i} today, thanks", "a") for i in range(5)]
    unseen = [(10, "For questions reach me under 555-7713 today", "a"), (11, "the sum of 12345 apples", "a"),
              (12, "we counted 12345 apples", "b"), (12, "we counted 12345 apples", "b")]
    rows = pii.personal_spans(make(*seeds, *unseen)).collect()
    found = {r.doc_id: [(s.start, s.end) for s in r.found] for r in rows}
    assert found[10] == [(29, 37)]
    assert found[11] == found[12] == []
    assert sum(r.doc_id == 12 for r in rows) == 2


def test_a_common_word_is_no_pattern(make):
    rows = [(i, f"the +1 (20{i}) 555-120{i} and the cat and the dog", "a") for i in range(5)]
    rows += [(10, "the 5551234 and more", "a")]
    assert all(not r.found for r in pii.personal_spans(make(*rows)).collect())


def word_set(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def groups(rows):
    """Component per row by comparing all pairs."""
    sets = [word_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return [smallest.get(find(i)) for i in range(len(rows))], sets


def test_near_duplicates(spark, folder, documents):
    got = {r.doc_id: r for r in QUERIES["op2_min_max_hash"](spark, folder).collect()}
    component, sets = groups([(i, t) for i, t, _ in documents])
    for (doc_id, _, _), c, s in zip(documents, component, sets, strict=True):
        assert (got[doc_id].component_id, got[doc_id].n_shingles, got[doc_id].kept) == (c, len(s), c == doc_id)


def test_near_duplicates_of_a_family_without_all_pairs(make):
    """Copies of one text with their own changes: links among them go beyond the first lead."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for p in rng.choice(120, rng.integers(0, 7), replace=False):
            words[p] = f"x{i}" if rng.random() < 0.7 else f"y{p % 3}"
        rows.append((i, " ".join(words), "a"))
        if i % 10 == 0:
            words[5] = "z"
            rows.append((1000 + i, " ".join(words), "a"))
    df = make(*rows)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(body(held(df, "t"))).collect()}
    component, _ = groups([(i, t) for i, t, _ in rows])
    assert got == {i: c for (i, _, _), c in zip(rows, component, strict=True)}


def test_near_duplicate_edges(edge):
    rows, df = edge
    got = neardup.near_duplicates(body(held(df, "t"))).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.doc_id in (6, 7)]
    assert {r.component_id for r in same} == {6} and sum(r.stays for r in same) == 1
    assert all(r.n_shingles == 0 and r.stays for r in got if r.doc_id in (1, 2, 3))
    kept = neardup.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2


def test_signature_extremes_agree_as_the_sets_do():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    one, two = (neardup.min_max_signature(np.concatenate([shared, x]), 2048) for x in (a, b))
    assert abs((one == two).mean() - 600 / 800) < 0.03


def test_word_hashes_split_as_bytes_do():
    texts = ["A b\tC\x0bd", "", None, "é È x", "a", "x" * 50 + " \r\n y"]
    column = pa.array(texts)
    (raw, offsets), = list(shingles.text_chunks(column))
    hashed, at = shingles.word_hashes(raw, offsets)
    want = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, hashed.tolist(), strict=True))) == len(set(flat)) == len(set(hashed.tolist()))


def test_language_model(spark, folder, documents):
    rows = QUERIES["op3_pitman_yor"](spark, folder).collect()
    token = {i: [*(t or "").encode().lower().split(), None] for i, t, _ in documents}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in token}
    counts = Counter(w for i, ws in token.items() if not out[i] for w in ws)
    total, words = sum(counts.values()), len(counts)
    for r in rows:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (words + 1))) for w in token[r.doc_id])
        assert math.isclose(base, r.base_score, rel_tol=1e-9)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(token[r.doc_id]), total)
        assert r.n_known == sum(counts[w] > 0 for w in token[r.doc_id])
    held_rows = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows)


def test_language_model_predictions_sum_to_one(spark, folder, monkeypatch):
    """Over all words and the unknown, in every context, also with words dealt in slices."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    rows = held(docs, "t").select("row_id", (F.col("doc.doc_id") % 5 != 1).alias("train"), "doc.text")
    model, table = hpylm.fit(rows)
    assert len(model.frequent)
    mass = np.zeros(hpylm.CONTEXTS)
    root = 0.0
    for row in table.toArrow().to_pylist():
        part = hpylm.Part(row, model)
        *_, before, _ = list(part.replay())
        tables, customers, root_tables = before
        mass += np.bincount(part.contexts, np.maximum(part.counts - hpylm.DISCOUNT * tables, 0), hpylm.CONTEXTS)
        last = part.root_chance(customers, root_tables, model.sweeps[-1])
        plain = ~part.is_frequent & (part.word_counts > 0)
        root += last[plain].sum()
    before = model.sweeps[-1]
    root += hpylm.root_probability(before.frequent_customers, before.frequent_tables, before, model.n_words).sum()
    root += hpylm.root_probability(np.zeros(1), np.zeros(1), before, model.n_words).sum()
    assert math.isclose(root, 1.0, rel_tol=1e-9)
    whole = (mass + hpylm.STRENGTH + hpylm.DISCOUNT * before.tables) / (hpylm.STRENGTH + model.contexts)
    assert np.allclose(whole, 1.0)
    assert before.customers >= model.n_words


def test_language_model_edges(edge, make):
    rows, df = edge
    got = hpylm.scored(df).collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3))
    assert all(math.isfinite(r.score) for r in got)
    assert hpylm.scored(make((1, "a", "a")).filter("false")).count() == 0


def test_seats_stay_in_bounds():
    counts = np.array([0, 1, 2, 5, 100, 100_000])
    tables = hpylm.seat(counts, lambda w, t: np.full(len(w), 3.0), 0.5, np.random.default_rng(1))
    assert (tables <= counts).all() and (tables >= np.minimum(counts, 1)).all() and tables[-1] > tables[3]


def test_tokens(spark, folder, documents):
    whole = tokens.encoding(PATH, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, folder).collect()}
    for doc_id, text, _ in documents:
        ids = whole.encode_ordinary(text or "")
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("text", [
    "hello  world \n\n it's " * 9000, "é" * 150_000, " " * 150_000 + "x", "a  　b\t" * 30_000,
    "x\x1c !\x1c " * 30_000, "<|endoftext|> " * 9000,
])
def test_long_texts_are_cut_safely(text):
    assert isinstance(tokens.encoding(PATH, public_tokenizers.PATTERN), tiktoken.Encoding)
    assert tokens.encode_text(text, PATH, public_tokenizers.PATTERN) == tokens.encoding(PATH, public_tokenizers.PATTERN).encode_ordinary(text)
    assert "".join(tokens.pieces(text, 1000)) == text


def test_very_many_short_texts_keep_their_numbers(monkeypatch):
    """More texts in one chunk than 16 bits number: each is dealt with its own row."""
    texts = pa.array([f"w{i % 5}" for i in range(150)])
    monkeypatch.setattr(hpylm, "DEAL_DOCS", 64)
    model = hpylm.Model(3, np.zeros(0, np.uint64))
    batch = pa.RecordBatch.from_arrays([pa.array(range(150)), pa.array([True] * 150), texts], ["row_id", "train", "text"])
    rows = [r for b in hpylm._deal(model)(iter([batch])) for r in pa.Table.from_batches([b]).to_pylist()]
    found = Counter()
    for part in range(3):
        own = [r for r in rows if r["part"] == part]
        if own:
            table = hpylm._gather(pa.Table.from_pylist(own)).to_pylist()[0]
            for row, n in zip(np.frombuffer(table["rows"], np.int64).tolist(), np.frombuffer(table["n"], np.int32).tolist(), strict=True):
                found[row] += n
    assert found == Counter(dict.fromkeys(range(150), 2))


def test_token_edges(edge):
    rows, df = edge
    out = tokens.token_columns(df, PATH, public_tokenizers.PATTERN, ("n_tokens", "ids", "decoded"), keep=("doc_id", "node"))
    got = out.collect()
    assert sorted(bytes(r.decoded).decode() for r in got) == sorted(t or "" for _, t, _ in rows)
    assert all(r.node == "x" for r in got)
    with pytest.raises(ValueError):
        tokens.token_columns(df.withColumn("ids", F.lit(1)), PATH, public_tokenizers.PATTERN, ("ids",), keep=("ids",))


def test_quality_edges_and_ablations(edge, make):
    rows, df = edge
    noted = quality.ledger(df.select("doc_id", "text")).select("doc_id", "_ledger.*")
    assert noted.count() == len(rows)
    assert quality.filtered(df).columns == df.columns
    good = " ".join(f"token{i}" for i in range(60))
    odd = make((1, good, "a"), (2, "# " * 80, "a"), (3, good.replace(" ", " # "), "a"), (4, "few", "a"))
    assert [r.doc_id for r in quality.filtered(odd).collect()] == [1]
    bits = quality.ledger(odd).select(F.col("_ledger.failed_bits").alias("failed_bits"))
    table = {(r.version, r.rule): (r.failing, r.only_this_rule, r.kept) for r in quality.ablations(bits).collect()}
    assert table[1, "few_words"] == (1, 1, 2)
    assert table[2, "many_symbols"] == (2, 1, 1)


def test_line_chunk_edges(edge, make):
    rows, df = edge
    got = lines.cleaned(body(held(df, "t"))).collect()
    assert len(got) == len(rows) and all(r.n_removed == 0 for r in got)
    passage = "".join(f"Sentence number {i} of a passage that stands in several documents. " for i in range(12))
    docs = make((1, "Alpha begins. " + passage, "a"), (2, "Beta is other. Gamma too\n" + passage + "Ends here.", "b"), (3, passage, None),
                (3, passage, None), (5, "A text of its own. It has two sentences in it.", "a"))
    out = {}
    for r in lines.deduplicated(docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert out[1][0].text == "Alpha begins. " + passage
    assert out[2][0].text.startswith("Beta is other.") and len(out[2][0].text) < len(passage) / 2
    assert out[2][0].n_chars == len(out[2][0].text) and out[2][0].places == "x"
    assert out[5][0].text == "A text of its own. It has two sentences in it."


def test_planted_passages_go_mostly(make):
    """Passages of short sentences among other text: each loses most of its words but in the first document."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 9)))
    said = lambda n: " ".join(" ".join(word() for _ in range(rng.randint(3, 12))).capitalize() + rng.choice((". ", ".\n")) for _ in range(n))
    planted = [said(16) for _ in range(8)]
    rows = [(i, said(6) + planted[i % 8] + said(6), "s") for i in range(40)]
    kept = {r.doc_id: r.text for r in lines.deduplicated(make(*rows)).collect()}
    words = lambda t: Counter(t.split())
    lost = whole = 0
    for i, text, _ in rows:
        if i < 8:
            assert kept[i] == text
            continue
        gone = words(text) - words(kept[i])
        assert not gone - words(planted[i % 8])
        lost, whole = lost + sum(gone.values()), whole + len(planted[i % 8].split())
    assert lost > 0.6 * whole


def test_chunks_have_two_lines(spark):
    text = "".join(f"Line {i * 7919 % 101}. " for i in range(200))
    chunks = lines.with_chunks(spark.createDataFrame([(text,)], "text string")).first()._chunks
    assert all(c.n_lines >= 2 for c in chunks[:-1]) and "".join(c.body for c in chunks) == text


def test_secret_edges_and_links(edge, make):
    rows, df = edge
    got = secrets.secret_spans(df).collect()
    assert len(got) == len(rows) and all(r.spans == "" for r in got)
    token = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dE3fG5"
    docs = make(
        (1, f"key AKIA{'A1' * 8} then {token} at https://x.example.org/a ok", "a"),
        (2, f"only {token} here", "a"), (3, "see https://x.example.org/a", "a"),
        (4, f"key AKIA{'A1' * 8}" + " far" * 80 + f" {token}", "a"),
        (5, "token=token: abcdefgh and username = bob, password: hunter22", "a"), (5, "é token = 'abcdef'", "a"),
    )
    spans = {}
    for r in secrets.secret_spans(docs).collect():
        spans.setdefault(r.doc_id, set()).update(filter(None, r.spans.split(",")))
    assert {s.split(":")[0] for s in spans[1]} == {"access", "weak_secret", "endpoint"}
    assert spans[2] == spans[3] == set()
    assert {s.split(":")[0] for s in spans[4]} == {"access"}
    assert spans[5] == {"assign:2:17", "assign:42:60", "weak_id:26:40"}
