"""Importance resampling, SimHash near-duplicates and collocations against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from holdfast.llm import phrases, resample, simhash
from holdfast.llm.common import written

LOW = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


# ---- importance resampling --------------------------------------------------------

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = ALNUM.findall((text or "").translate(LOW))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resample(docs, target, percent=5, least=20, buckets=10_000):
    of = lambda fs: [zlib.crc32(f.encode()) % buckets for f in fs]
    parsed = [(i, *runs(t)) for i, t in docs]
    s = Counter(b for *_, f in parsed for b in of(f))
    t = Counter(b for x in target for b in of(runs(x)[1]))
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * t_inv / ((s[b] + 1.0) * t_all)))
    t_inv = float(s_all)
    rows = []
    for i, words, f in parsed:
        weight = sum(gain(b) for b in of(f))
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), len(f), weight, weight + noise))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    rank = {id(r): n + 1 for n, r in enumerate(able[: len(able) * percent // 100])}
    return Counter((*r, rank.get(id(r))) for r in rows)


def test_resample_equals_plain(spark, folder, documents, con):
    target = [r[0] for r in con.execute("SELECT text FROM benchmark").fetchall()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = resample.resampled(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert Counter(tuple(r) for r in got.collect()) == plain_resample([(i, t) for i, t, _ in documents], target)


def test_resample_edges(spark, make, edge):
    rows, df = edge
    more = [(i, f"A{i % 3} " + "ähnlich " * 12 + "x" * (40 + i) + " b-c 9", "s") for i in range(10, 40)]
    more += [(7, more[0][1], "s")] * 5 + [(None, more[1][1], "s")] * 3
    target = spark.createDataFrame([("ähnlich ähnlich b", "x"), (None, "x"), ("", "x")], "text string, doc_id string")
    both = df.unionByName(make(*more))
    docs = [(i, t) for i, t, _ in [*rows, *more]]
    for percent in (5, 40, 100):
        got = Counter(tuple(r) for r in resample.resampled(both, target, percent, 5).collect())
        assert got == plain_resample(docs, ["ähnlich ähnlich b", None, ""], percent, 5)
    assert resample.resampled(df.filter("false"), target).count() == 0
    empty = Counter(tuple(r) for r in resample.resampled(df, target.filter("false"), 50, 1).collect())
    assert empty == plain_resample([(i, t) for i, t, _ in rows], [], 50, 1)


@pytest.mark.parametrize("k", [1, 2, 77, 400, 500])
def test_quickselect_finds_the_kth_key(spark, k):
    rows = [(i * 37 % 10, i) for i in range(500)]
    df = written(spark.createDataFrame(rows, "a int, b int"), "kth")
    assert tuple(resample.kth_key(df, ["a", "b"], k, pivots=3)) == sorted(rows)[k - 1]
    assert resample.kth_key(df.filter("a < 0"), ["a", "b"], 1) is None


def test_words_of_any_length_have_their_crc():
    text = f"a {'y' * 47} {'y' * 48} {'y' * 49} {'ö' * 400} z"
    raw = np.frombuffer(text.encode(), np.uint8)
    _, found = resample.feature_buckets(raw, np.array([0, len(raw)]))
    got = sorted(int(b) for f in found for b in f if b >= 0)
    assert got == sorted(zlib.crc32(f.encode()) % 10_000 for f in runs(text)[1])


# ---- SimHash ----------------------------------------------------------------------


def plain_print(text):
    words = SPACED.findall((text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def plain_components(values):
    """Smallest member of each value's component under at most three differing bits."""
    values = sorted(set(values))
    bits = np.array(values, np.uint64)
    least = list(range(len(values)))

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(bits[a + 1 :] ^ bits[a]) <= 3):
            x, y = sorted((root(a), root(a + 1 + int(b))))
            least[y] = x
    return {v: values[root(i)] for i, v in enumerate(values)}


def plain_simhash(docs):
    prints = [plain_print(t) for _, t in docs]
    component = plain_components(prints)
    ids = defaultdict(list)
    for (i, _), p in zip(docs, prints, strict=True):
        ids[component[p]].append(i)
    named = {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}
    return Counter((i, f"{p:016x}", named[component[p]], len(ids[component[p]]) - 1) for (i, _), p in zip(docs, prints, strict=True))


def test_simhash_equals_plain(spark, folder, documents):
    got = simhash.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    assert Counter(tuple(r) for r in got.collect()) == plain_simhash([(i, t) for i, t, _ in documents])


def test_simhash_edges(spark, make, edge, monkeypatch):
    rows, df = edge
    got = Counter(tuple(r) for r in simhash.near_duplicates(df).collect())
    assert got == plain_simhash([(i, t) for i, t, _ in rows])
    assert simhash.near_duplicates(df.filter("false")).count() == 0
    text = " ".join(f"w{i % 91}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole == plain_print(text)


@pytest.mark.parametrize("flips", [0.06, 0.2])
def test_families_of_near_prints_keep_every_link(spark, flips):
    """Large families around a few centres, chains between them, and unrelated prints."""
    rng = np.random.default_rng(5)
    values = {int(x) for x in rng.integers(0, 1 << 63, 150)}
    for _ in range(2):
        centre, noisy = int(rng.integers(0, 1 << 63)), rng.choice(64, 18, replace=False)
        for _ in range(350):
            v = centre
            for b in noisy[rng.random(18) < flips]:
                v ^= 1 << int(b)
            values.add(v)
    chain = int(rng.integers(0, 1 << 62))
    for step in range(20):
        values.add(chain)
        chain ^= 0b111 << (3 * step)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    nodes = written(spark.createDataFrame([(v, 1 + abs(v) % 4) for v in signed], "print bigint, n bigint"), "prints")
    got = {r[0]: r[1] for r in simhash.linked_prints(nodes).collect()}
    groups = defaultdict(list)
    for v, c in plain_components(values).items():
        groups[c].append(v - (1 << 64) if v >> 63 else v)
    assert got == {v: min(g) for g in groups.values() if len(g) > 1 for v in g}


def test_one_open_bit_finds_three_bits_only(spark):
    with pytest.raises(ValueError, match="3 bits"):
        simhash.linked_prints(spark.createDataFrame([(1, 1)], "print bigint, n bigint"), 4)


# ---- collocations -----------------------------------------------------------------


def plain_phrases(docs, least, longest=4, scale=2_000_000, contained=80, top=2000):
    count, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            count[lang].update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if a >= least}
        held = Counter()
        for p, a in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i : i + size]] = max(held[p[i : i + size]], a)
        found = []
        for p, a in often.items():
            if len(p) >= 2 and not (p in held and 100 * held[p] >= contained * a):
                score, k = min((scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def test_phrases_equal_plain(spark, folder, con):
    docs = con.execute("SELECT lang, text FROM documents").fetchall()
    df = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(map(tuple, phrases.collocations(df, least=8, top=300).collect())) == plain_phrases(docs, 8, top=300)


@pytest.mark.parametrize("block", [16, 1 << 21])
def test_phrases_in_small_blocks_and_edge_texts(spark, make, block, monkeypatch):
    rows = [("en", "New York is big. New York is old; new york\tIS  new\r\nYORK is" * 3), (None, "a b c d e a b c d e"), ("en", None),
            ("en", ""), ("en", " .,;\n"), ("und", "a b c d"), ("é", "x" * 500 + " y " + "x" * 500 + " y"), ("en", "new york is big, " * 40)]
    rows += [rows[0]] * 3
    columns = "lang string, text string, words string, part string, n string, cell string"
    df = spark.createDataFrame([(*r, "w", "p", "n", "c") for r in rows], columns).coalesce(2)
    if block < 100:
        # Workers read the module anew: the blocks are cut in this process
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        texts = [t for _, t in rows]
        whole = Counter()
        for grams in phrases._grams(texts, 4):
            for width, ids, at, count, _ in grams.widths:
                whole.update(dict(zip(grams.texts(width, ids, at), count.tolist(), strict=True)))
        want = Counter()
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
                words = re.findall(r"[^\x20\x09]+", piece)
                want.update(" ".join(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
        assert whole == want
        return
    assert sorted(map(tuple, phrases.collocations(df, least=2).collect())) == plain_phrases(rows, 2)
    assert phrases.collocations(df.filter("false"), least=2).count() == 0
    assert phrases.collocations(df, least=10_000).count() == 0


def test_summaries_lose_no_frequent_key():
    """Merged in pieces with a capacity beyond mass / least, every key with ``least`` occurrences survives."""
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.zipf(1.3, 20_000).astype(np.uint64) % np.uint64(5000), rng.integers(0, 1 << 60, 20_000).astype(np.uint64)])
    rng.shuffle(keys)
    least = 25
    capacity = len(keys) // least + 1
    held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lowered = 0
    for piece in np.array_split(keys, 17):
        k, c, by = phrases.merge_summary(
            np.concatenate([held[0], piece]), np.concatenate([held[1], np.ones(len(piece), np.int64)]), capacity
        )
        held, lowered = (k, c), lowered + by
        assert len(k) <= capacity
    true = Counter(keys.tolist())
    left = dict(zip(held[0].tolist(), held[1].tolist(), strict=True))
    assert 0 < lowered < least
    assert all(left.get(key, 0) <= n <= left.get(key, 0) + lowered for key, n in true.items())
    assert {key for key, n in true.items() if n >= least} <= {key for key, c in left.items() if c + lowered >= least}
