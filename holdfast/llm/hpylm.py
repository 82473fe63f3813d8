"""A hierarchical Pitman-Yor language model: seating by forward sweeps, averaged predictions.

Every context, the word before, has a restaurant of its own, however many there are; all contexts share the
root restaurant as parent, whose base is uniform over the training words and one unknown. The corpus is
dealt by word: a part holds all customers of its words, their contexts and the documents they stand in, so
seats in the root are drawn within the part. The tables of a context are spread over the parts that have
words behind it: after a sweep each part tells its own to the context's shard, and the shard answers with
the sum. Beyond that parts share totals alone, of a known size. A sweep redraws every dish's tables from
empty against those totals; no customer is reseated given all others.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import body, held, written
from holdfast.llm.shingles import mix, stream, text_chunks, word_hashes

# The driver gets sums over the contexts of a shard, in so many groups at most: numbers to check by, no restaurants
CONTEXTS = 4096
# Discount and strength of the context restaurants and of the root
DISCOUNT, STRENGTH = 0.8, 5.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 10.0
# Sweeps, and how many of the last are averaged
SWEEPS, SAMPLES = 4, 2
SEED = 20240229
# Characters of text whose words one part holds, about; a map task deals so many at once
PART_CHARS = 5_000_000
DEAL_BYTES = 16_000_000
DEAL_DOCS = 60_000
LEAST_PARTS = 32
PARTS_PER_SHEAF = 4
PARTS_PER_SHARD = 16
# Parts tell scores as whole numbers of 1 / UNIT, so that sums don't depend on the order in which they come
UNIT = 1 << 30
# Frequent words are dealt in slices of their contexts. Their number is at most twice this
FREQUENT = 20_000
SLICES = 64
# Customers seated one by one; beyond, in blocks of a sixteenth of those seated
ONE_BY_ONE = 64
# Contexts that are written as 16 bits where words are dealt, and as their hash otherwise: at most twice as many
COMMON = 32_000

_U = np.uint64
_END = stream(41, 1)[0]


@dataclass
class Totals:
    """What a sweep is drawn from beside the contexts' totals: fixed-size vectors and numbers."""

    tables: np.ndarray  # per group of contexts
    customers: float  # of the root
    root_tables: float
    frequent_customers: np.ndarray  # of the root, per frequent word
    frequent_tables: np.ndarray


@dataclass
class Model:
    parts: int
    frequent: np.ndarray  # word hashes, sorted
    frequent_counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    contexts: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXTS, np.int64))  # customers per group
    n_tokens: int = 0
    n_words: int = 0
    sweeps: list[Totals] = field(default_factory=list)
    common: np.ndarray = field(default_factory=lambda: np.zeros(0, _U))  # word hashes, sorted

    @property
    def sheaves(self) -> int:
        """Groups of documents in which the parts' sums are added up."""
        return max(LEAST_PARTS, self.parts // PARTS_PER_SHEAF)

    @property
    def shards(self) -> int:
        """Ranges of context hashes in which the parts' tables are added up."""
        return max(LEAST_PARTS, self.parts // PARTS_PER_SHARD)

    def slices(self) -> tuple[np.ndarray, np.ndarray]:
        """Stand-in words of the frequent words' slices, sorted, and the word of each."""
        if not len(self.frequent):
            return np.zeros(0, _U), np.zeros(0, np.int64)
        stand_in = _slice_word(np.repeat(self.frequent, SLICES), np.tile(np.arange(SLICES), len(self.frequent)))
        order = np.argsort(stand_in)
        return stand_in[order], np.repeat(np.arange(len(self.frequent)), SLICES)[order]


def _slice_word(word: np.ndarray, number: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(word + (number.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns as one compressed string, byte by byte of their values: equal high bytes lie together."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return np.array([len(c) for c in columns], np.int32).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes | pa.Buffer, *types: type) -> list[np.ndarray]:
    head = 4 * len(types)
    lengths = np.frombuffer(data[:head], np.int32).tolist()
    sizes = [np.dtype(t).itemsize for t in types]
    raw = pa.decompress(data[head:], sum(n * s for n, s in zip(lengths, sizes, strict=True)), codec="zstd", asbytes=True)
    columns, at = [], 0
    for t, n, size in zip(types, lengths, sizes, strict=True):
        columns.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(t).ravel())
        at += n * size
    return columns


def _member(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in the sorted array, and its place there."""
    place = np.searchsorted(among, values)
    if not len(among):
        return np.zeros(len(values), bool), place
    place = np.minimum(place, len(among) - 1)
    return among[place] == values, place


def token_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token, context, text number) of consecutive texts; each text closes with an end token.

    The context is the token before, whole; a text's first one has the end token as context.
    """
    first = 0
    for raw, offsets in text_chunks(column):
        hashed, at = word_hashes(raw, offsets)
        docs = len(offsets) - 1
        owner = np.repeat(np.arange(docs), np.diff(at))
        token = np.empty(len(hashed) + docs, _U)
        of = np.empty(len(token), np.int64)
        place = np.arange(len(hashed)) + owner
        token[place], of[place] = hashed, owner
        ends = at[1:] + np.arange(docs)
        token[ends], of[ends] = _END, np.arange(docs)
        before = np.concatenate([[_END], token[:-1]])
        yield token, before, of + first
        first += docs


def _short_runs(chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The chunks cut so that none has more than ``DEAL_DOCS`` texts, whose numbers fit in 16 bits."""
    for token, context, of in chunks:
        cuts = np.searchsorted(of, np.arange(of[0], of[-1] + 1, DEAL_DOCS)).tolist() + [len(of)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield token[a:b], context[a:b], of[a:b]


def _frequent(share: float):
    """Task: its tokens' number, and the words that are at least half that share of them.

    A word with that share of all tokens has at least half of it in the tasks that name it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, counts = 0, np.zeros(0, _U), np.zeros(0, np.int64)
        for batch in batches:
            for token, _, _ in token_chunks(batch.column(0)):
                total += len(token)
                w, n = np.unique(token, return_counts=True)
                keep = n >= share / 2 * len(token)
                words, counts = np.concatenate([words, w[keep]]), np.concatenate([counts, n[keep]])
                if len(words) > 1 << 16:
                    words, counts = _summed(words, counts)
        words, counts = _summed(words, counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[0], words.view(np.int64)])),
                pa.array(np.concatenate([[total], counts])),
                pa.array([True] + [False] * len(words)),
            ],
            names=["word", "n", "is_total"],
        )

    return run


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, place = np.unique(words, return_inverse=True)
    return words, np.bincount(place, counts, len(words)).astype(np.int64)


_DEALT = "part int, dealt binary"
# A dealt row: words, their runs, contexts (one more than the place among the common ones, or zero and the next
# of the others), documents, and of these documents the row numbers' steps and whether they train
_DEALT_TYPES = (_U, np.int32, np.uint16, _U, np.uint16, np.int64, np.bool_)


def _deal(model: Model):
    """Task: its tokens sorted by word, one row per part."""

    def coded(token: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens with the slices of the frequent ones, codes of the contexts, and the contexts without one."""
        hot, _ = _member(token, model.frequent)
        token = token.copy()
        token[hot] = _slice_word(token[hot], (context[hot] >> _U(40)) % _U(SLICES))
        common, place = _member(context, model.common)
        return token, np.where(common, place + 1, 0).astype(np.uint16), context[~common]

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        token, code, others, doc, rows, train = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(token)
        token = token[order]
        number = np.cumsum(code == 0, dtype=np.int32)
        code = code[order]
        others = others[number[order[code == 0]] - 1]
        doc = doc[order]
        del order, number
        part = ((token >> _U(32)) * _U(model.parts)) >> _U(32)
        cut = np.searchsorted(part, np.arange(model.parts + 1))
        del part
        at = 0
        for p in np.flatnonzero(np.diff(cut)):
            a, b = cut[p], cut[p + 1]
            new = np.flatnonzero(np.concatenate([[True], token[a + 1 : b] != token[a : b - 1]]))
            runs = np.diff(np.concatenate([new, [b - a]])).astype(np.int32)
            # Only the documents with a word in the part, however many the others are
            own, place = np.unique(doc[a:b], return_inverse=True)
            steps = np.diff(rows[own].astype(np.int64), prepend=0)
            n = np.count_nonzero(code[a:b] == 0)
            dealt = _packed(
                token[a:b][new], runs, code[a:b], others[at : at + n], place.astype(np.uint16), steps, train[own].astype(np.bool_)
            )
            at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p)], pa.int32()), pa.array([dealt], pa.binary())], names=["part", "dealt"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs = [], 0, 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for token, context, of in _short_runs(token_chunks(batch.column(2))):
                first, last = int(of[0]), int(of[-1]) + 1
                if held and (size + len(token) * 8 > DEAL_BYTES or docs + last - first > DEAL_DOCS):
                    yield from flush(held)
                    held, size, docs = [], 0, 0
                held.append((*coded(token, context), (of - first + docs).astype(np.uint16), rows[first:last], train[first:last]))
                size, docs = size + len(token) * 8, docs + last - first
        if held:
            yield from flush(held)

    return run


_PART = "part int, seats binary, entries binary, contexts binary"
# words, their number of contexts, steps of these contexts' places among the part's own, training counts, and how many
# of the part's contexts each shard has
_SEAT_TYPES = (_U, np.int32, np.int32, np.int64, np.int32)
# documents of each word and context, steps of their rows, occurrences
_ENTRY_TYPES = (np.int32, np.int64, np.int32)
# The part's contexts, sorted, and their customers in the part
_CONTEXT_TYPES = (_U, np.int64)


def _gather(table: pa.Table, common: np.ndarray | None = None) -> pa.Table:
    """One part: its words' contexts with training counts, and the documents of each.

    A document comes in one dealt row only. Rows are sorted by one number of word, context and document where it fits.
    """
    words, runs, context, rows, doc, train = [], [], [], [], [], []
    docs = 0
    for dealt in table["dealt"]:
        own, run, code, others, place, steps, trains = _unpacked(dealt.as_buffer(), *_DEALT_TYPES)
        of = np.empty(len(code), _U)
        of[code == 0] = others
        if len(others) < len(code):
            of[code > 0] = common[code[code > 0] - 1]
        words.append(own)
        runs.append(run)
        context.append(of)
        rows.append(np.cumsum(steps))
        doc.append(place.astype(np.int64) + docs)
        train.append(trains)
        docs += len(steps)
    runs, rows, train = map(np.concatenate, (runs, rows, train))
    words, word = np.unique(np.concatenate(words), return_inverse=True)
    contexts, pair = np.unique(np.concatenate(context), return_inverse=True)
    context.clear()
    pair += np.repeat(word, runs) * len(contexts)
    doc = np.concatenate(doc)
    if len(words) * len(contexts) * docs < 1 << 62:
        pair *= docs
        pair += doc
        pair.sort()
        doc = pair % docs
        pair //= docs
    else:
        order = np.lexsort((doc, pair))
        pair, doc = pair[order], doc[order]
    train = train[doc]
    new_type = np.concatenate([[True], pair[1:] != pair[:-1]])
    new_entry = new_type | np.concatenate([[True], doc[1:] != doc[:-1]])
    types, entries = np.flatnonzero(new_type), np.flatnonzero(new_entry)
    columns = {
        "words": words, "word_types": np.bincount(pair[types] // len(contexts), minlength=len(words)).astype(np.int32),
        "contexts": contexts, "places": pair[types] % len(contexts), "counts": np.add.reduceat(train.astype(np.int64), types),
        "type_entries": np.add.reduceat(new_entry.astype(np.int32), types).astype(np.int32),
        "rows": rows[doc[entries]], "n": np.diff(np.concatenate([entries, [len(doc)]])).astype(np.int32),
    }
    return pa.table(
        [pa.array([table["part"][0].as_py()], pa.int32())] + [pa.array([c.tobytes()], pa.binary()) for c in columns.values()],
        names=["part", *columns],
    )


def _shard(contexts: np.ndarray, model: Model) -> np.ndarray:
    return (((contexts >> _U(32)) * _U(model.shards)) >> _U(32)).astype(np.int64)


def _stored(model: Model):
    """:func:`_gather` with its columns packed, as a part is read once for each sweep."""

    def run(table: pa.Table) -> pa.Table:
        whole = _gather(table, model.common).to_pylist()[0]
        read = lambda name, t: np.frombuffer(whole[name], t)
        contexts, places, counts = read("contexts", _U), read("places", np.int64), read("counts", np.int64)
        in_shard = np.bincount(_shard(contexts, model), minlength=model.shards).astype(np.int32)
        customers = np.bincount(places, counts, len(contexts)).astype(np.int64)
        seats = read("words", _U), read("word_types", np.int32), np.diff(places, prepend=0).astype(np.int32), counts, in_shard
        entries = read("type_entries", np.int32), np.diff(read("rows", np.int64), prepend=0), read("n", np.int32)
        columns = [_packed(*seats)], [_packed(*entries)], [_packed(contexts, customers)]
        return pa.table([pa.array([whole["part"]], pa.int32()), *columns], names=["part", "seats", "entries", "contexts"])

    return run


def seat(counts: np.ndarray, new_mass, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after all customers of each dish sit down in turn.

    ``new_mass(which, tables)`` is the weight of a new table for the dishes ``which``. The
    first ``ONE_BY_ONE`` customers of a dish are drawn singly; later ones in blocks of a
    sixteenth of those seated, in which the chance of a new table is that of the block's start.
    """
    tables = np.minimum(counts, 1)
    busy = np.flatnonzero(counts > 1)
    busy = busy[np.argsort(-counts[busy], kind="stable")]
    sizes = counts[busy]
    seated = 1
    while True:
        active = int(np.searchsorted(-sizes, -seated, side="left"))
        if not active:
            return tables
        which = busy[:active]
        mass = new_mass(which, tables[which])
        chance = mass / (mass + seated - discount * tables[which])
        if seated < ONE_BY_ONE:
            tables[which] += rng.random(active) < chance
            seated += 1
        else:
            block = max(1, seated // 16)
            now = np.minimum(block, sizes[:active] - seated)
            tables[which] += rng.binomial(now, chance)
            seated += block


class Part:
    """The seats of one part, drawn on from a state by what its contexts' shards have answered.

    ``row``: part, seats; state, the packed tables after ``turn`` sweeps, or None before the first; heard, the
    packed totals of its contexts after that turn and the next ones; to score, entries and customers too. Draws
    depend on the part, the turn, the seed and the totals alone, so that any executor can work them out again.
    """

    def __init__(self, row: dict, model: Model):
        self.number, self.model = row["part"], model
        self.words, self.word_types, steps, self.counts, self.in_shard = _unpacked(row["seats"], *_SEAT_TYPES)
        # Of each word and context: the context's place among the part's own, and its group
        self.place = np.cumsum(steps, dtype=np.int64)
        self.contexts = np.repeat(np.arange(len(self.in_shard)) % CONTEXTS, self.in_shard)[self.place]
        self.of_word = np.repeat(np.arange(len(self.words)), self.word_types)
        stand_ins, owner = model.slices()
        self.is_frequent, place = _member(self.words, stand_ins)
        self.owner = owner[place] if len(owner) else np.zeros(len(self.words), np.int64)
        self.word_counts = np.bincount(self.of_word, self.counts, len(self.words)).astype(np.int64)
        self.turn = row["turn"]
        self.state = None if row["state"] is None else _unpacked(row["state"], np.int64, np.int64)
        self.heard = [_unpacked(x, np.int64)[0] for x in row["heard"]]

    def root_chance(self, customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
        """The root's probability of each word."""
        customers = np.where(self.is_frequent, _at(totals.frequent_customers, self.owner), customers)
        tables = np.where(self.is_frequent, _at(totals.frequent_tables, self.owner), tables)
        return root_probability(customers, tables, totals, self.model.n_words)

    def replay(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The state and what each sweep makes of it: tables per context and word, and the root's customers and tables."""
        if self.state is None:
            tables = np.minimum(self.counts, 1)
            customers, root_tables = self._root_start(tables)
        else:
            tables, root_tables = self.state
            customers = np.bincount(self.of_word, tables, len(self.words)).astype(np.int64)
        yield tables, customers, root_tables
        for turn, heard in enumerate(self.heard, self.turn):
            totals = self.model.sweeps[turn]
            rng = np.random.default_rng([SEED, turn, self.number])
            parent = self.root_chance(customers, root_tables, totals)[self.of_word]
            others = heard[self.place] - tables
            mass = lambda which, now, o=others, p=parent: (STRENGTH + DISCOUNT * (o[which] + now)) * p[which]
            tables = seat(self.counts, mass, DISCOUNT, rng)
            customers = np.bincount(self.of_word, tables, len(self.words)).astype(np.int64)
            base = (ROOT_STRENGTH + ROOT_DISCOUNT * totals.root_tables) / (self.model.n_words + 1)
            root_tables = seat(
                np.where(self.is_frequent, 0, customers), lambda which, now: np.full(len(which), base), ROOT_DISCOUNT, rng
            )
            yield tables, customers, root_tables

    def _root_start(self, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        customers = np.bincount(self.of_word, tables, len(self.words)).astype(np.int64)
        return customers, np.where(self.is_frequent, 0, np.minimum(customers, 1))

    def told(self) -> pa.Table:
        """After the last sweep: the state with this part's share of the totals, and to each shard the tables of its contexts."""
        for tables, customers, root_tables in self.replay():
            pass
        plain = ~self.is_frequent
        sums = np.concatenate([
            np.bincount(self.contexts, tables, CONTEXTS),
            np.bincount(self.contexts, self.counts, CONTEXTS),
            np.bincount(self.owner[~plain], customers[~plain], len(self.model.frequent)),
            np.bincount(self.owner[~plain], self.word_counts[~plain], len(self.model.frequent)),
            [customers[plain].sum(), root_tables.sum(), self.word_counts.sum(), (self.word_counts[plain] > 0).sum()],
        ]).astype(np.int64)
        shards, own = np.flatnonzero(self.in_shard), np.bincount(self.place, tables, self.in_shard.sum()).astype(np.int64)
        ends = np.cumsum(self.in_shard)[shards]
        data = [_packed(tables, root_tables), *[_packed(own[b - n : b]) for b, n in zip(ends, self.in_shard[shards], strict=True)]]
        return pa.table(
            [
                pa.array([self.number] * len(data), pa.int32()), pa.array([STATE, *shards.tolist()], pa.int32()),
                pa.array(data, pa.binary()), pa.array([_packed(sums)] + [None] * len(shards), pa.binary()),
            ],
            names=["part", "at", "data", "sums"],
        )

    def scores(self, row: dict) -> tuple[np.ndarray, ...]:
        """What :func:`_sheaves` takes: documents, their sums of log10 of the averaged probability in ``UNIT``,
        and the training counts of their words that are not frequent; :func:`_count` has the frequent ones.
        """
        model, there = self.model, STRENGTH + _unpacked(row["customers"], np.int64)[0][self.place]
        chance = np.zeros(len(self.counts))
        for turn, heard, (tables, customers, root_tables) in zip(range(self.turn, SWEEPS + 1), self.heard, self.replay(), strict=False):
            totals = model.sweeps[turn]
            parent = self.root_chance(customers, root_tables, totals)[self.of_word]
            chance += (
                np.maximum(self.counts - DISCOUNT * tables, 0.0) + (STRENGTH + DISCOUNT * heard[self.place]) * parent
            ) / there / SAMPLES
        entries, steps, n = _unpacked(row["entries"], *_ENTRY_TYPES)
        ids, place = np.unique(np.cumsum(steps), return_inverse=True)
        score = np.bincount(place, n * np.repeat(np.log10(chance), entries), len(ids))
        plain = np.repeat(~self.is_frequent[self.of_word], entries)
        counts = np.repeat(self.word_counts[self.of_word], entries)[plain]
        return ids, np.rint(score * UNIT).astype(np.int64), (), (place[plain], counts, n[plain])


def _base(counts: np.ndarray, n_tokens: int, n_words: int) -> np.ndarray:
    return np.log10((counts + 0.5) / (n_tokens + 0.5 * (n_words + 1)))


def _at(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    return values[place] if len(values) else np.zeros(len(place), np.int64)


def root_probability(customers: np.ndarray, tables: np.ndarray, totals: Totals, n_words: int) -> np.ndarray:
    new = (ROOT_STRENGTH + ROOT_DISCOUNT * totals.root_tables) / (n_words + 1)
    return (np.maximum(customers - ROOT_DISCOUNT * tables, 0.0) + new) / (ROOT_STRENGTH + totals.customers)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches; packed columns are read where the batch has them."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
            yield {name: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for name, x in row.items()}


# What parts tell and hear. At STATE the part's own state, else the shard that is told or has answered
STATE = -1
_TOLD = "part int, at int, data binary, sums binary"
# Kinds of rows that are brought together in a part
_KINDS = ("seats", "entries", "state", "customers", "heard")


def _first(model: Model):
    """Task: what each part tells before the first sweep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            yield from Part(row | {"turn": 0, "state": None, "heard": []}, model).told().to_batches()

    return run


def _kind(rows: DataFrame, kind: str, data: str, at: str = "0", later: int = 0) -> DataFrame:
    """Rows as one of ``_KINDS``; what is heard ``later`` turns after the state has a kind of its own."""
    number = F.lit(_KINDS.index(kind) + later).cast("int")
    return rows.select("part", number.alias("kind"), F.expr(f"CAST({at} AS INT)").alias("at"), F.col(data).alias("data"))


def _brought(table: pa.Table, turn: int) -> dict:
    """The rows of one part as :class:`Part` takes them; what shards sent is put together in their order."""
    whole: dict[int, list] = {}
    rows = zip(table["kind"].to_pylist(), table["at"].to_pylist(), table["data"], strict=True)
    for kind, _, data in sorted(rows, key=lambda r: r[:2]):
        whole.setdefault(kind, []).append(data.as_buffer())
    row = {"part": table["part"][0].as_py(), "turn": turn}
    for kind, name in enumerate(_KINDS[:-2]):
        row[name] = whole[kind][0] if kind in whole else None
    joined = [_packed(np.concatenate([_unpacked(x, np.int64)[0] for x in whole[k]])) for k in sorted(whole) if k >= len(_KINDS) - 2]
    has_customers = _KINDS.index("customers") in whole
    return row | {"customers": joined[0] if has_customers else None, "heard": joined[has_customers:]}


def _turn(model: Model, turn: int):
    """Group: a part after one more sweep."""
    return lambda table: Part(_brought(table, turn), model).told()


_WHOLE = "part int, turn int, seats binary, entries binary, state binary, customers binary, heard array<binary>"


def _whole(turn: int):
    """Group: all of a part in one row, with its state after ``turn`` sweeps and all that it has heard since."""

    def run(table: pa.Table) -> pa.Table:
        row = _brought(table, turn)
        names = ("seats", "entries", "state", "customers")
        columns = [pa.array([bytes(row[name])], pa.binary()) for name in names]
        ints = [pa.array([row[name]], pa.int32()) for name in ("part", "turn")]
        return pa.table([*ints, *columns, pa.array([row["heard"]], pa.list_(pa.binary()))], names=["part", "turn", *names, "heard"])

    return run


def _asked(model: Model):
    """Task: each part's contexts and their customers, to the shards that add them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            contexts, customers = _unpacked(row["contexts"], *_CONTEXT_TYPES)
            numbers, starts = np.unique(_shard(contexts, model), return_index=True)
            ends = np.append(starts[1:], len(contexts))
            data = [_packed(contexts[a:b], customers[a:b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array([row["part"]] * len(data), pa.int32()), pa.array(data, pa.binary())],
                names=["shard", "part", "data"],
            )

    return run


_ROUTES = "part int, at int, ranks binary, customers binary"


def _routed(table: pa.Table) -> pa.Table:
    """Group: of each part that has contexts of a shard, their ranks in the shard (as steps) and all customers of each."""
    asked = [_unpacked(x.as_buffer(), *_CONTEXT_TYPES) for x in table["data"]]
    _, rank = np.unique(np.concatenate([c for c, _ in asked]), return_inverse=True)
    whole = np.bincount(rank, np.concatenate([n for _, n in asked])).astype(np.int64)
    ranks = np.split(rank, np.cumsum([len(c) for c, _ in asked])[:-1])
    return pa.table(
        [
            table["part"], table["shard"], pa.array([_packed(np.diff(r, prepend=0).astype(np.int32)) for r in ranks], pa.binary()),
            pa.array([_packed(whole[r]) for r in ranks], pa.binary()),
        ],
        names=["part", "at", "ranks", "customers"],
    )


_ANSWERED = "part int, at int, data binary"


def _answer(table: pa.Table) -> pa.Table:
    """Group: to each part that told a shard its contexts' tables, the sums over all parts."""
    rows = {(r["is_rank"], r["part"]): r["data"] for r in table.to_pylist()}
    parts = sorted(part for is_rank, part in rows if is_rank)
    ranks = [np.cumsum(_unpacked(rows[True, p], np.int32)[0], dtype=np.int64) for p in parts]
    tables = [_unpacked(rows[False, p], np.int64)[0] for p in parts]
    whole = np.bincount(np.concatenate(ranks), np.concatenate(tables)).astype(np.int64)
    at = table["at"][0].as_py()
    return pa.table(
        [pa.array(parts, pa.int32()), pa.array([at] * len(parts), pa.int32()), pa.array([_packed(whole[r]) for r in ranks], pa.binary())],
        names=["part", "at", "data"],
    )


def _answered(routes: DataFrame, told: DataFrame) -> DataFrame:
    """Per part and shard the totals of the part's contexts, after what all parts have told."""
    ranks = routes.select("part", "at", F.lit(True).alias("is_rank"), F.col("ranks").alias("data"))
    tables = told.filter(F.col("at") != STATE).select("part", "at", F.lit(False).alias("is_rank"), "data")
    return ranks.unionByName(tables).groupBy("at").applyInArrow(_answer, _ANSWERED)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the sum of its parts' shares of the totals."""
    told = None
    for row in _one_by_one(batches):
        own = _unpacked(row["sums"], np.int64)[0]
        told = own if told is None else told + own
    if told is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(told))), pa.array(told)], names=["place", "n"])


# A sheaf's row: steps of document rows, scores, and tokens, known ones and base of what all tasks know;
# and the training counts of other words: steps of the documents' places in the row, counts, occurrences
_SHEAF = "sheaf int, sums binary"
_SHEAF_TYPES = (np.int64, np.int64, np.int64, np.int64, np.float64, np.int32, np.int64, np.int32)


def _sheaves(ids: np.ndarray, score: np.ndarray, known: tuple, others: tuple, model: Model) -> pa.RecordBatch:
    """One row for a sheaf of documents; ``ids`` ascend, and ``others`` are (place in ids, count, occurrences)."""
    sheaf = (mix(ids.view(_U)) % _U(model.sheaves)).astype(np.int32)
    order = np.argsort(sheaf, kind="stable")
    numbers, starts = np.unique(sheaf[order], return_index=True)
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    at = moved[others[0]]
    by_place = np.argsort(at, kind="stable")
    at, counts, n = at[by_place], others[1][by_place], others[2][by_place]
    bounds = np.append(starts, len(order))
    cuts = np.searchsorted(at, bounds).tolist()
    columns, none = [x[order] for x in (score, *known)], np.zeros(0, np.int64)
    packed = []
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        own = [x[a:b] for x in columns] + ([] if known else [none, none, none.astype(np.float64)])
        c, d = cuts[i], cuts[i + 1]
        steps = np.diff(at[c:d], prepend=a).astype(np.int32)
        packed.append(_packed(np.diff(ids[order[a:b]], prepend=0), *own, steps, counts[c:d], n[c:d].astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], names=["sheaf", "sums"])


def _score(model: Model, turn: int):
    """Group: a part's sums, in sheaves of documents, one row for a sheaf. In one worker with what brings the part together."""

    def run(table: pa.Table) -> pa.Table:
        row = _brought(table, turn)
        return pa.Table.from_batches([_sheaves(*Part(row, model).scores(row), model)])

    return run


def _count(model: Model):
    """Task: per document its tokens, and what is known of its frequent words, whose counts every task has."""
    base, known = _base(model.frequent_counts, model.n_tokens, model.n_words), model.frequent_counts > 0

    def flush(held: list) -> pa.RecordBatch:
        ids, *sums = (np.concatenate(x) for x in zip(*held, strict=True))
        order, none = np.argsort(ids), np.zeros(0, np.int64)
        return _sheaves(ids[order], np.zeros(len(ids), np.int64), tuple(x[order] for x in sums), (none, none, none), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = [], 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for token, _, of in token_chunks(batch.column(1)):
                ids, of = rows[of[0] : of[-1] + 1].astype(np.int64), of - of[0]
                hot, place = _member(token, model.frequent)
                owner, word = of[hot], place[hot]
                total = lambda x, at: np.bincount(at, x, len(ids))  # noqa: B023, E731
                held.append((
                    ids, np.bincount(of, minlength=len(ids)), total(_at(known, word), owner).astype(np.int64),
                    total(_at(base, word), owner),
                ))
                docs += len(ids)
                if docs >= DEAL_DOCS:
                    yield flush(held)
                    held, docs = [], 0
        if held:
            yield flush(held)

    return run


def _add(n_tokens: int, n_words: int):
    """The documents of one sheaf, summed over the parts."""

    def run(table: pa.Table) -> pa.Table:
        held = []
        for packed in table["sums"]:
            steps, score, tokens, known, base, at, counts, n = _unpacked(packed.as_buffer(), *_SHEAF_TYPES)
            if not len(tokens):
                place = np.cumsum(at)
                tokens = np.zeros(len(steps), np.int64)
                known = np.bincount(place, n * (counts > 0), len(steps)).astype(np.int64)
                base = np.bincount(place, n * _base(counts, n_tokens, n_words), len(steps))
            held.append((np.cumsum(steps), tokens, known, base, score))
        ids, tokens, known, base, score = (np.concatenate(x) for x in zip(*held, strict=True))
        ids, place = np.unique(ids, return_inverse=True)
        whole = []
        for x in (tokens, known, score):
            whole.append(np.zeros(len(ids), np.int64))
            np.add.at(whole[-1], place, x)
        columns = ids, whole[0], whole[1], np.bincount(place, base, len(ids)), whole[2] / UNIT
        return pa.table([pa.array(x) for x in columns], names=["row_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def _let_go(df: DataFrame) -> None:
    """Shuffle files of steps whose result is written stay until the driver collects its garbage: it does so now."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _learnt(rows: DataFrame) -> tuple[Model, DataFrame]:
    """The model learnt from the rows with ``train``, and all that :class:`Part` needs as rows to bring together by part.

    ``rows`` (row_id, train, text) are read three times here, and once more for the scores. After each sweep one vector comes to
    the driver, summed by Spark: two numbers per group of contexts and per frequent word, and four. Totals of the contexts go
    from part to shard and back.
    """
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-chars // PART_CHARS))
    share = max(1 / (4 * parts), 1 / FREQUENT)
    named = rows.select("text").mapInArrow(_frequent(1 / COMMON), "word bigint, n bigint, is_total boolean")
    counted = written(named.groupBy("word", "is_total").agg(F.sum("n").alias("n")), "lm-frequent")
    total = counted.filter("is_total").agg(F.sum("n")).first()[0] or 0
    common = counted.filter(~F.col("is_total") & (F.col("n") >= total / COMMON / 2)).select("word", "n").toArrow()
    word, n = common["word"].to_numpy().view(_U), common["n"].to_numpy()
    model = Model(parts, np.sort(word[n >= share / 2 * total]), common=np.sort(word))
    dealt = rows.select("row_id", "train", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_deal(model), _DEALT)
    table = written(dealt.groupBy("part").applyInArrow(_stored(model), _PART), "lm-parts")
    _let_go(table)
    asked = table.select("part", "contexts").mapInArrow(_asked(model), "shard int, part int, data binary")
    routes = written(asked.groupBy("shard").applyInArrow(_routed, _ROUTES), "lm-routes")
    told = written(table.select("part", "seats").mapInArrow(_first(model), _TOLD), "lm-told")
    f = len(model.frequent)
    first, sampled = SWEEPS + 1 - SAMPLES, []
    for turn in range(SWEEPS + 1):
        vectors = told.filter(F.col("at") == STATE).select("sums").mapInArrow(_added, "place bigint, n bigint")
        sums = vectors.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        whole = np.zeros(2 * CONTEXTS + 2 * f + 4, np.int64)
        whole[sums["place"].to_numpy()] = sums["n"].to_numpy()
        tables, contexts, customers, counts, rest = np.split(
            whole, np.cumsum([CONTEXTS, CONTEXTS, f, f])
        )
        if turn == 0:
            model.contexts, model.frequent_counts = contexts, counts
            model.n_tokens, model.n_words = int(rest[2]), int(rest[3] + (counts > 0).sum())
            frequent_tables = np.minimum(customers, 1)
        else:
            base = (ROOT_STRENGTH + ROOT_DISCOUNT * model.sweeps[-1].root_tables) / (model.n_words + 1)
            frequent_tables = seat(
                customers, lambda which, now, b=base: np.full(len(which), b), ROOT_DISCOUNT,
                np.random.default_rng([SEED, turn, parts]),
            )
        model.sweeps.append(
            Totals(tables, float(rest[0] + customers.sum()), float(rest[1] + frequent_tables.sum()), customers, frequent_tables)
        )
        state, heard = _kind(told.filter(F.col("at") == STATE), "state", "data"), _answered(routes, told)
        if turn == first:
            sampled.append(state)
        if turn >= first:
            sampled.append(_kind(heard, "heard", "data", "at", turn - first))
        if turn < SWEEPS:
            brought = _kind(table, "seats", "seats").unionByName(state).unionByName(_kind(heard, "heard", "data", "at"))
            told = written(brought.groupBy("part").applyInArrow(_turn(model, turn), _TOLD), "lm-told")
            _let_go(table)
    brought = _kind(table, "seats", "seats").unionByName(_kind(table, "entries", "entries"))
    for other in (_kind(routes, "customers", "customers", "at"), *sampled):
        brought = brought.unionByName(other)
    return model, brought


def fit(rows: DataFrame) -> tuple[Model, DataFrame]:
    """The model learnt from the rows with ``train``, and the parts as rows for :class:`Part`."""
    model, brought = _learnt(rows)
    return model, brought.groupBy("part").applyInArrow(_whole(SWEEPS + 1 - SAMPLES), _WHOLE)


def score(rows: DataFrame) -> tuple[Model, DataFrame]:
    """Per row_id: n_tokens, n_known, base_score, score; with the model."""
    model, brought = _learnt(rows)
    by_part = brought.groupBy("part").applyInArrow(_score(model, SWEEPS + 1 - SAMPLES), _SHEAF)
    texts = rows.select("row_id", F.coalesce("text", F.lit("")).alias("text"))
    partial = by_part.union(texts.mapInArrow(_count(model), _SHEAF))
    sums = partial.groupBy("sheaf").applyInArrow(
        _add(model.n_tokens, model.n_words), "row_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return model, sums


def held_out(doc_id: str = "doc_id"):
    """Documents that the model does not learn from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def scored(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the whole text and its end under the model. A null or empty
    text is one end token. Rows are told apart by a number, so repeated rows and repeated or
    null ids each get their own result. An empty table gives no rows; without training rows every
    word is unknown. Only doc_id and text are read.
    """
    rows = body(held(documents.select("doc_id", "text"), "lm-documents")).withColumn("train", ~held_out())
    model, sums = score(rows)
    return rows.join(sums, "row_id").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
