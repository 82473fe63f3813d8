"""Quality rules kept as a ledger of failure bits, with versioned policies over the bits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import filter_once, words, written

# One bit per rule; a rule keeps its bit for ever, so old ledgers stay readable
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 20 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
# Version -> mask of the rules that it enforces
POLICIES = {1: BASE, 2: (1 << len(RULES)) - 1}
CURRENT = 2

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(at: Column) -> Column:
    """Words covered by the windows that start at the sorted positions ``at``."""
    reach = F.transform(at, lambda p, i: F.least(F.lit(3), F.get(at, i + 1) - p))
    return F.aggregate(reach, F.lit(0), lambda total, n: total + n)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a struct column ``_ledger``: every measurement and ``failed_bits``.

    Each rule is evaluated once. Words are maximal runs without ASCII white space; windows of
    three words are sorted within the document, by a hash and then by their words, so that equal
    ones are neighbours. A null or empty text has zero of everything and fails ``few_words``.
    Rows are independent: repeated rows and ties need no rule, an empty table gives none, no row is
    shuffled. Columns may have any names; one called ``_ledger`` is replaced. The ledger is worked
    out before any filter or other use of it: see :func:`_fenced`.
    """
    kept = [c for c in df.columns if c != "_ledger"]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("text"))
    whole = F.coalesce(F.col("text"), F.lit(""))
    token = F.col("words")
    window = F.transform(
        F.slice(token, 1, F.greatest(F.size(token) - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.struct(
                F.xxhash64(w, F.get(token, i + 1), F.get(token, i + 2)).alias("h"),
                w.alias("a"), F.get(token, i + 1).alias("b"), F.get(token, i + 2).alias("c"),
            ).alias("said"),
            i.alias("at"),
        ),
    )
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    with_windows = packed.withColumn("words", words(F.col("text"))).withColumns(
        {"windows": F.sort_array(window), "lines": lines}
    )
    found = F.col("windows")
    twice = F.filter(
        found,
        lambda x, i: (x["said"] == F.get(found, i - 1)["said"]) | (x["said"] == F.get(found, i + 1)["said"]),
    )
    measured = with_windows.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["at"]))).withColumn(
        "measures",
        F.struct(
            F.size("words").cast("bigint").alias("n_words"),
            F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(F.col("places")).cast("bigint").alias("n_repeat_words"),
        ),
    )
    failed = F.lit(0).cast("bigint")
    for name, rule in RULES:
        for measure in MEASURES:
            rule = rule.replace(measure, f"measures.{measure}")
        failed = failed.bitwiseOR(F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)))
    noted = F.struct(*[f"measures.{m}" for m in MEASURES], failed.alias("failed_bits"))
    return measured.select(*[F.col(f"doc.`{c}`") for c in kept], _fenced(noted).alias("_ledger"))


def _fenced(noted: Column) -> Column:
    """The ledger as a value that Spark computes once, where it stands.

    A filter on it would otherwise be moved below the steps that work it out, each copied for every
    mention of it. A condition that numbers the rows, and always holds, keeps it in its place.
    """
    return F.when(F.monotonically_increasing_id() >= 0, noted)


def stored(df: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ledger alone, written to the shared folder: ``keys``, the measurements and ``failed_bits`` per row.

    Policies and ablations are worked out from it without a second look at the texts.
    """
    noted = ledger(df.select(*keys, text), text)
    return written(noted.select(*keys, "_ledger"), "quality-ledger")


def passes(version: int = CURRENT) -> Column:
    """Whether a ledger row fails no rule that the policy enforces."""
    return F.col("_ledger.failed_bits").bitwiseAND(F.lit(POLICIES[version])) == 0


def filtered(df: DataFrame, version: int = CURRENT, text: str = "text") -> DataFrame:
    """The rows that the policy keeps, with the columns they came with, whatever their names."""
    packed = df.select(F.struct("*").alias("doc"))
    return filter_once(ledger(packed, f"doc.{text}"), passes(version)).select("doc.*")


def ablations(bits: DataFrame, policies: Mapping[int, int] = POLICIES) -> DataFrame:
    """Per policy and rule: documents that fail it, and that only this rule rejects.

    ``bits`` has the column ``failed_bits``. Documents are counted per distinct mask before
    anything else, at most one row for each combination of rules and task, so a policy that
    did not exist when the ledger was written costs no second look at the texts.
    """
    counted = bits.groupBy("failed_bits").agg(F.count("*").alias("n"))
    wanted = F.array(
        *[
            F.struct(F.lit(version).alias("version"), F.lit(mask).cast("bigint").alias("mask"),
                     F.lit(name).alias("rule"), F.lit(BIT[name]).cast("bigint").alias("bit"))
            for version, mask in policies.items()
            for name, _ in RULES
            if mask & BIT[name]
        ]
    )
    enforced = F.col("failed_bits").bitwiseAND(F.col("p.mask"))
    return (
        counted.select("failed_bits", "n", F.explode(wanted).alias("p"))
        .groupBy("p.version", "p.rule")
        .agg(
            F.coalesce(F.sum(F.when(enforced.bitwiseAND(F.col("p.bit")) != 0, F.col("n"))), F.lit(0)).alias("failing"),
            F.coalesce(F.sum(F.when(enforced == F.col("p.bit"), F.col("n"))), F.lit(0)).alias("only_this_rule"),
            F.coalesce(F.sum(F.when(enforced == 0, F.col("n"))), F.lit(0)).alias("kept"),
        )
    )
