"""Contract rules per feed and the count of rows (or keys) that break each rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.keys import mark_known
from holdfast.operators.quality import VALID_TRANSACTION_TYPES
from holdfast.sources.schemas import RESCUE_COLUMN


class ContractRule(NamedTuple):
    rule_id: str
    tier: str
    kind: str
    columns: tuple[str, ...]
    argument: object = None


def not_null(tier: str, *columns: str, rule_id: str = "pk_not_null") -> ContractRule:
    return ContractRule(rule_id, tier, "not_null", columns)


def unique(tier: str, *columns: str) -> ContractRule:
    return ContractRule("no_duplicate_pk", tier, "unique", columns)


def fk(tier: str, column: str, feed: str, key: str, rule_id: str, optional=False) -> ContractRule:
    return ContractRule(rule_id, tier, "fk", (column,), (feed, key, optional))


def in_set(tier: str, column: str, values: Sequence[str], rule_id: str, optional=False):
    return ContractRule(rule_id, tier, "in_set", (column,), (tuple(values), optional))


def in_range(tier: str, column: str, low, high, rule_id: str, open_low=False) -> ContractRule:
    return ContractRule(rule_id, tier, "in_range", (column,), (low, high, open_low))


def iso_currency(tier: str, column: str) -> ContractRule:
    return ContractRule("currency_present", tier, "pattern", (column,), "^[A-Z]{3}$")


def no_drift(tier: str = "QUARANTINE") -> ContractRule:
    return ContractRule("schema_drift", tier, "no_drift", (RESCUE_COLUMN,))


def fresh(column: str, tier: str = "WARN") -> ContractRule:
    return ContractRule("freshness", tier, "fresh", (column,))


# Rules and tiers of the contracted feeds
ASSET_TYPES = ("EQUITY", "BOND", "FUND", "PRIVATE", "CASH", "DERIVATIVE")
LIMIT_SCOPES = ("SECTOR", "ISSUER", "COUNTRY", "ASSET_TYPE", "PORTFOLIO")
COUNTERPARTY_TYPES = ("BROKER", "BANK", "EXCHANGE", "CUSTODIAN", "OTHER")
RISK_CATEGORIES = ("LOW", "MEDIUM", "HIGH")

CONTRACTS: dict[str, tuple[ContractRule, ...]] = {
    "investment_transactions": (
        not_null("FAIL", "transaction_id"),
        unique("WARN", "transaction_id"),
        fk("QUARANTINE", "portfolio_id", "portfolio_master", "portfolio_id", "fk_portfolio"),
        fk("QUARANTINE", "investment_asset_id", "investment_asset_master",
           "investment_asset_id", "fk_asset"),
        in_range("QUARANTINE", "quantity", 0, None, "positive_quantity", open_low=True),
        in_set("QUARANTINE", "transaction_type", VALID_TRANSACTION_TYPES, "valid_type"),
        no_drift(),
        fk("WARN", "counterparty_id", "counterparty_master", "counterparty_id",
           "fk_counterparty"),
        fresh("transaction_date"),
    ),
    "listed_market_prices": (
        not_null("FAIL", "investment_asset_id", "price_date"),
        unique("WARN", "investment_asset_id", "price_date"),
        fk("QUARANTINE", "investment_asset_id", "investment_asset_master",
           "investment_asset_id", "fk_asset"),
        in_range("QUARANTINE", "close_price", 0, None, "price_non_negative"),
        no_drift(),
        fresh("price_date"),
    ),
    "investment_holdings_snapshot": (
        not_null("FAIL", "portfolio_id", "as_of_date", "investment_asset_id"),
        unique("WARN", "portfolio_id", "as_of_date", "investment_asset_id"),
        fk("QUARANTINE", "portfolio_id", "portfolio_master", "portfolio_id", "fk_portfolio"),
        fk("QUARANTINE", "investment_asset_id", "investment_asset_master",
           "investment_asset_id", "fk_asset"),
        not_null("QUARANTINE", "quantity", rule_id="quantity_present"),
        no_drift(),
        fresh("as_of_date"),
    ),
    "investment_limits": (
        not_null("FAIL", "limit_id"),
        unique("FAIL", "limit_id"),
        in_set("QUARANTINE", "scope_type", LIMIT_SCOPES, "valid_scope_type"),
        not_null("QUARANTINE", "scope_value", rule_id="scope_value_present"),
        in_range("QUARANTINE", "max_pct", 0, 100, "pct_in_range"),
        fk("QUARANTINE", "portfolio_id", "portfolio_master", "portfolio_id", "fk_portfolio",
           optional=True),
        no_drift(),
    ),
    "investment_asset_master": (
        not_null("FAIL", "investment_asset_id"),
        unique("FAIL", "investment_asset_id"),
        not_null("QUARANTINE", "name", rule_id="name_present"),
        in_set("QUARANTINE", "asset_type", ASSET_TYPES, "valid_asset_type"),
        iso_currency("QUARANTINE", "currency"),
        no_drift(),
    ),
    "portfolio_master": (
        not_null("FAIL", "portfolio_id"),
        unique("FAIL", "portfolio_id"),
        not_null("QUARANTINE", "portfolio_name", rule_id="name_present"),
        iso_currency("QUARANTINE", "base_currency"),
        no_drift(),
    ),
    "counterparty_master": (
        not_null("FAIL", "counterparty_id"),
        unique("FAIL", "counterparty_id"),
        not_null("QUARANTINE", "name", rule_id="name_present"),
        in_set("WARN", "type", COUNTERPARTY_TYPES, "valid_type", optional=True),
        in_set("WARN", "risk_category", RISK_CATEGORIES, "valid_risk", optional=True),
        no_drift(),
    ),
    "currency_rates": (
        not_null("FAIL", "currency", "rate_date"),
        unique("WARN", "currency", "rate_date"),
        in_range("QUARANTINE", "rate_to_base", 0, None, "rate_positive", open_low=True),
        iso_currency("QUARANTINE", "currency"),
        no_drift(),
        fresh("rate_date"),
    ),
}


def _violated(rule: ContractRule, known_flags: Mapping[str, str]) -> Column:
    """Row condition of a rule; a NULL in the tested column breaks it unless optional."""
    first = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return reduce(or_, [F.col(c).isNull() for c in rule.columns])
    if rule.kind == "fk":
        optional = rule.argument[2]
        unknown = ~F.col(known_flags[rule.rule_id])
        # The all-portfolios marker is a value of the feed, not a key
        return unknown & first.isNotNull() & (first != "ALL") if optional else unknown
    if rule.kind == "in_set":
        values, optional = rule.argument
        return F.coalesce(~first.isin(*values), F.lit(not optional))
    if rule.kind == "in_range":
        low, high, open_low = rule.argument
        inside = (first > low) if open_low else (first >= low)
        if high is not None:
            inside = inside & (first <= high)
        return F.coalesce(~inside, F.lit(True))
    if rule.kind == "pattern":
        return F.coalesce(~first.rlike(rule.argument), F.lit(True))
    if rule.kind == "no_drift":
        return first.isNotNull()
    raise ValueError(f"unknown rule kind: {rule.kind}")


def feed_violations(
    feed: str,
    df: DataFrame,
    references: Mapping[str, DataFrame],
    run_date: str,
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per rule of the feed: how many rows break it.

    ``unique`` counts keys that occur more than once; ``freshness`` is 1 when the newest
    date differs from the run date. A rule on a column that the feed does not carry is not
    evaluated: its count is NULL, which is not 0 (only drift is 0 then). All row rules of a feed share one pass; uniqueness needs its own grouping by the key.
    ``accepted`` replaces the accepted values of a column, for feeds with their own codes.
    """
    rules = [
        rule._replace(argument=(tuple(accepted[rule.columns[0]]), rule.argument[1]))
        if rule.kind == "in_set" and accepted and rule.columns[0] in accepted
        else rule
        for rule in CONTRACTS[feed]
    ]
    flags: dict[str, str] = {}
    checked = df
    for rule in rules:
        if rule.kind == "fk" and rule.columns[0] in df.columns:
            reference_feed, key, _ = rule.argument
            flags[rule.rule_id] = f"_{rule.rule_id}"
            checked = mark_known(
                checked, rule.columns[0], references[reference_feed], key, flags[rule.rule_id]
            )
    counters: list[Column] = []
    for rule in rules:
        present = all(c in df.columns for c in rule.columns)
        if rule.kind == "unique":
            continue
        if not present:
            # Without the rescue column a feed has no rescued value; other rules are unknown
            counter = F.lit(0 if rule.kind == "no_drift" else None).cast("bigint")
        elif rule.kind == "fresh":
            newest = F.max(rule.columns[0])
            counter = F.when(newest.eqNullSafe(F.lit(run_date)), 0).otherwise(1).cast("bigint")
        else:
            counter = F.count_if(_violated(rule, flags))
        counters.append(counter.alias(rule.rule_id))
    row_rules = [r for r in rules if r.kind != "unique"]
    counted = checked.agg(*counters).unpivot(
        [], [r.rule_id for r in row_rules], "rule_id", "violations"
    )
    for rule in rules:
        if rule.kind == "unique" and not set(rule.columns) <= set(df.columns):
            counted = counted.unionByName(
                df.agg(F.lit(None).cast("bigint").alias("violations")).select(
                    F.lit(rule.rule_id).alias("rule_id"), "violations"
                )
            )
        elif rule.kind == "unique":
            repeated = (
                df.groupBy(*rule.columns)
                .agg(F.count("*").alias("n"))
                .agg(F.count_if(F.col("n") > 1).alias("violations"))
                .select(F.lit(rule.rule_id).alias("rule_id"), "violations")
            )
            counted = counted.unionByName(repeated)
    tiers = F.create_map(*[F.lit(x) for r in rules for x in (r.rule_id, r.tier)])
    return counted.select(
        F.lit(feed).alias("feed"), "rule_id", tiers[F.col("rule_id")].alias("tier"), "violations"
    )


def contract_violations(
    feeds: Mapping[str, DataFrame],
    run_date: str,
    accepted: Mapping[str, Mapping[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Violations of all contracted feeds that are present, one row per feed and rule.

    ``accepted``: feed -> column -> accepted values, for feeds with their own codes.
    """
    parts = [
        feed_violations(name, df, feeds, run_date, (accepted or {}).get(name))
        for name, df in feeds.items()
        if name in CONTRACTS
    ]
    return reduce(DataFrame.unionByName, parts)
