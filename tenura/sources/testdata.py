"""The supplied star-schema tables read as subscription sources.

Order dates of 1995-2001 are folded into 2024-2026; customers and suppliers become accounts (suppliers
those without a subscription), orders subscriptions, line items feature usage and events support tickets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import fixed_values as fv
from tenura.operators.derive import with_ever_churned

# Fixed values of the mapping.
COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}
REFERRALS = ("organic", "ads", "partner", "outbound", "event", "other")
FEATURES = ("dashboard", "api", "export", "automation", "integration")
REASONS = {
    "1-URGENT": "price_too_high",
    "2-HIGH": "missing_features",
    "3-MEDIUM": "bugs",
    "4-NOT SPECIFIED": "competitor",
    "5-LOW": "no_longer_needed",
}
LIST_PRICE = (0, 10, 25, 60)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is stated, so no file is opened to find it."""
    return spark.read.schema(COLUMNS[name]).parquet(f"{data_dir}/{name}.parquet")


def _id(prefix: str, key: str) -> str:
    """Prefix and zero-padded number; numbers above nine digits are kept whole."""
    return f"concat('{prefix}', lpad({key}, greatest(9, length({key})), '0'))"


def _pick(values, index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), int({index}) + 1)"


def _folded(column: str) -> str:
    return f"date_add(date'2024-01-01', datediff(date({column}), date'1995-01-01') % 1096)"


_START = _folded("o_orderdate")
_END = f"timestamp({_START}) + make_dt_interval(int(30 + o_orderkey % 151), int(o_orderkey % 24))"


def subscriptions(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        table(spark, data_dir, "orders").selectExpr(
            f"{_id('S', 'o_orderkey')} as subscription_id",
            f"{_id('A', 'o_custkey')} as account_id",
            f"{_START} as start_date",
            f"{_END} as end_date",
            f"{_pick(fv.PLAN_TIERS, 'o_orderkey % 4')} as plan_tier",
            "int(1 + o_orderkey % 50) as seats",
            f"double((1 + o_orderkey % 50) * {_pick(LIST_PRICE, 'o_orderkey % 4')}) as mrr_amount",
            "if(o_orderkey % 2 = 0, 'monthly', 'annual') as billing_frequency",
        )
    )


def churn_events(spark: SparkSession, data_dir: str) -> DataFrame:
    reasons = " ".join(f"when '{code}' then '{text}'" for code, text in REASONS.items())
    return (
        table(spark, data_dir, "orders")
        .where("o_orderstatus = 'F'")
        .selectExpr(
            f"{_id('C', 'o_orderkey')} as churn_event_id",
            f"{_id('A', 'o_custkey')} as account_id",
            f"date({_END}) as churn_date",
            f"case o_orderpriority {reasons} end as reason_code",
            "double(if(o_orderkey % 151 < 30, o_orderkey % 97, 0)) as refund_amount_usd",
            "o_orderkey % 10 < 3 as is_reactivation",
        )
    )


def accounts(spark: SparkSession, data_dir: str) -> DataFrame:
    nations = table(spark, data_dir, "nation").select("n_nationkey", "n_name")
    buyers = table(spark, data_dir, "customer").selectExpr(
        f"{_id('A', 'c_custkey')} as account_id", "c_custkey as n", "c_name as account_name",
        "c_mktsegment as industry", "c_nationkey as nation",
    )
    sellers = table(spark, data_dir, "supplier").selectExpr(
        f"{_id('V', 's_suppkey')} as account_id", "s_suppkey as n", "s_name as account_name",
        "'SUPPLIER' as industry", "s_nationkey as nation",
    )
    rows = (
        buyers.unionByName(sellers)
        .join(nations, F.col("nation") == F.col("n_nationkey"))
        .selectExpr(
            "account_id",
            "account_name",
            "industry",
            "n_name as country",
            "date_add(date'2024-01-01', int(n % 1096)) as signup_date",
            f"{_pick(REFERRALS, 'n % 6')} as referral_source",
            f"{_pick(fv.PLAN_TIERS, 'n % 4')} as plan_tier",
            "int(1 + n % 50) as seats",
            "n % 5 < 2 as is_trial",
        )
    )
    return with_ever_churned(rows, churn_events(spark, data_dir))


def feature_usage(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "lineitem").selectExpr(
        f"concat({_id('U', 'l_orderkey')}, '-', l_linenumber) as usage_id",
        f"{_id('S', 'l_orderkey')} as subscription_id",
        f"{_folded('l_shipdate')} as usage_date",
        f"{_pick(FEATURES, 'l_partkey % 5')} as feature_name",
        "bigint(l_quantity) as usage_count",
        "bigint(l_quantity * (10 + l_suppkey % 51)) as usage_duration_secs",
        "bigint(l_linenumber % 4) as error_count",
        "l_partkey % 10 = 0 as is_beta_feature",
    )


def support_tickets(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "events").selectExpr(
        f"{_id('T', 'event_id')} as ticket_id",
        f"{_id('A', 'user_id')} as account_id",
        "timestamp(ts) as submitted_at",
        "if(event_id % 7 <> 0, timestamp(ts) + make_dt_interval(0, int(1 + event_id % 72)), null) as closed_at",
        "if(event_id % 7 <> 0, double(1 + event_id % 72), null) as resolution_time_hours",
        "case when event_type = 'error' then 'high' "
        "when event_type in ('purchase', 'signup') then 'medium' else 'low' end as priority",
        "int(5 + event_id % 116) as first_response_time_minutes",
        "if(event_id % 5 >= 2, double(1 + (event_id % 9) * 0.5), null) as satisfaction_score",
        "event_id % 10 = 0 as escalation_flag",
    )


SOURCES = {
    "accounts": accounts,
    "subscriptions": subscriptions,
    "churn_events": churn_events,
    "feature_usage": feature_usage,
    "support_tickets": support_tickets,
}
