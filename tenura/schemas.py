"""Table registry: what each source table is keyed, dated, typed and checked by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tenura import fixed_values as fv


# A subscription holds from its start to its end; whether a gap follows is judged by the next
# start, or by the day of the reader while there is none.
INTERVAL = "next_start_at timestamp, ended_at timestamp"


@dataclass(frozen=True)
class SourceTable:
    """One raw table and the staging / warehouse tables it feeds."""

    name: str
    key: str
    event_date: str
    source_system: str
    warehouse_name: str
    sort_key: tuple[str, ...]
    critical: tuple[str, ...]
    revenue: tuple[str, ...] = ()
    date_order: tuple[str, str] | None = None

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType.fromDDL(fv.RAW_COLUMNS[self.name])

    @property
    def staging_schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{fv.STAGING_COLUMNS[self.name]}, {fv.LINEAGE_COLUMNS}")

    @property
    def lake_schema(self) -> T.StructType:
        """Raw columns, the event date cut to a day, then lineage."""
        fields = [
            T.StructField(f.name, T.DateType() if f.name == self.event_date else f.dataType)
            for f in self.raw_schema.fields
        ]
        return T.StructType(fields + T.StructType.fromDDL(fv.LINEAGE_COLUMNS).fields)

    @property
    def kept_schema(self) -> T.StructType:
        """Staging columns as stored: subscriptions also keep the bounds of their validity."""
        interval = T.StructType.fromDDL(INTERVAL).fields if self.name == "subscriptions" else []
        return T.StructType([*self.staging_schema.fields, *interval])

    @property
    def stored_schema(self) -> T.StructType:
        """Warehouse columns as stored."""
        return self.kept_schema.add("_updated_at", T.LongType())

    @property
    def warehouse_schema(self) -> T.StructType:
        return self.staging_schema.add("_updated_at", T.LongType())


# Keys, event dates, source systems, sort keys and checked columns per table.
TABLES: dict[str, SourceTable] = {
    t.name: t
    for t in (
        SourceTable(
            name="accounts",
            key="account_id",
            event_date="signup_date",
            source_system="crm_system",
            warehouse_name="dim_accounts",
            sort_key=("account_id",),
            critical=("account_name", "industry", "country", "signup_date"),
        ),
        SourceTable(
            name="subscriptions",
            key="subscription_id",
            event_date="start_date",
            source_system="transactional_system",
            warehouse_name="fact_subscriptions",
            sort_key=("account_id", "start_date", "subscription_id"),
            critical=("account_id", "plan_tier", "start_date", "end_date"),
            revenue=("mrr_amount", "arr_amount"),
            date_order=("start_date", "end_date"),
        ),
        SourceTable(
            name="churn_events",
            key="churn_event_id",
            event_date="churn_date",
            source_system="transactional_system",
            warehouse_name="fact_churn_events",
            sort_key=("account_id", "churn_date", "churn_event_id"),
            critical=("account_id", "churn_date", "reason_code"),
            revenue=("refund_amount_usd",),
        ),
        SourceTable(
            name="feature_usage",
            key="usage_id",
            event_date="usage_date",
            source_system="application_logs",
            warehouse_name="fact_feature_usage",
            sort_key=("subscription_id", "usage_date", "usage_id"),
            critical=("subscription_id", "usage_date", "feature_name"),
        ),
        SourceTable(
            name="support_tickets",
            key="ticket_id",
            event_date="submitted_at",
            source_system="support_system",
            warehouse_name="fact_support_tickets",
            sort_key=("account_id", "submitted_at", "ticket_id"),
            critical=("account_id", "submitted_at", "priority"),
            date_order=("submitted_at", "closed_at"),
        ),
    )
}

WAREHOUSE: dict[str, SourceTable] = {t.warehouse_name: t for t in TABLES.values()}


def mart_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(fv.MART_COLUMNS[name])
