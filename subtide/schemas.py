"""The eight lifecycle tables: types, keys, references, domains and row checks.

Spark does not enforce constraints on parquet; ``subtide.operators.quality``
reports the rows that break the ones declared here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

# The value domains of the status and type columns.
SUBSCRIPTION_STATUS = ["pending", "active", "cancelled", "rejected", "completed"]
INTAKE_STATUS = ["completed", "pending", "expired"]
APPOINTMENT_TYPE = ["initial_appt", "follow_up"]
APPOINTMENT_STATUS = ["completed", "no_show", "rescheduled", "scheduled", "cancelled"]
ELIGIBILITY = ["eligible", "not_eligible"]
PAYMENT_STATUS = ["successful", "failed", "pending"]
PAYMENT_TYPE = ["initial", "renewal"]
REFUND_REASON = [
    "treatment_rejection",
    "duplicate_charge",
    "plan_change",
    "subscription_cancelled",
]
REFUND_STATUS = ["completed", "declined"]
EVENT_TYPE = [
    "selected",
    "activated",
    "rejected",
    "plan_changed",
    "cancelled",
    "treatment_started",
    "treatment_completed",
]
EVENT_REASON = [
    "intake_expired",
    "not_eligible",
    "appointment_no_show",
    "payment_failed",
    "patient_request",
    "side_effects",
    "not_satisfied",
    "no_longer_needed",
    "other",
]
GENDER = ["M", "F"]
CHANNEL = ["organic", "referral", "google_ads", "meta"]
REJECTION_REASON = ["intake_expired", "appointment_no_show", "not_eligible"]
CANCELLATION_REASON = [
    "patient_request",
    "side_effects",
    "not_satisfied",
    "no_longer_needed",
    "other",
]

# Reasons each event type may carry; None means no reason at all. plan_changed is open.
REASONS_BY_TYPE = {
    "selected": None,
    "activated": None,
    "treatment_started": None,
    "treatment_completed": None,
    "rejected": REJECTION_REASON,
    "cancelled": CANCELLATION_REASON,
}

# Report column -> event type, in the order of the lifecycle.
STAGES = {
    "selected": "selected",
    "activated": "activated",
    "treatment_started": "treatment_started",
    "treatment_completed": "treatment_completed",
    "rejected": "rejected",
    "cancelled": "cancelled",
}

# Subscription column an event's time is taken from. treatment_started has no such column.
EVENT_SOURCE = {
    "selected": "selected_at",
    "activated": "activated_at",
    "rejected": "ended_at",
    "cancelled": "ended_at",
    "treatment_completed": "ended_at",
}

# (earlier, later) stages of one subscription.
STAGE_ORDER = [
    ("selected", "activated"),
    ("selected", "rejected"),
    ("activated", "treatment_started"),
    ("treatment_started", "cancelled"),
    ("treatment_started", "treatment_completed"),
]

Checks = Callable[[], dict[str, Column]]


@dataclass(frozen=True)
class Table:
    ddl: str
    key: str
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    defaults: Checks = dict
    checks: Checks = dict

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    def all_checks(self) -> dict[str, Column]:
        """NOT NULL, domain and row checks by name; a row fails only on FALSE."""
        required = {
            f"{f.name}_not_null": F.col(f.name).isNotNull() for f in self.struct if not f.nullable
        }
        return required | self.checks()


def _in(name: str, values: list[str]) -> Column:
    return F.col(name).isin(*values)


def _updated_later() -> dict[str, Column]:
    return {"updated_after_created": F.col("updated_at") > F.col("created_at")}


def _at_most(name: str, width: int) -> dict[str, Column]:
    return {f"{name}_length": F.length(name) <= width}


def _available_now() -> dict[str, Column]:
    return {"is_available": F.lit(True), **_created_now()}


def _created_now() -> dict[str, Column]:
    return {"created_at": F.current_timestamp().cast("timestamp_ntz")}


CUSTOMERS = Table(
    ddl="""customer_id BIGINT NOT NULL, gender STRING NOT NULL, signup_date DATE,
        state_code STRING NOT NULL, acquisition_channel STRING NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="customer_id",
    defaults=_created_now,
    checks=lambda: {
        **_at_most("gender", 1),
        **_at_most("state_code", 2),
        **_at_most("acquisition_channel", 20),
        **_updated_later(),
    },
)

PLANS = Table(
    ddl="""plan_id BIGINT NOT NULL, plan_name STRING NOT NULL,
        monthly_price DECIMAL(10,2) NOT NULL, is_available BOOLEAN NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="plan_id",
    defaults=_available_now,
    checks=lambda: {**_at_most("plan_name", 30), **_updated_later()},
)

SUBSCRIPTIONS = Table(
    ddl="""subscription_id BIGINT NOT NULL, customer_id BIGINT NOT NULL,
        plan_id BIGINT NOT NULL, subscription_status STRING NOT NULL,
        selected_at TIMESTAMP_NTZ NOT NULL, activated_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="subscription_id",
    references={"customer_id": "customers", "plan_id": "plans"},
    defaults=_created_now,
    checks=lambda: {
        "status_domain": _in("subscription_status", SUBSCRIPTION_STATUS),
        "activated_not_before_selected": F.col("activated_at") >= F.col("selected_at"),
        "ended_after_selected": F.col("ended_at") > F.col("selected_at"),
        **_updated_later(),
    },
)

INTAKES = Table(
    ddl="""intake_id BIGINT NOT NULL, subscription_id BIGINT NOT NULL,
        intake_status STRING NOT NULL, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="intake_id",
    unique=("subscription_id",),
    references={"subscription_id": "subscriptions"},
    defaults=_created_now,
    checks=lambda: {
        "status_domain": _in("intake_status", INTAKE_STATUS),
        "completed_needs_earlier_start": F.col("completed_at").isNull()
        | (F.col("started_at").isNotNull() & (F.col("completed_at") > F.col("started_at"))),
        **_updated_later(),
    },
)

APPOINTMENTS = Table(
    ddl="""appointment_id BIGINT NOT NULL, subscription_id BIGINT NOT NULL,
        scheduled_at TIMESTAMP_NTZ NOT NULL, appointment_type STRING NOT NULL,
        appointment_status STRING NOT NULL, eligibility_result STRING,
        completed_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="appointment_id",
    references={"subscription_id": "subscriptions"},
    defaults=_created_now,
    checks=lambda: {
        "type_domain": _in("appointment_type", APPOINTMENT_TYPE),
        "status_domain": _in("appointment_status", APPOINTMENT_STATUS),
        "eligibility_domain": _in("eligibility_result", ELIGIBILITY),
        "completed_not_before_scheduled": F.col("completed_at") >= F.col("scheduled_at"),
        **_updated_later(),
    },
)

PAYMENTS = Table(
    ddl="""payment_id BIGINT NOT NULL, subscription_id BIGINT NOT NULL,
        payment_date TIMESTAMP_NTZ, payment_status STRING NOT NULL,
        payment_type STRING NOT NULL, amount DECIMAL(10,2) NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="payment_id",
    references={"subscription_id": "subscriptions"},
    defaults=_created_now,
    checks=lambda: {
        "status_domain": _in("payment_status", PAYMENT_STATUS),
        "type_domain": _in("payment_type", PAYMENT_TYPE),
        "amount_positive": F.col("amount") > 0,
        **_updated_later(),
    },
)

REFUNDS = Table(
    ddl="""refund_id BIGINT NOT NULL, payment_id BIGINT NOT NULL,
        processed_at TIMESTAMP_NTZ NOT NULL, refund_amount DECIMAL(10,2) NOT NULL,
        refund_reason STRING NOT NULL, refund_status STRING NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    key="refund_id",
    unique=("payment_id",),
    references={"payment_id": "payments"},
    defaults=_created_now,
    checks=lambda: {
        "reason_domain": _in("refund_reason", REFUND_REASON),
        "status_domain": _in("refund_status", REFUND_STATUS),
        "amount_positive": F.col("refund_amount") > 0,
        "processed_not_before_created": F.col("processed_at") >= F.col("created_at"),
        **_updated_later(),
    },
)

EVENTS = Table(
    ddl="""event_id BIGINT NOT NULL, subscription_id BIGINT NOT NULL,
        event_type STRING NOT NULL, event_reason STRING, event_timestamp TIMESTAMP_NTZ NOT NULL,
        created_at TIMESTAMP_NTZ""",
    key="event_id",
    references={"subscription_id": "subscriptions"},
    defaults=_created_now,
    checks=lambda: {
        "type_domain": _in("event_type", EVENT_TYPE),
        "reason_domain": _in("event_reason", EVENT_REASON),
    },
)

TABLES = {
    "customers": CUSTOMERS,
    "plans": PLANS,
    "subscriptions": SUBSCRIPTIONS,
    "intakes": INTAKES,
    "appointments": APPOINTMENTS,
    "payments": PAYMENTS,
    "refunds": REFUNDS,
    "subscription_events": EVENTS,
}

# Columns of the sign-up file, in the order of its header.
SIGNUP_FILE = "gender STRING, signup_date DATE, state_code STRING, acquisition_channel STRING"
