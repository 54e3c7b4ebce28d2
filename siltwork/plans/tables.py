"""Contracts of the tables the jobs read and write.

Column names, types, lengths and rules are fixed values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from siltwork.operators.contracts import UUID, Check, Contract, Field

USERS = Contract(
    fields=(
        Field("id", "long", required=True),
        Field("first_name", required=True, max_length=100),
        Field("last_name", required=True, max_length=100),
        Field("email", required=True, max_length=255),
        Field("gender", required=True, max_length=50),
        Field("dob", "timestamp", required=True),
        Field("phone_number", max_length=50),
        Field("address", required=True),
    ),
    unique=("email",),
)

LOGINS = Contract(
    fields=(
        Field("id", "long", required=True),
        Field("login_date", "timestamp", required=True),
        Field("logout_date", "timestamp", required=True),
        Field("user_email", max_length=255),
        Field("device", required=True, max_length=50),
    ),
    unique=("id",),
)

ORDER_LINES = Contract(
    fields=(
        Field("id", "long", required=True),
        Field("customer_email", max_length=255),
        Field("order_date", "timestamp", required=True),
        Field("delivery_address", required=True),
        Field("product_name", required=True, max_length=255),
        Field("product_category", max_length=100),
        Field("product_brand", max_length=100),
        Field("product_description"),
        Field("quantity", "integer", required=True),
        Field("unit_price", "decimal(10,2)", required=True),
        Field("total_price", "decimal(10,2)", required=True),
    ),
    checks=(
        Check("quantity", lambda c: c("quantity") > 0),
        Check("unit_price", lambda c: c("unit_price") >= 0),
        Check("total_price", lambda c: c("total_price") >= 0),
    ),
    unique=("id",),
)

CLICK_MESSAGE = Contract(
    fields=(
        Field("username", max_length=255),
        Field("age", "integer"),
        Field("gender", max_length=50),
        Field("ad_position", max_length=255),
        Field("browsing_history"),
        Field("activity_time", "timestamp"),
        Field("ip_address", max_length=45),
        Field("log"),
        Field("redirect_from", max_length=255),
        Field("redirect_to", max_length=255),
    )
)

CLICKS = Contract(
    fields=(
        *CLICK_MESSAGE.fields,
        Field("id", UUID, required=True, default=F.uuid),
        Field("created_at", "timestamp", default=F.current_timestamp),
        Field("status", max_length=50, default=lambda: F.lit("uploaded")),
    ),
    unique=("id",),
)

CHARGES = Contract(
    fields=(
        Field("id", UUID, required=True),
        Field("amount", "integer", required=True),
        Field("amount_captured", "integer", required=True),
        Field("amount_refunded", "integer", required=True),
        Field("currency", required=True, max_length=3),
        Field("created", "integer", required=True),
        Field("customer_id", UUID, required=True),
        Field("description"),
        Field("disputed", "boolean", required=True),
        Field("outcome_network_status", max_length=50),
        Field("outcome_reason"),
        Field("outcome_risk_level", max_length=50),
        Field("outcome_risk_score", "integer"),
        Field("paid", "boolean", required=True),
        Field("payment_intent", max_length=150),
        Field("payment_method", max_length=150),
        Field("payment_method_details_card_brand", max_length=50),
        Field("payment_method_details_card_country", max_length=2),
        Field("status", required=True, max_length=50),
    )
)

SATISFACTION = Contract(
    fields=(
        Field("customer_id", UUID, required=True),
        Field("customer_satisfaction_speed", "integer", required=True),
        Field("customer_satisfaction_product", "integer", required=True),
        Field("customer_satisfaction_service", "integer", required=True),
        Field("product_type", required=True, max_length=50),
    )
)

TRAINING = Contract(
    fields=(
        *SATISFACTION.fields,
        Field("avg_amount_captured", "decimal(16,2)", required=True),
    ),
    unique=("customer_id",),
)

# The flat user record; ``dob`` is part of it.
NEW_USERS = Contract(
    fields=(
        Field("id", UUID, required=True, default=F.uuid),
        Field("first_name", required=True),
        Field("last_name", required=True),
        Field("gender", required=True),
        Field("address", required=True),
        Field("post_code", required=True),
        Field("email", required=True),
        Field("username", required=True),
        Field("dob"),
        Field("registered_date", required=True),
        Field("phone", required=True),
        Field("picture", required=True),
    ),
    unique=("id",),
)
