"""Column specs of the CSV feeds: (csv header name, parser, target column).

Parsers: ``text`` blank/missing -> ''; ``double0``/``int0`` blank or invalid
-> 0 (``int0`` clamps on overflow, ``int0s`` gives 0); ``double?``/``int?`` ->
NULL; ``date`` ``yyyy-MM-dd`` only; ``date3`` date | RFC3339 |
``yyyy-MM-ddTHH:mm:ss``; ``clock`` time of day; ``ts`` timestamp; ``bool``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeedSpec:
    name: str
    columns: tuple  # (csv_name, parser, target)
    key: tuple  # rows with a blank value in any of these are dropped
    clean: str  # text cleaning of invalid UTF-8: 'runs' -> '?', 'replace' -> U+FFFD, 'none'

    @property
    def targets(self) -> list[str]:
        return [t for _, _, t in self.columns]


def _parse(block: str) -> tuple:
    out = []
    for line in block.strip().splitlines():
        parts = line.split()
        csv_name, parser = parts[0], parts[1]
        target = parts[2] if len(parts) > 2 else csv_name
        out.append((csv_name, parser, target))
    return tuple(out)


# ---------------------------------------------------------------------------
# Feed layouts of the source system, in file order.
# ---------------------------------------------------------------------------
TRANSACTIONS = FeedSpec("transactions", _parse("""
transaction_id text
transaction_item_id text
branch_id text
branch_name text
client_id text
client_first_name text
client_last_name text
client_source text
purchased_date date
purchase_time clock
item_type text
description text
quantity double0
purchase_voucher_discount_percentage double0
purchase_online_deposit double0
purchase_online_discount_amount double0
service_id text
service_name text
service_category_id text
service_category_name text
package_id text
package_name text
special_offer_id text
special_offer_name text
product_id text
product_name text
product_brand_id text
product_brand_name text
product_category_id text
product_category_name text
product_barcode text
product_code text
course_id text
course_name text
client_course_name text
voucher_serial text
service_reward_id text
service_reward_name text
product_reward_id text
product_reward_name text
unit_price double0
original_price double0
discount_type double0
discount_value double0
item_online_deposit double0
item_online_discount double0
loyalty_points_awarded double0
tax_rate double0
total_amount double0
total_amount_pre_vouch_disc double0
net_total_amount double0
gross_total_amount double0
net_price double0
gross_price double0
discount_amount double0
tax_amount double0
staff_tips double0
product_cost_price double0
service_cost double0
service_cost_type text
gross_total_with_discount double0
gross_total_with_discount_minus_tax double0
simple_discount_amount double0
membership_benefit_used int0
membership_discount_amount double0
deal double0
session_net_amount double0
session_gross_amount double0
phorest_tips double0 platform_tips
payment_type text
payment_type_ids text
payment_type_amounts double0
payment_type_codes text
payment_type_names text
payment_type_voucher_serials text
payment_type_prepaid_tax_amounts text
outstanding_balance_pmt int0
open_sale bool
open_sale_type text
purchase_type text
online_booking int0
void int0
voided_transaction_id text
void_reason text
department_id text
department_name text
staff_id text
staff_first_name text
staff_last_name text
staff_category_id text
staff_category_name text
is_requested_staff int0
primary_staff_id text
preferred_staff_id text
preferred_staff_name text
appointment_id text
appointment_date date
appointment_created ts
appointment_rating int0
client_birthday date
client_gender text
client_email text
client_first_visit date
appt_client_id text
appt_client_first_name text
appt_client_last_name text
appt_client_birthday date
appt_client_gender text
appt_client_email text
appt_client_first_visit date
internet_category_ids text
internet_category_names text
branch_product_id text
fixed_discount_id text
fixed_discount_name text
client_course_id text
creating_user text
tax_rate_name text
sale_fee_id text
purchase_updated_at ts source_updated_at
"""), key=("transaction_id",), clean="runs")

# Item columns kept from the first write when a newer version arrives.
ITEM_INSERT_ONLY = (
    "purchase_voucher_discount_percentage", "purchase_online_deposit", "purchase_online_discount_amount",
    "service_id", "service_name", "service_category_id", "service_category_name",
    "package_id", "package_name", "special_offer_id", "special_offer_name",
    "product_id", "product_name", "product_brand_id", "product_brand_name", "product_category_id",
    "product_category_name", "product_barcode", "product_code",
    "course_id", "course_name", "client_course_name", "voucher_serial",
    "service_reward_id", "service_reward_name", "product_reward_id", "product_reward_name",
)

# Transaction header = these item columns (newest version per transaction_id).
HEADER_COLUMNS = ("transaction_id", "branch_id", "branch_name", "client_id", "client_first_name",
                  "client_last_name", "client_source", "purchased_date", "purchase_time", "source_updated_at")

CLIENTS = FeedSpec("clients", _parse("""
client_id text
updated_at date source_updated_at
created_at date source_created_at
version int0
first_name text
last_name text
mobile text
linked_client_mobile text
land_line text
email text
birth_date date
gender text
sms_marketing_consent bool
email_marketing_consent bool
sms_reminder_consent bool
email_reminder_consent bool
archived bool
deleted bool
banned bool
merged_to_client_id text
street_address_1 text
street_address_2 text
city text
state text
postal_code text
country text
client_since date
first_visit date
last_visit date
notes text
photo_url text
preferred_staff_id text
credit_account_credit_days int?
credit_account_credit_limit double?
loyalty_card_serial_number text
external_id text
creating_branch_id text
client_category_ids text
"""), key=("client_id",), clean="replace")

REVIEWS = FeedSpec("reviews", _parse("""
review_id text
branch_id text
client_id text
client_first_name text
client_last_name text
review_date date3
visit_date date3
staff_id text
staff_first_name text
staff_last_name text
text text
rating int0s
facebook_review bool
twitter_review bool
"""), key=("review_id", "branch_id"), clean="none")

FEEDS = {s.name: s for s in (TRANSACTIONS, CLIENTS, REVIEWS)}


def clients_spec(version_parse: str = "date") -> FeedSpec:
    """Clients feed; ``version_parse='timestamp'`` reads ``updated_at`` /
    ``created_at`` as full timestamps instead of the date-only default (with
    the default a timestamp value yields a NULL version)."""
    if version_parse == "date":
        return CLIENTS
    cols = tuple((c, "ts" if c in ("updated_at", "created_at") else p, t) for c, p, t in CLIENTS.columns)
    return FeedSpec(CLIENTS.name, cols, CLIENTS.key, CLIENTS.clean)
