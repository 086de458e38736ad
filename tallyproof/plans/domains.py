"""The nine document domains. Everything that differs between them is stated here.

Table, column and sheet names are fixed values of the audited databases and of the
report. Several joins look odd (returns joined to sale items, a supplier id used as
a client id); they define what the checks compute and are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

BRANCH = "database_branch"
CLIENT = "database_client"
CUSTOMER = "database_customer"
SUPPLIER = "database_supplier"
SALE_SETTINGS = "database_sale_settings"
PURCHASE_SETTINGS = "database_purchase_settings"

# Every head column some check reads.
HEAD_COLUMNS = (
    "id",
    "entry_number",
    "entry_date",
    "branch_id",
    "billing_on",
    "net_amount",
    "gross_total",
    "total_gst",
    "total_disc",
    "overall_disc",
    "customer_id_id",
    "supplier_id_id",
    "is_b2b_bill",
)


@dataclass(frozen=True)
class Items:
    """An item table and its column names."""

    table: str
    header_key: str
    value: str
    quantity: str
    free: str
    total: str  # reported name of quantity + free


SALE_ITEMS = Items(
    "database_salesitem", "sale_header_id", "sale_value", "sale_quantity", "sale_free", "sum_of_sq_sf"
)
PURCHASE_ITEMS = Items(
    "database_purchaseitem",
    "purchase_header_id",
    "purchase_value",
    "purchase_quantity",
    "purchase_free",
    "sum_of_pq_pf",
)
SALE_RETURN_ITEMS = Items(
    "database_salereturnitem",
    "sale_return_header_id",
    "sale_value",
    "sale_quantity",
    "sale_free",
    "sum_of_sq_sf",
)
PURCHASE_RETURN_ITEMS = Items(
    "database_purchasereturnitem",
    "purchase_return_header_id",
    "return_value",
    "return_quantity",
    "return_free",
    "sum_of_pq_pf",
)
# Joined to its header by its own id; it takes no part in a quantity check.
TRANSFER_IN_ITEMS = Items("database_transferinitem", "id", "purchase_value", "", "", "")


@dataclass(frozen=True)
class GapRule:
    """How missing numbers are found.

    windowed          only day D's documents span the range (else all history)
    through_midnight  the window includes the exact midnight that ends day D
    guarded           only numbers ending in four digits take part
    skip_blank        unguarded, an empty number is passed over (else not a number)
    known_anywhere    a number is present if any document ever carried it
                      (else only if one of the window did)
    attach            head rows shown beside a number missing from the window: every
                      document of the 'series', or those with that exact 'number'
    head_flag         column of the attached rows to show as well
    series_flag       column of the series' lowest-id window document to show
    head_branch       show the attached row's branch_id, not the missing number's
    columns           output columns in order
    order             sort keys of the report
    """

    columns: tuple[str, ...]
    windowed: bool = True
    through_midnight: bool = True
    guarded: bool = True
    skip_blank: bool = True
    known_anywhere: bool = False
    attach: str = "number"
    head_flag: str | None = None
    series_flag: str | None = None
    head_branch: bool = False
    order: tuple[str, ...] = ("branch_id", "missing_entry_number")


@dataclass(frozen=True)
class AmountRule:
    """How header amounts are recomputed; see functions.money for the item rules."""

    rule: str
    items: Items
    columns: tuple[str, ...]
    value_total: str
    discount_total: str
    settings: str = SALE_SETTINGS
    customer_key: str | None = "customer_id_id"
    supplier_key: str | None = None  # joined, no column read
    client_key: str | None = None  # on the head; None: the branch's client_id
    party: str = "client_name"
    # Which header amounts are made fixed decimals: none, those in the formula, all shown.
    decimals: str = "none"


@dataclass(frozen=True)
class QuantityRule:
    """`own` items joined to their own head, or else the day's high purchase items
    joined to every head of the domain at the same branch."""

    items: Items
    own: bool
    with_branch: bool = True


@dataclass(frozen=True)
class Domain:
    slug: str
    sheet: str
    head: str
    gap: GapRule
    amount: AmountRule
    quantity: QuantityRule


_TOTALS = ("items_tax_value", "items_total_value", "calculated_net_amount", "difference_amount")
_HEADER = ("net_amount", "gross_total", "total_gst", "total_disc")
_WHO = ("entry_date", "entry_number", "branch_id", "branch_name", "domain")
_SALE_SUMS = ("item_total_sale_value", "item_total_gst_value", "item_discount_sale_value")
_PURCHASE_SUMS = ("item_total_purchase_value", "item_total_gst_value", "item_discount_value")
_RETURN_SUMS = ("item_total_purchase_returnvalue", "item_total_gst_value", "item_discount_value")

_SALE_AMOUNTS = (*_WHO, "client_name", "billing_on", *_HEADER, *_SALE_SUMS, "id", *_TOTALS)


def _sale_amounts(rule: str = "header_cut_by_mode", columns=_SALE_AMOUNTS, **other) -> AmountRule:
    return AmountRule(
        rule, SALE_ITEMS, columns, "item_total_sale_value", "item_discount_sale_value", **other
    )


_PURCHASES_SAME_DAY = QuantityRule(PURCHASE_ITEMS, own=False)

DOMAINS: tuple[Domain, ...] = (
    Domain(
        "sale",
        "Database_salehead",
        "database_salehead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "branch_id",
                "branch_name",
                "branch_domain",
                "is_retail_b2b_bill",
                "missing_entry_number",
            ),
            through_midnight=False,
            attach="series",
            head_flag="is_retail_b2b_bill",
            order=("branch_id", "series", "missing_entry_number"),
        ),
        _sale_amounts(),
        QuantityRule(SALE_ITEMS, own=True),
    ),
    Domain(
        "purchase",
        "Database_Purchasehead",
        "database_purchasehead",
        GapRule(
            ("id", "entry_number", "entry_date", "name", "domain", "missing_entry_number", "branch_id")
        ),
        AmountRule(
            "purchase",
            PURCHASE_ITEMS,
            ("id", *_WHO, "client_name", *_HEADER, *_PURCHASE_SUMS, *_TOTALS),
            "item_total_purchase_value",
            "item_discount_value",
            settings=PURCHASE_SETTINGS,
            customer_key=None,
            supplier_key="supplier_id_id",
            decimals="formula",
        ),
        QuantityRule(PURCHASE_ITEMS, own=True),
    ),
    Domain(
        "b2c_sale",
        "Database_b2csalehead",
        "database_b2csalehead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "branch_id",
                "branch_name",
                "branch_domain",
                "missing_entry_number",
            ),
            through_midnight=False,
            guarded=False,
            known_anywhere=True,
        ),
        _sale_amounts(),
        QuantityRule(PURCHASE_ITEMS, own=False, with_branch=False),
    ),
    Domain(
        "sale_return",
        "Database_Salereturnhead",
        "database_salereturnhead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "is_b2b_bill",
                "branch_id",
                "branch_name",
                "domain",
                "missing_entry_number",
            ),
            series_flag="is_b2b_bill",
        ),
        _sale_amounts(decimals="shown"),
        QuantityRule(SALE_RETURN_ITEMS, own=True),
    ),
    Domain(
        "purchase_return",
        "Database_Purchasereturnhead",
        "database_purchasereturnhead",
        GapRule(
            ("id", "entry_number", "entry_date", "branch_id", "name", "domain", "missing_entry_number"),
            head_branch=True,
        ),
        AmountRule(
            "customer_cut_by_mode",
            PURCHASE_RETURN_ITEMS,
            (*_WHO, "supplier_name", "billing_on", *_HEADER, *_RETURN_SUMS, "id", *_TOTALS),
            "item_total_purchase_returnvalue",
            "item_discount_value",
            customer_key="supplier_id_id",
            client_key="supplier_id_id",
            party="supplier_name",
            decimals="formula",
        ),
        QuantityRule(PURCHASE_RETURN_ITEMS, own=True),
    ),
    Domain(
        "expiry_in",
        "Database_Expiry_inhead",
        "database_expiryinhead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "branch_id",
                "branch_name",
                "domain",
                "missing_entry_number",
            ),
            windowed=False,
            guarded=False,
            skip_blank=False,
            known_anywhere=True,
        ),
        _sale_amounts(
            "header_cut", (*_WHO, "client_name", *_HEADER, *_SALE_SUMS, "id", *_TOTALS)
        ),
        _PURCHASES_SAME_DAY,
    ),
    Domain(
        "expiry_out",
        "Database_Expiryouthead",
        "database_expiryouthead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "branch_name",
                "domain",
                "missing_entry_number",
                "branch_id",
            )
        ),
        _sale_amounts(customer_key="supplier_id_id"),
        _PURCHASES_SAME_DAY,
    ),
    Domain(
        "transfer_in",
        "Database_Transferinhead",
        "database_transferinhead",
        GapRule(
            (
                "id",
                "entry_date",
                "entry_number",
                "branch_name",
                "branch_id",
                "domain",
                "missing_entry_number",
            ),
            attach="series",
        ),
        AmountRule(
            "customer_cut",
            TRANSFER_IN_ITEMS,
            ("id", *_WHO, "supplier_name", *_HEADER, *_PURCHASE_SUMS, *_TOTALS),
            "item_total_purchase_value",
            "item_discount_value",
            customer_key="supplier_id_id",
            client_key="supplier_id_id",
            party="supplier_name",
            decimals="formula",
        ),
        _PURCHASES_SAME_DAY,
    ),
    Domain(
        "transfer_out",
        "Database_Transferouthead",
        "database_transferouthead",
        GapRule(
            (
                "id",
                "entry_number",
                "entry_date",
                "domain",
                "branch_name",
                "missing_entry_number",
                "branch_id",
            ),
            attach="series",
        ),
        _sale_amounts(),
        _PURCHASES_SAME_DAY,
    ),
)

BY_SLUG = {domain.slug: domain for domain in DOMAINS}
