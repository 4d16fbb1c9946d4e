"""Domain values of the settlement jobs, kept in one place.

Fixed values: they must match the vocabulary of the marketplace statements and of the ERP import
layout, or results differ.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Transaction types of the statements.
ORDER_TYPES = ("Order", "TBYB Order Payment")
LIQUIDATION_TYPES = ("Liquidations", "Liquidations Adjustments")
RESERVE_TYPES = ("Payable to Amazon", "Current Reserve Amount", "Previous Reserve Amount Balance")

# Fee categories and types (two vocabularies are in use).
ITEM_PRICE = "ItemPrice"
PRICE_TYPE = "PRICE_TYPE"
ITEM_FEE_TYPE = "ITEM_RELATED_FEE_TYPE"
PRINCIPAL = "Principal"
FREIGHT_FEES = ("FBAPerUnitFulfillmentFee", "FBAPerOrderFulfillmentFee", "FBAWeightBasedFee")

# Ledger status, statement status, excluded credit class.
NOT_IMPORTED = "Not Imported"
COMPLETE = "Complete"
POSTED = "POSTED"
OPEN = "open"
EXCLUDED_CLASS = "X"

# Fulfilment channels of orders and of listed products.
CHANNEL_FBA = "Amazon"
CHANNEL_FBM = "Merchant"
CHANNEL_MARKETPLACE = "AMAZON_NA"

CURRENCIES = ("USD", "CAD", "MXN")

# Time zone of the statements and of the business day.
STATEMENT_ZONE = "US/Eastern"
BUSINESS_ZONE = "US/Pacific"

# Inventory event types left out of the adjustment ledger (current and draft rule).
EVENT_TYPES_SKIPPED = ("Shipments", "Receipts", "VendorReturns")
EVENT_TYPES_SKIPPED_DRAFT = ("Shipments", "Receipts", "WhseTransfers", "CustomerReturns")

# Packs that are stocked loose, and the size that marks a prepack row.
LOOSE_PACKS = ("M", "*N", "W")
PREPACK_SIZE = "ppk"
PREPACK_SLOTS = 30

# Reconciliation row labels.
RECON_RAW = "Raw Settlement Data"
RECON_LOGIC = "LOGIC"


@dataclass(frozen=True)
class ErpLayout:
    """ERP import codes. The defaults are fixed values; every one can be replaced."""

    company: str = "1"
    terms: int = 82
    routing: str = "RTG"
    warehouse: int = 297
    sales_rep: str = "JDE"
    order_type: str = "S"
    order_origin: str = "A"
    credit_season: str = "S/00"
    credit_rep: str = "C"
    business_unit: str = "66"
    credit_color: str = "ASST"
    credit_style_suffix: str = "-AMZ"
    default_division: int = 31
    default_sub_division: str = "000"
    sales_customer: dict[str, str] = field(
        default_factory=lambda: {"USD": "EASFO02", "CAD": "EASFO06", "MXN": "EASFO02"}
    )
    credit_customer: dict[str, str] = field(
        default_factory=lambda: {"USD": "EASFO02", "CAD": "EASFO06", "MXN": "EASFO06"}
    )
    # Account name -> store number, an input; accounts missing here get no customer and no store.
    stores: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class DraftLayout:
    """Codes of the earlier order-grain and line-grain layouts. Fixed values."""

    company: str = "01"
    customer: str = "EASF02"
    order_store: int = 1
    line_store: str = "0001"
    terms: int = 82
    routing: str = "RTG"
    warehouse: int = 297
    sales_rep: str = "RBM"
    business_unit: str = "AMAZON"


LAYOUT = ErpLayout()
DRAFT_LAYOUT = DraftLayout()

# ERP attributes a product match carries from stock to orders, credits and adjustments.
STOCK_ATTRIBUTES = (
    "division", "div_name", "sub_div", "sub_div_desc", "warehouse", "warehouse_name", "season",
    "style", "color", "pack_dim", "size", "carton_qty", "avail_in_stock", "wip", "in_transit",
    "cost", "sku200", "size_scale",
)
