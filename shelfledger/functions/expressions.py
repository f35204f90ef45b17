"""Column expressions shared by the operators. All are built-in Spark functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

DEC = "decimal(38,6)"

#: Keys of joins and sorts by product. A sort compares its first column by a prefix, so the one with more values stands first.
PRODUCT_KEYS = ["product", "site"]

# Warehouse document types and statuses.
INBOUND_TYPES = (1, 2, 3, 4, 21, 31, 41, 50)
OUTBOUND_TYPES = (5, 6, 7, 8, 9, 10, 20, 30, 40, 52)
OUTBOUND_IN_PROGRESS_TYPES = (5, 6, 7, 8, 9, 20, 30, 40, 52)
INBOUND_DONE, INBOUND_IN_PROGRESS = 3, 2
OUTBOUND_DONE, OUTBOUND_IN_PROGRESS = 6, 5
INTERNAL_RECEIPT_TYPE = 1

# Promotion types that count as a promotion.
PROMO_TYPES = (2, 7)

# Fixed value: barcodes with this prefix stand for a bundle of products, not for one retail product.
BUNDLE_PREFIX = "H"


def business_date(ts: Column) -> Column:
    return F.to_date(ts)


def in_window(ts: Column, start: date | Column, end: date | Column) -> Column:
    """Half-open test on a timestamp for the inclusive day range [start, end]."""
    first = start if isinstance(start, Column) else F.lit(start)
    last = end if isinstance(end, Column) else F.lit(end)
    return (ts >= first.cast("timestamp_ntz")) & (ts < F.date_add(last, 1).cast("timestamp_ntz"))


#: Quantities and amounts below this many units are held as whole millionths, which are added and compared without wide
#: decimals. A whole number holds the sum of at least 92 million of them; beyond, ANSI mode stops and G22 finds it.
SMALL_BELOW = 100_000


def millionths(value: Column) -> Column:
    """A decimal as a whole number of millionths. NULL from ``SMALL_BELOW`` on."""
    return (value.try_cast("decimal(11,6)") * F.lit(1_000_000)).cast("bigint")


def millionths_of_double(value: Column) -> Column:
    """The same for a floating number that is nearest to a whole number of millionths; NULL for others, whose cast to a decimal rounds.

    Eleven digits tell two floating numbers apart, so the millionths found are those of that cast.
    """
    near = F.rint(value * F.lit(1e6))
    return F.when((F.abs(value) < SMALL_BELOW) & (near / F.lit(1e6) == value), near.cast("bigint"))


def millionths_of_whole(value: Column) -> Column:
    return F.when(value.between(1 - SMALL_BELOW, SMALL_BELOW - 1), value.cast("bigint") * 1_000_000)


def price_millionths(amount: Column, qty: Column) -> Column:
    """``unit_price`` of an amount and a positive quantity in millionths, half up as decimals are."""
    half_up = F.call_function("div", F.abs(amount) * 2_000_000 + qty, qty * 2)
    return F.when(amount < 0, -half_up).otherwise(half_up)


def whole_sum(small: Column, large: Column) -> Column:
    """A sum from that of millionths and that of the quantities which are none."""
    units = (small.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast(DEC)
    return F.when(large.isNull(), units).otherwise((F.coalesce(units, F.lit(0).cast(DEC)) + large).cast(DEC))


def is_return(re_pos_details: Column) -> Column:
    return re_pos_details.isNotNull()


def imex_net_qty(
    doc_type: Column, status: Column, qty_received: Column, quantity: Column, include_in_progress: bool, kind: str = DEC
) -> Column:
    """Signed effect of a warehouse line on stock. NULL only when the chosen quantity is NULL. ``kind`` is the quantities' type."""
    inbound = doc_type.isin(*INBOUND_TYPES)
    net = F.when(inbound & (status == INBOUND_DONE), qty_received).when(
        doc_type.isin(*OUTBOUND_TYPES) & (status == OUTBOUND_DONE), -qty_received
    )
    if include_in_progress:
        net = net.when(inbound & (status == INBOUND_IN_PROGRESS), quantity).when(
            doc_type.isin(*OUTBOUND_IN_PROGRESS_TYPES) & (status == OUTBOUND_IN_PROGRESS), -qty_received
        )
    return net.otherwise(F.lit(0)).cast(kind)


def imex_in_scope(doc_type: Column, status: Column) -> Column:
    return (doc_type.isin(*INBOUND_TYPES) & status.isin(INBOUND_IN_PROGRESS, INBOUND_DONE)) | (
        doc_type.isin(*OUTBOUND_TYPES) & status.isin(OUTBOUND_IN_PROGRESS, OUTBOUND_DONE)
    )


def is_internal_receipt(doc_type: Column, status: Column) -> Column:
    return F.coalesce((doc_type == INTERNAL_RECEIPT_TYPE) & (status == INBOUND_DONE), F.lit(False))


def round_to_second(ts: Column) -> Column:
    """Nearest second, half up. Stays timezone-free, unlike date_trunc."""
    shifted = ts + F.expr("interval '0.5' second")
    fraction = F.extract(F.lit("SECOND"), shifted) - F.second(shifted)
    return shifted - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def receipt_candidate(internal: Column, receipt_ts: Column, eff_ts: Column, to_second: Column | None = None) -> Column:
    """Usable receipt time: present and on the effective day. Midnight is a real time. ``to_second`` is it, if already rounded."""
    rounded = round_to_second(receipt_ts) if to_second is None else to_second
    return F.when(internal & (F.to_date(receipt_ts) == F.to_date(eff_ts)), rounded)


def missing_barcode(barcode: Column) -> Column:
    return barcode.isNull() | (F.trim(barcode) == "")


def has_bundle_prefix(barcode: Column) -> Column:
    return F.coalesce(barcode.startswith(BUNDLE_PREFIX), F.lit(False))


def regular_price_line(returned: Column, discount: Column, qty: Column, amount: Column) -> Column:
    return ~returned & discount.isNull() & (qty > 0) & amount.isNotNull()


def unit_price(amount: Column, qty: Column) -> Column:
    return (amount / F.nullif(qty, F.lit(0).cast(DEC))).cast(DEC)


def promo_type_eligible(promo_type: Column) -> Column:
    return promo_type.isin(*PROMO_TYPES)


def sales_or_null(store_open: Column, qty: Column) -> Column:
    """Closed day: unknown. Open day: a number, zero included."""
    return F.when(store_open, F.coalesce(qty, F.lit(0).cast(DEC)))


def stock_status(tainted: Column, open_stock: Column, close_stock: Column) -> Column:
    return (
        F.when(tainted, F.lit("UNKNOWN_QUANTITY"))
        .when((open_stock < 0) | (close_stock < 0), F.lit("NEGATIVE"))
        .otherwise(F.lit("VALID"))
    )


def receipt_status(any_mismatch: Column, any_missing: Column, any_date_only: Column) -> Column:
    return (
        F.when(any_mismatch, F.lit("DATE_MISMATCH"))
        .when(any_missing, F.lit("MISSING"))
        .when(any_date_only, F.lit("DATE_ONLY"))
        .otherwise(F.lit("TIMED"))
    )
