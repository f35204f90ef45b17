"""Sales and warehouse ledgers: each source table pair is scanned and joined once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shelfledger.functions.expressions import (
    DEC,
    PRODUCT_KEYS,
    business_date,
    imex_in_scope,
    imex_net_qty,
    in_window,
    is_internal_receipt,
    is_return,
    millionths,
    price_millionths,
    receipt_candidate,
    regular_price_line,
    round_to_second,
    unit_price,
    whole_sum,
)
from shelfledger.functions.joins import sorted_side

#: Columns of the POS ledger that serve the control of its lines only. The staged book needs the first one for ``has_null_qty``.
CONTROLS = ("unknown_lines", "line_print")


def with_pos_header(details: DataFrame, masters: DataFrame, how: str = "left") -> DataFrame:
    """POS lines with their header's date, worked out once a header. The left join keeps lines without one, with a NULL date.

    The line side is the large one and may crowd on one header code or on NULL; adaptive execution splits such
    partitions of the line side, which an outer join from that side allows.
    """
    day = business_date(F.col("transaction_ts")).alias("business_date")
    headers = masters.select("site", F.col("code").alias("pos_master"), day)
    return details.join(headers, ["site", "pos_master"], how)


def line_print(*columns: str) -> Column:
    """One number for many lines: it changes if one is lost, doubled or altered, whatever their order."""
    return F.bit_xor(F.xxhash64(*columns)).alias("line_print")


def parts(*names: str) -> list[str]:
    """The two columns that hold a quantity or an amount: whole millionths, and a decimal for what is too large or too fine."""
    return [f"{size}_{name}" for name in names for size in ("small", "large")]


def in_parts(lines: DataFrame, *names: str) -> DataFrame:
    """Columns of decimals in two parts. Nearly every line has the small one only, which costs a fraction of a wide decimal."""
    absent = [name for name in names if f"small_{name}" not in lines.columns]
    lines = lines.withColumns({f"small_{name}": millionths(F.col(name)) for name in absent}) if absent else lines
    return lines.withColumns({f"large_{name}": F.when(F.col(f"small_{name}").isNull(), F.col(name)) for name in names}).drop(*names)


def whole(name: str) -> Column:
    return whole_sum(*map(F.col, parts(name))).alias(name)


def _unknown(name: str) -> Column:
    small, large = map(F.col, parts(name))
    return small.isNull() & large.isNull()


def _sums(name: str) -> list[Column]:
    """Sums of both parts; the large one passes over lines that have none."""
    small, large = parts(name)
    return [F.sum(small).alias(small), F.expr(f"sum({large}) filter (where {large} is not null)").alias(large)]


def _total(name: str, of: str = "true") -> Column:
    """Sum of both parts over any number of lines: units and millionths apart, so that no whole number overflows."""
    small, large = parts(name)
    units, rest = (F.expr(f"sum({small} {operator} 1000000) filter (where {of})") for operator in ("div", "%"))
    wide = F.expr(f"sum({large}) filter (where {large} is not null and {of})")
    zero = F.lit(0).cast(DEC)
    return F.when(units.isNotNull() | wide.isNotNull(), (F.coalesce(units.cast(DEC) + whole_sum(rest, F.lit(None).cast(DEC)), zero) + F.coalesce(wide, zero)).cast(DEC))


POS_LINE = ("product", "pos_master", *parts("qty", "amount"), "re_pos_details", "discount")
IMEX_LINE = ("product", "document_no", *parts("quantity", "qty_received"))


def pos_book(details: DataFrame, masters: DataFrame) -> DataFrame:
    """The whole POS history at product, day, discount and sale/return grain, as it is staged; ``pos_ledger`` reads it.

    Everything later steps read (quantities, unknown flags, price agreement, promotion) survives this grouping, so the
    lines themselves are joined only once. Lines are summed before the shuffle, so a product that holds a large share
    of all lines arrives as few rows. CONTROLS and ``line_count`` tell which lines went in. Quantities and prices stand in two
    columns each, as small numbers and, for those that are none, as wide decimals: nearly every line is a row of its own here,
    and wide decimals are dear to add and to compare.
    """
    returned = is_return(F.col("re_pos_details"))
    qty, amount = F.col("small_qty"), F.col("small_amount")
    regular = ~returned & F.col("discount").isNull() & ((qty > 0) | (F.col("large_qty") > 0)) & ~_unknown("amount")
    small = qty.isNotNull() & amount.isNotNull()
    lines = with_pos_header(in_parts(details.where("product is not null"), "qty", "amount"), masters).withColumns(
        {
            "small_price": F.when(regular & small, price_millionths(amount, qty)),
            "large_price": F.when(regular & ~small, unit_price(whole("amount"), whole("qty"))),
        }
    )
    return lines.groupBy("site", "product", "business_date", "discount", returned.alias("is_return")).agg(
        *_sums("qty"),
        F.count(F.lit(1)).alias("line_count"),
        *[F.min(f"{size}_price").alias(f"{size}_min_price") for size in ("small", "large")],
        *[F.max(f"{size}_price").alias(f"{size}_max_price") for size in ("small", "large")],
        F.count_if(_unknown("qty")).alias("unknown_lines"),
        line_print(*POS_LINE),
    )


def as_pos_ledger(book: DataFrame) -> DataFrame:
    """Quantities and prices of the staged ledger in one column each, for those who read them."""
    none = F.lit(None).cast(DEC)
    price = {name: (whole_sum(F.col(f"small_{name}"), none), F.col(f"large_{name}")) for name in ("min_price", "max_price")}
    return book.select(
        "site",
        "product",
        "business_date",
        "discount",
        "is_return",
        whole("qty"),
        "line_count",
        (F.col("unknown_lines") > 0).alias("has_null_qty"),
        F.least(*price["min_price"]).alias("min_price"),
        F.greatest(*price["max_price"]).alias("max_price"),
        *[name for name in CONTROLS if name in book.columns],
    )


def pos_ledger(
    details: DataFrame, masters: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda book: book
) -> DataFrame:
    """POS history at product, day, discount and sale/return grain. ``stage`` may write what it is read from."""
    return as_pos_ledger(stage(pos_book(details, masters)))


def pos_line_totals(details: DataFrame) -> DataFrame:
    """Per site what the ledger must hold, from the source columns alone: no header, no shuffle of lines."""
    return in_parts(details.where("product is not null"), "qty", "amount").groupBy("site").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(_unknown("qty")).alias("unknown_lines"),
        _total("qty", "re_pos_details is null").alias("sum_1"),
        _total("qty", "re_pos_details is not null").alias("sum_2"),
        line_print(*POS_LINE),
    )


def pos_ledger_totals(ledger: DataFrame) -> DataFrame:
    returned = F.col("is_return")
    return ledger.groupBy("site").agg(
        F.sum("line_count").alias("lines"),
        F.sum("unknown_lines").alias("unknown_lines"),
        F.sum(F.when(~returned, F.col("qty"))).alias("sum_1"),
        F.sum(F.when(returned, F.col("qty"))).alias("sum_2"),
        F.bit_xor("line_print").alias("line_print"),
    )


def pos_daily(ledger: DataFrame) -> DataFrame:
    """Sale and return quantity per product and day. A NULL date collects lines without a dated header."""
    sale = F.when(~F.col("is_return"), F.col("qty")).otherwise(F.lit(0))
    back = F.when(F.col("is_return"), F.col("qty")).otherwise(F.lit(0))
    return ledger.groupBy("site", "product", "business_date").agg(
        F.sum(sale).alias("sale_qty"),
        F.sum(back).alias("return_qty"),
        F.sum("line_count").alias("line_count"),
        F.bool_or("has_null_qty").alias("has_null_qty"),
    )


def activity_days(ledger: DataFrame) -> DataFrame:
    """Days on which the store had any POS line, whatever the product and whether sale or return."""
    return ledger.where("business_date is not null").select("site", "business_date").distinct()


def pos_lines(
    details: DataFrame, masters: DataFrame, targets: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """POS lines of the final population inside its window.

    ``targets`` carries each product's window, so the join is both the population filter and the exact date filter.
    ``first`` and ``last`` bound all windows; as plain values they reach the scan of the headers.
    """
    if first is not None and last is not None:
        masters = masters.where(in_window(F.col("transaction_ts"), first, last))
    scope = targets.select("site", "product", "window_start", "window_end")
    returned = is_return(F.col("re_pos_details")).alias("is_return")
    lines = in_parts(details.where("product is not null"), "qty", "amount")
    lines = lines.select("site", "product", "pos_master", *parts("qty", "amount"), "discount", returned)
    return (
        with_pos_header(lines, masters, "inner")
        .join(sorted_side(scope), PRODUCT_KEYS)
        .where("business_date between window_start and window_end")
        .select("site", "product", "business_date", whole("qty"), whole("amount"), "discount", "is_return")
    )


def imex_lines(details: DataFrame, masters: DataFrame, include_in_progress: bool = False) -> DataFrame:
    """All warehouse lines of a product with what their header makes of them; ``kept`` marks those in scope.

    In scope are the document kinds with a stock effect, lines without a header and headers without an effective date.
    """
    # What depends on the header alone is worked out on the header side, once per document.
    kind, status = F.col("document_type"), F.col("document_status")
    internal, receipt = is_internal_receipt(kind, status), F.col("raw_receipt_ts")
    headers = masters.withColumn("raw_receipt_ts", round_to_second(F.col("receipt_ts"))).select(
        "site",
        F.col("code").alias("document_no"),
        F.col("code").alias("document"),
        "document_type",
        "document_status",
        business_date(F.col("eff_ts")).alias("business_date"),
        (F.col("eff_ts").isNull() | imex_in_scope(kind, status)).alias("in_scope"),
        internal.alias("internal"),
        receipt,
        receipt_candidate(internal, F.col("receipt_ts"), F.col("eff_ts"), receipt).alias("receipt_candidate_ts"),
    )
    lines = in_parts(details.where("product is not null"), "quantity", "qty_received")

    def net(size: str) -> Column:
        given = F.col(f"{size}_qty_received"), F.col(f"{size}_quantity")
        return imex_net_qty(kind, status, *given, include_in_progress, "bigint" if size == "small" else DEC)

    lines = lines.join(headers, ["site", "document_no"], "left").withColumn("small_net_qty", net("small"))
    lines = lines.withColumn("large_net_qty", F.when(F.col("small_net_qty").isNull(), net("large")))
    return lines.select(
        "site",
        "document",
        "document_no",
        "product",
        "business_date",
        whole("net_qty"),
        F.coalesce("internal", F.lit(False)).alias("is_internal_receipt"),
        "raw_receipt_ts",
        "receipt_candidate_ts",
        *parts(*IMEX_SUMS),
        F.coalesce(F.col("document").isNull() | F.col("in_scope"), F.lit(False)).alias("kept"),
    )


def imex_ledger(details: DataFrame, masters: DataFrame, include_in_progress: bool = False) -> DataFrame:
    """Warehouse lines in scope with their signed stock effect and receipt times."""
    lines = imex_lines(details, masters, include_in_progress).where("kept")
    return lines.drop("document_no", "kept", *parts(*IMEX_SUMS))


#: Quantities that the warehouse ledger holds in two columns each, as the POS ledger does.
IMEX_SUMS = ("net_qty", "quantity", "qty_received")
#: Columns of the staged warehouse ledger that serve the control of its lines only.
IMEX_CONTROLS = ("line_count", "unknown_lines", *parts("quantity", "qty_received"), "line_print")


def imex_book(lines: DataFrame) -> DataFrame:
    """Movement and receipt evidence per product and day (``kept``), and control sums of all lines, as it is staged.

    Lines out of scope are one row for each site, without product and day, so that no line goes uncounted. Flags and minima
    combine the same over lines as over documents, so one grouping serves movement and receipts.
    """
    kept = F.col("kept")
    keys = [F.when(kept, F.col(name)).alias(name) for name in ("product", "business_date")]
    return lines.groupBy("site", *keys, "kept").agg(
        *_imex_day(),
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(_unknown("quantity") | _unknown("qty_received")).alias("unknown_lines"),
        *[part for name in IMEX_SUMS for part in _sums(name)],
        line_print(*IMEX_LINE),
    )


def imex_line_totals(details: DataFrame) -> DataFrame:
    return in_parts(details.where("product is not null"), "quantity", "qty_received").groupBy("site").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(_unknown("quantity") | _unknown("qty_received")).alias("unknown_lines"),
        _total("quantity").alias("sum_1"),
        _total("qty_received").alias("sum_2"),
        line_print(*IMEX_LINE),
    )


def imex_book_totals(book: DataFrame) -> DataFrame:
    return book.groupBy("site").agg(
        F.sum("line_count").alias("lines"),
        F.sum("unknown_lines").alias("unknown_lines"),
        _total("quantity").alias("sum_1"),
        _total("qty_received").alias("sum_2"),
        F.bit_xor("line_print").alias("line_print"),
    )


IMEX_DAY = (
    "site", "product", "business_date", "net_qty", "has_unknown_qty", "has_receipt", "first_receipt_date", "first_candidate_ts",
    "any_missing_receipt", "any_receipt_mismatch", "any_date_only_receipt",
)


def _imex_day() -> list[Column]:
    receipt, raw = F.col("is_internal_receipt"), F.col("raw_receipt_ts")
    midnight = (F.hour(raw) == 0) & (F.minute(raw) == 0) & (F.second(raw) == 0)
    return [
        F.bool_or(_unknown("net_qty")).alias("has_unknown_qty"),
        F.bool_or(receipt).alias("has_receipt"),
        F.min(F.when(receipt, F.to_date(raw))).alias("first_receipt_date"),
        F.min(F.when(receipt, F.col("receipt_candidate_ts"))).alias("first_candidate_ts"),
        F.bool_or(receipt & raw.isNull()).alias("any_missing_receipt"),
        F.bool_or(receipt & raw.isNotNull() & (F.to_date(raw) != F.col("business_date"))).alias("any_receipt_mismatch"),
        F.bool_or(receipt & raw.isNotNull() & midnight).alias("any_date_only_receipt"),
    ]


def imex_daily(book: DataFrame) -> DataFrame:
    """Warehouse movement and receipt evidence per product and day."""
    return book.where("kept").withColumn("net_qty", whole("net_qty")).select(*IMEX_DAY)
