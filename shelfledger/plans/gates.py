"""Checks that stop a run. Each gives rows of gate, site and the number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfledger.functions.expressions import DEC, has_bundle_prefix
from shelfledger.functions.joins import sorted_side
from shelfledger.operators import ledgers
from shelfledger.operators.stock import PRODUCT, check_runs
from shelfledger.violations import GateError, Violation

# Gate codes in the order in which a run stops at them.
GATES = {
    "G1": "sample size is not positive",
    "G2": "inactivity window is not positive",
    "G2b": "cutoff lies after the run date",
    "G3": "configuration table or column is missing",
    "G4": "store table or column is missing",
    "S5": "table or column is missing",
    "S5t": "a column's type cannot be read as what it stands for",
    "S5v": "values do not fit what their column is read as",
    "G5": "configuration does not name exactly one store",
    "G6": "configured store has no named store row",
    "K3": "configured store code has several names",
    "G7": "product table or column is missing",
    "G8": "product group table or column is missing",
    "G9": "POS line table or column is missing",
    "G10": "POS header table or column is missing",
    "G23": "discount column is not an integer key",
    "K1": "product codes repeat in the catalog",
    "K4a": "POS header codes repeat",
    "K4b": "warehouse header codes repeat",
    "G11": "no retail product is left in POS",
    "G12": "candidates have POS lines without a dated header",
    "G13": "candidates have warehouse lines without a dated header",
    "G14": "no source date up to the run date",
    "G15": "candidates have POS lines of unknown quantity inside the window",
    "G16": "cutoff lies after the latest source date",
    "G17": "inactivity window starts before the export window",
    "G18": "no barcode is left after the inactivity gate",
    "G19": "the sample left no product",
    "G22": "totals of a ledger and of its source lines differ",
    "G24": "a used discount code stands for several promotions",
    "K2": "promotion codes behind used discounts repeat",
    "G25": "the calendar does not cover the window",
    "G26": "stock does not continue from one day to the next",
    "I-1": "open or closed day disagrees with number or NULL",
    "I-2": "daily sales are lost or changed in the result",
    "I-2b": "0 <= promo <= sales is broken",
    "I-3": "promotion on a closed day",
    "I-4": "rows are not products times days",
    "I-5": "canonical key repeats",
    "I-6": "missing or bundle barcode in the result",
    "I-7": "exported product never appeared in POS",
    "I-8": "published sales differ from the sale lines",
    "I-9": "published promotion sales differ from the promotion lines",
}
#: Gates on parameters and schemas; they stop a run before there is data.
BEFORE_DATA = ("G1", "G2", "G2b", "G3", "G4", "S5", "S5t", "G7", "G8", "G9", "G10", "G23")
#: Gates on the dense result; I-5 also compares the names of stores before it.
ON_RESULT = ("G26", "I-1", "I-2", "I-2b", "I-3", "I-4", "I-5", "I-6", "I-8", "I-9")
_ORDER = {gate: place for place, gate in enumerate(GATES)}
_TOLERANCE = "0.000001"


def not_evaluated(params) -> set[str]:
    """Gates without a place in a report on data, given what the parameters leave off."""
    off = set(BEFORE_DATA)
    if not params.gated:
        off |= {"G16", "G17"}
    if params.test_mode_max_barcodes is None:
        off.add("G19")
    return off


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _per_site(gate: str, rows: DataFrame) -> DataFrame:
    return _named(gate, rows.groupBy("site").agg(F.count(F.lit(1)).alias("violations")))


def _named(gate: str, per_site: DataFrame) -> DataFrame:
    return per_site.select(F.lit(gate).alias("gate"), "site", F.col("violations").cast("bigint").alias("violations"))


def _unpivot(per_site: DataFrame, gates: list[str]) -> DataFrame:
    """Columns named after gates as rows of gate, site and violations."""
    pairs = [F.struct(F.lit(g).alias("gate"), F.col(f"`{g}`").cast("bigint").alias("violations")) for g in gates]
    return per_site.select("site", F.explode(F.array(*pairs)).alias("v")).select("v.gate", "site", "v.violations")


def _repeats(gate: str, df: DataFrame, *key: str) -> DataFrame:
    return _per_site(gate, df.groupBy("site", *key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def _differ(left: Column, right: Column) -> Column:
    zero = F.lit(0).cast(DEC)
    return F.abs(F.coalesce(left, zero) - F.coalesce(right, zero)) > F.lit(_TOLERANCE).cast(DEC)


def identity_gates(config: DataFrame, store: DataFrame) -> DataFrame:
    nothing = config.agg(F.count("store_code").alias("n")).where("n = 0").select(F.lit(None).cast("int").alias("site"))
    codes = config.groupBy("site").agg(F.count_distinct("store_code").alias("codes"))
    named = config.where("store_code is not null").distinct().join(store, ["site", "store_code"], "left")
    names = named.groupBy("site").agg(
        F.count("store_name").alias("names"), F.count_distinct("store_name").alias("distinct_names")
    )
    return union_all(
        [
            _per_site("G5", codes.where("codes <> 1").select("site").unionByName(nothing)),
            _per_site("G6", names.where("names = 0")),
            _per_site("K3", names.where("distinct_names > 1")),
        ]
    )


def value_gates(refused: DataFrame) -> DataFrame:
    return _named("S5v", refused.groupBy("site").agg(F.sum("violations").alias("violations")))


def key_gates(product: DataFrame) -> DataFrame:
    return _repeats("K1", product.where("product is not null"), "product")


def ledger_gates(run) -> DataFrame:
    """Both ledgers against the source columns: lines, known quantities and a fingerprint of every line.

    The totals of a ledger are columns of its stored rows, so a task that runs again changes none of them. More lines
    than the source has mean that header codes repeat (K4); anything else that differs is a loss (G22).
    """
    s = run.sources
    pairs = [
        ("K4a", ledgers.pos_ledger_totals(run.pos_ledger), ledgers.pos_line_totals(s.pos_detail)),
        ("K4b", ledgers.imex_book_totals(run.imex_book), ledgers.imex_line_totals(s.imex_detail)),
    ]
    return union_all([line_control(gate, held, given) for gate, held, given in pairs])


def line_control(gate: str, held: DataFrame, given: DataFrame) -> DataFrame:
    """Surplus lines under ``gate``, and sites whose totals differ otherwise under G22."""
    names = ("lines", "unknown_lines", "sum_1", "sum_2", "line_print")
    held = held.select("site", *[F.col(name).alias(f"held_{name}") for name in names])
    both = given.join(held, "site", "full")
    surplus = F.coalesce("held_lines", F.lit(0)) - F.coalesce("lines", F.lit(0))
    unequal = [~F.col(name).eqNullSafe(F.col(f"held_{name}")) for name in names]
    counted = both.select(
        "site",
        F.greatest(surplus, F.lit(0)).alias(gate),
        ((surplus <= 0) & reduce(Column.__or__, unequal)).cast("bigint").alias("G22"),
    )
    return _unpivot(counted, [gate, "G22"])


def population_gates(run) -> DataFrame:
    """Integrity of candidates and windows, before anything is multiplied by days."""
    seen = run.windows.select("site")
    sites = run.identity.select("site").unionByName(seen).distinct()
    shared = run.identity.groupBy("location_code").agg(F.min("site").alias("site"), F.count(F.lit(1)).alias("n"))
    keys = sorted_side(run.candidates.select(*PRODUCT))
    windows = run.windows
    # A day of unknown quantity has a row of the ledger that says so; only such rows are grouped.
    unknown_days = ledgers.pos_daily(run.pos_ledger.where("has_null_qty"))
    undated = run.pos_daily.where("business_date is null").join(keys, PRODUCT, "left_semi")
    undated_imex = run.imex_daily.where("business_date is null").join(keys, PRODUCT, "left_semi")
    unknown = (
        unknown_days.join(windows, "site")
        .where("business_date between window_start and window_end")
        .join(keys, PRODUCT, "left_semi")
    )
    found = [
        _per_site("G5", seen.join(run.identity, "site", "left_anti")),
        _per_site("I-5", shared.where("n > 1")),
        _per_site("G11", sites.join(run.candidates.select("site").distinct(), "site", "left_anti")),
        _per_site("G12", undated),
        _per_site("G13", undated_imex),
        _per_site("G14", sites.join(windows.where("window_end is not null"), "site", "left_anti")),
        _per_site("G15", unknown),
        _per_site("G18", sites.join(run.all_targets.select("site").distinct(), "site", "left_anti")),
    ]
    if run.params.gated:
        found += [
            _per_site("G16", windows.where(run.params.cutoff() > F.col("window_end"))),
            _per_site("G17", windows.where(run.params.inactivity_start() < F.col("window_start"))),
        ]
    if run.params.test_mode_max_barcodes is not None:
        found.append(_per_site("G19", sites.join(run.targets.select("site").distinct(), "site", "left_anti")))
    return union_all(found)


def line_gates(run) -> DataFrame:
    """Discount codes of the lines in scope and, on request, the totals of a second scan at line grain."""
    ambiguous = run.promotion_codes.where("promotions > 1").join(run.used_discounts, ["site", "discount"], "left_semi")
    used_promotions = run.discount_resolution.where("promotion_found").select("site", "promotion").distinct()
    found = [
        _per_site("G24", ambiguous),
        _repeats(
            "K2",
            run.sources.promotion.join(used_promotions, ["site", "promotion"], "left_semi"),
            "promotion",
        ),
        _per_site("I-7", run.targets.join(sorted_side(run.audit.select(*PRODUCT)), PRODUCT, "left_anti")),
    ]
    if run.params.reconcile_scans:
        found.append(scan_reconciliation(run.ledger_in_scope, run.pos_lines))
    return union_all(found)


def scan_reconciliation(ledger_in_scope: DataFrame, lines: DataFrame) -> DataFrame:
    """Sale and return totals of the ledger against a separate scan of the lines."""

    def totals(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("site").agg(
            F.sum(F.when(~F.col("is_return"), F.col("qty"))).alias(f"{prefix}_sale"),
            F.sum(F.when(F.col("is_return"), F.col("qty"))).alias(f"{prefix}_return"),
        )

    both = totals(ledger_in_scope, "day").join(totals(lines, "line"), "site", "full")
    return _per_site(
        "G22",
        both.where(
            _differ(F.col("day_sale"), F.col("line_sale")) | _differ(F.col("day_return"), F.col("line_return"))
        ),
    )


def calendar_gate(run) -> DataFrame:
    days = run.calendar.groupBy("site").agg(F.count(F.lit(1)).alias("days"))
    return _per_site(
        "G25",
        run.windows.join(days, "site", "left").where(
            F.coalesce("days", F.lit(0)) != F.date_diff("window_end", "window_start") + 1
        ),
    )


#: Days whose presence one number holds, a bit for each.
SPAN = 63


def day_print(day: Column, quantity: Column) -> Column:
    """A number for a day and its quantity, also for a quantity of zero. Null for a null quantity."""
    moved = F.xxhash64(day, quantity.cast(DEC))
    return F.when(quantity == 0, F.xxhash64(day)).when(quantity.isNotNull(), moved)


def expected_products(targets: DataFrame, calendar: DataFrame, sold: DataFrame, promoted: DataFrame) -> DataFrame:
    """For each exported product the days, totals and fingerprints that its published rows must have.

    The fingerprint of sales covers every open day, those without a sale too: all open days at zero, with the zeros of its
    sale days exchanged for their quantities. None of this has a row for each day.
    """
    day, zero = F.col("business_date"), F.lit(0).cast(DEC)
    open_days = calendar.where("has_sales_record").groupBy("site").agg(F.bit_xor(day_print(day, zero)).alias("zeros"))
    sales = sold.groupBy(*PRODUCT).agg(
        F.sum("sales_qty").alias("sale_lines"),
        F.bit_xor(day_print(day, F.col("sales_qty")).bitwiseXOR(day_print(day, zero))).alias("moved"),
    )
    promos = promoted.where("promo_qty <> 0").groupBy(*PRODUCT).agg(
        F.sum("promo_qty").alias("promo_lines"), F.bit_xor(day_print(day, F.col("promo_qty"))).alias("promo_print")
    )
    days = (F.date_diff("window_end", "window_start") + 1).alias("expected_rows")
    rows = targets.select(*PRODUCT, days).join(F.broadcast(open_days), "site", "left")
    rows = rows.join(sorted_side(sales), PRODUCT, "left").join(sorted_side(promos), PRODUCT, "left")
    moved = F.coalesce("moved", F.lit(0)).bitwiseXOR(F.coalesce("zeros", F.lit(0)))
    return rows.select(*PRODUCT, "expected_rows", "sale_lines", "promo_lines", moved.alias("sale_print"), "promo_print")


def row_checks(columns: dict[str, str]) -> dict[str, Column]:
    """Aggregates over the dense result: rows that break a rule, and what reconciles the rest.

    Sums pass over zeros, of which most cells are, as wide decimals are dear to add; without any other cell they are NULL.
    """
    c = {name: F.col(column) for name, column in columns.items()}
    known = c["sales"].isNotNull(), c["promo"].isNotNull()
    bit = F.expr(f"shiftleft(1L, cast(pmod(unix_date({columns['day']}), {SPAN}) as int))")
    return {
        "I-1": F.count_if((~c["open"] & (known[0] | known[1])) | (c["open"] & ~(known[0] & known[1]))),
        "I-2b": F.count_if(c["open"] & ((c["promo"] < 0) | (c["sales"] < 0) | (c["promo"] > c["sales"]))),
        "I-3": F.count_if(c["is_promo"] & ~c["open"]),
        "I-6": F.count_if(c["barcode"].isNull() | has_bundle_prefix(c["barcode"])),
        "rows": F.count(F.lit(1)),
        "days": F.bit_or(bit),
        "sales_total": F.expr("sum({0}) filter (where {0} <> 0)".format(columns["sales"])),
        "promo_total": F.expr("sum({0}) filter (where {0} <> 0)".format(columns["promo"])),
        "published_print": F.bit_xor(day_print(c["day"], c["sales"])),
        "published_promo": F.bit_xor(F.when(c["promo"] != 0, day_print(c["day"], c["promo"]))),
    }


GRID_COLUMNS = {
    "day": "business_date",
    "open": "has_sales_record",
    "sales": "sales_qty",
    "promo": "promo_qty",
    "is_promo": "is_promo",
    "barcode": "attributes.barcode",
}


def result_gates(run) -> DataFrame:
    """Invariants of the dense result over the whole population, in one pass over its rows, which it does not move."""
    return _invariants(run, run.grid, GRID_COLUMNS, ["label", *PRODUCT])


def _invariants(run, rows: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    return union_all([product_gates(run.expected, by_product(rows, columns, keys)), run_gates(run.runs)])


def by_product(rows: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    """The checks of all published rows of a product; ``repeated`` counts rows beyond one for a day.

    Rows are first summed by spans of days, so one number tells which of its days are there.
    """
    span = F.floor(F.unix_date(columns["day"]) / SPAN).alias("span")
    spans = rows.groupBy(*keys, span).agg(*[value.alias(name) for name, value in row_checks(columns).items()])
    repeated = F.col("rows") - F.bit_count("days")
    sums = ["I-1", "I-2b", "I-3", "I-6", "rows", "sales_total", "promo_total"]
    return spans.groupBy(*keys).agg(
        *[F.sum(f"`{name}`").alias(name) for name in sums],
        F.sum(repeated).alias("I-5"),
        *[F.bit_xor(name).alias(name) for name in ("published_print", "published_promo")],
    )


def product_gates(expected: DataFrame, published: DataFrame) -> DataFrame:
    """Published products against what they must add up to. No dense row takes part, only one row for each product."""
    both = expected.join(published.drop("label"), PRODUCT, "full")
    rows = F.coalesce("rows", F.lit(0))
    counts = {name: F.sum(f"`{name}`") for name in ("I-1", "I-2b", "I-3", "I-5", "I-6")}
    counts |= {
        "I-2": F.count_if(~F.coalesce("sale_print", F.lit(0)).eqNullSafe(F.col("published_print"))),
        "I-4": F.count_if(~F.col("expected_rows").eqNullSafe(rows)),
        "I-8": F.count_if(_differ(F.col("sales_total"), F.col("sale_lines"))),
        "I-9": F.count_if(
            _differ(F.col("promo_total"), F.col("promo_lines"))
            | ~F.coalesce("promo_print", F.lit(0)).eqNullSafe(F.coalesce("published_promo", F.lit(0)))
        ),
    }
    seen = both.groupBy("site").agg(*[F.coalesce(value, F.lit(0)).alias(name) for name, value in counts.items()])
    return _unpivot(seen, list(counts))


def run_gates(runs: DataFrame) -> DataFrame:
    """Continuity of stock and of days. Dense rows cannot share a key while runs follow each other without overlap."""
    checked = check_runs(runs).groupBy("site").agg(
        F.count_if("stock_jumps").alias("G26"), F.count_if("is_misplaced").alias("I-5")
    )
    return _unpivot(checked, ["G26", "I-5"])


WRITTEN_COLUMNS = {
    "day": "Date",
    "open": "HasSalesRecord",
    "sales": "SalesQty",
    "promo": "PromoSalesQty",
    "is_promo": "IsPromo",
    "barcode": "Barcode",
}


def written_gates(run, written: DataFrame) -> DataFrame:
    """The same invariants on the rows that were written. Stores have different names here, or I-5 has stopped the run."""
    sites = run.identity.select("site", F.col("location_code").alias("LocationCode"))
    named = written.join(sites, "LocationCode", "left").withColumn("product", F.col("ProductCode"))
    return _invariants(run, named, WRITTEN_COLUMNS, PRODUCT)


def failures(report: DataFrame) -> list[Violation]:
    """Failed gates in run order. Collects at most one row per gate."""
    totals = report.where("violations > 0").groupBy("gate").agg(F.sum("violations").alias("n")).collect()
    return sorted((Violation(r["gate"], GATES[r["gate"]], r["n"]) for r in totals), key=lambda v: _ORDER[v.gate])


def stop_on(report: DataFrame) -> None:
    found = failures(report)
    if found:
        raise GateError(found)
