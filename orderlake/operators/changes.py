"""Write transactions as new table versions (T-N, T-P, T-D, D1-D10).

Parquet has no UPDATE: each change is a pure function (base, requests) ->
new base. All requests of a batch are applied at once. Deltas per key are
aggregated first (partial aggregation before the shuffle), so a key touched
by millions of requests still joins its base row once. Where the order of
requests matters (order numbers, stock fold, balance after each payment) a
running total per key is computed with ``skew.running_totals``, which never
holds a whole key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import STOCK_FLOOR, STOCK_REFILL, address_line, money, refilled_stock
from ..session import cut_lineage
from . import derived, stock
from .skew import running_lows, running_totals, sequence_numbers

# Districts per warehouse served by one Delivery request.
DISTRICTS_PER_WAREHOUSE = 10

# A stock as the lines name it.
STOCK_KEY = ["supply_w_id", "i_id"]

# Order numbers counted together when the head of a delivery queue is looked for.
QUEUE_RANGE = 1024


def apply_delta(base: DataFrame, delta: DataFrame, keys: list[str], updates: dict) -> DataFrame:
    """Left join of the base with per-key deltas, then the update expressions.

    ``delta`` must hold at most one row per key (aggregate first). Columns of
    ``base`` not named in ``updates`` are kept as they are; rows without a
    delta keep their values (the update expressions must use ``coalesce``).
    """
    j = base.join(delta, keys, "left")
    return j.select(*[updates[c].alias(c) if c in updates else F.col(c) for c in base.columns])


def insert_if_absent(base: DataFrame, rows: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """INSERT ... IF NOT EXISTS for a batch.

    A row is inserted if its key is absent. Of several rows with one key the
    first by ``order_by`` (default: by all columns) is tried; the later ones find
    the key taken.
    """
    cols = base.columns
    first = (rows.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*(order_by or cols))).alias("r")).select("r.*"))
    return base.unionByName(first.select(*cols).join(base.select(*keys), keys, "left_anti"))


# ------------------------------------------------------------------ Payment


def payment_customers(customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Balance down, year-to-date payment and payment count up."""
    d = (payments.groupBy(F.col("w_id").alias("c_w_id"), F.col("d_id").alias("c_d_id"), "c_id")
                 .agg(F.sum("amount").alias("__paid"), F.count(F.lit(1)).alias("__n")))
    paid = F.coalesce(F.col("__paid"), F.lit(0))
    return apply_delta(customers, d, ["c_w_id", "c_d_id", "c_id"], {
        "c_balance": (F.col("c_balance") - paid).cast("decimal(12,2)"),
        "c_ytd_payment": (F.col("c_ytd_payment") + paid).cast("decimal(14,2)"),
        "c_payment_cnt": (F.col("c_payment_cnt") + F.coalesce(F.col("__n"), F.lit(0))).cast("int"),
    })


def payment_districts(districts: DataFrame, payments: DataFrame) -> DataFrame:
    d = (payments.groupBy(F.col("w_id").alias("d_w_id"), "d_id")
                 .agg(F.sum("amount").alias("__paid")))
    return apply_delta(districts, d, ["d_w_id", "d_id"], {
        "d_ytd": (F.col("d_ytd") + F.coalesce(F.col("__paid"), F.lit(0))).cast("decimal(12,2)")})


def payment_warehouses(warehouses: DataFrame, payments: DataFrame) -> DataFrame:
    d = payments.groupBy("w_id").agg(F.sum("amount").alias("__paid"))
    return apply_delta(warehouses, d, ["w_id"], {
        "w_ytd": (F.col("w_ytd") + F.coalesce(F.col("__paid"), F.lit(0))).cast("decimal(12,2)")})


def payment_receipts(payments: DataFrame, customers: DataFrame, districts: DataFrame,
                     warehouses: DataFrame) -> DataFrame:
    """One receipt per payment with the balance right after it.

    balance_after = c_balance - (sum of the customer's payments up to and
    including this one, in request order).
    """
    run = running_totals(payments.select("seq", "w_id", "d_id", "c_id", "amount"),
                         ["w_id", "d_id", "c_id"], ["seq"], {"__paid_so_far": F.col("amount")})
    c = customers.select(F.col("c_w_id").alias("w_id"), F.col("c_d_id").alias("d_id"), "c_id",
                         "c_first", "c_middle", "c_last", "c_credit", "c_discount", "c_balance")
    d = districts.select(F.col("d_w_id").alias("w_id"), "d_id", address_line("d").alias("d_address"))
    w = warehouses.select("w_id", address_line("w").alias("w_address"))
    j = (run.join(c, ["w_id", "d_id", "c_id"], "inner")
            .join(d, ["w_id", "d_id"], "inner").join(w, "w_id", "inner"))
    return j.select("seq", "w_id", "d_id", "c_id", "amount", "c_first", "c_middle", "c_last",
                    "c_credit", "c_discount",
                    (F.col("c_balance") - F.col("__paid_so_far")).cast("decimal(18,2)").alias("balance_after"),
                    "w_address", "d_address")


# ----------------------------------------------------------------- Delivery


def oldest_undelivered(orders: DataFrame) -> DataFrame:
    """Oldest undelivered order of every district (A3, W6): a grouped min."""
    u = derived.undelivered_orders(orders)
    return (u.groupBy(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"))
             .agg(F.min("o_id").alias("o_id"), F.min_by("o_c_id", "o_id").alias("c_id")))


def oldest_in_queue(orders: DataFrame, wanted: DataFrame, width: int = QUEUE_RANGE) -> DataFrame:
    """(w_id, d_id, k, o_id, c_id): the ``most`` oldest undelivered orders of each district in ``wanted`` (w_id, d_id, most).

    The backlog is counted by (district, range of ``width`` order numbers); the
    counts tell which ranges hold the first ``most``, and only the orders of
    those are fetched and numbered: at most ``most`` + ``width`` a district,
    however long the queue is.
    """
    u = derived.undelivered_orders(orders).select(
        F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), "o_id", F.col("o_c_id").alias("c_id"),
        F.floor(F.col("o_id") / F.lit(width)).cast("long").alias("__range"))
    earlier = W.partitionBy("w_id", "d_id").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    counts = u.groupBy("w_id", "d_id", "__range").agg(F.count(F.lit(1)).alias("__n")).join(wanted, ["w_id", "d_id"])
    ranges = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).where("__before < most").drop("__n")
    here = W.partitionBy("w_id", "d_id", "__range").orderBy("o_id")
    numbered = u.join(ranges, ["w_id", "d_id", "__range"]).withColumn("k", F.col("__before") + F.row_number().over(here))
    return numbered.where("k <= most").select("w_id", "d_id", "k", "o_id", "c_id")


def _delivery_attempts(requests: DataFrame) -> DataFrame:
    """One row per request and district; ``attempt`` counts the requests of the warehouse.
    A request without a delivery time is stamped with the current time (X12)."""
    rq = sequence_numbers(requests.select("seq", "w_id", "carrier_id",
                                          F.coalesce(F.col("delivery_d"), F.localtimestamp()).alias("delivery_d")),
                          ["w_id"], ["seq"], "attempt")
    return rq.select("seq", "w_id", "carrier_id", "delivery_d", "attempt",
                     F.explode(F.sequence(F.lit(1), F.lit(DISTRICTS_PER_WAREHOUSE))).alias("d_id"))


def delivered_orders(orders: DataFrame, requests: DataFrame) -> DataFrame:
    """Orders delivered by a batch of Delivery requests.

    A request names a warehouse; it delivers the oldest undelivered order of
    each of the warehouse's districts. The k-th request of a warehouse (in
    request order) takes the k-th oldest undelivered order of each district,
    if there are so many.
    """
    rq = _delivery_attempts(requests).withColumnRenamed("attempt", "k")
    wanted = requests.groupBy("w_id").agg(F.count(F.lit(1)).alias("most")).select(
        "w_id", "most", F.explode(F.sequence(F.lit(1), F.lit(DISTRICTS_PER_WAREHOUSE))).alias("d_id"))
    return (oldest_in_queue(orders, wanted).join(rq, ["w_id", "d_id", "k"], "inner")
              .select("seq", "w_id", "d_id", "o_id", "c_id", "carrier_id", "delivery_d"))


def delivery_replay(orders: DataFrame, requests: DataFrame, arrivals: DataFrame, districts: DataFrame) -> DataFrame:
    """What each Delivery request finds in each district, when orders arrive in between.

    ``arrivals`` are the new orders (seq, o_w_id, o_d_id, o_id, o_c_id) of the same
    script, ``orders`` and ``districts`` the tables before it. A request sees the orders
    before it in ``seq``; where a district has none left it takes nothing, and
    uses up nothing of what comes later.

    A row per request and district: seq, w_id, d_id, o_id, c_id (NULL if there was
    nothing), carrier_id, delivery_d.

    With B orders at the start, arrivals +1 and requests -1, a running sum S and its least
    value so far L, max(0, -(B + L)) requests have found nothing yet. So a request
    is served if it doesn't raise that number, and the order it takes is the one at the place
    (requests so far - those that found nothing) of the queue: the backlog first,
    then the arrivals by number. S and L come from ``running_lows``: no district is
    replayed by one task, and of the backlog only what is taken is numbered.
    """
    tries = _delivery_attempts(requests)
    events = (tries.withColumns({"step": F.lit(-1), "turn": F.lit(1)})
              .unionByName(arrivals.select("seq", F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), F.lit(1).alias("step"),
                                           F.lit(0).alias("turn")), allowMissingColumns=True))
    backlog = (derived.undelivered_orders(orders).groupBy(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"))
               .agg(F.count(F.lit(1)).alias("waiting")))
    scanned = running_lows(events, ["w_id", "d_id"], ["seq", "turn"], F.col("step")).where("step = -1")
    waiting = F.coalesce(F.col("waiting"), F.lit(0))
    idle = lambda low: F.greatest(F.lit(0), -(waiting + F.col(low)))
    served = F.when(idle("low") == idle("low_before"), F.col("attempt") - idle("low"))
    tried = cut_lineage(scanned.join(backlog, ["w_id", "d_id"], "left").select(
        "seq", "w_id", "d_id", "carrier_id", "delivery_d", waiting.alias("waiting"), served.alias("k")), "delivery-attempts")
    wanted = tried.where("k <= waiting").groupBy("w_id", "d_id").agg(F.max("k").alias("most"))
    first = districts.select(F.col("d_w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), "d_next_o_id")
    came = (arrivals.join(first, ["o_w_id", "o_d_id"]).join(backlog.withColumnsRenamed({"w_id": "o_w_id", "d_id": "o_d_id"}), ["o_w_id", "o_d_id"], "left")
            .select(F.col("o_w_id").alias("w_id"), F.col("o_d_id").alias("d_id"), (waiting + F.col("o_id") - F.col("d_next_o_id") + 1).alias("k"), "o_id",
                    F.col("o_c_id").alias("c_id")))
    queue = oldest_in_queue(orders, wanted).unionByName(came)
    return tried.join(queue, ["w_id", "d_id", "k"], "left").select("seq", "w_id", "d_id", "o_id", "c_id", "carrier_id", "delivery_d")


def deliver_orders(orders: DataFrame, delivered: DataFrame) -> DataFrame:
    d = delivered.select(F.col("w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), "o_id",
                         F.col("carrier_id").alias("__carrier"))
    return apply_delta(orders, d, ["o_w_id", "o_d_id", "o_id"], {
        "o_carrier_id": F.coalesce(F.col("__carrier"), F.col("o_carrier_id"))})


def deliver_lines(order_lines: DataFrame, delivered: DataFrame) -> DataFrame:
    d = delivered.select(F.col("w_id").alias("ol_w_id"), F.col("d_id").alias("ol_d_id"),
                         F.col("o_id").alias("ol_o_id"), F.col("delivery_d").alias("__dd"))
    return apply_delta(order_lines, d, ["ol_w_id", "ol_d_id", "ol_o_id"], {
        "ol_delivery_d": F.coalesce(F.col("__dd"), F.col("ol_delivery_d"))})


def deliver_customers(customers: DataFrame, order_lines: DataFrame, delivered: DataFrame) -> DataFrame:
    """Balance up by the delivered orders' amounts; delivery count up by one
    per delivered order (D5, V8)."""
    dk = delivered.select("w_id", "d_id", "o_id", "c_id")
    # Only the delivered orders' lines are read and summed (semi join first).
    keys = dk.select(F.col("w_id").alias("ol_w_id"), F.col("d_id").alias("ol_d_id"),
                     F.col("o_id").alias("ol_o_id"))
    lines = order_lines.join(keys, ["ol_w_id", "ol_d_id", "ol_o_id"], "left_semi")
    amounts = derived.order_amounts(lines).select("w_id", "d_id", "o_id", "amount")
    per_order = dk.join(amounts, ["w_id", "d_id", "o_id"], "left")
    d = (per_order.groupBy(F.col("w_id").alias("c_w_id"), F.col("d_id").alias("c_d_id"), "c_id")
                  .agg(F.sum(F.coalesce(F.col("amount"), F.lit(0))).alias("__amt"),
                       F.count(F.lit(1)).alias("__n")))
    return apply_delta(customers, d, ["c_w_id", "c_d_id", "c_id"], {
        "c_balance": (F.col("c_balance") + F.coalesce(F.col("__amt"), F.lit(0))).cast("decimal(12,2)"),
        "c_delivery_cnt": (F.col("c_delivery_cnt") + F.coalesce(F.col("__n"), F.lit(0))).cast("int"),
    })


def deliver_remaining_queue(orders: DataFrame, delivered: DataFrame) -> DataFrame:
    """Undelivered queue after the batch (D6): an anti join."""
    u = derived.undelivered_orders(orders)
    d = delivered.select(F.col("w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), "o_id")
    return u.join(d, ["o_w_id", "o_d_id", "o_id"], "left_anti")


# ---------------------------------------------------------------- New-Order


def new_order_checked_lines(line_requests: DataFrame, requests: DataFrame, items: DataFrame,
                            stocks: DataFrame, with_dist: bool = False) -> DataFrame:
    """Every requested line with its order, item price and starting stock.

    ``accepted`` is False when the item or the supplying stock row is missing
    (V15): such lines are reported, the rest of the order goes ahead. With
    ``with_dist`` the stock row's district info for the order's district is
    carried as ``s_dist`` (V17).
    """
    r = requests.select("seq", "w_id", "d_id", "c_id")
    it = items.select(F.col("i_id"), "i_name", "i_price", F.lit(True).alias("__item"))
    extra = ([F.array(*[F.col(f"s_dist_{k:02d}") for k in range(1, 11)]).alias("__dists")]
             if with_dist else [])
    st = stocks.select(F.col("s_w_id").alias("supply_w_id"), F.col("s_i_id").alias("i_id"),
                       F.col("s_quantity").alias("q0"), *extra)
    j = (line_requests.join(r, "seq", "inner")
         .join(it, "i_id", "left")
         .join(st, ["supply_w_id", "i_id"], "left"))
    j = j.withColumn("accepted", F.col("__item").isNotNull() & F.col("q0").isNotNull()).drop("__item")
    if with_dist:
        j = j.withColumn("s_dist", F.try_element_at("__dists", F.col("d_id"))).drop("__dists")
    return j


def new_order_headers(requests: DataFrame, line_requests: DataFrame, districts: DataFrame,
                      items: DataFrame, stocks: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """New orders with their numbers (W3, A16, A22, V5). ``checked``: the checked lines, if they are at hand.

    o_id = d_next_o_id + (rank of the request in its district) - 1; the rank
    comes from ``sequence_numbers``. o_ol_cnt counts accepted lines;
    o_all_local is 1 when every accepted line is supplied by the home
    warehouse.
    """
    if checked is None:
        checked = new_order_checked_lines(line_requests, requests, items, stocks)
    lines = checked.filter("accepted")
    per = (lines.groupBy("seq")
           .agg(F.count(F.lit(1)).alias("n_lines"),
                F.min((F.col("supply_w_id") == F.col("w_id")).cast("int")).alias("all_local"),
                F.sum("quantity").alias("total_quantity")))
    rn = sequence_numbers(requests.select("seq", "w_id", "d_id", "c_id", "entry_d"),
                          ["w_id", "d_id"], ["seq"], "rn")
    d = districts.select(F.col("d_w_id").alias("w_id"), "d_id", "d_next_o_id")
    j = rn.join(d, ["w_id", "d_id"], "inner").join(per, "seq", "left")
    return j.select(
        "seq",
        F.col("w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"),
        (F.col("d_next_o_id") + F.col("rn") - 1).cast("int").alias("o_id"),
        F.col("c_id").alias("o_c_id"),
        F.lit(None).cast("int").alias("o_carrier_id"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("o_ol_cnt"),
        F.coalesce(F.col("all_local"), F.lit(1)).cast("int").alias("o_all_local"),
        F.col("entry_d").alias("o_entry_d"),
        F.coalesce(F.col("total_quantity"), F.lit(0)).cast("long").alias("total_quantity"))


def new_order_lines(headers: DataFrame, line_requests: DataFrame, requests: DataFrame,
                    items: DataFrame, stocks: DataFrame, dist_info: str = "literal",
                    checked: DataFrame | None = None) -> DataFrame:
    """The order lines inserted by the batch.

    ``dist_info='literal'`` writes ``S_DIST_<d>`` (V17, the reference's
    behaviour); ``'stock'`` reads the supplying stock row's s_dist_<d>.
    """
    by_stock = dist_info == "stock"
    if checked is None or by_stock:
        checked = new_order_checked_lines(line_requests, requests, items, stocks, with_dist=by_stock)
    lines = checked.filter("accepted")
    dist = F.col("s_dist") if by_stock else F.concat(F.lit("S_DIST_"), F.col("d_id").cast("string"))
    h = headers.select("seq", "o_id")
    j = lines.join(h, "seq", "inner")
    return j.select(
        F.col("w_id").alias("ol_w_id"), F.col("d_id").alias("ol_d_id"), F.col("o_id").alias("ol_o_id"),
        F.col("line_no").alias("ol_number"), F.col("i_id").alias("ol_i_id"),
        F.lit(None).cast("timestamp_ntz").alias("ol_delivery_d"),
        (F.col("quantity") * F.col("i_price")).cast("decimal(12,2)").alias("ol_amount"),
        F.col("supply_w_id").alias("ol_supply_w_id"),
        F.col("quantity").alias("ol_quantity"),
        dist.alias("ol_dist_info"))


def _beyond_sums(checked: DataFrame) -> DataFrame | None:
    """Accepted lines of the stocks for which sums don't tell the result: a stock below the floor, or a
    quantity below 0 or above the refill. None if there are none. ``checked`` is a written table."""
    lines = checked.filter("accepted")
    odd = (F.col("q0") < STOCK_FLOOR) | (F.col("quantity") < 0) | (F.col("quantity") > STOCK_REFILL)
    if not lines.filter(odd).limit(1).count():
        return None
    return lines.join(lines.filter(odd).select(*STOCK_KEY).distinct(), STOCK_KEY, "left_semi")


def stock_changes(checked: DataFrame) -> DataFrame:
    """Per stock that accepted lines touch: ``used``, ``n`` lines, ``remote`` ones and the final ``quantity``.

    The final quantity follows from the sum (closed form of the refill fold) where stocks start at the
    floor or above and quantities lie between 0 and the refill; the lines of
    all other stocks are composed in order (``stock.final_stock``). ``checked`` is a written table.
    """
    d = (checked.filter("accepted").groupBy(F.col("supply_w_id").alias("s_w_id"), F.col("i_id").alias("s_i_id"))
         .agg(F.sum("quantity").alias("used"), F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("supply_w_id") != F.col("w_id"), 1).otherwise(0)).alias("remote"), F.min("q0").alias("__q0")))
    quantity = refilled_stock("__q0", "used")
    odd = _beyond_sums(checked)
    if odd is not None:
        final = stock.final_stock(odd, STOCK_KEY, ["seq", "line_no"], out="__final")
        d = d.join(final.withColumnsRenamed({"supply_w_id": "s_w_id", "i_id": "s_i_id"}), ["s_w_id", "s_i_id"], "left")
        quantity = F.coalesce("__final", quantity)
    return d.select("s_w_id", "s_i_id", "used", "n", "remote", quantity.alias("quantity"))


def new_order_stock(stocks: DataFrame, line_requests: DataFrame, requests: DataFrame,
                    items: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """Stock table after the batch (W4, X3, X4): per (warehouse, item) what
    ``stock_changes`` sums up; ``checked``: the checked lines as a written table, if they are at hand."""
    if checked is None:
        checked = cut_lineage(new_order_checked_lines(line_requests, requests, items, stocks), "new-order-checked")
    d = stock_changes(checked).withColumnsRenamed({"used": "__used", "n": "__n", "remote": "__remote", "quantity": "__quantity"})
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return apply_delta(stocks, d, ["s_w_id", "s_i_id"], {
        "s_quantity": F.coalesce("__quantity", "s_quantity"),
        "s_ytd": (F.col("s_ytd") + more("__used")).cast("decimal(12,2)"),
        "s_order_cnt": (F.col("s_order_cnt") + more("__n")).cast("int"),
        "s_remote_cnt": (F.col("s_remote_cnt") + more("__remote")).cast("int"),
    })


def new_order_stock_trace(line_requests: DataFrame, requests: DataFrame, items: DataFrame,
                          stocks: DataFrame) -> DataFrame:
    """Stock quantity after each accepted line, in request order (W4 trace).

    A running sum per (warehouse, item) over (seq, line_no) feeds the closed
    form, so no sequential loop is needed; stocks beyond its domain are composed
    line by line, range by range (``stock.stock_trace``).
    """
    checked = cut_lineage(new_order_checked_lines(line_requests, requests, items, stocks), "new-order-checked")
    lines = checked.filter("accepted").select("seq", "line_no", *STOCK_KEY, "quantity", "q0")
    odd = _beyond_sums(checked)
    plain = lines if odd is None else lines.join(odd.select(*STOCK_KEY).distinct(), STOCK_KEY, "left_anti")
    run = running_totals(plain, STOCK_KEY, ["seq", "line_no"], {"__used": F.col("quantity")})
    out = run.select("seq", "line_no", *STOCK_KEY, "quantity", refilled_stock("q0", "__used").alias("s_quantity_after"))
    if odd is not None:
        out = out.unionByName(stock.stock_trace(odd, STOCK_KEY, ["seq", "line_no"]))
    return out.withColumnsRenamed({"supply_w_id": "s_w_id", "i_id": "s_i_id"})


def new_order_districts(districts: DataFrame, requests: DataFrame) -> DataFrame:
    """d_next_o_id advanced by the number of new orders of each district."""
    d = requests.groupBy(F.col("w_id").alias("d_w_id"), "d_id").agg(F.count(F.lit(1)).alias("__n"))
    return apply_delta(districts, d, ["d_w_id", "d_id"], {
        "d_next_o_id": (F.col("d_next_o_id") + F.coalesce(F.col("__n"), F.lit(0))).cast("int")})


def new_order_totals(headers: DataFrame, new_lines: DataFrame, warehouses: DataFrame,
                     districts: DataFrame, customers: DataFrame) -> DataFrame:
    """Order total = sum(amount) * (1 + w_tax + d_tax) * (1 - c_discount),
    rounded half-even to cents once (A10, V6, X1, X2)."""
    amt = (new_lines.groupBy(F.col("ol_w_id").alias("o_w_id"), F.col("ol_d_id").alias("o_d_id"),
                             F.col("ol_o_id").alias("o_id"))
                    .agg(F.sum("ol_amount").cast("decimal(18,2)").alias("amount")))
    h = headers.select("seq", "o_w_id", "o_d_id", "o_id", "o_c_id")
    w = warehouses.select(F.col("w_id").alias("o_w_id"), "w_tax")
    d = districts.select(F.col("d_w_id").alias("o_w_id"), F.col("d_id").alias("o_d_id"), "d_tax")
    c = customers.select(F.col("c_w_id").alias("o_w_id"), F.col("c_d_id").alias("o_d_id"),
                         F.col("c_id").alias("o_c_id"), "c_discount")
    j = (h.join(amt, ["o_w_id", "o_d_id", "o_id"], "left").join(w, "o_w_id", "inner")
          .join(d, ["o_w_id", "o_d_id"], "inner").join(c, ["o_w_id", "o_d_id", "o_c_id"], "inner"))
    amount = F.coalesce(F.col("amount"), F.lit(0).cast("decimal(18,2)"))
    # Fixed-width factors keep the product exact (no precision-loss rescale).
    tax = (F.lit(1) + F.col("w_tax") + F.col("d_tax")).cast("decimal(6,4)")
    keep = (F.lit(1) - F.col("c_discount")).cast("decimal(6,4)")
    total = amount * tax * keep
    return j.select("seq", "o_w_id", "o_d_id", "o_id", "o_c_id", amount.alias("amount"),
                    money(total).alias("total_amount"))


def new_order_popular_lines(headers: DataFrame, new_lines: DataFrame, items: DataFrame) -> DataFrame:
    """Popular lines of the new orders (D10): max quantity, ties kept."""
    pl = derived.popular_lines(new_lines, "max")
    it = items.select(F.col("i_id").alias("ol_i_id"), "i_name")
    h = headers.select("seq", F.col("o_w_id").alias("ol_w_id"), F.col("o_d_id").alias("ol_d_id"),
                       F.col("o_id").alias("ol_o_id"))
    return (pl.join(h, ["ol_w_id", "ol_d_id", "ol_o_id"], "inner").join(it, "ol_i_id", "inner")
              .select("seq", "ol_w_id", "ol_d_id", "ol_o_id", "ol_number", "ol_i_id", "i_name",
                      "ol_quantity"))


# ------------------------------------------------------------- whole batch


def apply_batch(tables: dict, payments: DataFrame, new_orders: DataFrame, new_lines: DataFrame,
                deliveries: DataFrame, in_order: bool = False) -> dict:
    """Apply one batch of requests and return the new version of every table.

    Payments add up with everything else, so their place doesn't matter. With
    ``in_order`` a delivery sees the new orders before it in ``seq``, which all
    requests share (``delivery_replay``); without, new orders come first and
    deliveries see them all.

    The checked lines feed headers, lines and stock, the inserted rows and the
    deliveries several steps each: these are written once as parquet tables
    in the shared checkpoint folder (lineage cut, no plan is run twice, and a
    lost executor does not replay the batch); the base rows are already stored.
    """
    wh = payment_warehouses(tables["warehouses"], payments)
    di = payment_districts(tables["districts"], payments)
    cu = payment_customers(tables["customers"], payments)
    items, stocks = tables["items"], tables["stocks"]
    checked = cut_lineage(new_order_checked_lines(new_lines, new_orders, items, stocks), "new-order-checked")
    h = cut_lineage(new_order_headers(new_orders, new_lines, tables["districts"], items, stocks, checked=checked), "new-orders")
    nl = cut_lineage(new_order_lines(h, new_lines, new_orders, items, stocks, checked=checked), "new-order-lines")
    st = new_order_stock(stocks, new_lines, new_orders, items, checked=checked)
    di = new_order_districts(di, new_orders)
    orders = tables["orders"].unionByName(h.select(*tables["orders"].columns))
    lines = tables["order_lines"].unionByName(nl)
    if in_order:
        dl = delivery_replay(tables["orders"], deliveries, h, tables["districts"]).where("o_id is not null")
    else:
        dl = delivered_orders(orders, deliveries)
    dl = cut_lineage(dl, "delivered")
    return {
        "warehouses": wh,
        "districts": di,
        "customers": deliver_customers(cu, lines, dl),
        "orders": deliver_orders(orders, dl),
        "order_lines": deliver_lines(lines, dl),
        "items": items,
        "stocks": st,
    }
