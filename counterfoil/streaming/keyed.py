"""What a change stream remembers of each product, in Spark's state store."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from counterfoil.functions import stock_fold
from counterfoil.functions.stock_fold import BAD_OP, NO_KEY, NO_ORDER, NO_PRODUCT, decide_one

# Sent to the Python workers with the job, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(stock_fold)

LATE = "Late change"
#: The operation of an event that sets a price.
SET_PRICE = "price"

#: One row per event: what became of it, and what it does to stock, lines and prices.
LOG = (
    "op string, seq long, order_id long, product_id long, quantity int, price decimal(6,2), ts timestamp, "
    "accepted boolean, reason string, old_quantity int, delta int, unit_price decimal(6,2), old_price decimal(6,2)"
)
_FIELDS = [field.split()[0] for field in LOG.replace("decimal(6,2)", "decimal").split(", ")]


class ProductState(StatefulProcessor):
    """Last price, stock left and last number of a product as values; the lines that changes touched as a map.

    A product without state begins with the price and stock that its events bring along.

    Events of a micro-batch are taken in the order of their numbers; one that is not above the last number of an earlier
    batch is late. In memory are the events of one product in one micro-batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.product = handle.getValueState("product", "price decimal(6,2), stock int, last_seq long, known boolean")
        self.lines = handle.getMapState("lines", "order_id long", "quantity int, unit_price decimal(6,2)")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events = sorted(rows, key=lambda r: (r.seq is not None, r.seq or 0))
        begun = (events[0].start_price, events[0].start_stock, None, bool(events[0].known_product))
        stored = self.product.get()
        price, stock, last_seq, known = stored or begun
        lines, touched, newest = {}, set(), last_seq
        for event in events:
            op, order = event.op, event.order_id
            out = dict.fromkeys(_FIELDS) | {
                "op": op, "seq": event.seq, "order_id": order, "product_id": event.product_id,
                "quantity": event.quantity, "price": event.price, "ts": event.ts,
            }
            is_line = op in ("insert", "update", "delete")
            if event.seq is not None and event.product_id is not None and last_seq is not None and event.seq <= last_seq:
                reason = LATE
            elif event.seq is None or event.product_id is None or (order is None and op != SET_PRICE):
                reason = NO_KEY
            elif not is_line and op != SET_PRICE:
                reason = BAD_OP
            else:
                newest = event.seq if newest is None else max(newest, event.seq)
                reason = None
                if op == SET_PRICE or op == "insert":
                    reason = NO_PRODUCT if not known else None
                if op == "insert" and not event.known_order:
                    reason = NO_ORDER
                if reason is None and op == SET_PRICE:
                    out["old_price"], price = price, event.price
                elif reason is None:
                    if order not in lines:
                        held = (event.held, event.held_price) if event.has_line else (None, None)
                        # Lines are kept only with the product, so a product without state has none to ask for.
                        lines[order] = (self.lines.getValue((order,)) if stored else None) or held
                    old, unit_price = lines[order]
                    reason, used = decide_one(op, event.quantity, event.moved, old, stock)
                    out["old_quantity"] = old
                    if reason is None:
                        unit_price = price if op == "insert" else unit_price
                        lines[order] = (None, None) if op == "delete" else (event.quantity, unit_price)
                        touched.add(order)
                        stock = None if stock is None else stock - used
                        out |= {"delta": used, "unit_price": unit_price}
            yield Row(**out | {"accepted": reason is None, "reason": reason})
        for order in touched:
            self.lines.updateValue((order,), lines[order])
        if newest != last_seq:
            self.product.update((price, stock, newest, known))
