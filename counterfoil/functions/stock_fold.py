"""The row-by-row stock guard: the changes of each product, in order."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

# Sent to the Python workers with the job, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The two messages callers already know.
NOT_ENOUGH = "Not enough product quantity available"
KEY_CHANGE = "Cannot change product_id or order_id in Orderline"

ALREADY_THERE = "Line already exists"
NO_LINE = "No such line"
NO_ORDER = "No such order"
NO_PRODUCT = "No such product"
BAD_OP = "Unknown operation"
NO_KEY = "Change without order, product or sequence number"

# What the fold adds to the columns of a change, and what it reads of them.
FOLDED = "accepted boolean, reason string, old_quantity int, was_born boolean"
_ADDED = [field.split()[0] for field in FOLDED.split(", ")]
_KINDS = (pa.bool_(), pa.string(), pa.int32(), pa.bool_())
_READ = ("product_id", "_block", "available", "op", "order_id", "quantity", "moved", "has_line", "held", "born")

# What a block of changes leaves, as bounds: a row for its stock (``order_id`` NULL) and one for each line whose state it may
# have changed. Stock s at the start is at most max(s - least, cap) and at least max(s - most, floor) at the end.
ENDS = (
    "product_id long, _block long, order_id long, least long, cap long, most long, floor long, "
    "low long, high long, certain boolean, possible boolean, born boolean"
)
#: Below all stock there is.
NOTHING = -(1 << 60)
_BOUNDED = (
    "product_id", "_block", "left_low", "left_high", "op", "order_id", "quantity", "moved",
    "certain", "possible", "line_low", "line_high", "line_born",
)


def decide_one(op: str, quantity: int, moved: bool, old: int | None, left: int | None) -> tuple[str | None, int]:
    """Why a change is refused, if it is, and the stock it takes. ``old`` is the line's quantity, None without a line."""
    if op == "insert":
        if old is not None:
            return ALREADY_THERE, 0
        used = quantity
    elif old is None:
        return NO_LINE, 0
    elif op == "delete":
        return None, -old
    elif moved:
        return KEY_CHANGE, 0
    else:
        used = quantity - old
    return (NOT_ENOUGH if left is not None and used > 0 and used > left else None), used


def plain(column: pa.Array) -> list:
    """The values as Python ones; those without gaps by way of numpy and few different texts by their codes, not one by one."""
    if column.null_count:
        return column.to_pylist()
    if pa.types.is_string(column.type):
        coded = column.dictionary_encode()
        texts = coded.dictionary.to_pylist()
        return [texts[code] for code in coded.indices.to_numpy().tolist()]
    return column.to_numpy(zero_copy_only=False).tolist()


def fold_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk changes that come ordered by product, block and sequence number.

    In hand are the stock and the touched lines of the present block only; its rows say what both are at its start.
    """
    key, left, lines = None, None, {}
    for batch in batches:
        out = []
        for id_, block, available, op, order, quantity, moved, has_line, held, born in zip(
            *(plain(batch.column(name)) for name in _READ)
        ):
            if (id_, block) != key:
                key, left, lines = (id_, block), available, {}
            line = lines.setdefault(order, (held, born) if has_line else None)
            old, was_born = line or (None, False)
            reason, used = decide_one(op, quantity, moved, old, left)
            if reason is None:
                lines[order] = None if op == "delete" else (quantity, was_born or op == "insert")
                left = None if left is None else left - used
            out.append((reason is None, reason, old, was_born))
        added = [pa.array(values, kind) for values, kind in zip(zip(*out), _KINDS)] if out else [
            pa.array([], kind) for kind in _KINDS
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *_ADDED])


class Bounds:
    """Stock and lines of a block of changes, known within bounds.

    A line is (certain, possible, low, high, born): whether it is certainly there, whether it may be, its quantity if it
    is, and whether these changes put it there (None: not known). After each change the bounds hold what any stock and
    lines within the bounds before it lead to.

    A change that may take q either does, or finds less than q: stock s becomes at most max(s - q, q - 1), and never less
    than the floor. Such steps make one of the same form, so a block has an upper step (least, cap) and a lower one (most,
    floor), which hold for any start within its bounds.
    """

    def __init__(self, product: int, block: int, low: int, high: int):
        self.product, self.block, self.start = product, block, (low, high)
        self.least, self.cap = 0, NOTHING
        # Only a product that starts below nothing is ever there.
        self.most, self.ground = 0, min(low, 0)
        self.floor = self.ground
        self.lines: dict[int, tuple] = {}
        self.changed: set[int] = set()

    @property
    def low(self) -> int:
        return max(self.start[0] - self.most, self.floor)

    @property
    def high(self) -> int:
        return max(self.start[1] - self.least, self.cap)

    def _fall(self, least: int, most: int, cap: int = NOTHING) -> None:
        """Stock falls by ``least`` to ``most``, or is at most ``cap`` and then falls by no more than that."""
        self.least, self.cap = self.least + least, max(self.cap - least, cap)
        self.most, self.floor = self.most + most, max(self.floor - most, self.ground)

    def _set(self, order: int, *line) -> None:
        self.lines[order] = line
        self.changed.add(order)

    def apply(self, op: str, order: int, q: int, moved: bool, start: tuple) -> None:
        certain, possible, low, high, born = self.lines.setdefault(order, start)
        if op == "delete":
            if possible:
                self._fall(-high, -low if certain else 0)
                self._set(order, False, False, 0, 0, False)
        elif op == "insert":
            if certain or q > self.high:
                return
            fits = q <= self.low
            if possible:  # or it is there already, and nothing changes
                self._fall(0, q)
                self._set(order, fits, True, min(low, q), max(high, q), None)
            else:
                self._fall(q, q, NOTHING if fits else q - 1)
                self._set(order, fits, True, q, q, True)
        elif possible and not moved:
            fits = q <= low or q - low <= self.low
            if not fits and q > high and q - high > self.high:
                return
            if certain:
                self._fall(q - high, q - low, NOTHING if fits else q - low - 1)
            else:
                self._fall(min(0, q - high), max(0, q - low))
            self._set(order, certain, True, *((q, q) if fits else (min(low, q), max(high, q))), born)

    def ends(self) -> list[tuple]:
        mine = [(self.product, self.block, None, self.least, self.cap, self.most, self.floor, *(None,) * 5)]
        for order in self.changed:
            certain, possible, low, high, born = self.lines[order]
            mine.append((self.product, self.block, order, *(None,) * 4, low, high, certain, possible, born))
        return mine


def bound_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What blocks of changes leave, from changes that come ordered by product, block and sequence number."""
    now, ends = None, []
    kinds = (pa.int64(),) * 9 + (pa.bool_(),) * 3
    names = [field.split()[0] for field in ENDS.split(", ")]

    def written() -> pa.RecordBatch:
        columns = zip(*ends) if ends else ([] for _ in kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    for batch in batches:
        for product, block, low, high, op, order, quantity, moved, *start in zip(
            *(plain(batch.column(name)) for name in _BOUNDED)
        ):
            if now is None or (product, block) != (now.product, now.block):
                if now is not None:
                    ends += now.ends()
                now = Bounds(product, block, low, high)
            now.apply(op, order, quantity, moved, tuple(start))
        yield written()
        ends = []
    if now is not None:
        ends += now.ends()
    yield written()
