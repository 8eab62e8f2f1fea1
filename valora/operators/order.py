"""Row orders as one fixed-width number.

An aggregate that keeps a value by its row's order can update its buffers in place, and so combine in a hash table without sorting rows first, only while
they are of fixed width. An order of several columns is therefore packed into one number: every column takes the bits of its type (or those given),
and one more where it may be null, nulls first; up to 63 bits are a LONG and up to 126 a DECIMAL(38). Orders that do not fit, and texts, stay structs: right, but
sorted before they are combined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WORD = 63
_WIDTHS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


@dataclass(frozen=True)
class Bits:
    """A column of whole numbers from 0 to ``2 ** bits - 1``; any other number is an error, never a wrong order."""

    column: str
    bits: int


OrderColumn = str | Column | Bits


def order_column(c: OrderColumn) -> Column:
    return F.col(c.column) if isinstance(c, Bits) else F.col(c) if isinstance(c, str) else c


def order_struct(order_cols: Sequence[OrderColumn]) -> Column:
    return F.struct(*[order_column(c) for c in order_cols])


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _guess(size: Column) -> Column:
    return F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)))).cast("int")


def _exponent(size: Column, guess: Column) -> Column:
    """The logarithm may be rounded over a whole number."""
    low, high = (_power(guess) > size) & (guess > -1022), (_power(guess) * 2 <= size) & (guess < 1023)
    return guess - low.cast("int") + high.cast("int")


def _bits(x: Column, size: Column, exponent: Column) -> Column:
    bits = (exponent + 1023).cast("long") * F.lit(2**52) + ((size / _power(exponent) - 1) * float(2**52)).cast("long")
    top = F.lit(2047 * 2**52)
    whole = F.when(F.isnan(size), top + 1).when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), top).otherwise(bits)
    return whole * F.when(x < 0, -1).otherwise(1)


def with_ordered_bits(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add LONGs that grow with doubles: exponent and mantissa as one number, with the double's sign. Both zeros are equal, NaN is the greatest.

    Step by step, as each one uses the one before more than once and would repeat it.
    """
    names = list(columns)
    size = lambda n: F.abs(F.col(n))
    steps = [{n: c.cast("double") for n, c in columns.items()}, {f"{n}_guess": _guess(size(n)) for n in names},
             {f"{n}_exponent": _exponent(size(n), F.col(f"{n}_guess")) for n in names}, {n: _bits(F.col(n), size(n), F.col(f"{n}_exponent")) for n in names}]
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*[f"{n}_{helper}" for n in names for helper in ("guess", "exponent")])


def _part(df: DataFrame, c: OrderColumn) -> list[tuple[Column, int]] | None:
    """The column as whole numbers of so many bits each, the first one the highest; None for what has no fixed width."""
    column = order_column(c)
    field = df.select(column).schema[0]
    kind = field.dataType
    if isinstance(c, Bits):
        inside = (column >= 0) & (column < 2**c.bits)
        value, bits = F.when(column.isNull() | inside, column.cast("long")).otherwise(
            F.raise_error(F.concat(F.lit(f"{c.column} has no {c.bits} bits: "), column.cast("string"))).cast("long")), c.bits
    elif isinstance(kind, T.BooleanType):
        value, bits = column.cast("int").cast("long"), 1
    elif type(kind) in _WIDTHS and _WIDTHS[type(kind)] < 64:
        bits = _WIDTHS[type(kind)]
        value = column.cast("long") + 2 ** (bits - 1)
    elif isinstance(kind, T.DateType):
        value, bits = F.unix_date(column).cast("long") + 2**31, 32
    elif isinstance(kind, (T.LongType, T.TimestampType)):
        value, bits = column if isinstance(kind, T.LongType) else F.unix_micros(column), 64
    else:
        return None
    value = F.coalesce(value, F.lit(0).cast("long"))
    known = [(column.isNotNull().cast("int").cast("long"), 1)] if field.nullable else []
    if bits < 64:
        return [*known, (value, bits)]
    return [*known, (F.shiftright(value, 32) + 2**31, 32), (value.bitwiseAND(F.lit(2**32 - 1)), 32)]


def with_row_orders(df: DataFrame, orders: dict[str, Sequence[OrderColumn]]) -> DataFrame:
    """Add the order of rows by some columns as one number where they fit, else as a struct; ``orders`` has the columns by the name of the result."""
    doubles, plain = {}, {}
    for name, columns in orders.items():
        plain[name] = list(columns)
        for i, c in enumerate(columns):
            if isinstance(df.select(order_column(c)).schema[0].dataType, (T.DoubleType, T.FloatType)):
                doubles[f"{name}_{i}"] = order_column(c)
                plain[name][i] = f"{name}_{i}"
    numbered = with_ordered_bits(df, doubles) if doubles else df
    return numbered.withColumns({name: row_order(numbered, columns) for name, columns in plain.items()}).drop(*doubles)


def row_order(df: DataFrame, order_cols: Sequence[OrderColumn]) -> Column:
    """The order of rows by whole numbers, days and times as one number where they fit, else as a struct; for doubles see ``with_row_orders``."""
    parts = [_part(df, c) for c in order_cols]
    if any(p is None for p in parts) or not parts:
        return order_struct(order_cols)
    flat = [x for p in parts for x in p]
    total = sum(bits for _, bits in flat)
    if total > 2 * _WORD:
        return order_struct(order_cols)
    # Two words of 63 bits, filled from the highest bit by shifts; a number that meets the border is cut there.
    words, room = [F.lit(0).cast("long")], _WORD if total <= _WORD else total - _WORD
    for value, bits in flat:
        if bits > room:
            below = bits - room
            words[-1] = F.shiftleft(words[-1], room).bitwiseOR(F.shiftright(value, below))
            words.append(value.bitwiseAND(F.lit(2**below - 1)))
            room = _WORD - below
        else:
            words[-1] = F.shiftleft(words[-1], bits).bitwiseOR(value)
            room -= bits
    if len(words) == 1:
        return words[0]
    return (words[0].cast("decimal(38,0)") * F.lit(str(2**_WORD)).cast("decimal(20,0)") + words[1].cast("decimal(20,0)")).cast("decimal(38,0)")


def is_fixed_width(kind: T.DataType) -> bool:
    """Whether an aggregate's buffer of that type can be updated in place."""
    return isinstance(kind, (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
