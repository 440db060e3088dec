"""Column expressions for station records.

Lines are cut on *bytes*: a slice of a binary column is constant-time, while a
string slice walks the line to count characters. All expressions are JVM
built-ins that stay inside whole-stage code generation (no lambda functions,
except in ``slot_values``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .layouts import (
    CORE_ELEMENTS,
    CORRECTED_DATASET,
    DATASET_BY_SUFFIX,
    ELEMENT_BY_SUFFIX,
    MISSING_COORDINATE,
    MISSING_READING,
    UNKNOWN_DATASET,
    UNKNOWN_ELEMENT,
    SlotLayout,
)

# fixed patterns: unsigned numbers of two and four characters (a leading plus is
# allowed), and a real number
UNSIGNED = {2: r"[+0-9][0-9]", 4: r"[+0-9][0-9]{3}"}
REAL = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"
WHITESPACE = " \t\r\n\f\x0b"


def line_bytes(line: Column) -> Column:
    return line.cast("binary")


def line_length(raw: Column) -> Column:
    """Length in bytes, not counting one trailing carriage return."""
    ends_in_cr = F.substring(raw, -1, 1) == F.lit(b"\r")
    return F.octet_length(raw) - F.when(ends_in_cr, 1).otherwise(0)


def cut(raw: Column, span: tuple[int, int]) -> Column:
    """The text at byte positions [start, end)."""
    start, end = span
    return F.substring(raw, start + 1, end - start).cast("string")


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trimmed(text), F.lit(""))


def lenient_int(text: Column) -> Column:
    """Integer or null; surrounding blanks and a sign are allowed."""
    return text.try_cast("int")


def unsigned_int(text: Column, width: int) -> Column:
    """Integer made of exactly ``width`` characters, without blanks, or null."""
    return F.when(text.rlike(f"^{UNSIGNED[width]}$"), text.try_cast("int"))


def sentinel_to_null(number: Column, sentinel: int = MISSING_READING) -> Column:
    return F.nullif(number, F.lit(sentinel))


def scaled(number: Column, scale: int) -> Column:
    """Scaled integer to a 32-bit value in physical units."""
    return (number / F.lit(float(scale))).cast("float")


def lenient_real(text: Column) -> Column:
    """32-bit real or null; the missing-coordinate sentinel is null too."""
    number = trimmed(text)
    real = F.when(number.rlike(REAL), number.try_cast("float"))
    return F.nullif(real, F.lit(MISSING_COORDINATE).cast("float"))


def slot_start(slot: Column | int, layout: SlotLayout) -> Column:
    return F.lit(layout.first_slot) + slot * F.lit(layout.slot_width)


def slot_value(raw: Column, slot: Column, length: Column, layout: SlotLayout) -> Column:
    """The value of one 0-based slot in physical units, or null."""
    start = slot_start(slot, layout)
    text = F.substring(raw, start + F.lit(1), F.lit(layout.value_width)).cast("string")
    value = scaled(sentinel_to_null(lenient_int(text)), layout.scale)
    if layout.whole_slots:
        return F.when(start + F.lit(layout.slot_width) <= length, value)
    return value


def slot_flags(raw: Column, slot: Column, length: Column, layout: SlotLayout) -> list[Column]:
    """The one-character flags behind the value of one slot, blanks as ''.

    A flag the line does not reach is blank too; ``length`` leaves out a carriage
    return.
    """
    first = slot_start(slot, layout) + F.lit(layout.value_width + 1)
    flag = [F.substring(raw, first + F.lit(i), F.lit(1)).cast("string") for i in range(len(layout.flags))]
    return [
        F.when(first + F.lit(i) <= length, F.trim(flag[i])).otherwise("").alias(name)
        for i, name in enumerate(layout.flags)
    ]


def slot_values(raw: Column, length: Column, layout: SlotLayout) -> Column:
    """All values of a line as one array, for looking at single records.

    ``transform`` runs its lambda interpreted; the reshaping operators do not
    use this array but explode slot numbers and cut each value on its own.
    """
    slots = F.sequence(F.lit(0), F.lit(layout.slots - 1))
    return F.transform(slots, lambda slot: slot_value(raw, slot, length, layout))


def line_chunks(raw: Column, start: int, width: int, count: int) -> Column:
    """Up to ``count`` chunks of ``width`` bytes from ``start``; the last one
    may be short and empty ones are left out. A carriage return is no part."""
    rest = line_length(raw) - F.lit(start)

    def chunk(i: int) -> Column:
        size = F.least(F.lit(width), rest - F.lit(i * width))
        return F.substring(raw, F.lit(start + i * width + 1), size).cast("string")

    # written out, since a lambda runs interpreted
    filled = F.least(F.ceil(rest / F.lit(width)).cast("int"), F.lit(count))
    chunks = F.slice(F.array(*[chunk(i) for i in range(count)]), 1, filled)
    return F.when(rest > 0, chunks).otherwise(F.array().cast("array<string>"))


def value_at(values: Column, index: Column | int) -> Column:
    """Array element at a 0-based index, null when out of range."""
    return F.get(values, index)


def pad_line(line: Column, width: int) -> Column:
    return F.rpad(line, width, " ")


def element_code(text: Column, elements: tuple[str, ...] = CORE_ELEMENTS) -> Column:
    """Upper-cased element code when it is one of ``elements``, else Unknown."""
    code = F.upper(text)
    return F.when(code.isin(*elements), code).otherwise(UNKNOWN_ELEMENT)


def element_properties(text: Column, elements: tuple[str, ...] = CORE_ELEMENTS) -> list[Column]:
    """Properties of a record that names its own element: no dataset."""
    return [
        F.lit(UNKNOWN_DATASET).alias("dataset"),
        element_code(text, elements).alias("element"),
    ]


def _lookup(text: Column, table: dict[str, str], default: str) -> Column:
    result = F.lit(default)
    for key, label in table.items():
        result = F.when(text == key, label).otherwise(result)
    return result


def file_properties(file_name: Column) -> list[Column]:
    """(dataset, element) of a file, from the dot-separated parts of its name."""
    parts = F.split(file_name, r"\.")
    count = F.size(parts)
    last = F.substring_index(file_name, ".", -1)
    second = F.get(parts, 1)
    dataset = (
        F.when(count == 3, _lookup(second, DATASET_BY_SUFFIX, UNKNOWN_DATASET))
        .when(count == 4, CORRECTED_DATASET)
        .otherwise(UNKNOWN_DATASET)
    )
    element = F.when(
        count.isin(3, 4), _lookup(last, ELEMENT_BY_SUFFIX, UNKNOWN_ELEMENT)
    ).otherwise(UNKNOWN_ELEMENT)
    return [dataset.alias("dataset"), element.alias("element")]


def sink_label(label: Column) -> Column:
    """Label of a group as used in output names."""
    return F.lower(label)


def month_start(year: Column, month: Column) -> Column:
    """First day of a month, null for an impossible month.

    ``make_date`` raises on bad input, hence the guard.
    """
    return F.when(month.between(1, 12) & year.between(0, 9999), F.make_date(year, month, F.lit(1)))


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date, null when the calendar has no such day."""
    first = month_start(year, month)
    return F.when((day >= 1) & (day <= F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1))


def epoch_day(date: Column) -> Column:
    return F.unix_date(date)


def station_id(country: Column, network: Column, placeholder: Column, coop: Column) -> Column:
    return F.concat(country, network, placeholder, coop)


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))
