"""Text to typed values. Nothing here raises on bad data: what cannot be read is NULL."""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried by default; where several fit, the later one wins.
DATE_FORMATS = (
    "yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MM-yyyy", "dd/MM/yyyy",
    "yyyy/MM/dd", "yyyyMMdd", "MM-dd-yyyy", "dd.MM.yyyy", "yyyy.MM.dd",
)
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "MM/dd/yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "dd/MM/yyyy HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss", "yyyyMMdd HH:mm:ss", "MM-dd-yyyy HH:mm:ss",
)

# Words read as booleans.
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")

# Just under the largest long, so that a double cannot have been rounded across it.
SURELY_LONG = 9.2e18

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
FRACTIONAL_NUMBER = r"^\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)\s*$"

# Shapes of the runs of pattern letters, digits written as 0. Years of more than four digits carry a
# sign. Spark's own parser fails for good on years beyond the range of its timestamps, so those of six
# digits are looked at first; longer ones are never in range. Other letters have no fixed shape.
_SIX_DIGITS = ("+000000", "-000000")
_RUNS = {
    "yyyy": ("0000", "+00000", "-0000", "-00000", *_SIX_DIGITS), "MM": ("00",), "M": ("0", "00"), "dd": ("00",),
    "d": ("0", "00"), "HH": ("00",), "H": ("0", "00"), "mm": ("00",), "m": ("0", "00"),
    "ss": ("00",), "s": ("0", "00"), "SSS": ("0", "00", "000"),
}
_TOKEN = re.compile(r"'([^']+)'|([A-Za-z])\2*|([-/. :,_])")
_BETWEEN, _AFTER, _FAR = "\x02", "\x01", "\x03"
_FAR_YEAR = r"[+-]\d{6}"
# Whole years that timestamps of 64 bits hold.
_LEAST_YEAR, _MOST_YEAR = -290_307, 294_246


def shapes_of(fmt: str) -> dict[str, bool] | None:
    """Every usual shape a text of the date format can have, and whether its year has six digits.

    None if the shapes are not known.
    """
    parts, at = [], 0
    while at < len(fmt):
        token = _TOKEN.match(fmt, at)
        if token is None:
            return None
        literal = token.group(1) or token.group(3)
        run = _RUNS.get(token.group(0)) if literal is None else (_digits_as_zero(literal),)
        if run is None:
            return None
        parts.append(run)
        at = token.end()
    return {"".join(p): any(x in _SIX_DIGITS for x in p) for p in product(*parts)}


def _digits_as_zero(text: str) -> str:
    return re.sub("[0-9]", "0", text.lower())


def _stretched(fmt: str) -> str | None:
    """What a text like 001/02/2024 looks like, for a format with numbers of any length in it.

    None when all numbers have a fixed length, or when two numbers touch.
    """
    tokens = list(_TOKEN.finditer(fmt))
    numbers = [t.group(2) is not None for t in tokens]
    if any(a and b for a, b in zip(numbers, numbers[1:])):
        return None
    if not any(n and len(t.group(0)) == 1 for n, t in zip(numbers, tokens)):
        return None
    parts = []
    for t in tokens:
        literal = t.group(1) or t.group(3)
        if literal is not None:
            parts.append(r"\Q" + literal + r"\E")
        else:
            parts.append(r"[+-]?\d{4,5}" if t.group(0) == "yyyy" else r"\d+")
    return "(?i)^" + "".join(parts) + "$"


def _choices(c: Column, formats: Sequence[str]) -> tuple[dict, dict, list[str], Column]:
    """Shapes by format, formats by shape, formats that leave room for other shapes, and the text's shape."""
    last_first = list(dict.fromkeys(reversed(formats)))
    known = {fmt: shapes_of(fmt) for fmt in last_first}
    loose = [fmt for fmt in last_first if known[fmt] is None or _stretched(fmt)]
    choices = {
        shape: [fmt for fmt in last_first if known[fmt] is None or shape in known[fmt]]
        for shapes in known.values() for shape in shapes or ()
    }
    return known, choices, loose, _shape(c, choices)


def _shape(c: Column, shapes: Collection[str]) -> Column:
    """The shape of a text that is not longer than all of the shapes."""
    longest = max((len(shape.encode()) for shape in shapes), default=0)
    return F.when(F.octet_length(c) <= longest, F.translate(F.lower(c), "123456789", "000000000"))


def shape_of(c: Column, *formats: str) -> Column:
    """The shape of a text, NULL if it is too long for all of these formats: for ``has_reading``."""
    return _shape(c, [shape for fmt in formats for shape in shapes_of(fmt) or ()])


def _open_ended(c: Column, fmt: str) -> Column:
    """Whether a text of no known shape may be one of this format."""
    pattern = _stretched(fmt) if shapes_of(fmt) is not None else None
    return c.rlike(pattern) if pattern else ~c.rlike(_FAR_YEAR)


def _within_years(c: Column, fmt: Column) -> Column:
    """The format, if it is not marked as one of far years, or if the year of the text is no farther than timestamps go."""
    year = F.regexp_extract(c, "(" + _FAR_YEAR + ")", 1).try_cast("int")
    reads = F.when(year.between(_LEAST_YEAR, _MOST_YEAR), F.substr(fmt, F.lit(2)))
    return F.when(fmt.startswith(_FAR), reads).otherwise(fmt)


def has_reading(c: Column, formats: Sequence[str], shape: Column | None = None) -> Column:
    """Whether any of the formats reads the text: ``_first_reading`` is not NULL, in far less code.

    Code of over 8000 bytes a method is never compiled by the JVM, so looking at many values needs little of
    it: a set tells texts of no known shape apart, one map has the formats of a shape, and one expression
    tries them in turn. ``shape`` may be a column that holds ``shape_of`` these formats, and others.
    """
    known, choices, loose, own = _choices(c, formats)
    shape = own if shape is None else shape
    reads = F.lit(False)
    for fmt in loose:
        reads = reads | F.when(_open_ended(c, fmt), F.try_to_timestamp(c, F.lit(fmt)).isNotNull()).otherwise(False)
    if not choices:
        return F.coalesce(reads, F.lit(False))
    # Years of four digits first, as the map is searched in order.
    order = sorted(choices, key=lambda s: (s[0] in "+-" or "+" in s or "--" in s, len(s)))
    far = {s: [(_FAR if (known[fmt] or {}).get(s) else "") + fmt for fmt in choices[s]] for s in order}
    table = F.create_map(*[x for s in order for x in (F.lit(s), F.array(*map(F.lit, far[s])))])
    tried = F.exists(
        F.try_element_at(table, shape), lambda fmt: F.try_to_timestamp(c, _within_years(c, fmt)).isNotNull()
    )
    return F.coalesce(F.when(shape.isin(*choices), tried).otherwise(reads), F.lit(False))


def _first_reading(c: Column, formats: Sequence[str], kind: str) -> Column:
    """The reading by the last format that reads the text.

    A failed parse throws inside Spark, and trying every format on every value is slow and makes
    code too large to be compiled. So the shape of the text is looked up first, and only formats
    of that shape are tried: the i-th choice for a shape is in the i-th of a few constant maps.
    Texts of no known shape are only tried with formats that leave room for them.
    """
    known, choices, loose, shape = _choices(c, formats)
    readings = []
    for i in range(max(map(len, [loose, *choices.values()]), default=0)):
        entries = [
            s + _BETWEEN + (_FAR if (known[found[i]] or {}).get(s) else "") + found[i]
            for s, found in choices.items() if i < len(found)
        ]
        fmt = F.lit(None).cast("string")
        if entries:
            table = F.str_to_map(F.lit(_AFTER.join(entries)), F.lit(_AFTER), F.lit(_BETWEEN))
            fmt = F.try_element_at(table, shape)
            if any(_FAR in e for e in entries):
                fmt = _within_years(c, fmt)
        if i < len(loose):
            open_ended = _open_ended(c, loose[i])
            if choices:
                open_ended = open_ended & ~F.coalesce(shape.isin(*choices), F.lit(False))
            fmt = F.coalesce(fmt, F.when(open_ended, loose[i]))
        readings.append(F.try_to_timestamp(c, fmt).cast(kind))
    return F.coalesce(*readings) if readings else F.lit(None).cast(kind)


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date by the last of the formats that reads the text."""
    return _first_reading(c, formats, "date")


def parse_timestamp(c: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp by the last of the formats that reads the text."""
    return _first_reading(c, formats, "timestamp")


def boolean_word(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*TRUE_WORDS, *FALSE_WORDS)


def parse_boolean(c: Column) -> Column:
    """Boolean by word list, ignoring case and outer spaces."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def without_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def is_number(c: Column) -> Column:
    """True for decimal or scientific notation once thousands commas are gone."""
    return without_commas(c).rlike(NUMBER)


def as_double(c: Column) -> Column:
    """The number that a text is once thousands commas are gone."""
    return F.when(is_number(c), without_commas(c).try_cast("double"))


def is_whole(value: Column) -> Column:
    """True for a double without a fractional part that a long surely holds."""
    return F.coalesce((value == F.rint(value)) & (F.abs(value) < SURELY_LONG), F.lit(False))


def is_within(value: Column, precision: int, scale: int) -> Column:
    """True for a double that decimal(precision, scale) holds without being cut to its limits."""
    return F.coalesce(F.abs(value) < float(f"1e{precision - scale}"), F.lit(False))


def is_whole_number(c: Column) -> Column:
    """True for a number without a fractional part that a long surely holds; ``1.0`` counts."""
    return is_whole(as_double(c))


def fits_decimal(c: Column, precision: int, scale: int) -> Column:
    """True for a number that decimal(precision, scale) holds without being cut to its limits."""
    return is_within(as_double(c), precision, scale)


def parse_integer(c: Column, kind: str) -> Column:
    """Whole number of type ``kind``; digits after a point are cut off."""
    cut = F.when(c.rlike(FRACTIONAL_NUMBER), c.try_cast("decimal(38,10)").try_cast(kind))
    return F.coalesce(c.try_cast(kind), cut)


def decimal_limit(precision: int, scale: int) -> str:
    """Largest value of decimal(precision, scale), digit by digit so that nothing is rounded."""
    whole = "9" * (precision - scale) or "0"
    return whole + ("." + "9" * scale if scale else "")


def parse_decimal(c: Column, precision: int, scale: int, overflow: str = "null") -> Column:
    """Decimal, with a policy for what does not fit.

    ``null``: NULL. ``truncate``: numbers beyond the type become its largest or smallest value.
    ``string``: the column is text, values that do not convert stay as they were.
    """
    kind = f"decimal({precision},{scale})"
    value = c.try_cast(kind)
    if overflow == "null":
        return value
    if overflow == "string":
        return F.coalesce(value.cast("string"), c.cast("string"))
    if overflow != "truncate":
        raise ValueError(f"unknown overflow policy: {overflow}")
    top = F.lit(decimal_limit(precision, scale)).cast(kind)
    wide = c.try_cast("double")
    limit = float(decimal_limit(precision, scale))
    infinity = float("inf")
    clamped = F.when((wide >= limit) & (wide < infinity), top).when(
        (wide <= -limit) & (wide > -infinity), -top
    )
    return F.coalesce(value, clamped)
