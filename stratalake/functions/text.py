"""Column builders for text, numbers and identifiers. All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character Unicode calls white space, found by rule.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
#: The same set as a Java regular-expression class body.
WS_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
#: White space that can stand inside a line.
INNER_WS_CLASS = r"\t\x0b\f\r \x1c-\x1f\x85\p{Z}"
#: Characters that end a line of text, newline included.
LINE_ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"

#: Decimal number text: sign, digits, fraction, exponent, or a named special value.
NUMBER_PATTERN = (
    r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression.

    A column named inside a lambda is evaluated again for every element; binding it as
    the element of a one-item array evaluates it once per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def rstrip(col: Column) -> Column:
    return F.rtrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def safe_str(col: Column, max_len: int) -> Column:
    """Trimmed text cut to ``max_len`` characters; blank becomes null."""
    return F.left(blank_to_null(strip(col.cast("string"))), F.lit(max_len))


def _number_text(col: Column) -> Column:
    text = strip(col.cast("string"))
    grouped = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return F.when(F.contains(text, F.lit("_")), grouped).otherwise(text)


def safe_float(col: Column) -> Column:
    """A double, or null where the text is no number (type suffixes such as ``1.5d`` are none)."""
    text = _number_text(col)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def strict_float(col: Column, name: str) -> Column:
    """A double; the job fails on missing or unreadable values."""
    parsed = safe_float(col)
    return F.coalesce(
        parsed,
        F.raise_error(
            F.concat(F.lit(f"{name} is not a number: "), F.coalesce(col.cast("string"), F.lit("null")))
        ).cast("double"),
    )


def strict_float_of_number(col: Column, name: str) -> Column:
    """The same guard for a column that is numeric already: only null can fail."""
    return F.coalesce(
        col.cast("double"), F.raise_error(F.lit(f"{name} is not a number: null")).cast("double")
    )


def dot(left: Column, right: Column) -> Column:
    """Sum of products over the shorter of two arrays."""
    products = F.zip_with(
        left, right, lambda a, b: F.coalesce(a.cast("double") * b.cast("double"), F.lit(0.0))
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; a zero vector counts as length one."""

    def length(vec: Column) -> Column:
        size = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, a: acc + a.cast("double") * a))
        return F.coalesce(F.nullif(size, F.lit(0.0)), F.lit(1.0))

    return dot(left, right) / (length(left) * length(right))


def fingerprint(text: Column) -> Column:
    """First twelve hex digits of the sha-256 of the stripped text."""
    return F.left(F.sha2(strip(text).cast("binary"), 256), F.lit(12))


def snippet(text: Column, limit: int) -> Column:
    """One line of at most ``limit`` characters, an ellipsis marking a cut."""
    return let(
        strip(F.replace(text, F.lit("\n"), F.lit(" "))),
        lambda flat: F.when(
            F.length(flat) > limit, F.concat(rstrip(F.left(flat, F.lit(limit))), F.lit("…"))
        ).otherwise(flat),
    )


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Replace each ``{{key}}`` in turn by its value."""
    filled = F.lit(template)
    for key, value in values.items():
        filled = F.replace(filled, F.lit("{{" + key + "}}"), value)
    return filled


def numbered_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and a zero-padded number; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")),
    )


def storage_uri_parts(uri: Column) -> dict[str, Column]:
    """Container, account and path of an ``abfs[s]://container@account.host/path`` address."""
    pattern = r"^abfss?://([^@/]+)@([^./]+)\.[^/]+/(.*)$"
    return {
        "container": blank_to_null(F.regexp_extract(uri, pattern, 1)),
        "account": blank_to_null(F.regexp_extract(uri, pattern, 2)),
        "path": blank_to_null(F.regexp_extract(uri, pattern, 3)),
    }
