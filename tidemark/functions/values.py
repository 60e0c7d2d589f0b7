"""Coercion of loosely typed values.

A :class:`Value` is a column plus its Spark type. Payload tables have fixed column
types, so the branch is taken when the plan is built. A ``VARIANT`` carries its type
per row, so the branch becomes a ``CASE`` over ``schema_of_variant``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text

INT64_MAX = 9223372036854775807
INT64_MIN = -9223372036854775808

# The words read as true and as false.
TRUE_WORDS = ["1", "true", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "no", "n", "off"]

NUMERIC_TEXT = r"^[ \t\n\r\x0B\f]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\x0B\f]*$"


@dataclass(frozen=True)
class Value:
    col: Column
    dtype: T.DataType

    @property
    def kind(self) -> str:
        if isinstance(self.dtype, T.VariantType):
            return "variant"
        if isinstance(self.dtype, (T.StringType, T.CharType, T.VarcharType)):
            return "string"
        if isinstance(self.dtype, T.BooleanType):
            return "bool"
        if isinstance(self.dtype, T.IntegralType):
            return "int"
        if isinstance(self.dtype, (T.FractionalType, T.DecimalType)):
            return "float"
        if isinstance(self.dtype, T.DateType):
            return "date"
        if isinstance(self.dtype, (T.TimestampType, T.TimestampNTZType)):
            return "timestamp"
        return "other"


def column_value(df: DataFrame, name: str) -> Value:
    """A column of ``df``; a missing one reads as null text."""
    if name in df.columns:
        return Value(F.col(name), df.schema[name].dataType)
    return Value(F.lit(None).cast("string"), T.StringType())


def variant_value(payload: Column, name: str) -> Value:
    return Value(F.try_variant_get(payload, f"$.{name}", "variant"), T.VariantType())


# Kind -> (type to read it as, test on the variant's own type name). The text branch
# comes first: most payload values are texts.
_VARIANT_KINDS = {
    "string": ("string", lambda k: k == "STRING"),
    "int": ("bigint", lambda k: k == "BIGINT"),
    "bool": ("boolean", lambda k: k == "BOOLEAN"),
    "float": ("double", lambda k: k.isin("DOUBLE", "FLOAT") | k.startswith("DECIMAL")),
    # Kinds whose text is the value itself, in one branch.
    "as_text": ("string", lambda k: k.isin("STRING", "BIGINT", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ")),
    "string_or_time": ("string", lambda k: k.isin("STRING", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ")),
}


def by_kind(value: Value, rules: dict) -> Column | None:
    """Apply the rule for the value's kind; kinds without a rule give null."""
    if value.kind != "variant":
        rule = rules.get(value.kind)
        return rule(value.col) if rule else None
    kind = F.schema_of_variant(value.col)
    out = None
    for name, (target, test) in _VARIANT_KINDS.items():
        if name in rules:
            branch = rules[name](F.try_variant_get(value.col, "$", target))
            out = F.when(test(kind), branch) if out is None else out.when(test(kind), branch)
    return out


def _typed(value: Value, rules: dict, dtype: str) -> Column:
    out = by_kind(value, rules)
    return F.lit(None).cast(dtype) if out is None else out.cast(dtype)


def float_text(c: Column) -> Column:
    """A float as text with 14 significant digits: ``1``, ``0.3``, ``1.0E+25``."""
    sci = F.format_string("%.13e", c)
    rounded = sci.try_cast("double")
    plain = F.regexp_replace(rounded.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    long_form = F.regexp_replace(F.regexp_replace(sci, "0+e", "e"), r"\.e", ".0e")
    long_form = F.regexp_replace(F.regexp_replace(long_form, r"e\+0?", "E+"), "e-0?", "E-")
    size = F.abs(rounded)
    return F.when((size < 1e14) & ((size >= 1e-4) | (size == 0)), plain).otherwise(long_form)


def _date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def scalar_text(value: Value) -> Column:
    """Any scalar as trimmed text, null when blank. True is ``1``, false is blank."""
    rules = {"bool": lambda c: F.when(c, "1").otherwise(""), "float": float_text}
    if value.kind == "variant":
        rules["as_text"] = lambda c: c
    else:
        rules |= {
            "string": lambda c: c, "int": lambda c: c.cast("string"),
            "date": _date_text, "timestamp": _timestamp_text}
    return text.non_blank(_typed(value, rules, "string"))


def string_text(value: Value) -> Column:
    """Trimmed text of string values only, null when blank or of another type."""
    if value.kind == "variant":
        rules = {"string_or_time": lambda c: c}
    else:
        rules = {"string": lambda c: c, "date": _date_text, "timestamp": _timestamp_text}
    return text.non_blank(_typed(value, rules, "string"))


def saturating_int(digits: Column) -> Column:
    """Digit text as a 64-bit integer, held at the ends of the range."""
    edge = F.when(digits.startswith("-"), F.lit(INT64_MIN)).otherwise(F.lit(INT64_MAX))
    return F.coalesce(digits.try_cast("bigint"), edge)


def int_or_null(value: Value) -> Column:
    """Integers, booleans as 0/1, floats rounded half away from zero, integer text."""
    def from_text(c: Column) -> Column:
        digits = text.trim(c)
        return F.when(digits.rlike(r"^-?[0-9]+$"), saturating_int(digits))

    return _typed(value, {
        "int": lambda c: c.cast("bigint"),
        "bool": lambda c: c.cast("int").cast("bigint"),
        "float": lambda c: F.round(c.cast("double")).try_cast("bigint"),
        "string": from_text,
    }, "bigint")


def flag_or_null(value: Value) -> Column:
    """0 or 1 from booleans, integers and the known words; null otherwise."""
    def from_text(c: Column) -> Column:
        word = text.lower(text.trim(c))
        return F.when(word.isin(TRUE_WORDS), 1).when(word.isin(FALSE_WORDS), 0)

    return _typed(value, {
        "bool": lambda c: c.cast("int"),
        "int": lambda c: (c != 0).cast("int"),
        "string": from_text,
    }, "int")


def number_or_null(value: Value) -> Column:
    """A double when the value is a number or numeric text; booleans are not numbers."""
    return _typed(value, {
        "int": lambda c: c.cast("double"),
        "float": lambda c: c.cast("double"),
        "string": lambda c: F.when(c.rlike(NUMERIC_TEXT), F.regexp_replace(c, r"[ \t\n\r\x0B\f]", "").try_cast("double")),
    }, "double")


def positive_int_or_null(value: Value) -> Column:
    """An integer above zero, or untrimmed unsigned digits above zero."""
    def from_text(c: Column) -> Column:
        return F.when(c.rlike(r"^[0-9]+\z"), saturating_int(c))

    number = _typed(value, {"int": lambda c: c.cast("bigint"), "string": from_text}, "bigint")
    return F.when(number > 0, number)


def strict_flag_or_null(value: Value) -> Column:
    """0 or 1 from booleans, the integers 0 and 1, and digit text of those."""
    def from_text(c: Column) -> Column:
        return F.when(c.rlike(r"^[0-9]+\z"), saturating_int(c))

    number = _typed(value, {
        "bool": lambda c: c.cast("int").cast("bigint"),
        "int": lambda c: c.cast("bigint"),
        "string": from_text,
    }, "bigint")
    return F.when(number.isin(0, 1), number.cast("int"))
