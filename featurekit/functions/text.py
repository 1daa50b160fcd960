"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Device-name rules, tried in order; the first substring found decides.
DEVICE_RULES = [
    ("SM", "Samsung"),
    ("SAMSUNG", "Samsung"),
    ("GT-", "Samsung"),
    ("Moto G", "Motorola"),
    ("Moto", "Motorola"),
    ("moto", "Motorola"),
    ("LG-", "LG"),
    ("rv:", "RV"),
    ("HUAWEI", "Huawei"),
    ("ALE-", "Huawei"),
    ("-L", "Huawei"),
    ("Blade", "ZTE"),
    ("BLADE", "ZTE"),
    ("Linux", "Linux"),
    ("XT", "Sony"),
    ("HTC", "HTC"),
    ("ASUS", "Asus"),
]

# Address endings that count as one group.
US_SUFFIXES = ["gmail", "net", "edu"]


def part(column: str | Column, separator: str, index: int) -> Column:
    """The ``index``-th piece of a split text (from 0; -1 is the last); null when there is none."""
    pieces = F.split(column, _literal_pattern(separator))
    if index < 0:
        return F.try_element_at(pieces, F.lit(index))
    return F.get(pieces, F.lit(index))


def classify(column: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Replace a text by the class of the first rule whose substring it contains."""
    result = column
    for needle, label in reversed(rules):
        result = F.when(column.contains(needle), F.lit(label)).otherwise(result)
    return result


def suffix_group(column: Column, grouped: Sequence[str] = tuple(US_SUFFIXES), label: str = "us") -> Column:
    """Last dot-separated piece; the grouped endings share one label and null reads ``nan``."""
    last = part(F.coalesce(column, F.lit("nan")), ".", -1)
    return F.when(last.isin(list(grouped)), F.lit(label)).otherwise(last)


def screen_size(column: Column) -> tuple[Column, Column]:
    """Width and height of a ``WxH`` text as integers, 0 when missing."""
    filled = F.coalesce(column, F.lit("0x0"))
    return tuple(F.coalesce(part(filled, "x", i).try_cast("int"), F.lit(0)) for i in (0, 1))


def trailing_number(column: Column, separator: str = ":") -> Column:
    """Integer after the separator; zero and missing both become null."""
    number = part(column, separator, 1).try_cast("int")
    return F.when(number != 0, number)


def as_text(column: str, data_type: T.DataType) -> Column:
    """Text form of a value as a Python user would see it: ``nan`` for null, ``12345678.0`` for a whole double."""
    value = F.col(column)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        x = value.cast("double")
        scientific = x.cast("string")
        mantissa = F.regexp_replace(F.substring_index(scientific, "E", 1), r"\.0$", "")
        exponent = F.substring_index(scientific, "E", -1)
        text = (
            F.when(F.isnan(x), F.lit("nan"))
            .when((F.abs(x) < 1e16) & (x == F.floor(x)), F.concat(x.try_cast("bigint").cast("string"), F.lit(".0")))
            .when((F.abs(x) < 1e16) & (F.abs(x) >= 1e-4), F.rtrim(x.try_cast("decimal(38,20)").cast("string"), F.lit("0")))
            .when(
                scientific.contains("E"),
                F.concat(
                    mantissa,
                    F.when(exponent.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")),
                    F.lpad(F.regexp_replace(exponent, "-", ""), 2, "0"),
                ),
            )
            .otherwise(scientific)
        )
    elif isinstance(data_type, T.BooleanType):
        text = F.initcap(value.cast("string"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("nan"))


def joined_text(schema: T.StructType, columns: Sequence[str], separator: str = "_") -> Column:
    """Texts of several columns joined by a separator."""
    pieces: list[Column] = []
    for name in columns:
        if pieces and separator:
            pieces.append(F.lit(separator))
        pieces.append(as_text(name, schema[name].dataType))
    return F.concat(*pieces)


def _literal_pattern(separator: str) -> str:
    return "\\Q" + separator + "\\E"
