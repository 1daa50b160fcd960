"""Encoders that learn a dictionary from the table and attach it to rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions.text import as_text, joined_text
from featurekit.operators.groups import key_statistics, known_keys
from featurekit.operators.lookup import LIMIT, WEIGHT, BroadcastLimit, Size, attach, size_columns
from featurekit.operators.ordering import dense_codes, ordinals
from featurekit.session import materialize_by

# A dictionary within these bounds becomes a constant of the plan, so that one projection looks up all such columns; a join for
# each of them would copy the whole row every time. A look-up reads the values one by one, so there must be few.
INLINE = BroadcastLimit(200, 64 * 1024)


def _plain_text(column: str, data_type: T.DataType) -> Column:
    """Text that identifies a value; adding zero turns -0.0 into 0.0."""
    value = F.col(column)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(data_type)
    return value.cast("string")


def _plain_expression(column: str, data_type: T.DataType) -> str:
    """:func:`_plain_text` in SQL, which is planned much faster for hundreds of columns."""
    zero = {T.FloatType: " + 0.0F", T.DoubleType: " + 0.0D"}.get(type(data_type), "")
    return f"CAST(`{column}`{zero} AS STRING)"


def value_table(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows per (column, value) for many columns from one shuffle; values are text and null is a value."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = F.expr(f"array({', '.join(_plain_expression(c, kinds[c]) for c in columns)})")
    # Cells are grouped by the number of their column, which is cheaper to shuffle than its name.
    counted = (
        df.select(*within, F.posexplode(cells).alias("__at", "value"))
        .groupBy(*within, "__at", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("__at") + 1)
    return counted.select(*within, name.alias("column"), "value", "n")


def count_encode(
    df: DataFrame,
    columns: Sequence[str],
    within: Sequence[str] = (),
    suffix: str = "_count_full",
    nulls: bool = True,
) -> DataFrame:
    """Add ``{column}{suffix}``: the number of rows with the same value (per ``within`` if given).

    Nulls are counted as one value, or stay null when ``nulls`` is false. One pass counts all columns; each
    column's dictionary is then measured, and written into the plan or broadcast if small.
    """
    within, kinds = list(within), {f.name: f.dataType for f in df.schema.fields}
    counts = value_table(df, columns, within)
    if not nulls:
        counts = counts.where(F.col("value").isNotNull())
    parts = _by_column(counts.withColumnRenamed("n", WEIGHT), within)
    few = {} if within else parts.constants(columns, WEIGHT)
    counted = {c: F.expr(_plain_expression(c, kinds[c])) for c in few}
    rows = df.select("*", *[_found(few[c], text).alias(f"{c}{suffix}") for c, text in counted.items()])
    for column in parts.small_first([c for c in columns if c not in few]):
        dictionary = parts.part(column).select(
            *within, F.col("value").cast(kinds[column]).alias(column), F.col(WEIGHT).alias(f"{column}{suffix}"), WEIGHT,
        )
        rows = attach(rows, dictionary, [*within, column], size=parts.size(column))
    return rows.select(*df.columns, *[f"{c}{suffix}" for c in columns])


def _found(constant: Mapping[str | None, int], text: Column) -> Column:
    """The number that a constant dictionary holds for a text; null when it holds none."""
    known = F.lit(json.dumps({value: number for value, number in constant.items() if value is not None}))
    found = F.element_at(F.from_json(known, "map<string,bigint>"), text)
    return F.when(text.isNull(), F.lit(constant[None])).otherwise(found) if None in constant else found


@dataclass
class _Parts:
    """A stored table of many columns' dictionaries with the size of each part and, for codes, its first position."""

    stored: DataFrame
    rows: dict[str, Row]

    def part(self, column: str) -> DataFrame:
        return self.stored.where(F.col("column") == column)

    def size(self, column: str) -> Size:
        row = self.rows.get(column)
        return Size(row["rows"], row["bytes"], row["null_keys"], row["weight"]) if row else Size(0, 0, 0)

    def constants(self, columns: Iterable[str], number: str) -> dict[str, dict[str | None, int]]:
        """Value and ``number`` of every part within :data:`INLINE`; parts with malformed text, which Python cannot hold, are left out."""
        few: dict[str, dict[str | None, int]] = {c: {} for c in columns if self.size(c).fits(INLINE)}
        for row in self.stored.where(F.col("column").isin(list(few))).select("column", "value", number).collect():
            few[row["column"]][row["value"]] = row[number]
        return {c: values for c, values in few.items() if not any("\ufffd" in (v or "") for v in values)}

    def small_first(self, columns: Iterable[str]) -> list[str]:
        """Large dictionaries shuffle the rows, which are narrower once the other columns are encoded."""
        return sorted(columns, key=lambda c: not self.size(c).fits(LIMIT))


def _by_column(table: DataFrame, within: Sequence[str] = ()) -> _Parts:
    stored = materialize_by(table, "column")
    first = [F.min("position").alias("first")] if "position" in table.columns else []
    rows = stored.groupBy("column").agg(*size_columns(stored, [*within, "value"]), *first).collect()
    return _Parts(stored, {r["column"]: r for r in rows})


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code", missing: str | None = "nan") -> DataFrame:
    """Add codes from 0 in sorted text order over all rows; null reads as ``missing``, or stays null if that is None."""
    def read(column: str) -> Column:
        return F.col(column) if missing is None else _filled_text(df, column, missing)

    return _text_codes(df, {f"{c}{suffix}": read(c) for c in columns})


def pair_codes(df: DataFrame, pairs: Sequence[tuple[str, str]], prefix: str = "") -> DataFrame:
    """Add ``{prefix}{a}__{b}``: the code of the joined texts of two columns."""
    return _text_codes(df, {f"{prefix}{a}__{b}": joined_text(df.schema, [a, b]) for a, b in pairs})


def _text_codes(df: DataFrame, texts: Mapping[str, Column]) -> DataFrame:
    """Add one code column per text; all dictionaries are learnt and put in order in one pass."""
    if not texts:
        return df
    read = df.select(*[text.alias(name) for name, text in texts.items()])
    counted = value_table(read, list(texts)).where(F.col("value").isNotNull()).withColumnRenamed("n", WEIGHT)
    # One order over all columns: a code is the position of the value less that of the column's first value.
    parts = _by_column(ordinals(counted, ["column", "value"], name="position"))
    few = parts.constants(texts, "position")
    coded = {n: {value: at - parts.rows[n]["first"] for value, at in values.items()} for n, values in few.items()}
    rows = df.select("*", *[_found(codes, texts[n]).alias(n) for n, codes in coded.items()])
    for name in parts.small_first([n for n in texts if n not in coded]):
        first = parts.rows[name]["first"] if name in parts.rows else 0
        code = (F.col("position") - F.lit(first)).alias(name)
        dictionary = parts.part(name).select(F.col("value").alias("__text"), code, WEIGHT)
        # A text is made for its own join only: no shuffle carries those of the other columns.
        rows = attach(rows.withColumn("__text", texts[name]), dictionary, "__text", size=parts.size(name)).drop("__text")
    return rows.select(*df.columns, *texts)


def number_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the position (from 0) of the value among the sorted distinct values; null stays null."""
    codes, size = dense_codes(known_keys(df, [column]), column, name)
    return attach(df, codes, column, size=size)


def _filled_text(df: DataFrame, column: str, missing: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(missing)).otherwise(as_text(column, df.schema[column].dataType))


def target_mean_encode(
    df: DataFrame, columns: Sequence[str], label: str, fit: Column, suffix: str = "__target_mean"
) -> DataFrame:
    """Add the label mean of the value among the rows selected by ``fit``; null for values not seen there."""
    for column, _, means, size in key_statistics(df.where(fit), columns, [F.avg(label).alias("__mean")]):
        df = attach(df, means.withColumnRenamed("__mean", f"{column}{suffix}"), column, size=size)
    return df


def group_map(df: DataFrame, column: str, mapping: Mapping[str, str], name: str) -> DataFrame:
    """Add the group of a value from a fixed mapping; null when not listed."""
    table = df.sparkSession.createDataFrame(list(mapping.items()), f"{column} string, `{name}` string")
    width = sum(len(k.encode()) + len(v.encode()) + 48 for k, v in mapping.items())
    return attach(df, table, column, size=Size(len(mapping), width, 0))


def null_rare(df: DataFrame, column: str, fit: Column, above: int, count: str | None = None) -> DataFrame:
    """Keep a value only if more than ``above`` rows of ``fit`` carry it; every other value becomes null.

    ``count`` names a column for the number of all rows with the value, null where it was not kept; it costs no second join.
    """
    carried = known_keys(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias(WEIGHT), F.count_if(fit).alias("__fit"))
    frequent = carried.where(F.col("__fit") > above).select(column, F.col(WEIGHT).alias("__n"), WEIGHT)
    kept = F.when(F.col("__n").isNotNull(), F.col(column)).alias(column)
    counted = [F.col("__n").alias(count)] if count else []
    return attach(df, frequent, column).select(*[kept if c == column else c for c in df.columns], *counted)


def bucket_rare(df: DataFrame, column: str, below: int, within: Sequence[str] = (), other: str = "Others") -> DataFrame:
    """Replace values carried by fewer than ``below`` rows (per ``within``) by one label; null stays null."""
    group = [*within, column]
    # At most one value in every ``below`` rows is frequent, so this is the shorter of the two lists.
    frequent = known_keys(df, [column]).groupBy(*group).agg(F.count(F.lit(1)).alias(WEIGHT))
    frequent = frequent.where(F.col(WEIGHT) >= below).select(*group, F.lit(True).alias("__frequent"), WEIGHT)
    rare = F.col("__frequent").isNull() & F.col(column).isNotNull()
    return attach(df, frequent, group).withColumn(
        column, F.when(rare, F.lit(other)).otherwise(F.col(column))
    ).drop("__frequent")
