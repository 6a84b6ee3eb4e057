"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.missing import floating, nan_to, present
from windrow.operators.joins import attach
from windrow.operators.ordering import dense_index


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns, such as the session or framework a table belongs to."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in constants.items()])


def union_sessions(parts: Mapping[str, DataFrame], tag_column: str) -> DataFrame:
    """Union by name, each part tagged with its name."""
    frames = [tag(df, **{tag_column: name}) for name, df in parts.items()]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def drop_label(df: DataFrame, label: str, value) -> DataFrame:
    """Drop rows of the filler class. A null label is not comparable and is dropped as well."""
    return df.filter(F.col(label) != F.lit(value))


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with no reading in any of ``columns`` (null or NaN).

    Apply it to stored columns, before they are recomputed (see :func:`drop_incomplete`).
    """
    return df.na.drop(how="all", subset=list(columns))


def drop_family(df: DataFrame, contains: str) -> DataFrame:
    """Drop every column whose name contains ``contains``."""
    return df.drop(*[c for c in df.columns if contains in c])


def keep_family(df: DataFrame, contains: str, also: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c for c in df.columns if contains in c or c in set(also)])


def nan_to_zero(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN to 0.0 in one projection; null is left for :func:`drop_incomplete`."""
    targets = set(floating(df, columns))
    return df.select(*[nan_to(F.col(c)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of ``columns`` (all columns by default).

    One condition per column: the optimiser copies a condition for every computed column in it,
    which a single condition over many computed columns would multiply up.
    """
    names = list(df.columns if columns is None else columns)
    numbers = set(floating(df, names))
    return df.filter(reduce(Column.__and__, [
        present(F.col(c)) if c in numbers else F.col(c).isNotNull() for c in names]))


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Null and NaN to ``value``."""
    return df.na.fill(value, subset=list(columns))


def lookup(df: DataFrame, table: DataFrame, on: str, spread: Sequence[str] | None = None,
           small: bool | None = None) -> DataFrame:
    """Left join with a dimension table; a key the table does not know keeps a null."""
    return attach(df, table, [on], "left", spread=spread, small=small)


def decode_label(df: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Add the name of a label, or the text of its id where no name is known."""
    joined = attach(df, names.select(key, F.col(name).alias("_name")), [key], "left")
    return joined.select(
        *df.columns, F.coalesce("_name", F.col(key).cast("string")).alias(name))


def encode_label(df: DataFrame, label: str, code: str) -> DataFrame:
    """Add a dense code 0..k-1, labels in ascending order."""
    labels = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return attach(df, dense_index(labels, [label], code), [label], "left")


def split_fields(lines: DataFrame, fields: Mapping[str, str], separator: str = ",",
                 strip: str = ";", value: str = "value") -> DataFrame:
    """Parse delimited text lines into typed columns.

    Lines with another number of fields than ``fields`` are dropped, ``strip`` is removed from
    the last field, and a line with a field that does not parse is dropped.

    Parts and fields each come out of a generator of one row: projections would be merged into
    one another, and the line split anew for every field and condition.
    """
    names = list(fields)
    parts = F.split(F.col(value), _literal(separator), -1)
    kept = _once(lines, parts.alias("_parts")).filter(F.size("_parts") == len(names))

    def field(position: int) -> Column:
        text = F.col("_parts").getItem(position)
        if position == len(names) - 1 and strip:
            text = F.regexp_replace(text, _literal(strip), "")
        kind = fields[names[position]]
        return text if kind == "string" else text.try_cast(kind)

    return _once(kept, *[field(i).alias(n) for i, n in enumerate(names)]).na.drop()


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns, computed once per row however often they are used later."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _literal(text: str) -> str:
    """``text`` as a regular expression that matches just that text."""
    return "".join(c if c.isalnum() or c in " ,;" else f"\\{c}" for c in text)


def override(df: DataFrame, corrections: DataFrame, on: Sequence[str]) -> DataFrame:
    """Replace stored values of the named rows; a null correction leaves the stored value."""
    columns = [c for c in corrections.columns if c not in on]
    renamed = corrections.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = attach(df, renamed, on, "left")
    return joined.select(*[
        F.coalesce(f"_new_{c}", F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns])


def replace_missing(df: DataFrame, column: str, substitute: Column) -> DataFrame:
    """Take ``substitute`` where ``column`` is null."""
    return df.withColumn(column, F.coalesce(F.col(column), substitute))


def align(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns of ``order`` that ``df`` has, in that order."""
    return df.select(*[c for c in order if c in df.columns])
