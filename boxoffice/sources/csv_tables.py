"""Comma-separated extracts with a header line and no quoting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code page 1252, bytes 0x80 to 0x9F. The five unassigned bytes stay as they are.
CP1252_HIGH = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _from_cp1252(c: Column) -> Column:
    latin1 = "".join(chr(b) for b in range(0x80, 0xA0))
    return F.translate(c, latin1, CP1252_HIGH)


class MalformedLines(ValueError):
    """An extract has more odd lines than the load allows."""


#: Column of the raw line where its number of fields is not the declared one.
_LINE = "_line"


def _is_cp1252(encoding: str) -> bool:
    return encoding.lower() in ("1252", "cp1252", "windows-1252")


def _fields(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str, audited: bool = False
) -> DataFrame:
    """All fields as text, ``c0``, ``c1``, ...; with ``audited`` also the raw line, if it is odd."""
    # Header names are taken by position: extracts may carry an unnamed first column.
    as_text = T.StructType(
        [T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))]
    )
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("quote", "")
        .option("encoding", "ISO-8859-1" if _is_cp1252(encoding) else encoding)
    )
    if audited:
        as_text = as_text.add(_LINE, T.StringType())
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
    return reader.schema(as_text).csv(path)


def _text_or_number(i: int, field: T.StructField, cp1252: bool) -> Column:
    """Field ``i`` as text in the right characters, or without blanks and with null for empty."""
    c = F.col(f"c{i}")
    if isinstance(field.dataType, T.StringType):
        return _from_cp1252(c) if cp1252 else c
    return F.nullif(F.trim(c), F.lit(""))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8"
) -> DataFrame:
    """Read with a fixed column count, then cast to ``schema``; a bad value is an error.

    Fields past the declared ones are dropped and short lines are filled with nulls; use
    ``AuditedCsv`` to have them counted. An
    empty field of a non-text column is null. Code page 1252 is read as ISO-8859-1, which
    Spark supports, and its 27 other characters are translated afterwards.
    """
    raw = _fields(spark, path, schema, encoding)
    cp1252 = _is_cp1252(encoding)
    return raw.select(
        *[_text_or_number(i, f, cp1252).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


class AuditedCsv:
    """An extract whose odd lines are counted by the very job that reads it.

    ``rows`` is the typed frame and has every line but empty ones: surplus fields are dropped, absent
    ones and values that do not fit their type are null. After one action has read it to the end,
    ``counts`` has the number of lines, of ``long`` and ``short`` ones (more or fewer fields
    than declared), of ``unreadable`` ones (a value does not fit its type) and of ``undecoded``
    ones (bytes that are no characters of the encoding); a line may be of several kinds.
    ``odd_lines`` reads the extract again and shows them. Counts are of the job that ran; do
    not take them from a frame that was filtered or limited before it was read to the end.
    """

    KINDS = ("long", "short", "unreadable", "undecoded")

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8"):
        self.path, self._seen = path, Observation()
        cp1252 = _is_cp1252(encoding)
        self._raw = _fields(spark, path, schema, encoding, audited=True)
        clean = [_text_or_number(i, f, cp1252) for i, f in enumerate(schema.fields)]
        typed = [_try_cast(c, f.dataType) for c, f in zip(clean, schema.fields)]
        self._kind = _line_kinds(schema, clean, typed, cp1252)
        counts = [F.count_if(is_kind).alias(kind) for kind, is_kind in self._kind.items()]
        observed = self._raw.observe(self._seen, F.count(F.lit(1)).alias("lines"), *counts)
        self.rows = observed.select(*[c.alias(f.name) for c, f in zip(typed, schema.fields)])

    def counts(self) -> dict[str, int]:
        return {kind: self._seen.get[kind] for kind in ("lines", *self.KINDS)}

    def verify(self, **most: int) -> None:
        """Raise MalformedLines if a kind occurs more often than allowed; by default, at all."""
        found = {k: n for k, n in self.counts().items() if k in self.KINDS and n > most.get(k, 0)}
        if found:
            raise MalformedLines(f"{self.path}: {found}")

    def odd_lines(self) -> DataFrame:
        """``(kinds, fields)``: the kinds of each odd line, and its fields as they were read.

        A line with another number of fields than declared is split at every comma.
        """
        kinds = F.array_compact(F.array(*[F.when(is_kind, kind) for kind, is_kind in self._kind.items()]))
        declared = F.array(*[F.col(c) for c in self._raw.columns if c != _LINE])
        fields = F.when(F.col(_LINE).isNull(), declared).otherwise(F.split(F.col(_LINE), ",", -1))
        return self._raw.select(kinds.alias("kinds"), fields.alias("fields")).where(F.size("kinds") > 0)


def _try_cast(c: Column, kind: T.DataType) -> Column:
    return c if isinstance(kind, T.StringType) else c.try_cast(kind)


def _line_kinds(
    schema: T.StructType, clean: list[Column], typed: list[Column], cp1252: bool
) -> dict[str, Column]:
    """A test for each kind of odd line; fields are not quoted, so their number is that of commas and one."""
    n_fields = F.size(F.split(F.col(_LINE), ",", -1))
    unfit = [v.isNotNull() & t.isNull() for v, t in zip(clean, typed)]
    declared = [F.col(f"c{i}") for i in range(len(schema.fields))]
    # In code page 1252, five bytes stand for nothing; in other encodings the reader puts U+FFFD.
    strange = "[\\x81\\x8d\\x8f\\x90\\x9d]" if cp1252 else "\ufffd"
    tests = {
        "long": n_fields > len(schema.fields),
        "short": n_fields < len(schema.fields),
        "unreadable": reduce(lambda a, b: a | b, unfit, F.lit(False)),
        "undecoded": F.concat_ws(",", F.coalesce(F.col(_LINE), F.lit("")), *declared).rlike(strange),
    }
    return {kind: F.coalesce(test, F.lit(False)) for kind, test in tests.items()}


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").option("header", True).option("quote", "").option(
        "encoding", encoding
    ).csv(path)
