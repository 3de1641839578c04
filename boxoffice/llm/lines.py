"""Repeated lines or paragraphs, found by the digest of a normalised unit.

Units are lines (or paragraphs: runs of lines between blank ones). A unit is normalised by
lower-casing A-Z, by turning every run of ``[\\x20\\x09-\\x0D]`` into one space and trimming;
units that are empty then (or shorter than ``least_chars``) are never removed. Of the occurrences of a
digest the earliest (smallest document id, then place) stays, also within a document.

Scale. Only digests, ids and places are shuffled, not texts. The earliest occurrence and the
count of a digest are aggregated on the map side, so a line that many documents have is a row
per task; digests that occur once are dropped before the join that marks the others, and that
join may be split by adaptive execution where one line holds many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text, row_key

#: Fixed value: what separates units.
SEPARATORS = {"line": "\n", "paragraph": "\n\n"}


def normalised(unit: Column) -> Column:
    lower = F.translate(unit, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "))


def line_dedup(
    docs: DataFrame,
    unit: str = "line",
    least_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_units, n_removed, removed, kept_text.

    ``removed`` lists (unit, start, length) in code points of the original text, ascending;
    ``kept_text`` is the other units joined by the separator. A null text is empty and has
    one empty unit. Rows with equal id and text are one document and get the same result, a
    row each. Null ids rank after all others; documents of one id rank by a hash of their
    text. An empty table gives an empty result. Other columns are not read.
    """
    mark = SEPARATORS[unit]
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), row_key().alias("row")
    )
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "unit")
    units = (
        rows.select("doc_id", "row", F.posexplode(F.split("text", mark)).alias("unit", "words"))
        .select("doc_id", "row", "unit", normalised(F.col("words")).alias("words"))
        .where(F.length("words") >= least_chars)
        .select("doc_id", "row", "unit", F.unhex(F.md5("words")).alias("digest"))
    )
    # Repeated rows must not make a digest look repeated, so ranks are compared, not counted.
    ends = units.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
    repeated = ends.where("first != last").select(F.col("digest").alias("d"), "first")
    later = units.join(repeated, F.col("digest") == F.col("d")).where(rank != F.col("first"))
    gone = later.groupBy("doc_id", "row").agg(F.collect_set("unit").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("g_doc"), F.col("row").alias("g_row"), "gone")
    same = (F.col("row") == F.col("g_row")) & F.col("doc_id").eqNullSafe(F.col("g_doc"))
    marked = rows.join(gone, same, "left").select(
        "doc_id",
        F.split("text", mark).alias("units"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
    )
    place = F.transform("units", lambda u, i: F.struct(i.alias("unit"), F.length(u).alias("length"), u.alias("u")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<unit:int,start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        span = F.struct(x["unit"].alias("unit"), state["at"].alias("start"), x["length"].cast("long").alias("length"))
        spans = F.when(F.array_contains("gone", x["unit"]), F.concat(state["spans"], F.array(span)))
        after = state["at"] + x["length"].cast("long") + F.lit(len(mark))
        return F.struct(after.alias("at"), spans.otherwise(state["spans"]).alias("spans"))

    left = F.filter("units", lambda u, i: ~F.array_contains("gone", i))
    return marked.select(
        "doc_id",
        F.size("units").cast("long").alias("n_units"),
        F.size("gone").cast("long").alias("n_removed"),
        F.when(F.size("gone") == 0, start["spans"]).otherwise(F.aggregate(place, start, step)["spans"]).alias("removed"),
        F.when(F.size("gone") == 0, F.array_join("units", mark)).otherwise(F.array_join(left, mark)).alias("kept_text"),
    )
