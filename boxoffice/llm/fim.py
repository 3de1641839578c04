"""Fill-in-the-middle order for whole texts, cut by a counted-quantifier pattern.

``regexp_count`` gives the number of units (by default: code points) of a text, hashes of the
document's id give two cut points a <= b, and one pattern per row, with the possessive groups
``(?:unit){a}+`` and ``(?:unit){b-a}+``, captures prefix, middle and suffix in a single match,
which the replacement writes in the order of the row's form. The units are counted in runs of 256 first, so that
counting makes one match per run and not one per unit.

Forms: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``,
``plain`` is the text itself: texts that are empty or hold one of the marks, and a share of all
documents. A text without marks cannot form one where it meets a mark, because every mark
begins with ``<`` and has it nowhere else; so the first marks found are the ones written.

Scale. Every row is made on its own: no shuffle, no Python, no state. Possessive runs of a
plain unit are matched in a loop, so the depth of the stack does not follow the text.

Odd rows. A null text is empty. A null id is hashed as no digits (``1:``). Repeated rows are
made alike, each for itself. Further columns are not read, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: One code point, line ends included.
CODE_POINT = "(?s:.)"

_RUN = 256


def unit_count(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units follow each other from the start of ``text``: full runs, then the rest."""
    rest = F.regexp_extract(text, f"(?s)\\A(?:{unit}{{{_RUN}}}+)*+(.*+)\\z", 1)
    runs = F.regexp_count(text, F.lit(f"{unit}{{{_RUN}}}+"))
    return (runs * F.lit(_RUN) + F.regexp_count(rest, F.lit(unit))).cast("long")


def _hash_groups(doc_id: Column, seed: str) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = CODE_POINT,
    plain_percent: int = 10,
    spm_percent: int = 20,
    seed: str = "1:",
) -> DataFrame:
    """doc_id, text, n, cut_a, cut_b, form, output: one row per document.

    ``n`` counts units; the prefix holds ``cut_a`` of them and prefix and middle together
    ``cut_b``. ``unit`` is a pattern of one unit without groups that matches everywhere in a
    text, as ``(?s:.)`` does; units are taken from the left. ``plain_percent`` of the documents stay
    as they are, and ``spm_percent`` of the others take the order suffix, prefix, middle.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    h = _hash_groups(F.col("doc_id"), seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    cut = (
        rows.withColumn("n", unit_count(F.col("text"), unit))
        .withColumn("_x", h[0] % (F.col("n") + 1))
        .withColumn("_y", h[1] % (F.col("n") + 1))
        .withColumn("form", F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
        .withColumn("cut_a", F.least("_x", "_y"))
        .withColumn("cut_b", F.greatest("_x", "_y"))
    )
    pattern = F.concat(
        F.lit(f"(?s)\\A((?:{unit}){{"), F.col("cut_a").cast("string"),
        F.lit(f"}}+)((?:{unit}){{"), (F.col("cut_b") - F.col("cut_a")).cast("string"),
        F.lit("}+)(.*+)\\z"),
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cut.withColumn("output", output).select("doc_id", "text", "n", "cut_a", "cut_b", "form", "output")


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from, found from its form alone."""
    psm = F.regexp_replace(output, F.lit(f"(?s)\\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)\\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\\z"), F.lit("$2$3$1"))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)
