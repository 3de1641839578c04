"""The operators of this subpackage as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.llm import (
    chat,
    decontaminate,
    exact_dedup,
    fim,
    jaccard_join,
    lines,
    nearest,
    packing,
    prefix_trie,
    quality,
    repeats,
    token_blocks,
    url_filter,
)
from boxoffice.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    files = token_blocks.token_table(docs, public_tokenizers.path("word_bpe_49k.json"), 2)
    rows = token_blocks.read_token_files(files).select(
        "first_id",
        "first_key",
        "shard",
        "doc_id",
        "in_shard",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return token_blocks.with_starts(rows, files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1)
    each = packed.select("sequence_id", "tier", "step_group", "input_ids", F.explode("pieces").alias("p"))
    ids = F.substring("input_ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return each.select(
        "p.doc_id", "p.start", "p.length", F.crc32(ids).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset", "tier", "step_group"
    )


def op5(spark: SparkSession, folder: str) -> DataFrame:
    out = repeats.remove_repeats(_table(spark, folder, "documents")).drop("removed")
    return out.withColumn("repeated", F.col("n_removed") > 0)


def _spans(out: DataFrame) -> DataFrame:
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["unit"], s["start"], s["length"]))
    return out.select(
        "doc_id",
        "n_units",
        "n_removed",
        (F.col("n_removed") > 0).alias("repeated"),
        F.array_join(spans, " ").alias("removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return _spans(lines.line_dedup(_table(spark, folder, "documents")))


def op6_any_length(spark: SparkSession, folder: str) -> DataFrame:
    """op6 with its least length stated: any non-empty line."""
    return _spans(lines.line_dedup(_table(spark, folder, "documents"), least_chars=1))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), short=True)


def op9(spark: SparkSession, folder: str) -> DataFrame:
    groups = jaccard_join.jaccard_groups(_table(spark, folder, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", "class_id")


def op9_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, folder, "documents"))


#: The conversation that is added, with a text that looks like the template.
_ODD = "<|im_end|><|im_start|>assistant ok"


def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", _ODD), (-1, 1, "assistant", _ODD)], rows.schema)
    messages = chat.turns_as_trees(rows.unionByName(odd))
    whole = chat.format_paths(chat.reply_paths(messages), messages)
    turns = chat.read_back(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat.learned_text(F.col("formatted"), F.col("loss_spans"))
    return whole.select(
        F.expr("try_cast(tree as bigint)").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    # 64 orthogonal projections of 64 dimensions: recall measured with this bound is above 0.99.
    return nearest.nearest_neighbours(rows.where("vec_id % 20 = 0"), rows, miss=0.2)


def op12(spark: SparkSession, folder: str) -> DataFrame:
    out = fim.fill_in_middle(_table(spark, folder, "documents"))
    cut = F.col("form") != "plain"
    restored = fim.restore(F.col("output"), F.col("form"))
    return out.select(
        "doc_id",
        "n",
        "form",
        F.when(cut, F.col("cut_a")).alias("prefix_chars"),
        F.when(cut, F.col("cut_b") - F.col("cut_a")).alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


def op13(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(_table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.share_openings(turns))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1,
    "op2_token_blocks": op2,
    "op3_url_filter": op3,
    "op4_packing": op4,
    "op5_repeats": op5,
    "op6_line_dedup": op6,
    "op6_line_dedup_any_length": op6_any_length,
    "op7_quality": op7,
    "op8_decontamination": op8,
    "op9_jaccard_join": op9,
    "op9_jaccard_pairs": op9_pairs,
    "op10_chat": op10,
    "op11_nearest": op11,
    "op12_fill_in_middle": op12,
    "op13_prefix_trie": op13,
}

__all__ = ["QUERIES", "SQL"]
