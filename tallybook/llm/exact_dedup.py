"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Each block gets an integer name, then each pair
of neighbouring names gets one, and so on, until one name is left. A name is the smallest row number
that has this content at this place, so equal names mean equal content and nothing can collide: the
last name of a document is the smallest document equal to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import collapsed, cut, free_name, with_row

BLOCK_BYTES = 4096


def block_names(
    rows: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """(_row, name) for (_row, _text): rows have equal names exactly if their texts are equal.

    The text crosses the network once, to group equal blocks at a place. Their names go back to the rows
    by the block's fingerprint; fingerprints that different blocks share are resolved by the blocks.
    """
    data = F.col("_text").cast("binary")
    size = F.octet_length("_text")
    blocks = F.greatest(F.ceil(size / block_bytes), F.lit(1)).cast("int")
    whole = rows.select("_row", data.alias("_data"), blocks.alias("blocks"))
    level = whole.select(
        "_row", "blocks", "_data", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("place")
    ).select(
        "_row",
        "blocks",
        "place",
        F.expr(f"substring(_data, place * {block_bytes} + 1, {block_bytes})").alias("block"),
    ).withColumn("print", fingerprint(F.col("block")))
    key = ["blocks", "place", "print"]
    exact = level.groupBy(*key, "block").agg(F.min("_row").alias("name"))
    names = cut(
        exact.groupBy(*key).agg(F.min("name").alias("name"), F.count("*").alias("contents")), "block-names"
    )
    placed = level.select("_row", *key).join(names, key)
    named = placed.where("contents = 1").select("_row", "blocks", "place", "name")
    shared = names.where("contents > 1").select(*key)
    if not shared.isEmpty():
        resolved = (
            level.join(shared, key, "left_semi")
            .join(exact.join(shared, key, "left_semi"), [*key, "block"])
            .select("_row", "blocks", "place", "name")
        )
        named = named.unionByName(resolved)
    named = cut(named, "named")
    done = named.where("blocks = 1").select("_row", "name")
    most = named.agg(F.max("blocks")).first()[0] or 1
    left, length = named.where("blocks > 1"), most
    while length > 1:
        # Neighbours meet by grouping: two names of one row at most.
        pairs = cut(
            left.groupBy("_row", "blocks", F.shiftright("place", 1).alias("place")).agg(
                F.min(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
                F.coalesce(F.min(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
            ),
            "pairs",
        )
        key = ["blocks", "place", "first", "second"]
        names = cut(pairs.groupBy(*key).agg(F.min("_row").alias("name")), "pair-names")
        left = cut(pairs.join(names, key).select("_row", "blocks", "place", "name"), "named-pairs")
        length = (length + 1) // 2
        # Documents of fewer blocks keep naming themselves with nothing beside until the longest is done.
    return done.unionByName(left.select("_row", "name")) if most > 1 else done


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Each row with its group of equal texts.

    Adds ``keep_id`` (smallest id of the group), ``group_size``, ``kept`` and ``text_sha256`` to ``id_col``;
    other columns are left out. Texts are equal when they are identical after runs of white space become one
    space; null counts as empty. One row of each group is kept: of the smallest id, and of rows that repeat
    this id the first one numbered. Ids that are null sort last; a group without any other has a null
    ``keep_id``. An empty table gives an empty result. Hot groups: texts combine per task before the
    shuffle, and names return by joins whose hot keys Spark splits.
    """
    rows, _ = with_row(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw")), "_id", "_row")
    rows = rows.withColumn("_text", collapsed(F.col("_raw")))
    names = cut(block_names(rows.select("_row", "_text"), block_bytes, fingerprint), "identities")
    light = rows.select("_row", "_id", F.sha2("_text", 256).alias("text_sha256"))
    own = cut(light.join(names, "_row"), "own-identity")
    order = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    groups = cut(
        own.groupBy("name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups"
    )
    return own.join(groups, "name").select(
        F.col("_id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        F.col("_row").alias("row_number"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept row of each group of equal texts, with all columns of ``docs`` under their own names.

    Of a group stays the row with the smallest id, null ids last; of rows that share it the first one
    numbered. Null counts as empty, and runs of white space as one space. An empty table stays empty.
    """
    number = free_name(docs.columns, "row_number")
    rows, _ = with_row(docs, id_col, number)
    texts = rows.select(F.col(number).alias("_row"), F.col(id_col).alias("_id"), collapsed(F.col(text_col)).alias("_text"))
    names = block_names(texts.select("_row", "_text"))
    order = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    own = cut(texts.select("_row", "_id").join(names, "_row"), "own-identity")
    kept = own.groupBy("name").agg(F.min(order)["row"].alias("_row"), F.count("*").alias("rows")).where("rows > 1")
    # Rows that go are far fewer than rows that stay, so they are what meets the texts.
    several = own.join(kept.select("name", F.col("_row").alias("first")), "name").where("_row <> first")
    dropped = cut(several.select(F.col("_row").alias(number)), "dropped")
    return rows.join(dropped, number, "left_anti").select(*(rows[c] for c in docs.columns))
