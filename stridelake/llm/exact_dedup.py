"""Exact deduplication by two-pass Bloom filtering.

Pass one marks two slots per document in a filter of blocks and keeps the slots
that were hit twice, as one bitmap a block. Pass two tests every document against
its block: a document whose two slots were not both hit twice is certainly alone
and passes straight through; only the others shuffle, by their digest. Groups
that hold a large share of those are joined map-side, so that no task gathers one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, quoted, table

#: Filter slots per document. The filter grows with the documents, without a cap.
SLOTS_PER_ROW = 16
#: Slots in a block, whose bitmap is 4 KB. Both slots of a document lie in one block.
BLOCK = 32768
#: Blocks, 256 MB of them, that are broadcast at once. A larger filter goes range of blocks by range of blocks, each in a
#: scan of its own, so the documents are never dealt out by block.
BROADCAST_BLOCKS = 1 << 16
#: Groups with more than one in so many of the shuffled rows are hot; there are fewer than this.
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def filter_blocks(n_rows: int) -> int:
    """Blocks that give each row its slots."""
    return -(-max(1, n_rows) * SLOTS_PER_ROW // BLOCK)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hashed, 30), F.lit(blocks))


def _places(hashed: Column) -> tuple[Column, Column]:
    """The two slots of a hash in its block."""
    return hashed.bitwiseAND(F.lit(BLOCK - 1)), F.shiftrightunsigned(hashed, 15).bitwiseAND(F.lit(BLOCK - 1))


def repeated_slots(hashes: DataFrame, hashed: Column, blocks: int) -> DataFrame:
    """Bitmaps (block, bits) of the filter slots that two or more rows hit."""
    hits = hashes.select(_block(hashed, blocks).alias("block"), F.explode(F.array(*_places(hashed))).alias("place"))
    twice = hits.groupBy("block", "place").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def flag_possible(rows: DataFrame, hashed: str, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """Add ``possible``: whether both slots of the row were hit twice. No row is shuffled, at any size of the filter."""

    def hit(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("__bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2.0), place.bitwiseAND(F.lit(7)))), F.lit(2)) == 1, F.lit(False))

    one, two = _places(F.col(hashed))
    own, out = _block(F.col(hashed), blocks), None
    for low in range(0, blocks, BROADCAST_BLOCKS):
        high = low + BROADCAST_BLOCKS
        side = bitmaps.filter((F.col("block") >= low) & (F.col("block") < high)).select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
        some = rows if blocks <= BROADCAST_BLOCKS else rows.filter((own >= low) & (own < high))
        joined = some.join(F.broadcast(side), own == F.col("__block"), "left")
        flagged = joined.withColumn("possible", hit(one) & hit(two)).drop("__block", "__bits")
        out = flagged if out is None else out.unionByName(flagged)
    return out


def with_groups(rows: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Join each row to its key's row of ``groups`` (with ``size``), without gathering a hot key's rows.

    ``groups`` and ``rows`` are stored tables. Sizes add up to the rows, so fewer
    than ``HOT_SHARE`` keys are hot, which bounds the broadcast.
    """
    total = groups.agg(F.sum("size")).head()[0] or 0
    is_hot = F.col("size") * HOT_SHARE > total
    if not total or groups.filter(is_hot).isEmpty():
        return rows.join(groups, key)
    hot = F.broadcast(groups.filter(is_hot))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(groups.filter(~is_hot), key))


def decisions(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fate of every row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest id stays; a null id comes
    last, and of rows that share an id one stays. A null text is an empty one.
    An empty table gives no rows; other columns are not read.
    """
    hashed = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
    )
    hashed = scratch.save(hashed.withColumn("h", F.xxhash64("text_sha256")), "hashes")
    blocks = filter_blocks(hashed.count())
    flagged = flag_possible(hashed, "h", scratch.save(repeated_slots(hashed, F.col("h"), blocks), "filter"), blocks)
    alone = flagged.filter(~F.col("possible")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row_no").alias("row_no"))
    some = scratch.save(flagged.filter("possible").select("text_sha256", "doc_id", "row_no"), "possible")
    groups = scratch.save(some.groupBy("text_sha256").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size")), "groups")
    grouped = with_groups(some, "text_sha256", groups).select(
        "doc_id", F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("first.row_no") == F.col("row_no")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


def exact_dedup(docs: DataFrame, scratch: Scratch | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever those are called and of any type.

    The rows are stored with their digest once, each as one struct, so no name
    can clash. Rows that the filter clears never shuffle. Of a possible group one
    whole row is chosen map-side first, so that a group of any size sends one row
    per task. Nulls and ties are as in ``decisions``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    whole = F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")
    keyed = docs.select(whole, F.monotonically_increasing_id().alias("row_no"), F.unhex(F.sha2(normalised(F.col(quoted(text))), 256)).alias("sha"))
    keyed = scratch.save(keyed.withColumn("h", F.xxhash64("sha")), "rows")
    blocks = filter_blocks(keyed.count())
    flagged = flag_possible(keyed, "h", scratch.save(repeated_slots(keyed, F.col("h"), blocks), "filter"), blocks)
    identity = F.col("row").getField(doc_id)
    chosen = flagged.filter("possible").groupBy("sha").agg(F.min_by("row", F.struct(identity.isNull(), identity, "row_no")).alias("row"))
    return flagged.filter("not possible").select("row.*").unionByName(chosen.select("row.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions for every row of ``documents``."""
    return decisions(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
