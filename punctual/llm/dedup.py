"""Exact deduplication: a Bloom filter of what occurs twice decides which rows have to shuffle.

Pass 1 fills a blocked Bloom filter. Every text sets three bits of one 64-bit word, and only the
bits that at least two rows have set are kept. Pass 2 tests every row against it: a row that misses
one of its bits has no copy and passes straight through; the others shuffle on their full digest,
which settles the false alarms. The filter has 16 bits a row, so it grows with the input. It is
broadcast while its measured size allows it and joined by its word beyond that. All this is done on
narrow rows: pass 1 shuffles a word and a mask per row, and beyond the broadcast pass 2 an id and a digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BLANKS, broadcast_if_small, join_counted, text_or_empty, written

BITS_PER_ROW = 16


def normalised(text: str | Column) -> Column:
    """The text with each run of white space as one space; null is the empty text."""
    return F.regexp_replace(text_or_empty(text), f"[{BLANKS}]+", " ")


def text_digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _place(df: DataFrame, words: int) -> DataFrame:
    """The word of the filter and the three bits in it that the digest of a row stands for."""
    h = F.xxhash64("digest")
    bits = [f"shiftleft(1L, cast(shiftrightunsigned(h, {s}) & 63 as int))" for s in (0, 6, 12)]
    return (
        df.withColumn("h", h)
        .withColumn("word", F.expr(f"shiftrightunsigned(h, 18) & {words - 1}L"))
        .withColumn("mask", F.expr(" | ".join(bits)))
        .drop("h")
    )


def repeated_bits(digests: DataFrame) -> DataFrame:
    """Pass 1: (word, twice), the bits that two or more rows of ``digests`` (digest) set."""
    words, rows = 1, digests.count()
    while words * 64 < rows * BITS_PER_ROW:
        words *= 2
    masks = _place(digests.select("digest"), words).groupBy("word", "mask").agg(F.count("*").alias("n"))
    # at most one entry for each three-bit mask, about four of them on average
    per_word = masks.groupBy("word").agg(F.collect_list(F.struct("mask", "n")).alias("masks"))
    twice = F.expr(
        "aggregate(masks, named_struct('once', 0L, 'twice', 0L),"
        " (s, x) -> named_struct('once', s.once | x.mask,"
        " 'twice', s.twice | (s.once & x.mask) | if(x.n > 1, x.mask, 0L)), s -> s.twice)"
    )
    kept = per_word.select("word", twice.alias("twice")).where("twice <> 0")
    filled = written(kept, "bloom")
    return broadcast_if_small(filled, filled.count()), words


def _tested(df: DataFrame, bloom: tuple[DataFrame, int]) -> DataFrame:
    """Pass 2: ``df`` (with digest) and whether its row may have a copy."""
    bits, words = bloom
    hit = F.coalesce(F.col("twice").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return _place(df, words).join(bits, "word", "left").withColumn("maybe", hit).drop("word", "mask", "twice")


def _groups(maybe: DataFrame) -> DataFrame:
    """(digest, first, n) of the texts that really occur more than once."""
    return (
        maybe.groupBy("digest")
        .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_no")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of white space became one space; null
    equals the empty text. Of equal texts the row with the smallest id stays; a null id counts as
    larger than any other. Of rows that share text and id, exactly one is kept. Other columns of
    ``docs`` are ignored, whatever their names. An empty table gives an empty result.
    """
    rows = written(
        docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
        .withColumn("row_no", F.monotonically_increasing_id()),
        "digests",
    )
    tested = _tested(rows, repeated_bits(rows))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    alone = tested.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest
    )
    maybe = written(tested.where("maybe"), "maybe_copies")
    groups = written(_groups(maybe), "copy_groups")
    decided = join_counted(maybe, groups, "digest", "n", maybe.count()).select(
        "id",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("first.row_no") == F.col("row_no"), F.lit(True)).alias("kept"),
        digest,
    )
    return alone.unionByName(decided)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in ``copies``.

    Both passes and the digests that really repeat are settled on narrow rows (id, digest). The rows with their texts
    then meet only these digests. Up to a million of them are broadcast, and a row without a copy stays
    where it is; with more, texts are shuffled by their digest.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        text_digest(text_col).alias("digest"),
    )
    rows = written(packed.select("id", "digest"), "digests")
    maybe = _tested(rows, repeated_bits(rows)).where("maybe").withColumn("row_no", F.lit(0))
    groups = written(_groups(maybe).select("digest", "first"), "copy_groups")
    met = packed.join(broadcast_if_small(groups, groups.count()), "digest", "left")
    alone = met.where("first is null").select("row")
    # rows that share text and id are told apart by nothing else: one of them is taken
    chosen = met.where("first is not null and id <=> first.id").select("digest", "row").dropDuplicates(["digest"])
    return alone.unionByName(chosen.select("row")).select("row.*")
