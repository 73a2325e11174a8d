"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

DataFrame functions only.  Each level reads the text column in a scan and moves
only narrow keys:

1. lengths that occur more than once,
2. for texts of those lengths, the hash of a prefix; the (length, prefix hash) pairs that occur more than once,
3. for texts of those pairs, SHA-256 of the whole text.

What one level tells the next is a set of at most ``2 ** bits`` hash buckets, so the
broadcast side has a bound whatever the data.  Two keys in one bucket only let a text
through to the next, exact level.  Level 3 groups with partial aggregation, so a group
of copies that holds a third of all rows is one row a task before the shuffle; the way
back from groups to rows is a plain equi-join on a written table, which adaptive
execution splits or broadcasts.

Defined results: null text counts as empty; empty texts form one group; an empty table
gives an empty result; of rows that share text *and* id exactly one stays; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import free_names, materialize, read_table, texts


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 128, bits: int = 20, digest_all: bool = False) -> DataFrame:
    """Rows (doc_id, rid, keep_id, group_size, kept, digest); one for each input row.

    digest is the SHA-256 of texts that reached level 3, and of all texts with digest_all.
    rid numbers the rows and is what ties between repeated ids are settled by.
    """
    rows = texts(docs, id_col, text_col)
    slots = 1 << bits
    length = F.octet_length("text")
    prefix = F.xxhash64(F.substring("text", 1, prefix_chars))

    again = rows.groupBy(length.alias("n")).agg(F.count("*").alias("c")).filter("c > 1")
    by_length = again.select(F.pmod(F.col("n"), F.lit(1 << 16)).cast("int").alias("slot")).distinct()
    sized = rows.withColumn("slot", F.pmod(length, F.lit(1 << 16)).cast("int"))
    sized = sized.join(F.broadcast(by_length), "slot", "left_semi")
    pairs = sized.groupBy(length.alias("n"), prefix.alias("p")).agg(F.count("*").alias("c")).filter("c > 1")
    by_prefix = pairs.select(F.pmod(F.xxhash64("n", "p"), F.lit(slots)).cast("int").alias("slot")).distinct()

    full = F.sha2(F.col("text"), 256)
    scan = rows.select("doc_id", F.monotonically_increasing_id().alias("rid"), length.alias("n"), prefix.alias("p"), "text")
    scan = scan.withColumn("slot", F.pmod(F.xxhash64("n", "p"), F.lit(slots)).cast("int"))
    scan = scan.join(F.broadcast(by_prefix.withColumn("again", F.lit(True))), "slot", "left")
    digest = full if digest_all else F.when(F.col("again"), full)
    keyed = materialize(scan.select("doc_id", "rid", F.coalesce("again", F.lit(False)).alias("again"), "n", digest.alias("digest")), "exact_keys")

    groups = keyed.filter("again").groupBy("n", "digest").agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size"))
    # written, so that the join below deals both sides out itself and can split a hot group
    groups = materialize(groups.filter("group_size > 1"), "exact_groups")
    alone = keyed.filter("NOT again").select(
        "doc_id", "rid", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    grouped = keyed.filter("again").join(groups, ["n", "digest"], "left")
    grouped = grouped.select(
        "doc_id",
        "rid",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep").isNull() | F.struct("doc_id", "rid").eqNullSafe(F.col("keep"))).alias("kept"),
        "digest",
    )
    return alone.unionByName(grouped)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns.

    Dropped rows are found by (id, text digest), so rows that repeat an id with another text are safe;
    of rows that repeat both, one stays.
    """
    marked = refine(docs, id_col, text_col)
    gone, hashed, rid, first = free_names(docs, "gone", "digest", "rid", "first")
    dropped = marked.filter("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    if not _repeats(marked):
        return docs.join(dropped, docs[id_col].eqNullSafe(F.col(gone)), "left_anti")
    # ids repeat: decide by text as well
    digest = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    kept = materialize(docs.withColumn(hashed, digest).withColumn(rid, F.monotonically_increasing_id()), "repeated_rows")
    groups = kept.groupBy(hashed).agg(F.max(F.struct(F.col(id_col), rid)).alias(first)).select(F.col(f"{first}.{rid}").alias(rid))
    return kept.join(groups, rid, "left_semi").drop(hashed, rid)


def _repeats(marked: DataFrame) -> bool:
    """Whether some id occurs twice."""
    return bool(marked.groupBy("doc_id").count().filter("count > 1").limit(1).count())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = refine(read_table(spark, sf_dir, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
