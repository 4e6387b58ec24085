"""Set operations and comparison of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with their surplus, that one side has more often than the other.

    Both sides are counted per distinct row in one pass; combining before the shuffle keeps
    a row repeated many times cheap.
    """
    cols = left.columns
    marked = left.withColumn("__n", F.lit(1)).unionByName(right.select(*cols).withColumn("__n", F.lit(-1)))
    return marked.groupBy(*cols).agg(F.sum("__n").alias("surplus")).filter("surplus <> 0")


FAN, DEPTH = 256, 2


def row_hash(columns: list[str], seed: str) -> Column:
    """64 bits of a row; a NULL counts, so (NULL, 1) and (1, NULL) differ."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def digest_bucket(columns: list[str], level: int = DEPTH) -> Column:
    """Bucket of a row at a level of the tree: rows that are equal are in one bucket, at every level."""
    leaf = F.pmod(row_hash(columns, "bucket"), F.lit(FAN**DEPTH)).cast("int")
    return F.floor(leaf / FAN ** (DEPTH - level)).cast("int")


def digest_tree(df: DataFrame) -> DataFrame:
    """(level, bucket, n, total, mixed): rows of every bucket and two order-free digests of them, levels 0 to DEPTH.

    One pass without a shuffle of rows: a task folds its rows to at most FAN^DEPTH buckets. A tree may be stored with its
    table and compared later without reading a row.
    """
    hashed = df.select(digest_bucket(df.columns).alias("leaf"), row_hash(df.columns, "a").alias("a"), row_hash(df.columns, "b").alias("b"))
    leaves = hashed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("total"), F.expr("sum(cast(b as decimal(20,0)) * (b % 1009))").alias("mixed"))
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("leaf") / FAN ** (DEPTH - k)).cast("int").alias("bucket")) for k in range(DEPTH + 1)]))
    return leaves.select(levels.alias("at"), "n", "total", "mixed").groupBy("at.level", "at.bucket").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("mixed").cast("decimal(38,0)").alias("mixed"))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(bucket) of the last level in which two digest trees differ, from the root down: below equal buckets nothing is compared."""
    above = None
    for level in range(DEPTH + 1):
        a, b = (t.filter(F.col("level") == level).drop("level") for t in (left, right))
        if above is not None:
            parents = above.select(F.col("bucket").alias("parent"))
            a, b = (t.join(parents, F.floor(F.col("bucket") / FAN).cast("int") == F.col("parent"), "left_semi") for t in (a, b))
        b = b.select("bucket", *[F.col(c).alias(f"r_{c}") for c in ("n", "total", "mixed")])
        same = F.col("n").eqNullSafe(F.col("r_n")) & F.col("total").eqNullSafe(F.col("r_total")) & F.col("mixed").eqNullSafe(F.col("r_mixed"))
        above = a.join(b, "bucket", "full_outer").filter(~same).select("bucket")
    return above


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """`row_differences`, for tables that differ in little: only rows in buckets with different digests are shuffled.

    Equal digests of 2 x 64 bits and equal counts are taken for equal rows. The buckets are at most FAN^DEPTH numbers.
    """
    from ..sources.scratch import materialize

    right = right.select(*left.columns)
    trees = [materialize(digest_tree(t), "digests") for t in (left, right)]
    differ = materialize(differing_buckets(*trees), "differing-buckets")
    bucket = digest_bucket(left.columns)
    own = [t.withColumn("__bucket", bucket).join(differ, F.col("__bucket") == F.col("bucket"), "left_semi").drop("__bucket") for t in (left, right)]
    return row_differences(*own)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows the same number of times."""
    return set(left.columns) == set(right.columns) and row_differences(left, right).isEmpty()


def top_n(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The n keys with the largest total; ties go to the smaller key."""
    totals = df.groupBy(key).agg(F.sum(measure).alias("total"))
    return totals.orderBy(F.desc("total"), key).limit(n)


def top_n_present(df: DataFrame, key: str, measure: str, n: int, dim: DataFrame) -> DataFrame:
    """Top n first, then only those the dimension knows: may be fewer than n."""
    return top_n(df, key, measure, n).join(dim.select(key), key, "left_semi")


def ranked_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with a rank by size, for columns of few values (segments, types).

    The rank orders one row per value; `windows.prefix_sum` ranks columns of many values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("size_rank", F.row_number().over(Window.orderBy(F.desc("n"), column)).cast("bigint"))
