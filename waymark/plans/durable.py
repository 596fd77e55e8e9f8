"""Durable cuts of lineage and iterative graph work, safe against lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a lookup side is broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000
#: Rows of a task whose work on a row costs far more than reading it.
TASK_ROWS = 5_000
#: More tasks than a step has.
MOST_TASKS = 1 << 24


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where nothing is set, a temporary one, which only a local master may use."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="waymark-checkpoint-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read again: computed once, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/waymark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def forget(*tables: DataFrame) -> None:
    """Delete tables of `written` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a lookup table for broadcast if a count shows that it has at most limit narrow rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(rows: DataFrame, many: int | None = None, each: int = TASK_ROWS) -> DataFrame:
    """rows dealt to tasks of about `each` rows (many: their number, where it is known), for work that costs far more a row than
    reading does. Without it a compact file is one task or a few, however many cores there are."""
    tasks = -(-(rows.count() if many is None else many) // each)
    return rows.repartition(tasks) if tasks > 1 else rows


def stepwise(rows: DataFrame) -> DataFrame:
    """rows as they are, handed on one by one: a task holds what an explode after this makes of one row. Without it two explodes
    run as one step, which holds all that both make of a row, and most of the time goes into that. Coalescing to more
    partitions than there are changes none."""
    return rows.coalesce(MOST_TASKS)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def value_at(counts: DataFrame, value: str, n: str, rank: Callable[[int], int]):
    """The value at a rank (from 1, a function of the number of all) of distinct values with their counts, in ascending order.

    Values are dealt to ranges; of each range only its number of values and their sum come to the driver, and only the range that
    holds the rank is counted through. None without values or for a rank beyond them. Null values are left out.
    """
    known = counts.where(F.col(value).isNotNull()).select(F.col(value).alias("v"), F.col(n).alias("n"))
    dealt = written(known.repartitionByRange("v").withColumn("range_", F.spark_partition_id()))
    totals = sorted(dealt.groupBy("range_").agg(F.sum("n")).collect())  # one row a range
    place, found = rank(sum(t[1] for t in totals)), None
    for part, many in totals:
        if 0 < place <= many:
            upto = F.sum("n").over(Window.orderBy("v"))
            found = dealt.where(F.col("range_") == part).withColumn("upto", upto).where(F.col("upto") >= place).agg(F.min("v")).first()[0]
            break
        place -= many
    forget(dealt)
    return found


def row_numbers(rows: DataFrame, order: list, name: str) -> DataFrame:
    """rows with a column of numbers 1, 2, 3 ... in the order, which should tell all rows apart.

    Rows are dealt to ranges and numbered inside them; a range goes on where those before it end. No task holds all rows.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()))
    sizes = dealt.groupBy("range_").agg(F.count("*").alias("many_"))  # one row a range
    begins = F.coalesce(F.sum("many_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    joined = dealt.join(F.broadcast(sizes.select("range_", begins.alias("begins_"))), "range_")
    return joined.withColumn(name, F.col("begins_") + place).select(*rows.columns, name)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large and small stars: rows (node, component), component the least node.

    edges holds long ids; self loops, repeats and nulls are ignored, an empty table gives an empty result.
    A node's neighbours are only ever reduced to their minimum (pre-aggregated before the shuffle). The minima are
    broadcast while a count of the edges shows that they are few; beyond that they are written before they are joined
    back, so that a hub's rows are no group of an aggregate in the join's own stage and Spark can split them. Each
    round is written to the shared folder, and what no later round reads is deleted.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    seen = mark(pairs)
    while seen[0]:
        few = 2 * seen[0] <= BROADCAST_ROWS
        cut, side = (lambda df: df, F.broadcast) if few else (written, small_side)
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")))
        large = both.join(side(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = large.join(side(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        kept = low.select("a", F.col("m").alias("b"))
        after = written(moved.unionByName(kept).distinct())
        forget(pairs, *([] if few else [least, large, low]))
        pairs, now = after, mark(after)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def first_seeds(pairs: DataFrame) -> DataFrame:
    """Greedy grouping in input order, as rounds: (member, seed) for pairs (i, j) with i < j.

    A row is a seed if no earlier adjacent row is one, else it belongs to its first adjacent seed. In each round
    the undecided rows without an undecided earlier neighbour become seeds and their neighbours are decided.
    """
    pairs = written(pairs.select("i", "j").distinct())
    open_ = written(pairs.select(F.col("i").alias("n")).union(pairs.select("j")).distinct())
    seeds = pairs.sparkSession.createDataFrame([], "n long")
    while not open_.isEmpty():
        now = open_
        live = pairs.join(open_.withColumnRenamed("n", "i"), "i", "left_semi").join(open_.withColumnRenamed("n", "j"), "j", "left_semi")
        new = written(open_.join(live.select(F.col("j").alias("n")).distinct(), "n", "left_anti"))
        decided = live.join(new.withColumnRenamed("n", "i"), "i", "left_semi").select(F.col("j").alias("n")).union(new).distinct()
        open_ = written(open_.join(decided, "n", "left_anti"))
        forget(now)
        seeds = seeds.union(new)
    taken = pairs.join(seeds.withColumnRenamed("n", "i"), "i", "left_semi").groupBy(F.col("j").alias("member")).agg(F.min("i").alias("seed"))
    return taken.unionByName(seeds.select(F.col("n").alias("member"), F.col("n").alias("seed")))
