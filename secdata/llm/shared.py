"""What several operators need: tables that cut lineage, joins that stand hot keys, the number of reducers, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    Only a local session may do without, as in tests: it gets a temporary folder. On a cluster that would be each machine's own disk, so it is an error.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: a folder that all executors share is needed")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir().rstrip("/")


def settle(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there; its lineage ends. ``by``: columns that become folders, so that filters on them skip the rest."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4()}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.settled_at = path
    return made


def release(*tables: DataFrame) -> None:
    """Deletes settled tables. What was made from them must have been settled before."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.settled_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: So many narrow rows may meet in one task.
HOT_ROWS = 100_000


def reducers(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_hot(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", parts: int = 1000) -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each ``key``. Keys with more than a ``parts``-th of the rows (there are fewer than ``parts``) get their
    row of ``table`` by broadcast, so that no task reads more than that part for one key. Up to ``HOT_ROWS`` rows one task may have whole. ``rows`` is read three times: settle it before.
    """
    least = rows.count() // parts
    if least * parts < HOT_ROWS:
        return rows.join(table, key, how)
    hot = settle(rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > least).select(key))
    if hot.isEmpty():
        return rows.join(table, key, how)
    mine = F.broadcast(table.join(F.broadcast(hot), key, "left_semi"))
    return rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how).unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(mine, key, how))


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b): one settled row (node, root) per node with an edge; root is the smallest node.

    Alternates the large-star and small-star steps, whose rounds grow with the logarithm of the longest path. A round only
    takes minima per node and joins them back, so no neighbourhood is ever gathered in one place; the few nodes with more than a thousandth of the edges get their minimum by broadcast.
    A round's table is deleted when the next one is written.
    """
    edges = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    state = edges.agg(*mark).first()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
        up = both.where("b > a")
        hot = settle(low.where(F.col("n") > state[0] // 500).drop("n")) if state[0] > HOT_ROWS else None
        if hot is None:
            large = up.join(low.drop("n"), "a")
        else:
            large = up.join(F.broadcast(hot), "a", "left_anti").join(low.drop("n"), "a").unionByName(up.join(F.broadcast(hot), "a"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Here a node only meets its smaller neighbours, which the step before has cut to a few: a window holds them in one shuffle.
        small = large.withColumn("m", F.min("b").over(Window.partitionBy("a"))).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = settle(small.where("a <> b").distinct())
        release(edges, *([hot] if hot is not None else []))
        edges, old, state = after, state, after.agg(*mark).first()
        if state == old:
            break
    roots = settle(edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
    release(edges)
    return roots


#: Rounds, at most, and classes in a block of one signature (``star_links``).
ROUNDS, BLOCK = 3, 8


def star_links(posts: DataFrame, known: DataFrame, traits: list[str], near: Callable[[str, str], F.Column], tests: Callable[[DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Pairs (a, b) of classes that connect what all similar pairs with a shared signature connect: each class with the root of its first component, and further links.

    posts: settled (sig, class, up, leader, c), where leader is the signature's smallest upper class, c its number of classes, and a pair counts if at least one side is
    up; for c = 2 the row of the leader may be left out. known: (class, *traits, ...) of all classes in posts; near(x, y): a condition on the
    traits of two aliased rows that holds for all similar pairs; tests(classes) prepares an exact test pairs -> similar pairs for those classes.

    The leader of a signature is compared with its other classes. Then, in rounds, the classes of each signature are dealt to blocks of about ``BLOCK`` by a hash, and pairs of a block
    in different components are compared, until most such pairs aren't similar: a group of similar classes grows together at a few comparisons a class, and isn't expanded into its pairs.
    What is left, all pairs of one signature in *different* components, is compared at last: all against those outside the signature's largest component. So no link is lost.
    """
    known = known.select("class", *traits)
    all_stars = settle(posts.where("class <> leader").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct())
    x, y = known.select(F.col("class").alias("a"), F.struct(*traits).alias("x")), known.select(F.col("class").alias("b"), F.struct(*traits).alias("y"))
    stars = settle(join_hot(all_stars, x, "a").join(y, "b").where(near("x", "y")).select("a", "b"))
    release(all_stars)

    # Signatures of three classes or more may hold further pairs.
    wide = settle(posts.where("c > 2").select("sig", "class", "up").join(known, "class"))
    x, y = wide.alias("x"), wide.alias("y")
    semi = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.class") != F.col("y.class")) & (F.col("x.up") | F.col("y.up")) & near("x", "y"), "left_semi")
    needed = settle(semi.select("class").union(stars.select(F.explode(F.array("a", "b")).alias("class"))).distinct())
    similar = tests(needed)

    links = settle(similar(stars))
    roots = connected(links)
    release(links)
    placed = settle(wide.join(needed, "class", "left_semi"))
    release(wide)

    def opened() -> DataFrame:
        """The classes of the signatures that still join several components, with their root, the largest component there (main) and the number of classes (c)."""
        rooted = placed.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        sizes = rooted.groupBy("sig", "root").agg(F.count("*").alias("c"))
        split = sizes.groupBy("sig").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("c"), F.count("*").alias("roots")).where("roots > 1")
        return settle(rooted.join(split.select("sig", "main", "c"), "sig"))

    def pairs_of(x: DataFrame, y: DataFrame, tested: DataFrame, once: F.Column, *by: str) -> DataFrame:
        """``once``: holds for one of the two orders of a pair."""
        condition = once & (F.col("x.root") != F.col("y.root")) & (F.col("x.up") | F.col("y.up")) & near("x", "y")
        for c in ("sig", *by):
            condition = (F.col(f"x.{c}") == F.col(f"y.{c}")) & condition
        made = x.alias("x").join(y.alias("y"), condition).select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()
        return settle(made.join(tested, ["a", "b"], "left_anti"))

    ordered = F.col("x.class") < F.col("y.class")
    held, tested = [stars], stars
    for turn in range(ROUNDS):
        open_ = opened()
        blocks = open_.withColumn("block", F.pmod(F.xxhash64("class", F.lit(turn)), F.greatest(F.lit(1), F.floor(F.col("c") / BLOCK))))
        some = pairs_of(blocks, blocks, tested, ordered, "block")
        found = settle(similar(some))
        held.append(some)
        tested = tested.union(some)
        before, roots = roots, connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found))
        few = found.count() * 10 <= some.count()
        release(open_, found, before)
        if few:
            break

    open_ = opened()
    rest = pairs_of(open_, open_.where("root <> main"), tested, (F.col("x.root") == F.col("x.main")) | ordered)
    release(placed, open_, *held)
    more = settle(similar(rest))
    release(rest, needed)
    return roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)


def only_ids(rows: DataFrame, id_col: str, wanted: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """The rows whose id may be one of ``wanted``, to be joined with it: a bitmap of hashed ids, of ``bits`` bits at most however many ids there are,
    saves the other rows the way through the shuffle. The more ids, the less it saves; it never loses one.
    """
    place = F.pmod(F.xxhash64(id_col), F.lit(bits))
    parts = wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
    size = 4096
    held = bytearray((max([r["k"] for r in parts], default=0) + 1) * size)
    for r in parts:
        held[r["k"] * size : r["k"] * size + size] = r["m"]
    shared = rows.sparkSession.sparkContext.broadcast(bytes(held))
    names = rows.columns

    def run(batches):
        # Bucket k covers the places 32768 * (k - 1) + 1 to 32768 * k.
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        for batch in batches:
            p = batch.column("__place").to_numpy(zero_copy_only=False)
            at = np.where(p > 0, (1 + (p - 1) // 32768) * 32768 + (p - 1) % 32768, 0)
            yield batch.select(names).filter(pa.array((at < len(table)) & table[np.minimum(at, len(table) - 1)].astype(bool) | (p == 0)))

    return rows.withColumn("__place", place).mapInArrow(run, rows.schema)
