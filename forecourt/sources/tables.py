"""A listings table derived from a star schema of order lines, parts and customers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LUXURY_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
LUXURY_MAKES = ("brand-1", "brand-2", "brand-3")
ECONOMY_MAKES = ("brand-20", "brand-21", "brand-22", "brand-23", "brand-24", "brand-25")

_CONDITIONS = (
    "No damage", "Minor scratches", "Repainted bumper", "Dented door",
    "Engine repaired", "Accident history",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores when the files split into fewer parts than there are.

    A file cannot be read by more tasks than it has row groups. Large inputs have far more
    parts than a cluster has cores and pass through untouched. Hashing by a fine-grained key
    spares the sort that makes a round-robin exchange repeatable.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def listings_from_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Raw listings, one per order line.

    Joins carry no hints: adaptive execution broadcasts what its measured size allows. Orders get their
    customer's nation before they meet the lines, and parts come last: so lines are shuffled for orders and
    for parts only, each time without the texts of parts, which the last projection makes long.
    """
    line = spread(read_table(spark, folder, "lineitem"), "l_orderkey")
    part = read_table(spark, folder, "part")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")

    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    placed = orders.join(located, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "n_name")
    joined = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    text = lambda c: F.col(c).cast("string")
    luxury = F.col("p_brand").isin(*LUXURY_BRANDS)
    order = F.col("l_orderkey")
    condition = F.coalesce(
        F.get(F.array(*[F.lit(c) for c in _CONDITIONS]), F.col("l_linenumber") - 1),
        F.lit("Repossessed"),
    )
    return joined.select(
        F.concat_ws(
            "-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"),
            text("l_suppkey"), F.col("l_quantity").cast("int").cast("string"),
            F.col("l_shipdate").cast("date").cast("string"),
        ).alias("listing_id"),
        F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")).alias("make"),
        F.concat(
            F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"),
            (F.col("p_size") % 7).cast("string"),
        ).alias("model"),
        (F.year("l_shipdate") + 24).cast("int").alias("year"),
        (F.col("l_extendedprice") * F.when(luxury, 6).otherwise(1)).alias("price"),
        ((F.col("l_quantity") - 1) * 6000).cast("int").alias("mileage"),
        F.col("p_type").alias("body_type"),
        F.when(F.col("p_partkey") % 97 == 0, "Unknown")
        .when(luxury, (8 + F.col("p_size") % 5).cast("string"))
        .otherwise((3 + F.col("p_size") % 4).cast("string"))
        .alias("cylinders"),
        F.when(F.col("l_linestatus") == "O", "Automatic").otherwise("Manual").alias("transmission"),
        F.col("l_returnflag").alias("fuel_type"),
        F.col("o_orderpriority").alias("color"),
        F.when(order % 2 == 0, F.concat(F.lit(" "), F.col("n_name")))
        .otherwise(F.col("n_name")).alias("location"),
        F.when(
            order % 101 != 0,
            F.concat(
                F.col("p_name"), F.lit(" with "),
                F.when(order % 4 >= 2, "Sunroof, ").otherwise(""),
                F.when(order % 8 >= 4, "Leather seats, ").otherwise(""),
                F.when(F.col("l_partkey") % 3 == 0, "Rear camera, ").otherwise(""),
                F.lit("Bluetooth . Condition: "), condition, F.lit("."),
            ),
        ).alias("description"),
    )
