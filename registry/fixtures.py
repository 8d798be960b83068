"""Inputs derived from the given tables: landing rows, files and object keys.

Every fixture covers a whole table. The faults are placed by arithmetic on the
key, so Spark and SQL build the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.contracts import Field, TableContract, landing_contract
from intake.operators.rules import IntCastable, NotNull
from intake.sources.files import delete, names, rename
from intake.sources.landing import write_landing
from intake.workspace import run_dir

# The tables of a data folder.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Every n-th order gets this fault.
NULL_ID, LETTER_ID, FRACTION_ID = 97, 89, 83
NULL_NAME, NULL_TIME = 53, 61
BAD_DEPARTMENT, BIG_JOB, BLANK_JOB = 71, 79, 73
DEPARTMENTS, JOBS = 12, 180

ORDERS = landing_contract("orders")
ORDERS_STRICT = landing_contract("orders", mode="strict")
ORDERS_TYPED = landing_contract("orders", typed=True)

# Landing forms of two more tables, for runs over several contracts.
CUSTOMER = TableContract(
    name="customer",
    fields=(
        Field("c_custkey", "bigint"),
        Field("c_name"),
        Field("c_nationkey", "int"),
        Field("c_mktsegment"),
    ),
    rules=(IntCastable("c_custkey"), NotNull("c_name"), IntCastable("c_nationkey")),
    key=("c_custkey",),
)
PART = TableContract(
    name="part",
    fields=(
        Field("p_partkey", "bigint"),
        Field("p_name"),
        Field("p_brand"),
        Field("p_size", "int"),
    ),
    rules=(IntCastable("p_partkey"), NotNull("p_name"), IntCastable("p_size")),
    key=("p_partkey",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in the landing columns, some of them faulty."""
    key = F.col("o_orderkey")
    text = key.cast("string")

    def every(n: int):
        return key % n == 0

    return table(spark, sf_dir, "orders").select(
        F.when(every(NULL_ID), F.lit(None))
        .when(every(LETTER_ID), F.concat(F.lit("x"), text))
        .when(every(FRACTION_ID), F.concat(text, F.lit(".5")))
        .otherwise(text)
        .alias("id"),
        F.when(~every(NULL_NAME), F.col("o_orderpriority")).alias("name"),
        F.when(
            ~every(NULL_TIME), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).alias("datetime"),
        F.when(every(BAD_DEPARTMENT), F.lit("N/A"))
        .otherwise((F.col("o_custkey") % DEPARTMENTS).cast("string"))
        .alias("department_id"),
        F.when(every(BIG_JOB), F.lit("2147483648"))
        .when(every(BLANK_JOB), F.lit(" 7 "))
        .otherwise((key % JOBS).cast("string"))
        .alias("job_id"),
    )


_written: dict[tuple[str, str], str] = {}


def landing_file(spark: SparkSession, sf_dir: str) -> str:
    """The landing rows as CSV, written once per session and input."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _written:
        path = f"{run_dir(spark, 'landing')}/ingestion/orders.csv"
        write_landing(landing(spark, sf_dir), path, ORDERS)
        _written[slot] = path
    return _written[slot]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in landing form; every 29th has no nation."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string"),
        "c_name",
        F.when(key % 29 != 0, F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        "c_mktsegment",
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts in landing form; every 31st has no name."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string"),
        F.when(key % 31 != 0, F.col("p_name")).alias("p_name"),
        "p_brand",
        F.col("p_size").cast("string"),
    )


def put_files(
    df: DataFrame, folder: str, contract: TableContract, name: str, n_files: int = 1
) -> None:
    """Writes rows as ``n_files`` files ``<name>`` of a flat folder, ``{}`` in it being the number.

    A file that is there already is uploaded again."""
    spark = df.sparkSession
    made = f"{run_dir(spark, 'files')}/{contract.name}"
    write_landing(df.repartition(n_files), made, contract)
    data = [f for f in names(spark, made) if f.startswith("part-")]
    for i, file in enumerate(data):
        delete(spark, f"{folder}/{name.format(i)}")
        rename(spark, f"{made}/{file}", f"{folder}/{name.format(i)}")


def typed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as text for TYPED_FIELDS, with values that do not fit their types."""
    k = F.col("o_orderkey")
    text = k.cast("string")

    def every(n: int):
        return k % n == 0

    return table(spark, sf_dir, "orders").select(
        F.when(every(17), F.concat(F.lit("9999999999999999999"), text))
        .when(every(13), F.concat(text, F.lit(".7")))
        .when(every(11), (k + 3000000000).cast("string"))
        .otherwise(text)
        .alias("id"),
        F.when(every(7), F.lit("yesterday"))
        .when(every(19), F.lit("2024-02-30"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day"),
        F.when(every(23), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+05:00'"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("at"),
        (k % 40000).cast("string").alias("n"),
    )


TYPED_FIELDS = TableContract(
    name="typed_orders",
    fields=(
        Field("id", "bigint"),
        Field("day", "date"),
        Field("at", "timestamp_ntz"),
        Field("n", "smallint"),
    ),
    rules=(IntCastable("id"),),
)


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object key per order: folders, versions, suffixes and unknown tables."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("ingestion/"),
            F.when(k % 5 == 0, F.concat(F.lit("x/"), F.lower("o_orderpriority"), F.lit("/")))
            .otherwise(F.lit("")),
            F.when(k % 7 == 0, F.lit("unknown"))
            .when(k % 11 == 0, F.lit(""))
            .otherwise(F.lit("orders")),
            F.when(k % 3 == 0, F.concat(F.lit(".v"), k.cast("string"))).otherwise(F.lit("")),
            F.when(k % 13 == 0, F.lit(".CSV"))
            .when(k % 17 == 0, F.lit(".xcsv"))
            .when(k % 19 == 0, F.lit(".txt"))
            .otherwise(F.lit(".csv")),
        ).alias("key")
    )


def request_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One maintenance request per supplier."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(k % 4 == 0, F.lit("/backup"))
        .when(k % 4 == 1, F.lit("/restore/supplier"))
        .when(k % 4 == 2, F.concat(F.lit("/restore/"), F.lower("s_name")))
        .otherwise(F.lit("/restore"))
        .alias("path")
    )
