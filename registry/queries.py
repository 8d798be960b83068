"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.contracts import Field, TableContract, landing_contract
from intake.functions.casts import int_lenient, int_strict, typed_value
from intake.functions.keys import key_verdict, table_name
from intake.operators.dedupe import duplicate_report, first_per_key, key_stats
from intake.operators.rules import Decoded, InSet, IntCastable, NotNull, References, WellFormed
from intake.operators.validate import accepted, by_reason, rejected, typed, violation_counts
from intake.plans.audit import AuditLog, load_report
from intake.plans.backup import backup, expire, read_manifest, read_snapshot, restore, verify
from intake.plans.ingest import Intake, ingest_file, ingest_folder, ingest_new, validate
from intake.plans.load import load
from intake.plans.measures import batch_measures, null_totals, totals
from intake.plans.replay import replay
from intake.plans.requests import handle, route
from intake.sources.landing import read_landing, write_landing
from intake.sources.ledger import FileLedger
from intake.sources.staged import read_quarantine, read_staged
from intake.sources.tables import BucketedTable, Expected, ParquetTable, parquet_tables
from intake.streaming import ingest_stream
from intake.workspace import run_dir
from registry.fixtures import (
    CUSTOMER,
    ORDERS,
    ORDERS_STRICT,
    ORDERS_TYPED,
    PART,
    TABLES,
    TYPED_FIELDS,
    customers,
    landing,
    landing_file,
    object_keys,
    parts,
    put_files,
    request_paths,
    table,
    typed_landing,
)

Query = Callable[[SparkSession, str], DataFrame]


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, landing_file(spark, sf_dir), ORDERS)


def _intake(spark: SparkSession, label: str, *contracts: TableContract) -> Intake:
    root = run_dir(spark, label)
    targets = {c.name: ParquetTable(f"{root}/tables/{c.name}", c.table_schema) for c in contracts}
    return Intake.of(contracts, f"{root}/staged", targets, f"{root}/audit")


# -- scanning and validating a landing file ---------------------------------


def landing_scan(spark, sf_dir):
    return _scan(spark, sf_dir).select(*ORDERS.columns)


def not_null(spark, sf_dir):
    rules = (NotNull("name"), NotNull("datetime"))
    return accepted(_scan(spark, sf_dir), ORDERS.but(rules=rules, key=()))


def int_castable(spark, sf_dir):
    rules = tuple(IntCastable(c) for c in ("department_id", "id", "job_id"))
    return accepted(_scan(spark, sf_dir), ORDERS.but(rules=rules))


def validated(spark, sf_dir):
    return accepted(_scan(spark, sf_dir), ORDERS)


def validated_strict(spark, sf_dir):
    return accepted(_scan(spark, sf_dir), ORDERS_STRICT)


def violations(spark, sf_dir):
    return violation_counts(_scan(spark, sf_dir), ORDERS)


def quarantine(spark, sf_dir):
    root = run_dir(spark, "quarantine")
    validate(_scan(spark, sf_dir), ORDERS, root, "first")
    return by_reason(read_quarantine(spark, root, ORDERS, "first"))


def stage_roundtrip(spark, sf_dir):
    root = run_dir(spark, "stage")
    validate(_scan(spark, sf_dir), ORDERS, root, "first")
    return read_staged(spark, root, ORDERS, "first")


def stage_dropping(spark, sf_dir):
    """As above, but the bad rows are dropped and only counted."""
    root = run_dir(spark, "stage")
    validate(_scan(spark, sf_dir), ORDERS.but(on_violation="drop"), root, "first")
    return read_staged(spark, root, ORDERS, "first")


def dictionary_rule(spark, sf_dir):
    """Priorities outside the declared list, by reason."""
    rules = (InSet("name", ("1-URGENT", "2-HIGH", "3-MEDIUM")),)
    return by_reason(rejected(_scan(spark, sf_dir), ORDERS.but(rules=rules, key=())))


def malformed_lines(spark, sf_dir):
    """Lines with a field too few or too many, caught verbatim by the scan."""
    k = F.col("o_orderkey")
    line = F.concat_ws(
        ";",
        k.cast("string"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        F.when(k % 10 != 0, (F.col("o_custkey") % 12).cast("string")),
        F.lit("7"),
        F.when(k % 15 == 0, F.lit("extra")),
        F.when(k % 25 == 0, F.lit("more")),
    )
    path = f"{run_dir(spark, 'malformed')}/ingestion/orders.csv"
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    contract = landing_contract("orders", rules=(WellFormed(),), key=())
    return by_reason(rejected(read_landing(spark, path, contract), contract))


def lenient_cast(spark, sf_dir):
    """Both casts over numbers written in every way the rules distinguish."""
    k = F.col("o_orderkey")
    text = k.cast("string")
    forms = F.array(
        text,
        F.concat(F.lit("+"), text),
        F.concat(F.lit("  -"), text, F.lit("\t")),
        F.concat(F.lit("000"), text),
        F.concat(text, F.lit(".")),
        F.concat(F.lit("."), text),
        F.concat(text, F.lit(".99")),
        F.concat(text, F.lit("00000")),
        F.concat(text, F.lit("e2")),
        F.concat(F.lit("0x"), text),
        F.concat(text, F.lit(",5")),
        F.concat(text, F.lit(" 1")),
        F.concat(F.lit("- "), text),
        F.concat(text, F.lit(".1.2")),
        F.col("o_orderpriority"),
        F.lit(""),
        F.concat(text, F.lit("\u2028")),
        F.concat(text, F.lit("\x85")),
    )
    values = table(spark, sf_dir, "orders").select(k, F.posexplode(forms).alias("form", "v"))
    return values.select(
        "o_orderkey",
        "form",
        int_lenient("v").isNotNull().alias("lenient_ok"),
        F.coalesce(int_lenient("v"), F.lit(0)).alias("lenient"),
        int_strict("v").isNotNull().alias("strict_ok"),
        F.coalesce(int_strict("v"), F.lit(0)).alias("strict"),
    )


def typed_rows(spark, sf_dir):
    return typed(accepted(_scan(spark, sf_dir), ORDERS_TYPED), ORDERS_TYPED)


def _nations_outside_africa(spark, sf_dir):
    regions = table(spark, sf_dir, "region").where("r_name <> 'AFRICA'")
    return table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    )


def referential(spark, sf_dir):
    """Departments must be a nation outside Africa."""
    nations = _nations_outside_africa(spark, sf_dir)
    rule = References("department_id", dimension=nations, key="n_nationkey")
    return by_reason(rejected(_scan(spark, sf_dir), ORDERS.but(rules=(rule,), key=())))


LINEITEM = TableContract(
    name="lineitem",
    fields=(
        Field("l_orderkey", "bigint"),
        Field("l_partkey", "bigint"),
        Field("l_suppkey", "bigint"),
        Field("l_linenumber", "int"),
        Field("l_quantity", "double"),
        Field("l_extendedprice", "double"),
        Field("l_discount", "double"),
        Field("l_tax", "double"),
        Field("l_returnflag"),
        Field("l_linestatus"),
        Field("l_shipdate", "timestamp_ntz"),
    ),
)


def referential_large(spark, sf_dir):
    """Lines must belong to an open order: a dimension too big to broadcast."""
    open_orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    rule = References(
        "l_orderkey", dimension=open_orders, key="o_orderkey", data_type="bigint"
    )
    lines = table(spark, sf_dir, "lineitem")
    return by_reason(rejected(lines, LINEITEM.but(rules=(rule,))))


# -- gates --------------------------------------------------------------------


def key_gate(spark, sf_dir):
    key = F.col("key")
    return object_keys(spark, sf_dir).select(
        "key",
        table_name(key).alias("table_name"),
        key_verdict(key, ["orders"]).alias("verdict"),
        key_verdict(key, ["orders"], parity=True).alias("parity_verdict"),
    )


def request_routing(spark, sf_dir):
    return route(request_paths(spark, sf_dir), ["supplier", "customer"])


# -- duplicates and loading ---------------------------------------------------


def batch_dedupe(spark, sf_dir):
    return first_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "l_shipdate"],
    )


def batch_dedupe_hot_key(spark, sf_dir):
    """Three keys, each with about a third of all rows."""
    return first_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    )


ORDER_TABLE = TableContract(
    name="orders",
    fields=(
        Field("o_orderkey", "bigint"),
        Field("o_custkey", "bigint"),
        Field("o_orderstatus"),
        Field("o_totalprice", "double"),
        Field("o_orderdate", "timestamp_ntz"),
        Field("o_orderpriority"),
    ),
    rules=(NotNull("o_orderkey"),),
    key=("o_orderkey",),
    order_by=("o_orderdate",),
)


def load_skip_existing(spark, sf_dir):
    """Finished orders are in the table already and must stay as they are."""
    orders = table(spark, sf_dir, "orders")
    target = ParquetTable(f"{run_dir(spark, 'load')}/orders", ORDER_TABLE.table_schema)
    before = orders.where("o_orderstatus = 'F'")
    target.append(before.withColumn("o_orderpriority", F.lit("loaded before")), "earlier")
    load(spark, orders, target, ORDER_TABLE, "now")
    return target.rows(spark)


def load_bucketed(spark, sf_dir):
    """As above, with the keys matched in the buckets of a catalog table."""
    orders = table(spark, sf_dir, "orders")
    folder = run_dir(spark, "load")
    target = BucketedTable(
        name=f"orders_{uuid.uuid4().hex[:12]}",
        path=f"{folder}/orders",
        schema=ORDER_TABLE.table_schema,
        key=ORDER_TABLE.key,
        buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    before = orders.where("o_orderstatus = 'F'")
    target.append(before.withColumn("o_orderpriority", F.lit("loaded before")), "earlier")
    load(spark, orders, target, ORDER_TABLE, "now", broadcast_limit=0)
    return target.rows(spark)


def load_twice(spark, sf_dir):
    """A batch that is loaded again, and overlaps the next one, adds nothing."""
    lines = table(spark, sf_dir, "lineitem")
    contract = LINEITEM.but(
        rules=(NotNull("l_orderkey"), NotNull("l_linenumber")),
        key=("l_orderkey", "l_linenumber"),
        order_by=("l_partkey", "l_suppkey", "l_shipdate"),
    )
    target = ParquetTable(f"{run_dir(spark, 'load')}/lineitem", contract.table_schema)
    for batch_id in ("first", "first", "second"):
        load(spark, lines, target, contract, batch_id)
    return target.rows(spark)


def load_duplicates_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    returned = lines.where("l_returnflag = 'R'")
    return duplicate_report(lines, returned, key, key_stats(lines, key))


# -- whole runs ---------------------------------------------------------------


def ingest_one_file(spark, sf_dir):
    intake = _intake(spark, "ingest", ORDERS_TYPED)
    ingest_file(spark, landing_file(spark, sf_dir), intake, "first")
    return intake.targets["orders"].rows(spark)


def ingest_many_tables(spark, sf_dir):
    """Files of three tables, each in its own folder, one run per contract."""
    contracts = [
        c.but(file_glob="*.csv", name=c.name) for c in (ORDERS_TYPED, CUSTOMER, PART)
    ]
    intake = _intake(spark, "folder", *contracts)
    root = run_dir(spark, "folder-landing")
    for rows, contract in zip(_three(spark, sf_dir), contracts, strict=True):
        folder = f"{root}/{contract.name}"
        write_landing(rows, folder, contract)
        one = Intake.of([contract], intake.staged_root, intake.targets, intake.audit.path)
        ingest_folder(spark, folder, one, "first")
    return intake.audit.read(spark).select(
        "table_name", "scanned", "accepted", "rejected", "loaded", "skipped"
    )


def _three(spark, sf_dir):
    return landing(spark, sf_dir), customers(spark, sf_dir), parts(spark, sf_dir)


def mixed_folder(spark, sf_dir):
    """Three tables, an undeclared one and a wrong type in one folder: the log."""
    contracts = (ORDERS_TYPED, CUSTOMER, PART)
    intake = _intake(spark, "mixed", *contracts)
    folder = f"{run_dir(spark, 'mixed-landing')}/ingestion"
    for rows, contract in zip(_three(spark, sf_dir), contracts, strict=True):
        put_files(rows, folder, contract, contract.name + ".{}.csv", n_files=3)
    put_files(parts(spark, sf_dir), folder, PART, "products.csv")
    put_files(customers(spark, sf_dir), folder, CUSTOMER, "customer.txt")
    ingest_folder(spark, folder, intake, "first")
    log = intake.audit.read(spark).groupBy("table_name", "step", "status")
    return log.agg(
        F.count("*").alias("n_runs"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("scanned", "accepted", "loaded")],
    )


def _halves(spark, sf_dir):
    rows = landing(spark, sf_dir)
    urgent = F.coalesce(F.col("name") < "3", F.lit(False))
    return rows.where(urgent), rows.where(~urgent)


def two_files_one_day(spark, sf_dir):
    """Two files ask for one batch id: the second is refused it and comes under another."""
    intake = _intake(spark, "day", ORDERS)
    root = run_dir(spark, "day-landing")
    for i, half in enumerate(_halves(spark, sf_dir)):
        path = f"{root}/{i}/orders.csv"
        write_landing(half, path, ORDERS)
        try:
            ingest_file(spark, path, intake, "day1")
        except ValueError:
            ingest_file(spark, path, intake, "day1-again")
    return intake.targets["orders"].rows(spark)


def reupload(spark, sf_dir):
    """A folder that is ingested daily: a file uploaded again with other rows comes in, one already taken does not."""
    contract = ORDERS.but(key=())
    intake, root = _intake(spark, "reupload", contract), run_dir(spark, "reupload-landing")
    ledger = FileLedger(f"{root}/ledger")
    first, second = _halves(spark, sf_dir)
    put_files(first, f"{root}/files", contract, "orders.{}.csv", n_files=3)
    ingest_new(spark, f"{root}/files", intake, ledger, "day1")
    put_files(second, f"{root}/files", contract, "orders.0.csv")
    for day in ("day2", "day2", "day3"):
        ingest_new(spark, f"{root}/files", intake, ledger, day)
    return intake.targets["orders"].rows(spark)


def replayed(spark, sf_dir):
    """Rows that one rule refused come back when it has gone, once; what breaks the others stays rejected."""
    strict = ORDERS.but(key=(), rules=(*ORDERS.rules, InSet("name", ("1-URGENT", "2-HIGH"))))
    intake, root = _intake(spark, "replay", strict), run_dir(spark, "replay-landing")
    for i, half in enumerate(_halves(spark, sf_dir)):
        put_files(half, f"{root}/{i}", ORDERS, "orders.csv")
        ingest_folder(spark, f"{root}/{i}", intake, f"day{i}")
    now = replace(intake, contracts={"orders": ORDERS.but(key=())})
    for batch_id in ("again", "again", "once-more"):
        replay(spark, "orders", now, batch_id)
    return intake.targets["orders"].rows(spark)


def two_streams(spark, sf_dir):
    """Two streams, each with a checkpoint of its own, into one table."""
    contract = ORDERS.but(file_glob="*.csv")
    intake = _intake(spark, "streams", contract)
    root = run_dir(spark, "streams-landing")
    for i, half in enumerate(_halves(spark, sf_dir)):
        write_landing(half, f"{root}/{i}", contract)
        query = ingest_stream(spark, f"{root}/{i}", contract, intake, f"{root}/checkpoint-{i}")
        query.awaitTermination()
    return intake.targets["orders"].rows(spark)


def typed_quarantine(spark, sf_dir):
    """Values that do not fit the declared types, by reason."""
    return by_reason(rejected(typed_landing(spark, sf_dir), TYPED_FIELDS))


def two_rules_one_column(spark, sf_dir):
    """Two lists for one column and two dimensions for another."""
    rules = (
        InSet("name", ("1-URGENT", "2-HIGH", "3-MEDIUM")),
        InSet("name", ("2-HIGH", "3-MEDIUM", "5-LOW")),
        References("department_id", dimension=_nations_outside_africa(spark, sf_dir), key="n_nationkey"),
        References("department_id", dimension=table(spark, sf_dir, "region"), key="r_regionkey"),
    )
    return by_reason(rejected(_scan(spark, sf_dir), ORDERS.but(rules=rules, key=())))


def failed_runs(spark, sf_dir):
    """A good file, one whose rows are all bad and one that is missing: the log (-1: not counted)."""
    intake = _intake(spark, "failed", ORDERS)
    bad = f"{run_dir(spark, 'failed-landing')}/orders.csv"
    write_landing(landing(spark, sf_dir).withColumn("id", F.lit("none")), bad, ORDERS)
    paths = {"good": landing_file(spark, sf_dir), "bad": bad, "missing": f"{bad}.not.csv"}
    for batch_id, path in paths.items():
        with suppress(Exception):
            ingest_file(spark, path, intake, batch_id)
    counts = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("scanned", "accepted", "loaded")]
    return intake.audit.read(spark).select("step", "batch_id", "status", *counts)


def recorded_schema(spark, sf_dir):
    """The schema that an ingest has recorded, column by column, with its rows."""
    intake = _intake(spark, "schema", ORDERS_TYPED)
    ingest_file(spark, landing_file(spark, sf_dir), intake, "first")
    shape = "fields array<struct<name: string, type: string>>"
    log = intake.audit.read(spark).withColumn("schema", F.from_json("schema_json", shape))
    return log.select("table_name", "loaded", F.explode("schema.fields").alias("f")).select(
        "table_name", "loaded", F.col("f.name").alias("name"), F.col("f.type").alias("type")
    )


def stream_ingest(spark, sf_dir):
    """Files arrive in two uploads; the stream is run once after each."""
    contract = ORDERS.but(file_glob="*.csv")
    intake = _intake(spark, "stream", contract)
    root = run_dir(spark, "stream-landing")
    for upload in _halves(spark, sf_dir):
        write_landing(upload, f"{root}/orders", contract, mode="append")
        query = ingest_stream(spark, f"{root}/orders", contract, intake, f"{root}/checkpoint")
        query.awaitTermination()
    return intake.targets["orders"].rows(spark)


def report(spark, sf_dir):
    """What the audit log says about one ingest, without its date."""
    intake = _intake(spark, "report", ORDERS)
    ingest_file(spark, landing_file(spark, sf_dir), intake, "first")
    return load_report(AuditLog(intake.audit.path).read(spark)).drop("day")


# -- backup and restore -------------------------------------------------------


def backup_manifest(spark, sf_dir):
    """Every given table, written, read back and compared."""
    root = run_dir(spark, "backup")
    backup(spark, parquet_tables(sf_dir, TABLES, spark), root, snapshot_id="all")
    return verify(spark, root, "all").select("table_name", "n_rows", "verified")


def expired(spark, sf_dir):
    """Three snapshots of all tables, of which two are kept: the manifest."""
    root = run_dir(spark, "expire")
    for snapshot in ("s1", "s2", "s3"):
        backup(spark, parquet_tables(sf_dir, TABLES, spark), root, snapshot_id=snapshot)
    expire(spark, root, keep=2)
    return read_manifest(spark, root).select("snapshot_id", "table_name", "n_rows")


def compacted(spark, sf_dir):
    """Orders loaded in eight batches, then gathered in one file."""
    orders = table(spark, sf_dir, "orders")
    target = ParquetTable(f"{run_dir(spark, 'compact')}/orders", ORDER_TABLE.table_schema, ORDER_TABLE.key)
    for i in range(8):
        load(spark, orders.where(F.col("o_custkey") % 8 == i), target, ORDER_TABLE, f"b{i}")
    target.compact(spark)
    target.vacuum(spark)
    load(spark, orders.where(F.col("o_custkey") % 8 == 3), target, ORDER_TABLE, "b3")
    return target.rows(spark)


def failed_repeat(spark, sf_dir):
    """All orders are loaded; the same batch comes again and dies in a task: the table as before."""
    orders = table(spark, sf_dir, "orders")
    target = ParquetTable(f"{run_dir(spark, 'repeat')}/orders", ORDER_TABLE.table_schema)
    load(spark, orders, target, ORDER_TABLE, "first", source="orders")
    lost = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("o_orderpriority"))
    with suppress(Exception):
        load(spark, orders.withColumn("o_orderpriority", lost), target, ORDER_TABLE, "first", source="orders")
    return target.rows(spark)


def keyless_repeat(spark, sf_dir):
    """Lines without a key: loaded, compacted, loaded again under the same id."""
    lines = table(spark, sf_dir, "lineitem")
    target = ParquetTable(f"{run_dir(spark, 'keyless')}/lineitem", LINEITEM.table_schema)
    load(spark, lines, target, LINEITEM, "first")
    target.compact(spark)
    load(spark, lines, target, LINEITEM, "first")
    return target.rows(spark)


def bucketed_replace(spark, sf_dir):
    """A bucketed table refuses a copy that is not as recorded, takes the other orders, and is set anew."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_TABLE.columns)
    target = BucketedTable(
        name=f"orders_{uuid.uuid4().hex[:12]}",
        path=f"{run_dir(spark, 'bucketed')}/orders",
        schema=ORDER_TABLE.table_schema,
        key=ORDER_TABLE.key,
        buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    load(spark, orders.where("o_orderstatus = 'F'"), target, ORDER_TABLE, "finished")
    with suppress(ValueError):
        target.replace(orders.where("o_orderstatus = 'P'"), Expected.of(orders))
    load(spark, orders, target, ORDER_TABLE, "all")
    target.replace(target.rows(spark), Expected.of(orders))
    target.vacuum(spark)
    return target.rows(spark)


def exact_casts(spark, sf_dir):
    """Texts of several types for every order, and what the cast takes of them, written out again."""
    day, key = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey").cast("string")
    forms = [
        ("date", day),
        ("date", F.concat(day, F.lit(" yesterday"))),
        ("date", F.concat(day, F.lit("Tjunk"))),
        ("date", F.left(day, F.lit(4))),
        ("decimal(12,2)", F.concat(key, F.lit(".25"))),
        ("decimal(12,2)", F.concat(key, F.lit(".239"))),
        ("double", F.concat(key, F.lit(".5"))),
        ("double", F.concat(key, F.lit(".5d"))),
        ("double", F.concat(F.lit("1"), key, F.lit("e400"))),
        ("timestamp_ntz", F.concat(day, F.lit(" 10:00:00"))),
        ("timestamp", F.concat(F.lit("10:"), F.right(F.concat(F.lit("0"), (F.col("o_orderkey") % 60).cast("string")), F.lit(2)))),
        ("timestamp", F.concat(day, F.lit("T10:00:00"))),
        ("timestamp", F.concat(day, F.lit("T10:00:00+02:00"))),
    ]
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(F.array(*[t for _, t in forms])).alias("form", "v"))
    values = F.lit(None).cast("string")
    for number, (data_type, _) in enumerate(forms):
        value = typed_value("v", data_type)
        value = value.cast("long") if data_type == "timestamp" else value
        values = F.when(F.col("form") == number, value.cast("string")).otherwise(values)
    return texts.select("o_orderkey", "form", F.coalesce(values, F.lit("refused")).alias("value"))


def quoted_names(spark, sf_dir):
    """Customers with line ends, quotes and accents in their names, in Latin-1 files; and how many names UTF-8 would spoil."""
    key = F.col("c_custkey")
    line_end = F.when(key % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    accent = F.when(key % 3 == 0, F.lit('"é"; ü')).otherwise(F.lit('"e"; u'))
    rows = customers(spark, sf_dir).withColumn("c_name", F.concat("c_name", line_end, accent))
    rules = (IntCastable("c_custkey"), NotNull("c_nationkey"), Decoded("c_name"))
    contract = CUSTOMER.but(rules=rules, encoding="ISO-8859-1", multi_line=True, line_sep="\n", escape='"')
    path = f"{run_dir(spark, 'quoted')}/ingestion/{contract.name}.csv"
    write_landing(rows, path, contract)
    intake = _intake(spark, "quoted", contract)
    ingest_file(spark, path, intake, "first")
    spoiled = rejected(read_landing(spark, path, contract.but(encoding="UTF-8")), contract)
    n = spoiled.where(F.array_contains("reasons", "undecoded:c_name")).count()
    return intake.targets[contract.name].rows(spark).withColumn("spoiled", F.lit(n))


def merged_measures(spark, sf_dir):
    """Orders in four batches, one of them twice, by priority: rows, keys and null priorities from the batches' measures."""
    target = ParquetTable(f"{run_dir(spark, 'measured')}/orders", ORDER_TABLE.table_schema, ORDER_TABLE.key)
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    orders = orders.withColumn("o_orderpriority", F.when(~urgent, F.col("o_orderpriority")))
    for i in (0, 1, 2, 3, 2):
        batch = orders.where(F.col("o_orderkey") % 4 == i)
        load(spark, batch, target, ORDER_TABLE, f"b{i}", source=f"part {i}")
        batch_measures(spark, {"orders": target})
    measures = batch_measures(spark, {"orders": target})
    nulls = null_totals(measures, "batch_id").where("column = 'o_orderpriority'").drop("column")
    close = F.abs(F.col("distinct_keys") / F.col("n_rows") - 1) < 0.1
    return totals(measures, "batch_id").join(nulls, ["table_name", "batch_id"]).select(
        "batch_id", "batches", "n_rows", "nulls", close.alias("keys_close")
    )


def parted_backup(spark, sf_dir):
    """Orders in parts by key, twice, one row changed between: the second snapshot alone, its parts written and wrong."""
    root = run_dir(spark, "parted")
    orders = table(spark, sf_dir, "orders")
    highest = orders.agg(F.max("o_orderkey").alias("k")).first()["k"]
    late = F.when(F.col("o_orderkey") == highest, F.lit("late")).otherwise(F.col("o_orderpriority"))
    for snapshot, rows in (("s1", orders), ("s2", orders.withColumn("o_orderpriority", late))):
        backup(spark, {"orders": rows}, root, snapshot_id=snapshot, keys={"orders": ("o_orderkey",)}, parts=16)
    parts = read_manifest(spark, root).select("snapshot_id", F.explode("parts.path").alias("path"))
    snapshots = parts.groupBy("path").agg(F.min("snapshot_id").alias("first"))
    written = snapshots.where("first = 's2'").count()
    expire(spark, root, keep=1)
    wrong = verify(spark, root, "s2").first()["wrong_parts"]
    return read_snapshot(spark, root, "orders").select(
        "*", F.lit(written).alias("parts_written"), F.lit(len(wrong)).alias("parts_wrong")
    )


def sketched_load(spark, sf_dir):
    """Orders in four stored batches in no order of their keys, then all of them again: only that one opens folders."""
    folder = run_dir(spark, "sketched")
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(4)).alias("_part")
    table(spark, sf_dir, "orders").select("*", part).write.partitionBy("_part").parquet(f"{folder}/batches")
    batches = spark.read.parquet(f"{folder}/batches")
    target = ParquetTable(f"{folder}/orders", ORDER_TABLE.table_schema, ORDER_TABLE.key, sketched=True)
    for i in range(4):
        load(spark, batches.where(F.col("_part") == i).drop("_part"), target, ORDER_TABLE, f"b{i}", source=f"part {i}")
    late = batches.drop("_part").withColumn("o_orderpriority", F.lit("late"))
    load(spark, late, target, ORDER_TABLE, "late", source="late")
    return target.rows(spark)


SUPPLIER = TableContract(
    name="supplier",
    fields=(
        Field("s_suppkey", "bigint"),
        Field("s_name"),
        Field("s_nationkey", "int"),
        Field("s_acctbal", "double"),
    ),
    rules=(NotNull("s_suppkey"),),
    key=("s_suppkey",),
)


def _supplier_table(spark, sf_dir, root):
    target = ParquetTable(f"{root}/tables/supplier", SUPPLIER.table_schema)
    load(spark, table(spark, sf_dir, "supplier"), target, SUPPLIER, "first")
    return target


def restore_replace(spark, sf_dir):
    """The table is damaged after a backup, then put back by request."""
    root = run_dir(spark, "restore")
    target = _supplier_table(spark, sf_dir, root)
    handle(spark, "/backup", {"supplier": target}, f"{root}/backup")
    damaged = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    target.replace(damaged.withColumn("s_name", F.lit("damaged")))
    handle(spark, "/restore/supplier", {"supplier": target}, f"{root}/backup")
    return target.rows(spark)


def restore_append(spark, sf_dir):
    """Rows lost since the backup come back; rows still there are left alone."""
    root = run_dir(spark, "restore")
    target = _supplier_table(spark, sf_dir, root)
    backup(spark, {"supplier": target}, f"{root}/backup")
    left = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    target.replace(left.withColumn("s_name", F.lit("changed")))
    restore(spark, f"{root}/backup", "supplier", target, mode="append", contract=SUPPLIER)
    return target.rows(spark)


QUERIES: dict[str, Query] = {
    "q01_landing_scan": landing_scan,
    "q02_not_null": not_null,
    "q03_int_castable": int_castable,
    "q04_validated": validated,
    "q05_validated_strict": validated_strict,
    "q06_violation_counts": violations,
    "q07_quarantine": quarantine,
    "q08_key_gate": key_gate,
    "q09_stage_roundtrip": stage_roundtrip,
    "q10_batch_dedupe": batch_dedupe,
    "q11_load_skip_existing": load_skip_existing,
    "q12_load_duplicates_report": load_duplicates_report,
    "q14_backup_manifest": backup_manifest,
    "q15_restore_replace": restore_replace,
    "q16_typed": typed_rows,
    "q17_referential": referential,
    "q18_stream_ingest": stream_ingest,
    "q19_load_report": report,
    "q20_referential_large": referential_large,
    "q21_restore_append": restore_append,
    "q22_request_routing": request_routing,
    "q23_dictionary_rule": dictionary_rule,
    "q24_malformed_lines": malformed_lines,
    "q25_lenient_cast": lenient_cast,
    "q26_ingest_file": ingest_one_file,
    "q27_ingest_many_tables": ingest_many_tables,
    "q28_stage_dropping": stage_dropping,
    "q29_batch_dedupe_hot_key": batch_dedupe_hot_key,
    "q30_load_twice": load_twice,
    "q31_load_bucketed": load_bucketed,
    "q32_two_files_one_day": two_files_one_day,
    "q33_two_streams": two_streams,
    "q34_typed_quarantine": typed_quarantine,
    "q35_mixed_folder": mixed_folder,
    "q36_two_rules_one_column": two_rules_one_column,
    "q37_failed_runs": failed_runs,
    "q38_recorded_schema": recorded_schema,
    "q39_expire": expired,
    "q40_compacted": compacted,
    "q41_failed_repeat": failed_repeat,
    "q42_keyless_repeat": keyless_repeat,
    "q43_bucketed_replace": bucketed_replace,
    "q44_exact_casts": exact_casts,
    "q45_sketched_load": sketched_load,
    "q46_reupload": reupload,
    "q47_replayed": replayed,
    "q48_parted_backup": parted_backup,
    "q49_quoted_names": quoted_names,
    "q50_merged_measures": merged_measures,
}
