"""The same results in SQL, over the given tables registered as views."""

from __future__ import annotations

from registry.fixtures import TABLES

LANDING = """landing AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 89 = 0 THEN concat('x', CAST(o_orderkey AS VARCHAR))
         WHEN o_orderkey % 83 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), '.5')
         ELSE CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderpriority END AS name,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS datetime,
    CASE WHEN o_orderkey % 71 = 0 THEN 'N/A'
         ELSE CAST(o_custkey % 12 AS VARCHAR) END AS department_id,
    CASE WHEN o_orderkey % 79 = 0 THEN '2147483648'
         WHEN o_orderkey % 73 = 0 THEN ' 7 '
         ELSE CAST(o_orderkey % 180 AS VARCHAR) END AS job_id
  FROM orders)"""


def lenient(c: str) -> str:
    blank = r"[\x00-\x20\x7f]*"
    return (
        rf"CASE WHEN regexp_matches({c}, '^{blank}[+-]?[0-9]*(\.[0-9]*)?{blank}$') "
        rf"AND regexp_matches({c}, '[0-9.]') "
        rf"THEN TRY_CAST(coalesce(nullif(regexp_extract({c}, '^{blank}([+-]?[0-9]+)', 1), ''), '0') "
        r"AS INTEGER) END"
    )


def strict(c: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({c}, '^\s*[+-]?[0-9]+\s*$') THEN TRY_CAST({c} AS INTEGER) END"
    )


def all_ints(cast) -> str:
    return " AND ".join(f"({cast(c)}) IS NOT NULL" for c in ("id", "department_id", "job_id"))


TEXT_PRESENT = "name IS NOT NULL AND datetime IS NOT NULL"
COLUMNS = "id, name, datetime, department_id, job_id"
VALID = f"{all_ints(lenient)} AND {TEXT_PRESENT}"
VALIDATED = f"WITH {LANDING} SELECT {COLUMNS} FROM landing WHERE {VALID}"

# Reason -> when a landing row breaks it.
BROKEN = {
    "not_int:id": f"({lenient('id')}) IS NULL",
    "not_int:department_id": f"({lenient('department_id')}) IS NULL",
    "not_int:job_id": f"({lenient('job_id')}) IS NULL",
    "null:name": "name IS NULL",
    "null:datetime": "datetime IS NULL",
    "malformed": "false",
}

TYPED = f"""WITH {LANDING}
SELECT {lenient('id')} AS id, name,
       strptime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
       {lenient('department_id')} AS department_id,
       {lenient('job_id')} AS job_id
FROM landing WHERE {VALID}"""

TYPED_LANDING = """typed AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 17 = 0 THEN concat('9999999999999999999', CAST(o_orderkey AS VARCHAR))
         WHEN o_orderkey % 13 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), '.7')
         WHEN o_orderkey % 11 = 0 THEN CAST(o_orderkey + 3000000000 AS VARCHAR)
         ELSE CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN o_orderkey % 7 = 0 THEN 'yesterday' WHEN o_orderkey % 19 = 0 THEN '2024-02-30'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
    CASE WHEN o_orderkey % 23 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+05:00')
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS "at",
    CAST(o_orderkey % 40000 AS VARCHAR) AS n
  FROM orders)"""

LINE_ORDER = (
    "l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
FIRST_LINES = f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) = 1"""


LOADED_BEFORE = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus = 'F' THEN 'loaded before' ELSE o_orderpriority END AS o_orderpriority
FROM orders"""


def _union(selects) -> str:
    return " UNION ALL ".join(selects)



def _ingest_counts(name: str, source: str, bad: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS scanned,
       count(*) FILTER (WHERE NOT ({bad})) AS accepted,
       count(*) FILTER (WHERE {bad}) AS rejected,
       count(*) FILTER (WHERE NOT ({bad})) AS loaded,
       CAST(0 AS BIGINT) AS skipped FROM {source}"""


def _verdict(type_ok: str) -> str:
    return (
        f"CASE WHEN NOT ({type_ok}) THEN 'wrong type' "
        "WHEN table_name NOT IN ('orders') THEN 'unknown table' ELSE 'pass' END"
    )


ALL_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority FROM orders"""

ORACLES: dict[str, str] = {
    "q01_landing_scan": f"WITH {LANDING} SELECT {COLUMNS} FROM landing",
    "q02_not_null": f"WITH {LANDING} SELECT {COLUMNS} FROM landing WHERE {TEXT_PRESENT}",
    "q03_int_castable": f"WITH {LANDING} SELECT {COLUMNS} FROM landing WHERE {all_ints(lenient)}",
    "q04_validated": VALIDATED,
    "q05_validated_strict": (
        f"WITH {LANDING} SELECT {COLUMNS} FROM landing "
        f"WHERE {all_ints(strict)} AND {TEXT_PRESENT}"
    ),
    "q06_violation_counts": f"WITH {LANDING} "
    + _union(
        f"SELECT '{reason}' AS reason, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {broken}) AS n_violations FROM landing"
        for reason, broken in BROKEN.items()
    ),
    "q07_quarantine": f"WITH {LANDING} "
    + _union(
        f"SELECT {COLUMNS}, CAST(NULL AS VARCHAR) AS raw_line, '{reason}' AS reason "
        f"FROM landing WHERE {broken}"
        for reason, broken in BROKEN.items()
    ),
    "q08_key_gate": f"""WITH keys AS (
  SELECT concat('ingestion/',
    CASE WHEN o_orderkey % 5 = 0 THEN concat('x/', lower(o_orderpriority), '/') ELSE '' END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'unknown'
         WHEN o_orderkey % 11 = 0 THEN '' ELSE 'orders' END,
    CASE WHEN o_orderkey % 3 = 0 THEN concat('.v', CAST(o_orderkey AS VARCHAR)) ELSE '' END,
    CASE WHEN o_orderkey % 13 = 0 THEN '.CSV' WHEN o_orderkey % 17 = 0 THEN '.xcsv'
         WHEN o_orderkey % 19 = 0 THEN '.txt' ELSE '.csv' END) AS key FROM orders),
named AS (SELECT key, split_part(split(key, '/')[-1], '.', 1) AS table_name FROM keys)
SELECT key, table_name, {_verdict("lower(key) LIKE '%.csv'")} AS verdict,
       {_verdict("key LIKE '%csv'")} AS parity_verdict FROM named""",
    "q09_stage_roundtrip": VALIDATED,
    "q10_batch_dedupe": FIRST_LINES,
    "q11_load_skip_existing": LOADED_BEFORE,
    "q12_load_duplicates_report": """SELECT l_orderkey, l_linenumber, count(*) AS n_in_batch,
  bool_or(l_returnflag = 'R') AS in_target FROM lineitem GROUP BY l_orderkey, l_linenumber
  HAVING count(*) > 1 OR bool_or(l_returnflag = 'R')""",
    "q14_backup_manifest": _union(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS verified FROM {t}"
        for t in TABLES
    ),
    "q15_restore_replace": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "q16_typed": TYPED,
    "q17_referential": f"""WITH {LANDING}
SELECT {COLUMNS}, 'no_reference:department_id' AS reason FROM landing
WHERE department_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'AFRICA' AND n_nationkey = {lenient('department_id')})""",
    "q18_stream_ingest": VALIDATED,
    "q19_load_report": f"""WITH {LANDING}
SELECT 'orders' AS table_name, outcome, CAST(1 AS BIGINT) AS n_runs, n_rows FROM ("""
    + _union(
        f"SELECT '{outcome}' AS outcome, count(*) FILTER (WHERE {test}) AS n_rows FROM landing"
        for outcome, test in {
            "scanned": "true",
            "accepted": VALID,
            "loaded": VALID,
            "rejected": f"NOT ({VALID})",
            "skipped": "false",
            **BROKEN,
        }.items()
    )
    + ")",
    "q20_referential_large": """SELECT *, 'no_reference:l_orderkey' AS reason FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')""",
    "q21_restore_append": """SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'changed' ELSE s_name
  END AS s_name, s_nationkey, s_acctbal FROM supplier""",
    "q22_request_routing": """WITH requests AS (SELECT CASE
    WHEN s_suppkey % 4 = 0 THEN '/backup'
    WHEN s_suppkey % 4 = 1 THEN '/restore/supplier'
    WHEN s_suppkey % 4 = 2 THEN concat('/restore/', lower(s_name))
    ELSE '/restore' END AS path FROM supplier)
SELECT path, CASE WHEN path = '/backup' THEN 'backup'
                  WHEN path IN ('/restore/supplier', '/restore/customer') THEN 'restore'
                  ELSE 'refused' END AS action,
       CASE WHEN path LIKE '/restore/%' THEN substr(path, 10) END AS table_name
FROM requests""",
    "q23_dictionary_rule": f"""WITH {LANDING}
SELECT {COLUMNS}, 'not_in_set:name' AS reason FROM landing
WHERE name NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "q24_malformed_lines": """WITH lines AS (
  SELECT o_orderkey AS k, o_orderpriority AS p, o_orderstatus AS s,
    list_filter([CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 12 AS VARCHAR) END, '7',
                 CASE WHEN o_orderkey % 15 = 0 THEN 'extra' END,
                 CASE WHEN o_orderkey % 25 = 0 THEN 'more' END],
                lambda x: x IS NOT NULL) AS rest
  FROM orders)
SELECT CAST(k AS VARCHAR) AS id, p AS name, s AS datetime, rest[1] AS department_id,
       rest[2] AS job_id, 'malformed' AS reason,
       concat_ws(';', CAST(k AS VARCHAR), p, s, array_to_string(rest, ';')) AS raw_line
FROM lines WHERE len(rest) <> 2""",
    "q25_lenient_cast": f"""WITH forms AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS t, o_orderpriority AS p FROM orders),
lists AS (
  SELECT o_orderkey, [t, '+' || t, '  -' || t || chr(9), '000' || t, t || '.', '.' || t,
    t || '.99', t || '00000', t || 'e2', '0x' || t, t || ',5', t || ' 1', '- ' || t,
    t || '.1.2', p, '', t || chr(8232), t || chr(133)] AS vs FROM forms),
vals AS (
  SELECT o_orderkey, CAST(i AS INTEGER) AS form, vs[i + 1] AS v
  FROM lists, range(18) AS r(i))
SELECT o_orderkey, form,
  ({lenient('v')}) IS NOT NULL AS lenient_ok, coalesce({lenient('v')}, 0) AS lenient,
  ({strict('v')}) IS NOT NULL AS strict_ok, coalesce({strict('v')}, 0) AS strict FROM vals""",
    "q26_ingest_file": TYPED,
    "q27_ingest_many_tables": f"WITH {LANDING} "
    + _union(
        [
            _ingest_counts("orders", "landing", f"NOT ({VALID})"),
            _ingest_counts("customer", "customer", "c_custkey % 29 = 0"),
            _ingest_counts("part", "part", "p_partkey % 31 = 0"),
        ]
    ),
    "q28_stage_dropping": VALIDATED,
    "q29_batch_dedupe_hot_key": """SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) = 1""",
    "q30_load_twice": FIRST_LINES,
    "q31_load_bucketed": LOADED_BEFORE,
    "q32_two_files_one_day": VALIDATED,
    "q33_two_streams": VALIDATED,
    "q34_typed_quarantine": f"WITH {TYPED_LANDING} "
    + _union(
        f"SELECT id, day, \"at\", n, '{reason}' AS reason FROM typed WHERE {broken}"
        for reason, broken in {
            "not_int:id": "k % 17 = 0",
            "not_date:day": "k % 7 = 0 OR k % 19 = 0",
            "not_timestamp_ntz:at": "k % 23 = 0",
            "not_smallint:n": "k % 40000 > 32767",
        }.items()
    ),
    "q35_mixed_folder": f"WITH {LANDING} "
    + _union(
        [
            *[
                f"""SELECT '{name}' AS table_name, 'ingest' AS step, 'ok' AS status,
  CAST(1 AS BIGINT) AS n_runs, count(*) AS scanned, count(*) FILTER (WHERE {good}) AS accepted,
  count(*) FILTER (WHERE {good}) AS loaded FROM {source}"""
                for name, source, good in (
                    ("orders", "landing", VALID),
                    ("customer", "customer", "c_custkey % 29 <> 0"),
                    ("part", "part", "p_partkey % 31 <> 0"),
                )
            ],
            *[
                f"""SELECT '{name}' AS table_name, 'gate' AS step, 'failed' AS status,
  CAST(1 AS BIGINT) AS n_runs, CAST(0 AS BIGINT) AS scanned, CAST(0 AS BIGINT) AS accepted,
  CAST(0 AS BIGINT) AS loaded"""
                for name in ("products", "customer")
            ],
        ]
    ),
    "q36_two_rules_one_column": f"WITH {LANDING} "
    + _union(
        f"SELECT {COLUMNS}, '{reason}' AS reason FROM landing WHERE {broken}"
        for reason, broken in {
            "not_in_set:name": "name NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
            "not_in_set:name#2": "name NOT IN ('2-HIGH', '3-MEDIUM', '5-LOW')",
            "no_reference:department_id": f"""department_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'AFRICA' AND n_nationkey = {lenient('department_id')})""",
            "no_reference:department_id#2": f"""department_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM region WHERE r_regionkey = {lenient('department_id')})""",
        }.items()
    ),
    "q37_failed_runs": f"""WITH {LANDING}
SELECT 'ingest' AS step, 'good' AS batch_id, 'ok' AS status, count(*) AS scanned,
  count(*) FILTER (WHERE {VALID}) AS accepted, count(*) FILTER (WHERE {VALID}) AS loaded
FROM landing UNION ALL
SELECT 'ingest', 'bad', 'failed', count(*), 0, -1 FROM landing UNION ALL
SELECT 'gate', 'missing', 'failed', -1, -1, -1""",
    "q38_recorded_schema": f"""WITH {LANDING}, n AS (
  SELECT count(*) FILTER (WHERE {VALID}) AS loaded FROM landing)
SELECT 'orders' AS table_name, loaded, name, type FROM n, (VALUES
  ('id', 'integer'), ('name', 'string'), ('datetime', 'timestamp_ntz'),
  ('department_id', 'integer'), ('job_id', 'integer')) AS f(name, type)""",
    "q39_expire": _union(
        f"SELECT '{s}' AS snapshot_id, '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for s in ("s2", "s3")
        for t in TABLES
    ),
    "q40_compacted": ALL_ORDERS,
    "q41_failed_repeat": ALL_ORDERS,
    "q42_keyless_repeat": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "q43_bucketed_replace": ALL_ORDERS,
    "q45_sketched_load": ALL_ORDERS,
    "q46_reupload": VALIDATED,
    "q47_replayed": VALIDATED,
    "q49_quoted_names": """SELECT c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN chr(13) || chr(10) ELSE chr(10) END
  || CASE WHEN c_custkey % 3 = 0 THEN '"é"; ü' ELSE '"e"; u' END AS c_name, c_nationkey, c_mktsegment,
  (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) AS spoiled FROM customer WHERE c_custkey % 29 <> 0""",
    "q50_merged_measures": """SELECT 'b' || (o_orderkey % 4) AS batch_id, 1 AS batches, count(*) AS n_rows,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS nulls, true AS keys_close FROM orders GROUP BY ALL""",
    "q48_parted_backup": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'late' ELSE o_orderpriority END AS o_orderpriority,
  1 AS parts_written, 0 AS parts_wrong FROM orders""",
    "q44_exact_casts": """WITH texts AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_orderkey AS VARCHAR) AS k,
    CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) + 8 * 3600 AS seconds FROM orders),
forms AS (SELECT o_orderkey, unnest(range(13)) AS form, day, k, seconds FROM texts)
SELECT o_orderkey, CAST(form AS INTEGER) AS form, CASE form
  WHEN 0 THEN day
  WHEN 4 THEN k || '.25'
  WHEN 6 THEN k || '.5'
  WHEN 9 THEN day || ' 10:00:00'
  WHEN 12 THEN CAST(seconds AS VARCHAR)
  ELSE 'refused' END AS value FROM forms""",
}
