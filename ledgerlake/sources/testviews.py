"""Banking-shaped raw tables derived from the driver's TPC-H-style tables.

There are no banking tables in the test data, so each raw table is a
projection of a driver table, written once as SQL that Spark and DuckDB
evaluate identically (integer arithmetic, CASE, casts, date + days).  The
same text feeds the Spark queries (through ``spark.sql`` with DataFrame
arguments) and the DuckDB oracle, so both sides start from equal inputs.

Every adapter reads its whole source table; modulo rules only shape values
(mixed case, NULLs, re-extracted versions) so that every branch of the models
fires.  Each raw table also carries a second, re-extracted copy of every row
whose timestamp is newer, older or equal, which the dedup step must resolve:

* customers      <- customer x nation x region (plus a re-extracted copy)
* accounts       <- orders   (plus a re-extracted copy; some of unknown customer)
* transactions   <- lineitem (its (orderkey, linenumber) repeats give natural
                    re-extracts; some rows point at an unknown account)
* loan_applications <- events (plus a re-extracted copy)
* nz_cities      <- the ten seed rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("customer", "nation", "region", "orders", "lineitem", "events")

# CTE bodies in definition order.  ``{name}`` marks a driver table; ``{TS}`` the
# zone-less timestamp type (TIMESTAMP_NTZ in Spark, TIMESTAMP in DuckDB).
FRAGMENTS: dict[str, str] = {}
DEPENDS: dict[str, tuple[str, ...]] = {}


def _frag(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    FRAGMENTS[name] = sql
    DEPENDS[name] = deps


_frag("customers_v1", """
SELECT c.c_custkey AS customer_id,
       split_part(c.c_name, '#', 1) AS first_name,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS last_name,
       DATE '1940-01-01' + CAST(c.c_custkey * 37 % 20000 AS INT) AS date_of_birth,
       CASE WHEN c.c_custkey % 10 = 0 THEN NULL
            ELSE 'customer' || CAST(c.c_custkey AS STRING) || '@example.com' END AS email,
       CASE WHEN c.c_custkey % 7 = 0 THEN NULL
            ELSE '+64 21 ' || CAST(100000 + c.c_custkey % 900000 AS STRING) END AS phone,
       CAST(1 + c.c_custkey % 300 AS STRING) || ' ' || n.n_name || ' Road' AS address_street,
       n.n_name AS address_city,
       r.r_name AS address_region,
       CAST(1000 + c.c_nationkey * 37 AS STRING) AS postcode,
       lower(c.c_mktsegment) AS customer_segment,
       CASE c.c_custkey % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'VERIFIED'
                            WHEN 2 THEN 'Pending' ELSE NULL END AS kyc_status,
       CAST('2000-01-01 09:00:00' AS {TS}) + INTERVAL '1' HOUR * CAST(c.c_custkey % 5000 AS INT) AS created_date,
       CAST('2001-01-01 00:00:00' AS {TS}) + INTERVAL '1' DAY * CAST(c.c_custkey % 300 AS INT) AS last_modified_date
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
""")

# A re-extracted copy of every customer: newer with a changed segment (id % 5),
# an exact copy (id % 11), otherwise an older stale version.
_frag("customers", """
SELECT * FROM customers_v1
UNION ALL
SELECT customer_id, first_name, last_name, date_of_birth, email, phone, address_street,
       address_city, address_region, postcode,
       CASE WHEN customer_id % 11 = 0 THEN customer_segment
            WHEN customer_id % 5 = 0 THEN 'private_banking'
            ELSE 'stale' END AS customer_segment,
       kyc_status, created_date,
       CASE WHEN customer_id % 11 = 0 THEN last_modified_date
            WHEN customer_id % 5 = 0 THEN last_modified_date + INTERVAL '1' DAY
            ELSE last_modified_date - INTERVAL '30' DAY END AS last_modified_date
FROM customers_v1
""", ("customers_v1",))

_frag("accounts_v1", """
SELECT o.o_orderkey AS account_id,
       CASE WHEN o.o_orderkey % 101 = 0 THEN -1 ELSE o.o_custkey END AS customer_id,
       'ACC-' || CAST(o.o_orderkey AS STRING) AS account_number,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'cheque' WHEN '2' THEN 'Savings'
            WHEN '3' THEN 'CREDIT' WHEN '4' THEN 'Term_Deposit' ELSE 'MORTGAGE' END AS account_type,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'everyday CHEQUE account' WHEN 1 THEN 'smart-saver plus'
            WHEN 2 THEN 'LOW RATE visa' WHEN 3 THEN NULL ELSE 'home  loan fixed' END AS product_name,
       CAST(10 + o.o_orderkey % 90 AS STRING) || '-' || CAST(1000 + o.o_orderkey % 9000 AS STRING) AS bsb_number,
       CASE WHEN o.o_orderkey % 50 = 0 THEN NULL
            WHEN o.o_orderkey % 3 = 0 THEN CAST(floor((o.o_totalprice - 250000) / 100) AS DECIMAL(18,2))
            ELSE CAST(o.o_totalprice - 250000 AS DECIMAL(18,2)) END AS balance,
       CASE WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN
            CAST(CASE o.o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5000 WHEN 2 THEN 200000 ELSE 500000 END
                 AS DECIMAL(18,2))
            ELSE NULL END AS credit_limit,
       CASE o.o_orderkey % 6 WHEN 0 THEN 'nzd' WHEN 1 THEN 'AUD' WHEN 2 THEN NULL ELSE 'NZD' END AS currency,
       CASE o.o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'CLOSED' ELSE 'Dormant' END AS status,
       CAST(o.o_orderdate AS DATE) AS open_date,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS DATE) + 400 ELSE NULL END AS close_date,
       o.o_orderdate + INTERVAL '1' HOUR * CAST(o.o_orderkey % 48 AS INT) AS last_modified_date
FROM {orders} o
""")

# Re-extracted copy of every account: newer with a changed balance and status
# (id % 7), an exact copy (id % 13), otherwise an older stale version.
_frag("accounts", """
SELECT * FROM accounts_v1
UNION ALL
SELECT account_id, customer_id, account_number, account_type, product_name, bsb_number,
       CASE WHEN account_id % 13 = 0 THEN balance
            WHEN account_id % 7 = 0 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(-1 AS DECIMAL(18,2)) END AS balance,
       credit_limit, currency,
       CASE WHEN account_id % 13 = 0 THEN status
            WHEN account_id % 7 = 0 THEN 'DORMANT'
            ELSE 'stale' END AS status,
       open_date, close_date,
       CASE WHEN account_id % 13 = 0 THEN last_modified_date
            WHEN account_id % 7 = 0 THEN last_modified_date + INTERVAL '2' DAY
            ELSE last_modified_date - INTERVAL '2' DAY END AS last_modified_date
FROM accounts_v1
""", ("accounts_v1",))

_frag("transactions", """
SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
       CASE WHEN l.l_partkey % 97 = 0 THEN -1 ELSE l.l_orderkey END AS account_id,
       l.l_shipdate + INTERVAL '1' HOUR * CAST(l.l_partkey % 24 AS INT) AS transaction_date,
       CAST(l.l_shipdate AS DATE) + 2 AS value_date,
       CAST(CASE WHEN l.l_suppkey % 3 = 0 THEN -1 ELSE 1 END
            * floor(l.l_extendedprice / CASE l.l_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 10
                                                            WHEN 2 THEN 1000 ELSE 10000 END)
            AS DECIMAL(18,2)) AS amount,
       CASE l.l_linenumber % 4 WHEN 0 THEN 'debit' WHEN 1 THEN 'DEBIT' WHEN 2 THEN 'Credit' ELSE NULL END
           AS transaction_type,
       CASE l.l_partkey % 5 WHEN 0 THEN 'eftpos' WHEN 1 THEN 'ONLINE' WHEN 2 THEN 'Atm'
                            WHEN 3 THEN 'mobile_app' ELSE NULL END AS channel,
       CASE l.l_partkey % 6 WHEN 0 THEN 'jb hi-fi nz' WHEN 1 THEN 'COUNTDOWN' WHEN 2 THEN 'the  warehouse'
                            WHEN 3 THEN NULL WHEN 4 THEN 'z energy' ELSE 'SkyCity casino' END AS merchant_name,
       CASE l.l_suppkey % 7 WHEN 0 THEN 'groceries' WHEN 1 THEN 'FUEL' WHEN 2 THEN 'gambling'
                            WHEN 3 THEN 'CRYPTO' WHEN 4 THEN 'Dining' WHEN 5 THEN NULL ELSE 'utilities' END
           AS merchant_category,
       CASE l.l_partkey % 9 WHEN 0 THEN 'AUCKLAND' WHEN 1 THEN 'wellington' WHEN 2 THEN 'Auckland CBD'
                            WHEN 3 THEN 'palmerston north' WHEN 4 THEN 'Sydney' WHEN 5 THEN NULL
                            WHEN 6 THEN 'nelson' WHEN 7 THEN 'Christchurch' ELSE 'london' END
           AS merchant_city,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE 'INV-' || CAST(l.l_orderkey AS STRING) END AS reference,
       CASE WHEN l.l_linenumber % 5 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END
           AS balance_after,
       l.l_discount > 0.08 AS is_fraud_flagged,
       CASE WHEN l.l_tax = 0 THEN NULL ELSE CAST(l.l_quantity * 2 AS DECIMAL(5,2)) END AS fraud_score,
       CASE l.l_returnflag WHEN 'R' THEN 'DECLINED' WHEN 'A' THEN 'SETTLED' ELSE 'settled' END AS status,
       l.l_shipdate + INTERVAL '1' DAY AS last_modified_date
FROM {lineitem} l
""")

_frag("loans_v1", """
SELECT e.event_id AS application_id,
       e.user_id AS customer_id,
       CASE e.event_id % 4 WHEN 0 THEN 'home_loan' WHEN 1 THEN 'PERSONAL_LOAN'
                           WHEN 2 THEN 'Auto_Loan' ELSE 'business_loan' END AS loan_type,
       CAST(e.value * 1000 AS DECIMAL(18,2)) AS applied_amount,
       CASE WHEN e.event_type IN ('purchase', 'signup') THEN CAST(e.value * 800 AS DECIMAL(18,2))
            ELSE NULL END AS approved_amount,
       CASE WHEN e.event_id % 6 = 0 THEN NULL
            ELSE CAST(CAST(300 + e.event_id % 500 AS DECIMAL(5,2)) * 0.01 AS DECIMAL(5,2)) END AS interest_rate,
       CASE WHEN e.event_id % 8 = 0 THEN NULL ELSE CAST(12 * (1 + e.event_id % 30) AS INT) END AS term_months,
       CAST(e.ts AS DATE) AS application_date,
       CASE WHEN e.event_type = 'view' THEN NULL
            ELSE CAST(e.ts AS DATE) + CAST(e.event_id % 20 AS INT) END AS decision_date,
       CASE e.event_type WHEN 'purchase' THEN 'APPROVED' WHEN 'signup' THEN 'approved'
                         WHEN 'error' THEN 'DECLINED' WHEN 'view' THEN 'PENDING' ELSE 'WITHDRAWN' END AS status,
       CASE WHEN e.event_type = 'error' THEN 'LOW CREDIT SCORE' ELSE NULL END AS decline_reason,
       CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST(300 + e.event_id * 7 % 601 AS INT) END AS credit_score,
       CASE WHEN e.event_id % 19 = 0 THEN NULL
            ELSE CAST(CAST(e.event_id % 100 AS DECIMAL(5,2)) * 0.01 AS DECIMAL(5,2)) END AS debt_to_income,
       e.ts AS last_modified_date
FROM {events} e
""")

# Re-extracted copy of every application: newer with a changed decision
# (id % 9), an exact copy (id % 10), otherwise an older stale version.
_frag("loan_applications", """
SELECT * FROM loans_v1
UNION ALL
SELECT application_id, customer_id, loan_type, applied_amount,
       CASE WHEN application_id % 10 = 0 THEN approved_amount
            WHEN application_id % 9 = 0 THEN CAST(NULL AS DECIMAL(18,2))
            ELSE approved_amount END AS approved_amount,
       interest_rate, term_months, application_date, decision_date,
       CASE WHEN application_id % 10 = 0 THEN status
            WHEN application_id % 9 = 0 THEN 'DECLINED'
            ELSE 'stale' END AS status,
       decline_reason, credit_score, debt_to_income,
       CASE WHEN application_id % 10 = 0 THEN last_modified_date
            WHEN application_id % 9 = 0 THEN last_modified_date + INTERVAL '3' HOUR
            ELSE last_modified_date - INTERVAL '3' HOUR END AS last_modified_date
FROM loans_v1
""", ("loans_v1",))

# The seed rows (fixed values of the reference's city list).
_frag("nz_cities", """
SELECT * FROM (VALUES
  ('Auckland', 'NZ', 'Auckland'),
  ('Wellington', 'NZ', 'Wellington'),
  ('Christchurch', 'NZ', 'Canterbury'),
  ('Hamilton', 'NZ', 'Waikato'),
  ('Tauranga', 'NZ', 'Bay of Plenty'),
  ('Dunedin', 'NZ', 'Otago'),
  ('Queenstown', 'NZ', 'Otago'),
  ('Napier', 'NZ', 'Hawke''s Bay'),
  ('Palmerston North', 'NZ', 'Manawatu'),
  ('Nelson', 'NZ', 'Nelson')
) AS t(city_name, country, region)
""")

RAW_NAMES = ("customers", "accounts", "transactions", "loan_applications")

# A watermark cut used by the incremental queries, inside every table's time range.
INCREMENTAL_CUTS = {
    "customers": "2001-06-01 00:00:00",
    "accounts": "2000-01-01 00:00:00",
    "transactions": "2000-06-30 00:00:00",
    "loan_applications": "2024-01-15 00:00:00",
}


def closure(names) -> list[str]:
    """Fragments needed for ``names``, in definition order."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n not in need:
            need.add(n)
            for d in DEPENDS[n]:
                visit(d)

    for n in names:
        visit(n)
    return [n for n in FRAGMENTS if n in need]


def ctes(names, dialect: str) -> list[tuple[str, str]]:
    """(name, body) pairs for a WITH clause, placeholders filled per dialect."""
    ts = "TIMESTAMP_NTZ" if dialect == "spark" else "TIMESTAMP"
    out = []
    for n in closure(names):
        body = FRAGMENTS[n].replace("{TS}", ts)
        if dialect != "spark":
            for t in SOURCE_TABLES:
                body = body.replace("{" + t + "}", t)
        out.append((n, body.strip()))
    return out


class SourceTables(dict):
    """Driver tables of one data directory, each read (and its footer parsed) once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __missing__(self, table: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        self[table] = df
        return df


def raw_table(spark: SparkSession, sf_dir: str, name: str,
              sources: SourceTables | None = None) -> DataFrame:
    """One banking raw table as a lazily planned DataFrame."""
    sources = sources if sources is not None else SourceTables(spark, sf_dir)
    parts = ctes([name], "spark")
    text = "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in parts) + f"\nSELECT * FROM {name}"
    used = {t: sources[t] for t in SOURCE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


class RawTables(dict):
    """The banking raw tables of one data directory, each planned on first use
    and projected onto its declared schema."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self.sources = SourceTables(spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        from .raw import conform
        df = conform(raw_table(self.spark, self.sf_dir, name, self.sources), name)
        self[name] = df
        return df

    def keys(self):
        return list(RAW_NAMES)

    def items(self):
        return [(n, self[n]) for n in RAW_NAMES]


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sources = SourceTables(spark, sf_dir)
    return {n: raw_table(spark, sf_dir, n, sources) for n in RAW_NAMES + ("nz_cities",)}
