"""Catalogues, triggers, profiles and ledger events that Spark derives from the
data tables, so that metadata operators meet as many rows as the data has.

Every customer is a tenant with a schema of its own: a CUSTOMER table, and an
ORDERS and a LINES table for each month the customer ordered in. The NATION tables
all tenants refer to are in one shared schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorwell.operators.catalog import CONSTRAINTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _constraint(kind: str, owner, name, constraint, columns, r_owner=None, r_name=None, status=None):
    text = lambda v: F.lit(v).cast("string") if v is None or isinstance(v, str) else v
    return [
        text(owner).alias("owner"),
        text(name).alias("table_name"),
        text(constraint).alias("constraint_name"),
        F.lit(kind).alias("constraint_type"),
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        text(r_owner).alias("r_owner"),
        text(r_name).alias("r_constraint_name"),
        text(status if status is not None else "ENABLED").alias("status"),
    ]


def _tenant(key: str) -> Column:
    return F.concat(F.lit("C"), F.col(key).cast("string"))


def _named(prefix: str, part: str | Column) -> Column:
    column = F.col(part) if isinstance(part, str) else part
    return F.concat(F.lit(prefix), column.cast("string"))


def tenant_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_custkey, month, pending)``, one row per tenant and month."""
    month = F.date_format("o_orderdate", "yyyyMM").alias("month")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", month)
        .agg(F.bool_or(F.col("o_orderstatus") == "P").alias("pending"))
    )


def tenant_constraints(spark: SparkSession, sf_dir: str, last_order: bool = False) -> DataFrame:
    """Keys of all tenants. Foreign keys of a month with a pending order are
    disabled. ``last_order`` adds, for customers in debt, a key from CUSTOMER to
    the newest ORDERS table, which closes a cycle."""
    months = tenant_months(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    state = F.when(F.col("pending"), "DISABLED").otherwise("ENABLED")
    owner = _tenant("o_custkey")
    orders_pk = _named("PK_ORDERS_", "month")
    per_month = months.select(
        F.inline(
            F.array(
                F.struct(*_constraint("P", owner, _named("ORDERS_", "month"), orders_pk, ["ID"])),
                F.struct(
                    *_constraint(
                        "P", owner, _named("LINES_", "month"), _named("PK_LINES_", "month"), ["ID"]
                    )
                ),
                F.struct(
                    *_constraint(
                        "R", owner, _named("ORDERS_", "month"), "FK_ORDERS_CUSTOMER",
                        ["CUSTOMER_ID"], owner, "PK_CUSTOMER", state,
                    )
                ),
                F.struct(
                    *_constraint(
                        "R", owner, _named("LINES_", "month"), "FK_LINES_ORDERS",
                        ["ORDER_ID"], owner, orders_pk, state,
                    )
                ),
            )
        )
    )
    me = _tenant("c_custkey")
    per_customer = customer.select(
        F.inline(
            F.array(
                F.struct(*_constraint("P", me, "CUSTOMER", "PK_CUSTOMER", ["ID"])),
                F.struct(
                    *_constraint(
                        "R", me, "CUSTOMER", "FK_CUSTOMER_NATION", ["NATION_ID"],
                        "SHARED", _named("PK_NATION_", "c_nationkey"),
                    )
                ),
            )
        )
    )
    shared = table(spark, sf_dir, "nation").select(
        *_constraint(
            "P", "SHARED", _named("NATION_", "n_nationkey"), _named("PK_NATION_", "n_nationkey"), ["ID"]
        )
    )
    rows = per_month.unionByName(per_customer).unionByName(shared)
    if last_order:
        newest = months.groupBy("o_custkey").agg(F.max("month").alias("month"))
        in_debt = customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
        rows = rows.unionByName(
            newest.join(in_debt, "o_custkey").select(
                *_constraint(
                    "R", owner, "CUSTOMER", "FK_CUSTOMER_LAST_ORDER", ["LAST_ORDER_ID"],
                    owner, orders_pk,
                )
            )
        )
    return rows.select(*CONSTRAINTS.names)


def tables_of(constraints: DataFrame) -> DataFrame:
    """``(owner, table_name)``; every table has one primary key."""
    return constraints.where("constraint_type = 'P'").select("owner", "table_name")


def document_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trigger per document: its text around two sequence assignments."""
    body = F.concat_ws(
        " ",
        F.col("text"),
        F.concat(F.lit("\n:New.Doc_Id  := App."), F.col("lang"), F.lit("_seq.NEXTVAL;")),
        F.col("text"),
        F.concat(F.lit(":NEW.src$no="), F.col("lang"), F.lit("_src.nextval; :new.skipped := 1;")),
    )
    return table(spark, sf_dir, "documents").select(
        F.lit("DOCS").alias("owner"), _named("DOC_", F.upper("source")).alias("table_name"),
        body.alias("body"),
    )


def part_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile per part, its sales standing for rows and megabytes."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            (F.sum(F.col("l_quantity").cast("bigint")) * 50_000).alias("rows"),
            (F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / 1000).alias("size_mb"),
        )
    )
    return (
        table(spark, sf_dir, "part")
        .join(sold, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            "p_partkey",
            "rows",
            "size_mb",
            (F.col("p_type") == "PROMO").alias("wide"),
            (F.col("p_size") == 50).alias("refused"),
        )
    )


def _event_status() -> Column:
    states = {"signup": "PLANNED", "click": "RUNNING", "purchase": "DONE", "error": "FAILED"}
    status = F.lit(None).cast("string")
    for kind, state in states.items():
        status = F.when(F.col("event_type") == kind, state).otherwise(status)
    return status


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per user: sign-ups plan it, clicks run it, purchases and errors end it;
    views only set its snapshot."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        _named("j_", "user_id").alias("job_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_at"),
        F.when(kind == "signup", F.col("ts")).alias("created_at"),
        F.when(kind.isin("signup", "view"), F.col("props")).alias("snapshot_id"),
        _event_status().alias("status"),
        F.when(kind == "error", F.col("props")).alias("error"),
    )


def job_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per event, planned with a configuration stored as JSON."""
    mode = F.when(F.col("value") > 50, "per_table").otherwise("defer_insert_commits")
    config = F.struct(
        F.upper("event_type").alias("source_schema"),
        mode.alias("commit_mode"),
        F.array(F.lit("ORDERS"), _named("T_", "user_id")).alias("tables"),
    )
    return table(spark, sf_dir, "events").select(
        _named("j_", "user_id").alias("job_id"),
        F.col("event_id").alias("seq"),
        F.to_json(config).alias("config_json"),
    )


def table_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for tables of a job; the number in ``props`` names the table."""
    kind = F.col("event_type")
    amount = F.round(F.col("value") * 100).cast("bigint")
    return table(spark, sf_dir, "events").select(
        _named("j_", "user_id").alias("job_id"),
        _named("T_", F.regexp_extract("props", "[0-9]+", 0)).alias("table_name"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_at"),
        F.when(kind.isin("click", "view"), amount).alias("rows_source"),
        F.when(kind == "purchase", amount).alias("rows_target"),
        _event_status().alias("status"),
        F.when(kind == "error", F.col("props")).alias("error"),
    )
