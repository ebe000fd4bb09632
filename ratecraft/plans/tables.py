"""Load driver tables and derive the reference's roles from them.

Roles on the TPC-H-like tables (see FIXTURES.md section 3):
counts = line items per (nation, year, priority, return flag);
population = distinct ordering customers per (nation, year);
economy = order value and volume per (nation, year);
survey = share of each order status per (nation, year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.scalar import rate_per, truncate_int
from ratecraft.operators.joins import left_join
from ratecraft.sources.files import scan_parquet

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Return flags of the line-item table: the pivot levels of the rate table.
SITES = ("A", "N", "R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def known_site(site: str) -> F.Column:
    """The flag itself; a flag outside the list, for which the pivot has no column, is an error and
    does not vanish silently. Tested on the few aggregated rows, so no scan is spent on it."""
    c = F.col(site)
    message = F.concat(F.lit("return flag "), c, F.lit(f" is not among the pivot levels {SITES}"))
    return F.when(c.isNull() | c.isin(*SITES), c).otherwise(F.raise_error(message).cast("string"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to their customer's nation; one row per order."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.year("o_orderdate").cast("long").alias("yr"))
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nk"))
    return o.join(c, "o_custkey")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, pr, site, cnt): line items per nation, order year, priority and flag.

    Line items are pre-aggregated per (order, flag) before the big join, which
    shrinks the shuffled side and collapses a hot order key to at most 3 rows.
    """
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey", F.col("l_returnflag").alias("site"))
          .agg(F.count(F.lit(1)).alias("_c")))
    of = order_facts(spark, sf_dir).select(
        F.col("o_orderkey").alias("l_orderkey"), "nk", "yr",
        F.col("o_orderpriority").alias("pr"))
    return (li.join(of, "l_orderkey")
            .groupBy("nk", "yr", "pr", "site")
            .agg(F.sum("_c").cast("long").alias("cnt"))
            .withColumn("site", known_site("site")))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, population): distinct ordering customers per nation and order year.

    De-duplicate (customer, year) before joining the customer table; the count per
    (nation, year) then equals count(DISTINCT customer) with partial aggregation.
    """
    cy = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").cast("long").alias("yr")
    ).distinct()
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nk"))
    return (cy.join(c, "c_custkey").groupBy("nk", "yr")
            .agg(F.count(F.lit(1)).alias("population")))


def status_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, o_orderstatus, _n, _value): orders and order value per nation, year and
    status; economy and survey are both rolled up from it (a small table)."""
    return (order_facts(spark, sf_dir).groupBy("nk", "yr", "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("o_totalprice").alias("_value")))


def economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, gdp, n_jobs): order value (2 decimals) and order count per nation-year."""
    return (status_stats(spark, sf_dir).groupBy("nk", "yr")
            .agg(F.round(F.sum("_value"), 2).alias("gdp"),
                 F.sum("_n").cast("long").alias("n_jobs")))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, measure, response, data_value): share of each order status, in percent."""
    from pyspark.sql import Window
    per = status_stats(spark, sf_dir)
    # totals from the aggregated table (nations x years x statuses rows): no second
    # pass over the orders and no join
    tot = F.sum("_n").over(Window.partitionBy("nk", "yr"))
    return (per.withColumn("_t", tot)
            .select("nk", "yr", F.lit("order status").alias("measure"),
                    F.col("o_orderstatus").alias("response"),
                    (F.col("_n") / F.col("_t") * 100).alias("data_value")))


def rate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nk, yr, pr, site, cnt, population, rate): counts with population, rate per 100,000.

    J1 with the many-to-one check skipped in the plan (population is a group-by
    result, unique by construction); the population side is small per key and
    AQE broadcasts it once its runtime size is known.
    """
    r = left_join(counts(spark, sf_dir), population(spark, sf_dir), ["nk", "yr"])
    return r.withColumn("rate", truncate_int(rate_per("cnt", "population")))


def order_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiling frame with real gaps: every order, its returned-item totals (NULL when
    the order has no returned line) and a price column with NaN for open orders."""
    rr = (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
          .groupBy(F.col("l_orderkey").alias("o_orderkey"))
          .agg(F.sum("l_quantity").alias("r_qty"), F.avg("l_extendedprice").alias("r_price"),
               F.count(F.lit(1)).alias("r_lines")))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus",
        F.year("o_orderdate").cast("long").alias("yr"),
        F.when(F.col("o_orderstatus") == "O", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("price_nan"))
    return o.join(rr, "o_orderkey", "left")


def trial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a search log: user = trial, (ts, event_id) = step order, value = loss."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("trial_id"), "ts", "event_id", "event_type",
        F.col("value").alias("loss"),
        (F.unix_date(F.to_date("ts"))).cast("long").alias("epoch"))


def trial_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trial_id, value, n_steps, state): one row per trial.

    value = mean loss; state from the trial's last event: 'error' -> FAIL,
    'signup' -> PRUNED, anything else -> COMPLETE.
    """
    m = trial_metrics(spark, sf_dir)
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    return (m.groupBy("trial_id")
            .agg(F.avg("loss").alias("value"), F.count(F.lit(1)).alias("n_steps"),
                 last.alias("_last"))
            .select("trial_id", "value", "n_steps",
                    F.when(F.col("_last") == "error", "FAIL")
                    .when(F.col("_last") == "signup", "PRUNED")
                    .otherwise("COMPLETE").alias("state")))


LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
