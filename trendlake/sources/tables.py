"""The driver's parquet tables and the daily series Spark derives from them.

The test tables hold no health data, so the observation table (12-field
``OBS`` schema, one row per location and day) is derived from
``orders ⋈ customer ⋈ nation``:

* ``location`` = nation name, ``date`` = order day
* ``new_cases`` = orders that day, ``new_deaths`` = orders with status F,
  ``new_vaccinations`` = urgent orders (null when none)
* ``excess_mortality`` = mean customer balance of that day's orders (null when < 0)
* ``life_expectancy`` = mean balance of all the nation's customers (constant)
* ``total_*`` = running sums by location in date order

Plan: the three-way join is left to Catalyst/AQE (nation is a 25-row
dimension and is broadcast by its size statistics; orders ⋈ customer is a
sort-merge join on the customer key at scale, with AQE splitting a hot key);
the aggregation to (location, day) is partial before its shuffle, so the
second shuffle (by location, for the running sums) moves only
locations × days rows, independent of the order volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlake.schema import OBS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (location, date) counts from the order tables, before running sums."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    avg_bal = F.avg("c_acctbal")
    return (j.groupBy(F.col("n_name").alias("location"), F.to_date("o_orderdate").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("new_cases"),
                 F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double").alias("new_deaths"),
                 F.nullif(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)),
                          F.lit(0)).cast("double").alias("new_vaccinations"),
                 F.when(avg_bal < 0, F.lit(None).cast("double")).otherwise(avg_bal).alias("excess_mortality")))


def nation_life_expectancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("location"))
            .agg(F.avg("c_acctbal").alias("life_expectancy")))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived observation table in the 12-field ``OBS`` schema."""
    d = daily_counts(spark, sf_dir)
    # One row per nation: the nation dimension has a fixed 25 rows at every scale
    # factor, so this broadcast has a proven size bound (and spares the series a
    # sort-merge join: the windows below then need a single sort).
    d = d.join(F.broadcast(nation_life_expectancy(spark, sf_dir)), "location", "left")
    w = Window.partitionBy("location").orderBy("date")  # RANGE unbounded → current row
    d = (d.withColumn("total_cases", F.sum("new_cases").over(w))
          .withColumn("total_deaths", F.sum("new_deaths").over(w))
          .withColumn("total_vaccinations", F.sum("new_vaccinations").over(w))
          .withColumn("people_vaccinated", F.lit(None).cast("double"))
          .withColumn("people_fully_vaccinated", F.lit(None).cast("double")))
    return d.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OBS.fields])


def observations_sql() -> str:
    """The same derivation as ANSI SQL (runs unchanged in Spark SQL and DuckDB)."""
    return """
with d as (
  select n_name as location, cast(o_orderdate as date) as date,
         cast(count(*) as double) as new_cases,
         cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as double) as new_deaths,
         cast(nullif(sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end), 0) as double) as new_vaccinations,
         case when avg(c_acctbal) < 0 then null else avg(c_acctbal) end as excess_mortality
  from orders join customer on o_custkey = c_custkey
              join nation on c_nationkey = n_nationkey
  group by n_name, cast(o_orderdate as date)),
le as (
  select n_name as location, avg(c_acctbal) as life_expectancy
  from customer join nation on c_nationkey = n_nationkey group by n_name)
select d.location, d.date,
       sum(new_cases) over (partition by d.location order by d.date) as total_cases,
       new_cases,
       sum(new_deaths) over (partition by d.location order by d.date) as total_deaths,
       new_deaths,
       sum(new_vaccinations) over (partition by d.location order by d.date) as total_vaccinations,
       cast(null as double) as people_vaccinated,
       cast(null as double) as people_fully_vaccinated,
       new_vaccinations, le.life_expectancy, excess_mortality
from d left join le on d.location = le.location
"""
