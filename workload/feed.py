"""The given tables reshaped to the raw feed contract.

One line item is one delivered copy of an order: about four copies per key, ties on the
creation time, blanks, padding, NULLs, points outside the box, and cases that close before
they open. The text is the same for Spark and DuckDB but for the epoch functions. The line
items are joined last and by merge, both sides being the largest tables there are: the rows
are shuffled once, by the case key. (To DuckDB the hint is a comment.)
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.functions import flags
from civicflow.operators.clean import clean_requests
from civicflow.operators.dedup import keep_latest
from civicflow.session import configure

RAW_REQUESTS = """
select /*+ MERGE(line) */ o_orderkey as OBJECTID,
  case when l_linestatus='F' then 'End User Digest: ' || l_linenumber else 'Case ' || l_linenumber end as Case_Summary,
  o_orderstatus as Case_Status,
  case o_orderpriority when '1-URGENT' then 'Email - desk' when '5-LOW' then null else o_orderpriority end as Case_Source,
  {created_ms} as Case_Created_Date,
  cast(cast(o_orderdate as date) as string) as Case_Created_dttm,
  case when l_returnflag='N' then null else {shipped_ms} end as Case_Closed_Date,
  case when l_returnflag='N' then null else cast(cast(l_shipdate as date) as string) end as Case_Closed_dttm,
  case when l_linenumber=3 then ' Y ' else 'N' end as First_Call_Resolution,
  cast(80000 + c_custkey%300 as string) as Customer_Zip_Code,
  case when l_partkey%5=0 then '  ' else l_partkey || ' Main St' end as Incident_Address_1,
  case when l_suppkey%4=0 then ' Unit ' || l_suppkey || ' ' else null end as Incident_Address_2,
  case when l_partkey%5=0 then ' A St ' else null end as Incident_Intersection_1,
  case when l_partkey%5=0 then '' else null end as Incident_Intersection_2,
  cast(80000 + l_partkey%300 as string) as Incident_Zip_Code,
  case when l_linenumber=1 then null when l_linenumber=2 then cast(0.0 as double) else -105.0e0 + l_discount end as Longitude,
  case when l_linenumber=1 then null when l_linenumber=2 then cast(0.0 as double) else 39.5e0 + l_tax*6.25e0 end as Latitude,
  case when c_nationkey%7=0 then '   ' else '  ' || n_name || ' ' end as Agency,
  case when l_linenumber%2=0 then ' ' else ' Unit ' || n_regionkey end as Division,
  'Area ' || n_regionkey as Major_Area,
  case when l_returnflag='R' then '' else c_mktsegment end as Type,
  case when l_linenumber=7 then null else l_returnflag end as Topic,
  cast(c_custkey%3 as int) as Council_District,
  cast(n_regionkey as int) as Police_District,
  case when c_custkey%11=0 then ' ' else 'NB-' || (c_custkey%40) end as Neighborhood,
  cast(year(l_shipdate) as int) as ingest_year,
  cast(month(l_shipdate) as int) as ingest_month,
  cast(day(l_shipdate) as int) as ingest_day,
  cast(l_linenumber as int) as part_no, l_partkey as tb1, l_suppkey as tb2, l_extendedprice as tb3
from {orders}
join {customer} on c_custkey=o_custkey
join {nation}   on n_nationkey=c_nationkey
join {lineitem} as line on l_orderkey=o_orderkey
"""

# Order of delivery, newest first, without ties at any size.
DELIVERY_ORDER = (
    "Case_Created_Date desc nulls last, ingest_year desc, ingest_month desc, ingest_day desc, "
    "part_no desc, tb1, tb2, tb3"
)
EXTRA_COLUMNS = ["ingest_year", "ingest_month", "ingest_day", "part_no", "tb1", "tb2", "tb3"]
SPLIT_YEAR = 1998
# Feed rows in memory against the Parquet files they are joined from.
EXPANSION = 20.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = functools.partial(table, spark, sf_dir)
    text = RAW_REQUESTS.format(
        created_ms="unix_millis(cast(o_orderdate as timestamp))",
        shipped_ms="unix_millis(cast(l_shipdate as timestamp))",
        orders="{orders}",
        lineitem="{lineitem}",
        customer="{customer}",
        nation="{nation}",
    )
    return spark.sql(
        text,
        orders=read("orders"),
        lineitem=read("lineitem"),
        customer=read("customer"),
        nation=read("nation"),
    )


def dirty_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some keys and some creation times removed."""
    raw = raw_requests(spark, sf_dir)
    key = F.col("OBJECTID")
    return raw.withColumns(
        {
            "OBJECTID": F.when(key % 97 != 0, key),
            "Case_Created_Date": F.when(key % 89 != 0, F.col("Case_Created_Date")),
        }
    )


def delivery_order() -> list[Column]:
    down = ["ingest_year", "ingest_month", "ingest_day", "part_no"]
    return [
        F.col("Case_Created_Date").desc_nulls_last(),
        *(F.col(c).desc() for c in down),
        *(F.col(c).asc() for c in ["tb1", "tb2", "tb3"]),
    ]


def deduped(df: DataFrame, null_keys: str = "collapse") -> DataFrame:
    """Newest copy per key. The key is an inner join key and never NULL unless made so, so
    the branch for NULL keys is only asked for by the dirty variant."""
    return keep_latest(df, order=delivery_order(), null_keys=null_keys)


def clean(df: DataFrame, null_keys: str = "collapse") -> DataFrame:
    return clean_requests(df, order=delivery_order(), null_keys=null_keys)


def valid(df: DataFrame) -> DataFrame:
    """Clean cases that do not close before they open."""
    return clean(df).where(~flags.closed_too_early(F.col("created_at"), F.col("closed_at")))


def valid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(raw_requests(spark, sf_dir)).drop(*EXTRA_COLUMNS)


def delivery(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """First or second delivery of the feed; they overlap in one year."""
    year = F.col("ingest_year")
    raw = raw_requests(spark, sf_dir)
    return raw.where(year <= SPLIT_YEAR if number == 1 else year >= SPLIT_YEAR)
