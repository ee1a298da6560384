"""Claim-shaped views over the given tables, once as DataFrames and once as SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.cohort import ClaimTables, CohortOptions
from tabml.session import small_tasks

OPTIONS = CohortOptions(
    drug_pattern="%RING%", coverage_index=datetime.date(1998, 6, 30)
)


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once; naming it afterwards saves
    the job that would read it again."""
    small_tasks(spark)
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def member(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "c_custkey as person_id", "c_mktsegment as segment", "nullif(c_nationkey, 7) as region_code"
    )


def header(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as claim_id",
        "o_custkey as person_id",
        "case when o_orderkey % 97 = 0 then 'n/a'"
        " else cast(cast(o_orderdate as date) as string) end as service_from",
        "case when o_orderkey % 5 = 0 then null"
        " else cast(date_add(cast(o_orderdate as date), cast(o_orderkey % 7 as int)) as string)"
        " end as service_thru",
        "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'inst' else 'prof' end as claim_type",
        "nullif(o_orderstatus, 'P') as drg",
        "cast(o_orderkey % 200 as string) as bill_type",
        "case when o_orderkey % 89 = 0 then 'bad' else cast(o_totalprice as string) end"
        " as allowed_amount",
        "cast(floor(o_totalprice) / 100.0D as string) as copay_amount",
        "case when o_orderkey % 4 = 0 then null"
        " else cast(floor(o_totalprice * 2) / 100.0D as string) end as coinsurance_amount",
        "cast(o_orderkey % 50 as string) as deductible_amount",
        "nullif(o_orderkey % 100, 13) as provider_id",
    )


def line(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as claim_id",
        "l_linenumber as line_no",
        "case when l_returnflag = 'R' and l_linenumber = 1 then '0450'"
        " when l_returnflag = 'A' and l_linenumber = 2 then '0981' else '0300' end as revenue_code",
    )


def _line_parts(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf, "part")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )


def diagnosis(spark, sf) -> DataFrame:
    return _line_parts(spark, sf).selectExpr(
        "o_custkey as person_id",
        "l_orderkey as claim_id",
        "concat(lower(p_type), p_brand) as dx_code",
    )


def pharmacy(spark, sf) -> DataFrame:
    return _line_parts(spark, sf).selectExpr(
        "o_custkey as person_id",
        "case when l_orderkey % 53 = 0 then 'unknown'"
        " else cast(cast(l_shipdate as date) as string) end as fill_date",
        "l_partkey as ndc",
        "l_suppkey as prescriber_id",
        "case when l_orderkey % 31 = 0 then 'x'"
        " else cast(cast(l_quantity as int) as string) end as days_supply",
        "cast(l_extendedprice as string) as paid_amount",
        "p_name as drug_name",
    )


def provider(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey as provider_id",
        "case when s_nationkey % 6 = 0 then null else cast(s_nationkey as string) end as specialty",
    )


def claims(spark, sf) -> ClaimTables:
    return ClaimTables(
        member(spark, sf), header(spark, sf), line(spark, sf),
        diagnosis(spark, sf), pharmacy(spark, sf), provider(spark, sf),
    )


def scored(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as row_key",
        "case when l_returnflag = 'R' then 1 else 0 end as y",
        "((cast(l_quantity as bigint) + 3 * l_linenumber"
        " + case when l_returnflag = 'R' then 17 else 0 end) % 91) / 91.0D as score",
        "l_orderkey % 3 as grp",
    )


# The same views for the comparison engine. Dates are parsed where the view is made.
_VIEWS = {
    "x_member": """
  select c_custkey as person_id, c_mktsegment as segment, nullif(c_nationkey, 7) as region_code
  from customer""",
    "x_header": """
  select o_orderkey as claim_id, o_custkey as person_id,
    case when o_orderkey % 97 = 0 then 'n/a'
      else cast(cast(o_orderdate as date) as varchar) end as service_from,
    case when o_orderkey % 5 = 0 then null
      else cast(cast(o_orderdate as date) + cast(o_orderkey % 7 as int) as varchar) end as service_thru,
    case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'inst' else 'prof' end as claim_type,
    nullif(o_orderstatus, 'P') as drg,
    cast(o_orderkey % 200 as varchar) as bill_type,
    case when o_orderkey % 89 = 0 then 'bad' else cast(o_totalprice as varchar) end as allowed_amount,
    cast(floor(o_totalprice) / 100.0::double as varchar) as copay_amount,
    case when o_orderkey % 4 = 0 then null
      else cast(floor(o_totalprice * 2) / 100.0::double as varchar) end as coinsurance_amount,
    cast(o_orderkey % 50 as varchar) as deductible_amount,
    nullif(o_orderkey % 100, 13) as provider_id
  from orders""",
    "x_line": """
  select l_orderkey as claim_id, l_linenumber as line_no,
    case when l_returnflag = 'R' and l_linenumber = 1 then '0450'
      when l_returnflag = 'A' and l_linenumber = 2 then '0981' else '0300' end as revenue_code
  from lineitem""",
    "x_diagnosis": """
  select o_custkey as person_id, l_orderkey as claim_id, lower(p_type) || p_brand as dx_code
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "x_pharmacy": """
  select o_custkey as person_id,
    case when l_orderkey % 53 = 0 then 'unknown'
      else cast(cast(l_shipdate as date) as varchar) end as fill_date,
    l_partkey as ndc, l_suppkey as prescriber_id,
    case when l_orderkey % 31 = 0 then 'x'
      else cast(cast(l_quantity as int) as varchar) end as days_supply,
    cast(l_extendedprice as varchar) as paid_amount, p_name as drug_name
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "x_provider": """
  select s_suppkey as provider_id,
    case when s_nationkey % 6 = 0 then null else cast(s_nationkey as varchar) end as specialty
  from supplier""",
    "x_scored": """
  select l_orderkey * 10 + l_linenumber as row_key,
    case when l_returnflag = 'R' then 1 else 0 end as y,
    ((cast(l_quantity as bigint) + 3 * l_linenumber
      + case when l_returnflag = 'R' then 17 else 0 end) % 91) / 91.0::double as score,
    l_orderkey % 3 as grp
  from lineitem""",
    # One relation per kind of event, each event with its parsed day and its own flags.
    "visit": """
  select person_id, claim_id, upper(claim_type) as kind, drg, lpad(bill_type, 3, '0') as bill,
    try_cast(service_from as date) as day, try_cast(service_thru as date) as until, provider_id,
    try_cast(allowed_amount as double) as allowed, try_cast(copay_amount as double) as copay,
    try_cast(coinsurance_amount as double) as coinsurance, try_cast(deductible_amount as double) as deductible,
    urgent is not null as emergency,
    kind = 'INST' and (left(bill, 2) in ('11', '12') or drg is not null) as admitted,
    cast(emergency or coalesce(admitted, false) as bigint) as acute
 from x_header left join (select distinct claim_id as urgent from x_line
    where revenue_code = '0981' or left(revenue_code, 3) = '045') on claim_id = urgent
  where service_from is not null""",
    "fill": """
  select person_id, try_cast(fill_date as date) as day, ndc, prescriber_id, drug_name,
    cast(try_cast(days_supply as decimal(38, 0)) as int) as supply, try_cast(paid_amount as double) as paid
  from x_pharmacy where fill_date is not null""",
    "coding": """
  select x_diagnosis.person_id, day, left(upper(dx_code), 3) as family
  from x_diagnosis join (select claim_id, day from visit) using (claim_id)""",
    # Every month in which a member has a visit, and its last day.
    "person_month": """
  select distinct person_id, date_trunc('month', day)::date as index_month, last_day(day) as closing
  from visit semi join x_member using (person_id) where day is not null""",
}
_NEEDS = {
    "visit": ["x_header", "x_line"],
    "fill": ["x_pharmacy"],
    "coding": ["x_diagnosis", "visit"],
    "person_month": ["x_member", "visit"],
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the named views and whatever they need."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    views = ",\n".join(f"{n} as ({_VIEWS[n]})" for n in wanted)
    body = body.strip()
    if body.startswith("with "):
        return f"with {views},\n{body[5:]}"
    return f"with {views}\n{body}"


def cast_all(df: DataFrame) -> DataFrame:
    """Whole numbers to bigint, fractions to double rounded to 6 digits."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        col = F.col(f"`{f.name}`")
        if kind in ("int", "smallint", "tinyint", "boolean"):
            col = col.cast("bigint")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            col = F.round(col.cast("double"), 6)
        cols.append(col.alias(f.name))
    return df.select(*cols)
