"""Inputs of the registered queries, derived from the given tables.

Each is one SQL text over those tables that Spark and DuckDB both run.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidewatch.functions.shared import parts

#: A panel of suppliers by day in the columns of the raw member-day table.
RAW_PANEL = """
select cast(l_suppkey as bigint) as member_id,
       cast(l_shipdate as date) as activity_date,
       case l_suppkey % 5 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44' when 3 then '45-54' else '55+' end as age_band,
       cast(1 + l_suppkey % 120 as bigint) as membership_months,
       case when min(l_linenumber) > 4 then 'low' when min(l_linestatus) = 'F' then 'moderate' else 'high' end as activity_level,
       case l_suppkey % 3 when 0 then 'low' when 1 then 'medium' else 'high' end as reward_profile,
       case l_suppkey % 4 when 0 then 'low' when 1 then 'medium' else 'high' end as intervention_profile,
       cast(sum(cast(l_quantity as bigint)) * 500 as bigint) as daily_steps,
       cast(sum(cast(l_quantity as bigint)) as bigint) as active_minutes,
       case when min(l_linenumber) = 5 then null else 4.0e0 + min(l_linenumber) * 0.5e0 end as sleep_hours,
       cast(60 + 10 * (l_suppkey % 12) as bigint) as weekly_goal,
       case when min(l_linenumber) = 4 then null else cast(count(*) as bigint) end as app_sessions,
       cast(sum(case when l_returnflag <> 'N' then 1 else 0 end) as bigint) as rewards_viewed,
       cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as rewards_redeemed,
       max(l_discount) > 0.05e0 as intervention_received,
       case when max(l_discount) > 0.05e0 then max(l_tax) > 0.03e0 end as intervention_opened,
       case when max(l_discount) > 0.05e0 then max(l_tax) > 0.05e0 end as intervention_clicked,
       cast(case when min(l_linenumber) = 7 then 3 when min(l_linenumber) = 6 then 1 else 0 end as int) as record_delay_days
from lineitem group by l_suppkey, cast(l_shipdate as date)
"""

#: Users by day.
USER_DAY = """
select user_id as entity_id, cast(ts as date) as activity_date,
       cast(sum(cast(floor(value) as bigint)) as bigint) as active_minutes,
       cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) as app_sessions,
       cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) as rewards_viewed,
       cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint) as rewards_redeemed,
       max(600 + 20 * (user_id % 20)) as weekly_goal
from events group by user_id, cast(ts as date)
"""

#: Scored customers by day, with a known label; k is unique.
SCORED = """
select o_custkey as member_id, cast(o_orderdate as date) as prediction_date, max(o_orderkey) as k,
       round(max(cast(0.6 as double) * ((o_orderkey * 7919) % 10007) / 10007
             + cast(case when o_orderstatus = 'F' then 0.3 else 0.0 end as double)), 6) as p,
       max(case when o_orderstatus = 'F' then 1 else 0 end) = 1 as actual_label
from orders group by o_custkey, cast(o_orderdate as date)
"""

#: Contact context; some customers are missing and some rows break the context's rules.
CONTEXT = """
select c_custkey as member_id, (c_acctbal >= 0 and c_custkey % 17 <> 0) or c_custkey % 34 = 0 as contact_allowed,
       c_custkey % 17 = 0 as opted_out, c_custkey % 13 = 0 as active_case_open,
       case when c_custkey % 5 = 0 then null else cast(c_custkey % 30 as int) end as days_since_contact,
       cast(c_custkey % 4 as bigint) as interventions_last_28d
from customer where c_custkey % 11 <> 0
"""

THRESHOLD = 0.431
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


def build(spark: SparkSession, sf_dir: str, sql: str, deal: dict[str, str] | None = None) -> DataFrame:
    """A fixture over the tables of a directory; only the named tables are read. ``deal`` names, by table, a column by whose hash its rows are dealt first."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    frames = {f"t_{t}": spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    frames |= {f"t_{t}": frames[f"t_{t}"].repartition(parts(frames[f"t_{t}"]), c) for t, c in (deal or {}).items()}
    text = sql
    for t in used:
        text = re.sub(rf"\b(from|join)\s+{t}\b", rf"\1 {{t_{t}}}", text)
    return spark.sql(text, **frames)
