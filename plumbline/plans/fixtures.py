"""Deterministic survey views over the driver's tables; the same SQL text runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TARGETS = """select s_suppkey as tid, concat(case when s_suppkey % 3 = 0 then 'GCP-' else 'CHK-' end, cast(s_suppkey as string), case when s_suppkey % 13 = 5 then '-dup' else '' end) as label,
  cast(36.80 as double) + cast((s_suppkey*7919) % 9973 as double)/cast(9973 as double)*cast(0.01 as double) as lat,
  cast(-107.95 as double) + cast((s_suppkey*104729) % 9967 as double)/cast(9967 as double)*cast(0.01 as double) as lon,
  cast(1700 as double) + cast((s_suppkey*31) % 97 as double)/cast(8 as double) as ellip_alt_m,
  case when s_suppkey % 10 = 0 then 'Local' else 'Global' end as origin,
  case when s_suppkey % 17 = 4 then 'FLOAT' else 'FIX' end as solution_status from {supplier}"""
IMAGES = """select o_orderkey as iid, concat('DJI_', lpad(cast(o_orderkey as string), 8, '0'), '_V.JPG') as image,
  cast(36.80 as double) + cast((o_orderkey*15485863) % 99991 as double)/cast(99991 as double)*cast(0.01 as double) as lat,
  cast(-107.95 as double) + cast((o_orderkey*32452843) % 99989 as double)/cast(99989 as double)*cast(0.01 as double) as lon,
  cast(1770 as double) + cast(o_orderkey % 41 as double) as abs_alt, cast(12.29 as double) as focal_mm, cast(24 as double) as focal35_mm, 5280 as img_w, 3956 as img_h,
  case when o_orderkey % 5 = 0 then cast(-60 as double) else cast(-90 as double) end as gimbal_pitch,
  cast((o_orderkey*7) % 360 as double) as gimbal_yaw, case when o_orderkey % 2 = 0 then cast(0 as double) else cast(180 as double) end as gimbal_roll from {orders}"""
ESTIMATES = """select distinct l_suppkey as tid, l_orderkey as iid,
  cast(100 + (l_suppkey*7919 + l_orderkey*104729) % 5000 as double) as px, cast(100 + (l_suppkey*104729 + l_orderkey*7919) % 3700 as double) as py,
  case (l_suppkey + l_orderkey) % 4 when 3 then 'projection' when 2 then 'tri_color' else 'color' end as src from {lineitem}"""
TAGS = """select l_suppkey as tid, l_orderkey as iid, l_partkey, l_linenumber,
  cast(100 + (l_suppkey*7919 + l_orderkey*104729) % 5000 + l_partkey % 7 - 3 + case when l_partkey % 11 = 0 then 60 else 0 end + (l_suppkey + l_orderkey) % 4 as double) as px,
  cast(100 + (l_suppkey*104729 + l_orderkey*7919) % 3700 + l_partkey % 5 - 2 as double) as py,
  case when l_returnflag = 'R' then 'tagged' else '' end as src from {lineitem} where l_partkey % 5 <> 0"""
MARKS = """select event_id as seq, case when event_type = 'error' then 'RemoveTiePoints' else 'MarkTiePoint' end as op, user_id as iid, event_id % 40 as tid, value as px from {events}"""
TIN = """select p_partkey as pid, cast(p_partkey % 20 as double)*cast(10 as double) as x, cast((p_partkey - p_partkey % 20) / 20 as double)*cast(10 as double) as y, cast(1700 as double) + cast((p_partkey*7919) % 997 as double)/cast(8 as double) as z from {part}"""
VIEWS = {"t": (TARGETS, "supplier"), "i": (IMAGES, "orders"), "e": (ESTIMATES, "lineitem"), "g": (TAGS, "lineitem"), "m": (MARKS, "events"), "p": (TIN, "part")}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, table = VIEWS[name]
    return spark.sql(text, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(sql: str, names: str) -> str:
    """DuckDB SQL with the named views in front."""
    heads = [f"fx_{n} as ({VIEWS[n][0].format(**{VIEWS[n][1]: VIEWS[n][1]})})" for n in names]
    return f"with {', '.join(heads)}{', ' if sql.lstrip().startswith('with ') else ' '}{sql.lstrip()[5:] if sql.lstrip().startswith('with ') else sql}"
