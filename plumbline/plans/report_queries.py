"""Queries of report tables, with DuckDB SQL; registered beside those of queries.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import geodesy as G
from plumbline.operators import reports as P
from plumbline.plans.fixtures import table, view
from plumbline.plans.queries import query, rounded
from plumbline.streaming import telemetry as T

FT = repr(G.US_FOOT)


@query("p19_j10_import_check", f"""
with d as (select tid, label, cast(tid * 10 as double) as e, cast(tid * 20 as double) as n, cast(tid as double) as z from fx_t), l as (select tid, label, case when tid % 4 <> 3 then cast(tid * 10 as double) + cast(tid % 5 as double) / 5 end as e, cast(tid * 20 as double) + cast(tid % 3 as double) / 5 as n, cast(tid as double) - cast(tid % 7 as double) / 8 as z from fx_t where tid % 10 = 0 or tid % 6 = 1),
x as (select tid, sqrt(pow(coalesce(l.e, 0) - d.e, 2) + pow(l.n - d.n, 2)) * {FT} as h, abs(l.z - d.z) * {FT} as dz from d join l using (tid))
select tid, nullif(concat_ws(', ', case when h > 0.15 then 'ΔH=' || printf('%.2f', h) || ' m > 0.15' end, case when dz > 0.15 then 'ΔZ=' || printf('%.2f', dz) || ' m > 0.15' end), '') as message, round(h, 6) as h_m, round(dz, 6) as dz_m from x""", "t")
def import_check(spark, d):
    k = F.col("tid")
    t = view(spark, d, "t").select("tid", F.col("tid").cast("string").alias("label"))
    dc = t.select("label", (k * 10).cast("double").alias("easting"), (k * 20).cast("double").alias("northing"), k.cast("double").alias("elevation"))
    own = t.where("tid % 10 = 0 or tid % 6 = 1").select("label", F.when(k % 4 != 3, (k * 10).cast("double") + (k % 5).cast("double") / 5).alias("easting"), ((k * 20).cast("double") + (k % 3).cast("double") / 5).alias("northing"), (k.cast("double") - (k % 7).cast("double") / 8).alias("elevation"))
    return rounded(P.import_check(dc, own).select(F.col("label").cast("long").alias("tid"), "message", "h_m", "dz_m"))


@query("p19_localization_check", f"""
with x as (select tid, cast(tid % 9 as double) / 32 as dist, abs(cast(tid % 5 as double) / 4) * {FT} as dz from fx_t)
select 'L' || tid || '↔G' || tid as label, nullif(concat_ws(', ', case when dist > 0.15 then 'ΔH=' || printf('%.3f', dist) || ' m > 0.15' end, case when dz > 0.2 then 'ΔZ=' || printf('%.3f', dz) || ' m > 0.20' end), '') as message from x""", "t")
def localization(spark, d):
    k = F.col("tid")
    pairs = view(spark, d, "t").select(F.concat(F.lit("L"), k.cast("string")).alias("local"), F.concat(F.lit("G"), k.cast("string")).alias("global"), ((k % 9).cast("double") / 32).alias("dist_m"), F.lit(100.0).alias("local_elev"), (100.0 + (k % 5).cast("double") / 4).alias("global_elev"))
    return P.localization_check(pairs, {"residual_z_m": 0.2}).select("label", "message")  # X08: one limit of its own


RTK = """r as (select label, solution_status, case when tid % 8 <> 0 then cast(tid % 16 as double) / 80 end as e, cast(tid % 11 as double) / 64 as n, cast(tid % 13 as double) / 32 as z, case when tid % 9 <> 0 then tid % 9 end as samples, cast(tid % 11 as double) / 2 as pdop from fx_t)"""


def _rtk(spark, d):
    k = F.col("tid")
    return view(spark, d, "t").select("label", "solution_status", F.when(k % 8 != 0, (k % 16).cast("double") / 80).alias("easting_rms"), ((k % 11).cast("double") / 64).alias("northing_rms"), ((k % 13).cast("double") / 32).alias("elevation_rms"), F.when(k % 9 != 0, k % 9).alias("samples"), ((k % 11).cast("double") / 2).alias("pdop"))


@query("p19_rtk_check", f"""with {RTK} select label, nullif(concat_ws(', ', case when solution_status <> 'FIX' then 'solu=' || solution_status end, case when e > 0.1 then 'eRMS=' || printf('%.3f', e) || ' > 0.10' end, case when n > 0.1 then 'nRMS=' || printf('%.3f', n) || ' > 0.10' end,
 case when z > 0.2 then 'elRMS=' || printf('%.3f', z) || ' > 0.20' end, case when samples < 5 then 'samples=' || samples || ' < 5' end, case when pdop > 4 then 'PDOP=' || printf('%.1f', pdop) || ' > 4.0' end), '') as message from r""", "t")
def rtk(spark, d):
    return P.rtk_check(_rtk(spark, d)).select("label", "message")


@query("a19_rtk_summary", f"with {RTK} select count(*) as n, count(*) filter (where solution_status = 'FIX') as n_fix, greatest(max(e), max(n)) as max_rms_h, max(z) as max_rms_v, min(samples) as min_samples from r", "t")
def rtk_summary(spark, d):
    return P.rtk_summary(_rtk(spark, d))


@query("j02_observations", """
with s as (select image, iid, 'cam' || (iid % 3) as camera from fx_i where iid % 5 <> 2), c as (select * from (values ('cam0', 0.85), ('cam1', 0.9)) x(camera, focal))
select e.tid, e.iid, camera, cast(focal as double) as focal, s.iid is null as missing from fx_e e join fx_i i using (iid) left join s on i.image = s.image left join c using (camera) where s.iid is null or focal is not null""", "ei")
def observed(spark, d):
    i = view(spark, d, "i").select("iid", "image")
    obs = view(spark, d, "e").select("tid", "iid").join(i, "iid")
    shots = i.where("iid % 5 <> 2").select("image", F.concat(F.lit("cam"), (F.col("iid") % 3).cast("string")).alias("camera"))
    cameras = spark.createDataFrame([("cam0", 0.85), ("cam1", 0.9)], "camera string, focal double")
    good = P.observations(obs, shots, F.broadcast(cameras)).select("tid", "iid", "camera", "focal", F.lit(False).alias("missing"))
    none = P.missing_shots(obs, shots).select("tid", "iid", F.lit(None).cast("string").alias("camera"), F.lit(None).cast("double").alias("focal"), F.lit(True).alias("missing"))
    return good.unionByName(none)


@query("j15_unmatched_locals", "select tid, label from fx_t where origin = 'Local' and tid % 20 <> 0", "t")
def unmatched(spark, d):
    t = view(spark, d, "t")
    return P.unmatched_locals(t, t.where("tid % 20 = 0").select(F.col("tid").alias("local_tid"))).select("tid", "label")


@query("j19_brown_models", "select iid, cast(case when iid % 3 = 1 then 0.7 when iid % 3 = 2 then 0.8 end as double) as focal from fx_i", "i")
def brown(spark, d):
    i = view(spark, d, "i").withColumn("img_w", (F.col("iid") % 3).cast("int"))
    models = spark.createDataFrame([(1, 3956, 0.7), (2, 3956, 0.8), (0, 1, 0.9)], "width int, height int, focal double").withColumn("camera_model", F.struct("focal"))
    return P.with_brown(i, F.broadcast(models)).select("iid", F.col("camera_model.focal").alias("focal"))


NORM = "upper(regexp_replace(regexp_replace(regexp_replace(label, '^(CHK-|GCP-|DUP-)', ''), '-dup[0-9]*$', ''), '[^A-Za-z0-9]', '', 'g'))"
STAR = f"""p as (select tid, label, case when label like 'GCP-%' then 'GCP' else 'CHK' end as grp, {NORM} as norm from fx_t),
g as (select 0 as s, tid as seq, cast(tid as varchar) as norm, 'control' as role, case when tid % 4 <> 1 then cast(tid % 8 as double) / 16 end as dx, cast(tid % 3 as double) / 8 as dy, cast(tid % 5 as double) / 16 as dz from fx_t where tid % 3 <> 1),
c as (select 1, tid, cast(tid as varchar), 'checkpoint', cast(tid % 8 as double) / 32, null, -cast(tid % 5 as double) / 32 from fx_t where tid % 2 = 0),
q as (select norm, arg_max(struct_pack(role := role, dh := case when dx is not null then sqrt(pow(coalesce(dx, 0), 2) + pow(coalesce(dy, 0), 2)) * {FT} end, dz := dz * {FT}), (s, seq)) as r from (select * from g union all select * from c) group by 1),
n as (select tid, count(*) as n from fx_e group by 1),
star as (select p.tid, p.grp, q.r.role as role, q.r.dh as qr_dH_m, q.r.dz as qr_dZ_m, case when p.tid % 6 < 4 then cast(p.tid % 6 as double) / 8 end as ortho_dH, case when p.tid % 11 <> 3 then coalesce(n.n, 0) else 0 end as n_images, case when p.tid % 7 <> 2 then cast(p.tid % 7 as double) / 8 - 0.25 end as tin_dZ from p left join q using (norm) left join n using (tid))"""


def _star(spark, d):
    k = F.col("tid")
    t = view(spark, d, "t").select("tid", "label", F.when(F.col("label").startswith("GCP-"), "GCP").otherwise("CHK").alias("grp"))
    cell = lambda m, n: (k % m).cast("double") / n
    g = t.where("tid % 3 <> 1").select(k.alias("seq"), F.concat(F.lit("GCP-"), k.cast("string")).alias("label"), F.when(k % 4 != 1, cell(8, 16)).alias("dx"), cell(3, 8).alias("dy"), cell(5, 16).alias("dz"), F.lit(1).alias("verified"), F.lit(2).alias("marked"))
    c = t.where("tid % 2 = 0").select(k.alias("seq"), F.concat(F.lit("chk "), k.cast("string")).alias("label"), cell(8, 32).alias("dx"), F.lit(None).cast("double").alias("dy"), (-cell(5, 32)).alias("dz"), F.lit(1).alias("verified"), F.lit(2).alias("marked"))
    c = c.withColumn("label", F.regexp_replace("label", "^chk ", "CHK-"))
    ortho, tin = t.where("tid % 6 < 4").select("label", cell(6, 8).alias("ortho_dH")), t.where("tid % 7 <> 2").select("label", (cell(7, 8) - 0.25).alias("tin_dZ"))
    counts = view(spark, d, "e").groupBy("tid").agg(F.count("*").alias("n_images")).where("tid % 11 <> 3").join(t.select("tid", "label"), "tid").select("label", "n_images")
    return P.report_points(t, P.quality_rows(g, c), ortho, counts, tin)


@query("j11_u02_report_points", f"with {STAR} select tid, grp, role, round(qr_dH_m, 6) as \"qr_dH_m\", round(qr_dZ_m, 6) as \"qr_dZ_m\", ortho_dH as \"ortho_dH\", n_images, tin_dZ as \"tin_dZ\" from star", "te")
def report_points(spark, d):
    return rounded(_star(spark, d).select("tid", "grp", "role", "qr_dH_m", "qr_dZ_m", "ortho_dH", "n_images", "tin_dZ"))


@query("a20_tin_stats", f"with {STAR} select grp, count(tin_dZ) as n, round(sqrt(avg(tin_dZ * tin_dZ)), 6) as \"rms_dZ\", round(avg(tin_dZ), 6) as \"mean_dZ\" from star group by 1", "te")
def tin_stats(spark, d):
    return rounded(P.tin_stats(_star(spark, d)))


@query("o01_worst_first", f"with {STAR} select tid, cast(row_number() over (order by ortho_dH desc nulls last, qr_dH_m desc nulls last, tid) as integer) as rank from star", "te")
def worst_first(spark, d):
    return P.worst_order(_star(spark, d), "ortho_dH", "qr_dH_m", "tid").select("tid", "rank")


@query("o09_error_table", f"with {STAR} select tid, cast(row_number() over (order by qr_dH_m desc nulls last, tid) as integer) as error_rank, cast(row_number() over (order by tin_dZ nulls last, tid) as integer) as delta_rank from star", "te")
def error_table(spark, d):
    return P.error_order(_star(spark, d), "qr_dH_m", "tin_dZ", "tid").select("tid", "error_rank", "delta_rank")


@query("a18_gate_summary", """
with g as (select tid, case tid % 7 when 0 then 'COLOR_INCONSISTENT' when 1 then 'SURVEY_DISAGREES' when 2 then 'skipped' when 3 then 'failed' else 'PASS' end as gate from fx_t)
select count(*) as n_total, count_if(gate = 'PASS') as n_pass, count_if(tid % 7 < 2) as n_suspect, count_if(gate = 'skipped') as n_skipped, count_if(gate = 'failed') as n_failed, cast(sum(tid % 4) as bigint) as promoted_proj, cast(sum(tid % 3) as bigint) as promoted_color from g""", "t")
def gates(spark, d):
    k = F.col("tid")
    gate = F.when(k % 7 == 0, "COLOR_INCONSISTENT").when(k % 7 == 1, "SURVEY_DISAGREES").when(k % 7 == 2, "skipped").when(k % 7 == 3, "failed").otherwise("PASS")
    return P.gate_summary(view(spark, d, "t").select(gate.alias("gate"), (k % 4).alias("n_promoted_proj"), (k % 3).alias("n_promoted_color")))


@query("a27_findings", "select tid, list(src order by iid, src) as messages, count(*) as n from fx_e group by 1", "e")
def finding_lists(spark, d):
    return P.findings(view(spark, d, "e"), "tid", "src", "iid")


@query("a29_f08_summary_rows", """
with c as (select p_size as page, p_partkey as seq, case p_partkey % 9 when 0 then 'Min' when 1 then ' Max' when 2 then 'Sigma' when 3 then null when 4 then '' else 'P' || p_partkey end as c0, p_partkey % 6 <> 5 as whole, cast(p_partkey as double) as v, case p_partkey % 4 when 0 then '3/5' when 1 then ' 4 / 4' when 2 then 'x/5' else '7' end as vm from part),
f as (select page, min(seq) as first from c where trim(coalesce(c0, '')) in ('Min', 'Max', 'Sigma') group by 1),
s as (select page, seq, v, whole, case when trim(coalesce(c0, '')) in ('Min', 'Max', 'Sigma') then lower(trim(c0)) when trim(coalesce(c0, '')) = '' and seq > first and whole then 'rms' end as stat from c join f using (page))
select page, stat, arg_max(v, seq) as dx, arg_max(struct_pack(x := case when whole then 0.5 end), seq).x::double as reproj_px, null::integer as verified, null::integer as marked from s where stat is not null group by 1, 2
union all select page, 'P', v, null, case when trim(vm) = '3/5' then 3 when trim(vm) = '4 / 4' then 4 end, case when trim(vm) = '3/5' then 5 when trim(vm) = '4 / 4' then 4 end from c where c0 like 'P%'""")
def summaries(spark, d):
    k = F.col("p_partkey")
    c0 = F.when(k % 9 == 0, "Min").when(k % 9 == 1, " Max").when(k % 9 == 2, "Sigma").when(k % 9 == 3, None).when(k % 9 == 4, "").otherwise(F.concat(F.lit("P"), k.cast("string")))
    whole = F.when(k % 6 != 5, "0.5").otherwise("n/a")
    vm = F.when(k % 4 == 0, "3/5").when(k % 4 == 1, " 4 / 4").when(k % 4 == 2, "x/5").otherwise("7")
    c = table(spark, d, "part").select(F.col("p_size").alias("page"), k.alias("seq"), c0.alias("c0"), F.format_number(k.cast("double"), 1).alias("c1"), F.lit("1").alias("c2"), F.lit("2").alias("c3"), whole.alias("c4"), vm.alias("c7"))
    v, m = P.marks_verified(F.col("c7"))
    none = F.lit(None).cast("int")
    points = c.where("c0 like 'P%'").select("page", F.lit("P").alias("stat"), F.col("seq").cast("double").alias("dx"), F.lit(None).cast("double").alias("reproj_px"), v.alias("verified"), m.alias("marked"))
    return P.summary_rows(c, ["page"]).select("page", "stat", "dx", "reproj_px", none.alias("verified"), none.alias("marked")).unionByName(points)


@query("k02_o04_tagging_rows", r"""
with t as (select tid, label, lon * 1000 as x, lat * 1000 as y, case when tid % 8 <> 7 then ellip_alt_m end as z, case when tid % 5 = 4 then tid - tid % 5 end as prim from fx_t),
e as (select tid, iid, px, py, src, iid as ir, case when iid % 2 = 0 then '1,2,3,4' end as box from fx_e),
j as (select *, row_number() over (order by coalesce(prim, tid), prim is not null, tid, ir) as rank from t join e using (tid) where z is not null)
select cast(rank as integer) as rank, concat_ws(chr(9), regexp_replace(regexp_replace(printf('%.3f', x), '(\.\d*?)0+$', '\1'), '\.$', ''), regexp_replace(regexp_replace(printf('%.3f', y), '(\.\d*?)0+$', '\1'), '\.$', ''), regexp_replace(regexp_replace(printf('%.3f', z), '(\.\d*?)0+$', '\1'), '\.$', ''),
 regexp_replace(regexp_replace(printf('%.2f', px), '(\.\d*?)0+$', '\1'), '\.$', ''), regexp_replace(regexp_replace(printf('%.2f', py), '(\.\d*?)0+$', '\1'), '\.$', ''), 'i' || iid, label, src, box) as line from j""", "te")
def tagging(spark, d):
    k = F.col("tid")
    t = view(spark, d, "t").select("label", "tid", (F.col("lon") * 1000).alias("x"), (F.col("lat") * 1000).alias("y"), F.when(k % 8 != 7, F.col("ellip_alt_m")).alias("z"), k.alias("target_rank"), F.when(k % 5 == 4, k - k % 5).alias("primary_rank"))
    e = view(spark, d, "e").join(t.select("tid", "label"), "tid").select("label", F.concat(F.lit("i"), F.col("iid").cast("string")).alias("image"), "px", "py", F.col("src").alias("confidence"), F.when(F.col("iid") % 2 == 0, "1,2,3,4").alias("marker_bbox"), F.col("iid").alias("image_rank"))
    return P.tagging_rows(t.drop("tid"), e)


@query("o07_label_lists", "select s_nationkey as nation, list_sort(list(distinct 'S' || (s_suppkey % 30))) as labels from supplier group by 1")
def lists(spark, d):
    return P.label_lists(table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.concat(F.lit("S"), (F.col("s_suppkey") % 30).cast("string")).alias("label")), "nation", "label")


@query("o08_point_order", """
with p as (select s_suppkey as id, case when s_suppkey % 4 = 0 then 'BM-' || s_suppkey else cast(s_suppkey as varchar) end as point from supplier) select point, cast(row_number() over (order by try_cast(point as bigint) is null, try_cast(point as bigint), point) as integer) as rank from p""")
def points(spark, d):
    k = F.col("s_suppkey")
    return P.point_order(table(spark, d, "supplier").select(F.when(k % 4 == 0, F.concat(F.lit("BM-"), k.cast("string"))).otherwise(k.cast("string")).alias("point")), "point")


@query("u05_alias_overlap", """
with a as (select n_nationkey as id, unnest(['n' || n_nationkey, 'r' || n_regionkey, 'm' || (n_nationkey % 7)]) as name from nation), b as (select r_regionkey as id, unnest(['r' || r_regionkey, 'm' || r_regionkey, 'r' || r_regionkey]) as name from region)
select distinct a.id as l, b.id as r from a join b using (name)""")
def aliases(spark, d):
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    n, r = F.col("n_nationkey"), F.col("r_regionkey")
    left = table(spark, d, "nation").select(n.alias("id"), F.array(s("n", n), s("r", F.col("n_regionkey")), s("m", n % 7)).alias("names"))
    return P.alias_overlap(left, table(spark, d, "region").select(r.alias("id"), F.array(s("r", r), s("m", r), s("r", r)).alias("names")))


@query("s01b_first_seen", """
with g as (select (seq * 7919) % 10007 as seq, tid from fx_m), f as (select tid, row_number() over (order by min(seq)) as o from g group by 1) select seq, tid, cast(o as integer) as label_order from g join f using (tid)""", "m")
def seen(spark, d):
    return P.first_seen(view(spark, d, "m").select(((F.col("seq") * 7919) % 10007).alias("seq"), "tid"), "tid", "seq").select("seq", "tid", "label_order")


@query("s01f_first_tagged", "select tid, arg_min(px, (iid, l_partkey, l_linenumber)) as px, arg_min(py, (iid, l_partkey, l_linenumber)) as py from fx_g where src = 'tagged' group by 1", "g")
def tagged(spark, d):
    return P.first_tagged(view(spark, d, "g").withColumn("seq", F.struct("iid", "l_partkey", "l_linenumber")), "tid")


@query("t03_sliding_rate", """
with e as (select user_id, value, event_id, ts, time_bucket(interval 900 seconds, ts, timestamp '1970-01-01') as b from events), w as (select user_id, event_id, ts, value, b - to_seconds(900 * k) as s from e, range(8) r(k)),
r as (select user_id, s, value, ts, lag(value) over (partition by user_id, s order by ts, event_id) as p from w)
select user_id, s as w_start, round(sum(case when p is null then 0 when value < p then value else value - p end) / 7200, 8) as rate from r group by 1, 2""")
def sliding(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return T.sliding_rate(e, ["user_id"], "value", "event_id", "2 hours", "15 minutes").select("user_id", F.col("w_start").cast("timestamp_ntz").alias("w_start"), F.round("rate", 8).alias("rate"))


@query("f15_grids", """
with c as (select s_suppkey as id, case s_suppkey % 6 when 0 then 'EPSG:6529' when 1 then '6533' when 2 then 'nad83(2011) / New Mexico East' when 3 then 'EPSG:65291' when 4 then 'epsg:32613' end as crs from supplier)
select id, cast(case id % 6 when 0 then 6529 when 1 then 6533 when 2 then 6530 when 4 then 32613 end as integer) as epsg, case when id % 6 in (0, 1) then 0.3048006096012192::double when id % 6 in (2, 4) then 1.0::double end as unit, case id % 6 when 0 then 'EPSG:6528' when 1 then 'EPSG:6532' when 2 then crs when 4 then crs end as metric from c""")
def grids(spark, d):
    k = F.col("s_suppkey")
    crs = F.element_at(F.array(*[F.lit(x) for x in ("EPSG:6529", "6533", "nad83(2011) / New Mexico East", "EPSG:65291", "epsg:32613", None)]), (k % 6 + 1).cast("int"))
    c = table(spark, d, "supplier").select(k.alias("id"), crs.alias("crs"))
    return c.select("id", G.grid_number(F.col("crs")).alias("epsg"), G.grid_unit(F.col("crs")).alias("unit"), G.metric_counterpart(F.col("crs")).alias("metric"))


@query("f23_f24_grids_of_one_zone", f"""
with t as (select tid, 450000 + cast(tid as double) * 3.25 as x, cast(tid as double) / 3 as z from fx_t)
select tid, 0.0::double as e_off, 0.0::double as n_off, round(z / {FT}, 6) as h, 0.0::double as design_e_off, 0.0::double as design_n_off, round(z / {FT}, 6) as design_h, x as same_x from t""", "t")
def one_zone(spark, d):
    """Metres to feet of one zone: the projection must cancel, whatever it is; offsets in feet from the plain ratio."""
    k = F.col("tid").cast("double")
    t = view(spark, d, "t").select("tid", (450000 + k * 3.25).alias("x"), (650000 + k / 7).alias("y"), (k / 3).alias("z"))
    xyz, a, b = [F.col(c) for c in "xyz"], G.GRIDS[6528], G.GRIDS[6529]
    e, n, h = G.reproject(*xyz, a, b)
    de, dn, dh = G.design_grid(*xyz, a, b, -1000.0, 250.5)
    off = lambda v, plain: F.abs(F.round(v - plain, 2))
    x, y = (F.col(c) / G.US_FOOT for c in "xy")
    return t.select("tid", off(e, x).alias("e_off"), off(n, y).alias("n_off"), F.round(h, 6).alias("h"), off(de, x - 1000).alias("design_e_off"), off(dn, y + 250.5).alias("design_n_off"), F.round(dh, 6).alias("design_h"), G.reproject(*xyz, a, a)[0].alias("same_x"))


@query("k12_metric_summary", """
with s as (select event_type, value, row_number() over (partition by event_type order by value) - 1 as k, count(*) over (partition by event_type) as n from events where value is not null)
select event_type, max(n) as n, round_even(min(value), 3) as min, round_even(max(case when k = floor(0.5 * (n - 1)) then value end), 3) as p50, round_even(max(case when k = floor(0.95 * (n - 1)) then value end), 3) as p95, round_even(max(value), 3) as max, round_even(avg(value), 3) as mean from s group by 1""")
def metric_summary(spark, d):
    from plumbline.sources.readers import metric_summary as summary

    return summary(table(spark, d, "events"), ["event_type"])
