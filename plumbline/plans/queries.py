"""The registered queries of the survey operators and their DuckDB SQL. Names begin with the operators they cover."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import camera as C
from plumbline.functions import geodesy as G
from plumbline.functions import geometry as M
from plumbline.functions import labels as L
from plumbline.operators import keyed as K
from plumbline.operators import order as R
from plumbline.operators import replay as Y
from plumbline.operators import spatial as S
from plumbline.operators import stats as A
from plumbline.plans.fixtures import table, view, with_views
from plumbline.streaming import telemetry as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
NORM = "upper(regexp_replace(regexp_replace(regexp_replace(label, '^(CHK-|GCP-|DUP-)', ''), '-dup[0-9]*$', ''), '[^A-Za-z0-9]', '', 'g'))"


def query(name: str, sql: str | None = None, views: str = ""):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(sql, views) if views else sql
        return f

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ------------------------------------------------------------------ marks, tiers, labels


@query("p03_f01_a05_a06_tiers", f"""
with n as (select {NORM} as norm, min(label) as label from fx_t group by 1),
k as (select {NORM} as norm, count(*) as marks from fx_g join fx_t using (tid) where src = 'tagged' group by 1),
v as (select {NORM} as norm, count(distinct iid) as visible from fx_e join fx_t using (tid) group by 1)
select n.norm, n.label, coalesce(marks, 0) as marks, visible, case when coalesce(marks, 0) >= least(7, coalesce(visible, 7)) then 'green' when coalesce(marks, 0) >= least(3, coalesce(visible, 3)) then 'amber' else 'red' end as tier
from n left join k using (norm) left join v using (norm)""", "tge")
def tiers(spark, d):
    t = view(spark, d, "t").select("tid", "label", L.normalize_label(F.col("label")).alias("norm"))
    names = t.groupBy("norm").agg(F.min("label").alias("label"))
    marks = view(spark, d, "g").where("src = 'tagged'").groupBy("tid").agg(F.count("*").alias("k")).join(t, "tid").groupBy("norm").agg(F.sum("k").alias("marks"))
    seen = view(spark, d, "e").join(t, "tid").groupBy("norm").agg(F.countDistinct("iid").alias("visible"))
    out = names.join(marks, "norm", "left").join(seen, "norm", "left").withColumn("marks", F.coalesce("marks", F.lit(0)))
    out = out.withColumn("tier", K.tier(F.col("marks"), F.col("visible")))
    return out.orderBy(K.rank_of(F.col("tier"), K.TIER_RANK, 9), F.desc("marks"), "label")


@query("f02_f03_f04_f05_f07_labels", """
select tid, regexp_replace(regexp_replace(label, '^(CHK-|GCP-|DUP-)', ''), '-dup[0-9]*$', '') as base, (label like 'DUP-%' or regexp_matches(label, '-dup[0-9]*$')) as is_dup,
 cast(regexp_extract('EPSG:' || (6529 + tid % 3), '([0-9]+)', 1) as integer) as epsg, printf('%.3f', ellip_alt_m) as alt3,
 regexp_replace(regexp_replace(printf('%.3f', ellip_alt_m), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') as alt_trim from fx_t""", "t")
def labels(spark, d):
    t = view(spark, d, "t")
    return t.select("tid", L.base_label(F.col("label")).alias("base"), L.is_duplicate_label(F.col("label")).alias("is_dup"), L.epsg_number(F.concat(F.lit("EPSG:"), (6529 + F.col("tid") % 3).cast("string"))).alias("epsg"), L.fixed(F.col("ellip_alt_m"), 3).alias("alt3"), L.trimmed(F.col("ellip_alt_m"), 3).alias("alt_trim"))


@query("f03_short_image", "select iid, regexp_extract(image, '(\\d+)', 1) as short from fx_i", "i")
def short_image(spark, d):
    return view(spark, d, "i").select("iid", L.short_image(F.concat(F.lit("C:\\x\\"), F.col("image"))).alias("short"))


@query("p04_role_routing", """select case when label like 'GCP-%' then 'GCP' when label like 'CHK-%' then 'CHK' else 'other' end as role, count(*) as n, count(distinct iid) as n_images from fx_g join fx_t using (tid) group by 1""", "tg")
def routing(spark, d):
    role = F.when(F.col("label").startswith("GCP-"), "GCP").when(F.col("label").startswith("CHK-"), "CHK").otherwise("other")
    return view(spark, d, "g").join(F.broadcast(view(spark, d, "t").select("tid", role.alias("role"))), "tid").groupBy("role").agg(F.count("*").alias("n"), F.countDistinct("iid").alias("n_images"))


@query("p05_nadir_p14_counts", "select (gimbal_pitch is null or abs(gimbal_pitch + 90) <= 10) as nadir, count(*) as n from fx_i group by 1", "i")
def nadir(spark, d):
    return view(spark, d, "i").groupBy(C.is_nadir(F.col("gimbal_pitch")).alias("nadir")).agg(F.count("*").alias("n"))


@query("p06_min_confidence", "select src, count(*) as n from fx_e where case src when 'color' then 0 when 'tri_color' then 1 when 'tri_proj' then 2 when 'projection' then 3 else 99 end <= 1 group by src", "e")
def confidence(spark, d):
    return K.at_least_confident(view(spark, d, "e"), "src", "tri_color").groupBy("src").agg(F.count("*").alias("n"))


@query("p07_p08_j21_exclude", "select tid, label from fx_t where not regexp_matches(label, '-dup[0-9]*$') and label not like 'DUP-%' and tid not in (1, 2, 3) and tid in (select tid from fx_e)", "te")
def exclude(spark, d):
    drop = spark.createDataFrame([(1,), (2,), (3,)], "tid long")
    return view(spark, d, "t").where(~L.is_duplicate_label(F.col("label"))).join(F.broadcast(drop), "tid", "left_anti").join(view(spark, d, "e"), "tid", "left_semi").select("tid", "label")


@query("p09_p10_j07_monuments", """
with d as (select *, case tid % 6 when 1 then '3" BRASS disk' when 2 then 'Plastic Cap on rod' when 3 then 'aerial target' when 4 then 'nail, disk' end as description from fx_t),
near as (select distinct a.tid from d a join d b on a.origin = 'Global' and b.origin = 'Local' and sqrt(pow((b.lon - a.lon) * 111319.9 * cos(radians((a.lat + b.lat) / 2)), 2) + pow((b.lat - a.lat) * 111319.9, 2)) <= 40)
select t.tid, (origin = 'Local' or n.tid is not null or regexp_matches(lower(coalesce(description, '')), 'brass|alum cap|plastic cap|rebar|monument|ngs|control pt|control peg|survey marker|survey m')) as is_monument from d t left join near n on t.tid = n.tid""", "t")
def monuments(spark, d):
    k = F.col("tid") % 6
    t = view(spark, d, "t").withColumn("description", F.when(k == 1, '3" BRASS disk').when(k == 2, "Plastic Cap on rod").when(k == 3, "aerial target").when(k == 4, "nail, disk"))
    near = S.nearest_within(t.where("origin = 'Global'"), t.where("origin = 'Local'"), 40.0, 36.8, "tid").select(F.col("l_tid").alias("tid"))
    return K.monuments(t, near).select("tid", "is_monument")


@query("p12_w15_outliers", """
with x as (select tid, cast((tid * 31) % 97 as double) / 8 as dh from fx_t) select tid, dh, dh > greatest((select median(dh) from x) * 1.5, 0.5) as suspect from x""", "t")
def outliers(spark, d):
    return A.outliers(view(spark, d, "t").select("tid", ((F.col("tid") * 31) % 97).cast("double").alias("dh")).withColumn("dh", F.col("dh") / 8), "dh", 1.5)


DETAILS = ["error 3 more than 2.5 times the average GSD", "relative difference more than 20%", "less than 100% of cameras", "percentage of difference between", "Median of fewer than 10000 matches", "", None, "FAILED, a warning", "MEDIAN OF FEWER THAN"]
DETAIL = "case p_partkey % 9 " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(DETAILS) if x is not None) + " end as detail"
SEVERITY = "case when detail = '' then null when contains(detail, 'more than 2.5 times the average GSD') or contains(detail, 'more than 20%') or contains(detail, 'less than 100%') then 'fail' when contains(detail, 'percentage of difference between') or contains(detail, 'Median of fewer than') then 'warn' when detail is not null then 'ok' end"


def _details(spark, d):
    return table(spark, d, "part").select("p_partkey", F.element_at(F.array(*[F.lit(x) for x in DETAILS]), (F.col("p_partkey") % len(DETAILS) + 1).cast("int")).alias("detail"))


@query("p16_severity", f"select p_partkey, {SEVERITY} as sev from (select p_partkey, {DETAIL} from part)")
def severities(spark, d):
    return _details(spark, d).select("p_partkey", L.severity(F.col("detail")).alias("sev"))


@query("p17_actionable", f"""
with c as (select 'check ' || p_partkey as name, detail, {SEVERITY} as severity from (select p_partkey, {DETAIL} from part)),
p as (select label, case when tid % 5 <> 0 then tid % 4 end as marked, case when tid % 7 <> 0 then tid % 3 end as verified from fx_t)
select severity, name || ': ' || detail as message from c where severity in ('fail', 'warn')
union all select 'warn', 'GCP ' || label || ': solver verified ' || verified || '/' || marked || ' marks (rejected ' || (marked - verified) || ' as outliers)' from p where marked > 0 and verified < marked
union all select 'warn', 'GCP ' || label || ': 0 marks placed (untagged)' from p where marked = 0""", "t")
def actionable(spark, d):
    checks = _details(spark, d).select(F.concat(F.lit("check "), F.col("p_partkey").cast("string")).alias("name"), "detail", L.severity(F.col("detail")).alias("severity"))
    k = F.col("tid")
    points = view(spark, d, "t").select("label", F.when(k % 5 != 0, k % 4).alias("marked"), F.when(k % 7 != 0, k % 3).alias("verified"))
    return K.actionable(checks, points)


@query("p18_role_disagreement", """
with r as (select tid, label, case when tid % 4 = 0 then null when tid % 4 < 3 then 'control' else 'checkpoint' end as role from fx_t where tid % 6 <> 5)
select tid, role, coalesce(role, '') <> case when label like 'GCP-%' then 'control' else 'checkpoint' end as disagrees from r""", "t")
def role_disagreement(spark, d):
    k = F.col("tid")
    t = view(spark, d, "t").select("tid", "label", F.when(F.col("label").startswith("GCP-"), "GCP").otherwise("CHK").alias("grp"))
    report = t.where(k % 6 != 5).select("label", F.when(k % 4 == 0, None).when(k % 4 < 3, "control").otherwise("checkpoint").alias("role"))
    return K.role_disagreement(t, report).select("tid", "role", "disagrees")


# ------------------------------------------------------------------ joins


FOOT = "sqrt(pow((t.lon - i.lon) * 111319.9 * cos(radians(i.lat)), 2) + pow((t.lat - i.lat) * 111319.9, 2))"
RADIUS = "(i.abs_alt - (select avg(ellip_alt_m) from fx_t)) * tan(atan(43.2666 * 12.29 / 24 / (2 * 12.29)))"


def _in_footprint(t, i):
    """Images with all targets in their footprint; p_ (target) and c_ (image) prefixes."""
    mean = t.agg(F.avg("ellip_alt_m").alias("ground"))
    c = i.join(F.broadcast(mean)).withColumn("radius", C.footprint_radius(F.col("abs_alt") - F.col("ground"), F.col("focal_mm"), F.col("focal35_mm"), F.col("img_w"), F.col("img_h"), 50.0))
    top = c.agg(F.max("radius")).first()[0] or 1.0
    return S.within(t, c.drop("ground"), "radius", top, 36.8)


@query("j01_a12_f17_footprints", f"select i.iid, count(*) as n, min(t.tid) as lo, max(t.tid) as hi from fx_i i join fx_t t on {FOOT} <= {RADIUS} group by 1", "ti")
def footprints(spark, d):
    got = _in_footprint(view(spark, d, "t").select("tid", "lat", "lon", "ellip_alt_m"), view(spark, d, "i").select("iid", "lat", "lon", "abs_alt", "focal_mm", "focal35_mm", "img_w", "img_h"))
    return got.groupBy(F.col("c_iid").alias("iid")).agg(F.count("*").alias("n"), F.min("p_tid").alias("lo"), F.max("p_tid").alias("hi"))


@query("j03_offsets", """
select g.tid, count(*) as n, round(sum(g.px - e.px), 6) as dx, round(sum(g.py - e.py), 6) as dy from fx_g g join fx_e e using (tid, iid) where g.src = 'tagged' group by 1""", "ge")
def offsets(spark, d):
    e = view(spark, d, "e").select("tid", "iid", F.col("px").alias("ex"), F.col("py").alias("ey"))
    return view(spark, d, "g").where("src = 'tagged'").join(e, ["tid", "iid"]).groupBy("tid").agg(F.count("*").alias("n"), F.round(F.sum(F.col("px") - F.col("ex")), 6).alias("dx"), F.round(F.sum(F.col("py") - F.col("ey")), 6).alias("dy"))


def _taggers(spark, d):
    g = view(spark, d, "g").select(F.col("tid").alias("label"), F.col("iid").alias("image"), "px", "py", F.struct("l_linenumber", "l_partkey", "src").alias("seq"), "l_partkey")
    return g.drop("l_partkey"), g.where("l_partkey % 3 <> 0").withColumn("px", F.col("px") + F.col("label") % 30).drop("l_partkey")


@query("j04_a10_w03_u01_compare", """
with a as (select tid as label, iid as image, max_by(px, (l_linenumber, l_partkey, src)) as ax, max_by(py, (l_linenumber, l_partkey, src)) as ay from fx_g group by 1, 2),
b as (select tid as label, iid as image, max_by(px + tid % 30, (l_linenumber, l_partkey, src)) as bx, max_by(py, (l_linenumber, l_partkey, src)) as by_ from fx_g where l_partkey % 3 <> 0 group by 1, 2),
m as (select label, count(*) as n_match, median(sqrt((ax-bx)*(ax-bx) + (ay-by_)*(ay-by_))) as med_off, max(sqrt((ax-bx)*(ax-bx) + (ay-by_)*(ay-by_))) as max_off, count_if(sqrt((ax-bx)*(ax-bx) + (ay-by_)*(ay-by_)) <= 20) as n_near from a join b using (label, image) group by 1),
n as (select tid as label, count(*) as n_a, nullif(count_if(l_partkey % 3 <> 0), 0) as n_b from fx_g group by 1)
select label, n_a, n_b, n_match, round(med_off, 6) as med_off, round(max_off, 6) as max_off, cast(n_near as bigint) as n_near, case when n_b is null then 'only_a' when n_match is null then 'unmatched' else 'matched' end as kind from n left join m using (label)""", "g")
def compare(spark, d):
    return rounded(K.compare_taggers(*_taggers(spark, d)))


@query("j05_a11_errors", """
with x as (select g.tid, sqrt((g.px - e.px) * (g.px - e.px) + (g.py - e.py) * (g.py - e.py)) as err from fx_g g left join fx_e e on g.tid = e.tid and g.iid = e.iid and e.src <> 'projection')
select tid, count(*) as n, cast(count_if(err is null) as bigint) as missing, cast(count_if(err < 5) as bigint) as lt5, cast(count_if(err < 10) as bigint) as lt10, cast(count_if(err >= 50) as bigint) as ge50, round(avg(err), 6) as mean_err, round(max(err), 6) as max_err from x group by 1""", "ge")
def errors(spark, d):
    e = view(spark, d, "e").where("src <> 'projection'").select("tid", "iid", F.col("px").alias("ex"), F.col("py").alias("ey"))
    x = view(spark, d, "g").join(e, ["tid", "iid"], "left").withColumn("err", F.sqrt((F.col("px") - F.col("ex")) ** 2 + (F.col("py") - F.col("ey")) ** 2))
    c = lambda cond, n: F.count_if(cond).alias(n)
    return rounded(x.groupBy("tid").agg(F.count("*").alias("n"), c(F.col("err").isNull(), "missing"), c(F.col("err") < 5, "lt5"), c(F.col("err") < 10, "lt10"), c(F.col("err") >= 50, "ge50"), F.avg("err").alias("mean_err"), F.max("err").alias("max_err")))


@query("j06_variant_deltas", """
with a as (select tid, avg(px) as v from fx_g where src = 'tagged' group by 1), b as (select tid, avg(px) as v from fx_g where src = '' group by 1)
select cast(count_if(b.v - a.v < -5) as bigint) as improved, cast(count_if(b.v - a.v > 5) as bigint) as worsened, count(*) as n from a join b using (tid)""", "g")
def deltas(spark, d):
    g = view(spark, d, "g")
    a, b = (g.where(F.col("src") == s).groupBy("tid").agg(F.avg("px").alias(n)) for s, n in (("tagged", "a"), ("", "b")))
    return a.join(b, "tid").agg(F.count_if(F.col("b") - F.col("a") < -5).alias("improved"), F.count_if(F.col("b") - F.col("a") > 5).alias("worsened"), F.count("*").alias("n"))


@query("j08_o10_nearest_cameras", """
with q as (select tid, lon * 88000 as x, lat * 111319.9 as y from fx_t), c as (select iid, lon * 88000 as x, lat * 111319.9 as y from fx_i),
r as (select tid, iid, sqrt((q.x - c.x) * (q.x - c.x) + (q.y - c.y) * (q.y - c.y)) as dist, row_number() over (partition by tid order by sqrt((q.x - c.x) * (q.x - c.x) + (q.y - c.y) * (q.y - c.y)), iid) as rank from q, c)
select tid, iid, round(dist, 4) as dist, cast(rank as integer) as rank from r where rank <= 5""", "ti")
def nearest_cameras(spark, d):
    plane = lambda v, k: view(spark, d, v).select(k, (F.col("lon") * 88000).alias("x"), (F.col("lat") * 111319.9).alias("y"))
    got = S.k_nearest(plane("t", "tid"), plane("i", "iid"), 5, 60.0, "iid")
    return got.select(F.col("p_tid").alias("tid"), F.col("c_iid").alias("iid"), F.round("dist", 4).alias("dist"), "rank")


TRI = """f as (select pid * 2 as fid, pid as p1, pid + 1 as p2, pid + 20 as p3 from fx_p where pid % 20 < 19 union all select pid * 2 + 1, pid + 1, pid + 21, pid + 20 from fx_p where pid % 20 < 19),
tri as (select fid, a.x x1, a.y y1, a.z z1, b.x x2, b.y y2, b.z z2, c.x x3, c.y y3, c.z z3 from f join fx_p a on p1 = a.pid join fx_p b on p2 = b.pid join fx_p c on p3 = c.pid)"""


def _faces(spark, d):
    p = view(spark, d, "p")
    q = p.where("pid % 20 < 19")
    f = q.select((F.col("pid") * 2).alias("fid"), F.col("pid").alias("p1"), (F.col("pid") + 1).alias("p2"), (F.col("pid") + 20).alias("p3"))
    f = f.unionByName(q.select((F.col("pid") * 2 + 1).alias("fid"), (F.col("pid") + 1).alias("p1"), (F.col("pid") + 21).alias("p2"), (F.col("pid") + 20).alias("p3")))
    return S.faces_with_points(f, p)


@query("j09_j17_f21_tin_heights", f"""
with {TRI}, q as (select tid as pid, cast(tid * 37 % 190 as double) + 0.25 as x, cast(tid * 11 % 400 as double) + 0.25 as y from fx_t),
w as (select pid, x, y, fid, ((y2-y3)*(x-x3)+(x3-x2)*(y-y3))/((y2-y3)*(x1-x3)+(x3-x2)*(y1-y3)) as a, ((y3-y1)*(x-x3)+(x1-x3)*(y-y3))/((y2-y3)*(x1-x3)+(x3-x2)*(y1-y3)) as b, z1, z2, z3 from q join tri on x between least(x1,x2,x3) and greatest(x1,x2,x3) and y between least(y1,y2,y3) and greatest(y1,y2,y3)),
h as (select *, row_number() over (partition by pid order by fid) as rn from w where a between -1e-9 and 1+1e-9 and b between -1e-9 and 1+1e-9 and 1-a-b between -1e-9 and 1+1e-9)
select pid, x, y, round(a*z1+b*z2+(1-a-b)*z3, 6) as z, fid from h where rn = 1""", "tp")
def tin_heights(spark, d):
    q = view(spark, d, "t").select(F.col("tid").alias("pid"), ((F.col("tid") * 37 % 190).cast("double") + 0.25).alias("x"), ((F.col("tid") * 11 % 400).cast("double") + 0.25).alias("y"))
    return rounded(S.triangle_at(q, _faces(spark, d), 20.0))


@query("j10_j13_lookups", """
select n_name, r_name, count(*) as n, cast(count_if(o_orderkey is null) as bigint) as lost from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey left join orders on o_custkey = c_custkey group by 1, 2""")
def lookups(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("n_name", "r_name").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderkey").isNull()).alias("lost"))


@query("j11_star_join", """
with o as (select tid, count(*) as n_obs from fx_g group by 1), e as (select tid, count(*) as n_est, max(px) as max_px from fx_e group by 1)
select t.tid, n_obs, n_est, max_px from fx_t t left join o on t.tid = o.tid left join e on t.tid = e.tid""", "tge")
def star(spark, d):
    o = view(spark, d, "g").groupBy("tid").agg(F.count("*").alias("n_obs"))
    e = view(spark, d, "e").groupBy("tid").agg(F.count("*").alias("n_est"), F.max("px").alias("max_px"))
    return view(spark, d, "t").select("tid").join(o, "tid", "left").join(e, "tid", "left")


@query("j12_u04_token_match", """
with a as (select distinct s_suppkey as id, unnest(string_split_regex(upper(s_name), '[^A-Z0-9]+')) as tok from supplier), b as (select distinct c_custkey as id, unnest(string_split_regex(upper(c_name), '[^A-Z0-9]+')) as tok from customer),
h as (select a.id as l, b.id as r, count(*) as score from a join b on a.tok = b.tok and a.tok not in ('', 'SUPPLIER', 'CUSTOMER') group by 1, 2)
select l, r, score from (select *, row_number() over (partition by l order by score desc, r) as k from h) where k = 1""")
def token_match(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return S.token_match(a, b, ["SUPPLIER", "CUSTOMER"])


@query("j15_u01_u03_set_operations", """
select 'both' as kind, count(*) as n from (select tid from fx_g intersect select tid from fx_e where src = 'color') union all select 'only_g', count(*) from (select tid from fx_g except select tid from fx_e where src = 'color')
union all select 'any', count(*) from (select tid from fx_g union select tid from fx_e where src = 'color')""", "ge")
def set_operations(spark, d):
    a, b = view(spark, d, "g").select("tid"), view(spark, d, "e").where("src = 'color'").select("tid")
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(a.intersect(b), "both").unionByName(count(a.subtract(b), "only_g")).unionByName(count(a.union(b).distinct(), "any"))


@query("j16_camera_tiles", """
with t as (select i as tx, j as ty, i * 100 + 50.0 as x, j * 100 + 50.0 as y from range(0, 10) a(i), range(0, 12) b(j)), c as (select iid, (lon + 107.95) * 88000 as x, (lat - 36.80) * 111319.9 as y from fx_i)
select cast(tx as bigint) as tx, cast(ty as bigint) as ty, count(*) as n from t join c on sqrt((t.x-c.x)*(t.x-c.x)+(t.y-c.y)*(t.y-c.y)) < 150 group by 1, 2""", "i")
def camera_tiles(spark, d):
    c = view(spark, d, "i").select("iid", ((F.col("lon") + 107.95) * 88000).alias("x"), ((F.col("lat") - 36.80) * 111319.9).alias("y"))
    c = c.withColumn("tx", F.explode(F.sequence(F.floor(F.col("x") / 100) - 2, F.floor(F.col("x") / 100) + 2))).withColumn("ty", F.explode(F.sequence(F.floor(F.col("y") / 100) - 2, F.floor(F.col("y") / 100) + 2)))
    c = c.where("tx between 0 and 9 and ty between 0 and 11").withColumn("dist", F.sqrt((F.col("tx") * 100 + 50.0 - F.col("x")) ** 2 + (F.col("ty") * 100 + 50.0 - F.col("y")) ** 2))
    return c.where("dist < 150").groupBy("tx", "ty").agg(F.count("*").alias("n"))


@query("j18_prefix_lookup", """
with s as (select cast(tid as varchar) as k, tid from fx_t) select label, coalesce(a.tid, b.tid) as found from fx_t t left join s a on a.k = substr(label, strpos(label, '-') + 1) left join s b on b.k = label""", "t")
def prefix_lookup(spark, d):
    t = view(spark, d, "t").select("label", F.regexp_replace("label", "^[^-]*-", "").alias("bare"))
    s = view(spark, d, "t").select(F.col("tid").cast("string").alias("k"), "tid")
    a, b = s.select(F.col("k").alias("ka"), F.col("tid").alias("ta")), s.select(F.col("k").alias("kb"), F.col("tid").alias("tb"))
    return t.join(a, F.col("bare") == F.col("ka"), "left").join(b, F.col("label") == F.col("kb"), "left").select("label", F.coalesce("ta", "tb").alias("found"))


@query("j20_p13_raster_cells", """
with c as (select p_partkey % 20 as col, p_partkey // 20 as row, case when p_partkey % 9 = 0 then -9999.0 else p_retailprice end as v from part), q as (select tid, cast(tid * 37 % 210 as double) + 0.5 as x, cast(tid * 11 % 400 as double) + 0.5 as y from fx_t)
select tid, round(nullif(cast(v as double), -9999), 4) as value from q left join c on col = floor(x / 10) and row = floor(y / 10)""", "t")
def raster_cells(spark, d):
    k = F.col("p_partkey")
    c = table(spark, d, "part").select((k % 20).alias("col"), F.expr("p_partkey div 20").alias("row"), F.when(k % 9 == 0, -9999.0).otherwise(F.col("p_retailprice").cast("double")).alias("value"))
    q = view(spark, d, "t").select("tid", ((F.col("tid") * 37 % 210).cast("double") + 0.5).alias("x"), ((F.col("tid") * 11 % 400).cast("double") + 0.5).alias("y"))
    return S.raster_cell(q, c, [0, 10, 0, 0, 0, 10], -9999.0).select("tid", F.round("value", 4).alias("value"))


@query("j23_w06_selection", """
with w(pos, tid) as (values (0, 7), (1, 3), (2, 5)), r as (select pos, fx_e.tid, iid, row_number() over (partition by fx_e.tid order by iid) as rn from fx_e join w on fx_e.tid = w.tid) select cast(pos as integer) as pos, tid, iid, cast(rn as integer) as rn from r where rn <= 7""", "e")
def selection(spark, d):
    p = view(spark, d, "e").select(F.col("tid").cast("string").alias("label"), "tid", "iid", F.col("iid").alias("seq"))
    return K.select_images(p, ["7", "3", "5"], 7).select("pos", "tid", "iid", "rn")


@query("j24_a28_ablation", """
with r as (select tid, iid, row_number() over (partition by tid order by iid) as k, cast((tid * 31 + iid * 7) % 97 as double) / 100 as dh from fx_e), g(n, excl) as (select * from (values (1), (3), (5), (7), (null)) a(n), (values (false), (true)) b(e)),
v as (select n, excl, tid, round_even(avg(dh), 6) as dh from r, g where n is null or r.k <= n group by all)
select coalesce(cast(n as varchar), 'all') as n_images, excl, count(*) as n, round(sqrt(avg(dh * dh)), 6) as rms from v where not (excl and dh > 0.6) group by 1, 2""", "e")
def ablation(spark, d):
    rows = view(spark, d, "e").withColumn("dh", ((F.col("tid") * 31 + F.col("iid") * 7) % 97).cast("double") / 100).withColumn("k", F.row_number().over(Window.partitionBy("tid").orderBy("iid")))
    grid = F.explode(F.array(*[F.struct(F.lit(n).cast("int").alias("n"), F.lit(e).alias("excl")) for n in (1, 3, 5, 7, None) for e in (False, True)])).alias("g")
    v = rows.select("tid", "dh", "k", grid).where("g.n is null or k <= g.n").groupBy("g.n", "g.excl", "tid").agg(F.bround(F.avg("dh"), 6).alias("dh")).where("not (excl and dh > 0.6)")
    return rounded(v.groupBy(F.coalesce(F.col("n").cast("string"), F.lit("all")).alias("n_images"), "excl").agg(F.count("*").alias("n"), A.rms(F.col("dh")).alias("rms")))


@query("j25_w05_duplicates", """
with r as (select tid, label, row_number() over (partition by tid % 5 order by tid) as k, tid % 5 as prim from fx_t) select tid, 'P' || prim || '-dup' || case when k > 1 then cast(k as varchar) else '' end as dup_label from r""", "t")
def duplicates(spark, d):
    t = view(spark, d, "t").select("tid", F.concat(F.lit("P"), (F.col("tid") % 5).cast("string")).alias("prim"))
    return K.duplicate_names(t, "prim", ["tid"]).select("tid", "dup_label")


# ------------------------------------------------------------------ aggregates


@query("a01_a22_p12_group_stats", """
with r as (select case when label like 'GCP-%' then 'GCP' else 'CHK' end as grp, round(cast(tid % 13 as double) / 8, 6) as x, round(cast(tid % 7 as double) / 16, 6) as y, round(cast(tid % 5 as double) / 4 - 0.5, 6) as z from fx_t),
s as (select grp, count(*) as n, sqrt(avg(x*x)) as a, sqrt(avg(y*y)) as b, sqrt(avg(z*z)) as c, sqrt(avg(round(sqrt(x*x+y*y),6)*round(sqrt(x*x+y*y),6))) as h, avg(z) as m, stddev_pop(z) as sd from r group by 1),
u as (select grp, unnest(['rms_dX','rms_dY','rms_dZ','rms_dH','mean_dZ','std_dZ']) as metric, unnest([a,b,c,h,m,sd]) as value from s)
select metric, round_even(max(case when grp = 'GCP' then value end), 6) as "GCP", round_even(max(case when grp = 'CHK' then value end), 6) as "CHK" from u group by 1""", "t")
def group_stats(spark, d):
    k = F.col("tid")
    t = view(spark, d, "t").select(F.when(F.col("label").startswith("GCP-"), "GCP").otherwise("CHK").alias("grp"), ((k % 13).cast("double") / 8).alias("x"), ((k % 7).cast("double") / 16).alias("y"), ((k % 5).cast("double") / 4 - 0.5).alias("z"), *[F.lit(0.0).alias(f"survey_{a}") for a in "xyz"])
    s = A.group_stats(A.residuals(t), "grp", ["GCP", "CHK"])
    return A.side_by_side(s, "grp", ["rms_dX", "rms_dY", "rms_dZ", "rms_dH", "mean_dZ", "std_dZ"])


@query("a02_a03_a04_medians", """
select event_type, round(median(value), 6) as med, round(list_sort(list(value))[cast(floor(count(value) / 2) as bigint) + 1], 6) as upper_med, round(list_sort(list(value))[cast(floor(0.95 * (count(value) - 1)) as bigint) + 1], 6) as p95, round(min(value), 6) as lo, round(max(value), 6) as hi, round(avg(value), 6) as mean from events group by 1""")
def medians(spark, d):
    v = F.col("value")
    return rounded(table(spark, d, "events").groupBy("event_type").agg(F.median(v).alias("med"), A.upper_median(v).alias("upper_med"), A.index_percentile(v, 0.95).alias("p95"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean")))


CONS = """
with o as (select g.tid as label, e.src, g.px - e.px as dx, g.py - e.py as dy from fx_g g join fx_e e using (tid, iid) where g.src = 'tagged'),
s as (select label, count(*) as n_tagged, count_if(src in ('color','tri_color')) as n_color, count_if(src in ('color','tri_color') and sqrt(dx*dx+dy*dy) < 10) as n_anchor,
 avg(case when src in ('color','tri_color') and sqrt(dx*dx+dy*dy) < 10 then dx end) as ax, avg(case when src in ('color','tri_color') and sqrt(dx*dx+dy*dy) < 10 then dy end) as ay,
 median(case when src in ('color','tri_color') then dx end) as cx, median(case when src in ('color','tri_color') then dy end) as cy, median(dx) as mx, median(dy) as my from o group by 1),
c as (select *, case when n_anchor >= 3 then 'anchors' when n_color >= 1 then 'color' else 'all' end as consensus_src, case when n_anchor >= 3 then ax when n_color >= 1 then cx else mx end as cdx, case when n_anchor >= 3 then ay when n_color >= 1 then cy else my end as cdy from s),
r as (select label, count_if(sqrt((dx-cdx)*(dx-cdx)+(dy-cdy)*(dy-cdy)) > 50) as n_suspect, max(sqrt((dx-cdx)*(dx-cdx)+(dy-cdy)*(dy-cdy))) as max_resid, median(sqrt((dx-cdx)*(dx-cdx)+(dy-cdy)*(dy-cdy))) as med_resid from o join c using (label) where src in ('color','tri_color') group by 1)
select label, n_tagged, cast(n_color as bigint) as n_color, cast(n_anchor as bigint) as n_anchor, consensus_src, round(cdx, 5) as consensus_dx, round(cdy, 5) as consensus_dy, cast(coalesce(n_suspect, 0) as bigint) as n_suspect, round(coalesce(max_resid, 0), 5) as max_resid, round(coalesce(med_resid, 0), 5) as med_resid, round(sqrt(cdx*cdx+cdy*cdy), 5) as consensus_mag,
 round(case when n_color > 0 then coalesce(n_suspect, 0) / n_color * 2.0 else 0 end + greatest(0.0, 0.3 - case when n_color > 0 then n_anchor / n_color else 0 end) * 3.33 + least(1.0, greatest(0.0, sqrt(cdx*cdx+cdy*cdy) - 20) / 80), 5) as score
from c left join r using (label)"""


def _offsets(spark, d):
    e = view(spark, d, "e").select("tid", "iid", F.col("px").alias("ex"), F.col("py").alias("ey"), F.col("src").alias("esrc"))
    x = view(spark, d, "g").where("src = 'tagged'").join(e, ["tid", "iid"])
    return x.select(F.col("tid").alias("label"), F.col("esrc").alias("src"), (F.col("px") - F.col("ex")).alias("dx"), (F.col("py") - F.col("ey")).alias("dy"))


@query("a07_a08_a09_consensus", CONS, "ge")
def consensus(spark, d):
    return rounded(A.consensus(_offsets(spark, d)), 5)


@query("a13_triangulation", """
with r as (select tid as label, cast(iid % 40 as double) * 5 as cx, cast(iid % 30 as double) * 7 as cy, 100.0 + cast(iid % 9 as double) as cz, cast(tid % 50 as double) as tx, cast(tid % 40 as double) as ty, cast(tid % 5 as double) as tz from fx_e),
k as (select label, count(distinct (cx, cy, cz)) as n, count(*) as m, any_value(tx) as tx, any_value(ty) as ty, any_value(tz) as tz from r group by 1)
select label, m as n_rays, case when n >= 2 then tx end as x, case when n >= 2 then ty end as y, case when n >= 2 then tz end as z from k""", "e")
def triangulation(spark, d):
    i, t = F.col("iid"), F.col("tid")
    r = view(spark, d, "e").select(t.alias("label"), ((i % 40).cast("double") * 5).alias("cx"), ((i % 30).cast("double") * 7).alias("cy"), (100.0 + (i % 9).cast("double")).alias("cz"), (t % 50).cast("double").alias("tx"), (t % 40).cast("double").alias("ty"), (t % 5).cast("double").alias("tz"))
    n = F.sqrt(sum(((F.col(f"t{a}") - F.col(f"c{a}")) ** 2 for a in "yz"), (F.col("tx") - F.col("cx")) ** 2))
    r = r.select("label", "cx", "cy", "cz", *[((F.col(f"t{a}") - F.col(f"c{a}")) / n).alias(f"d{a}") for a in "xyz"])
    return A.triangulate(r).select("label", "n_rays", *[(F.round(a, 4) + 0.0).alias(a) for a in "xyz"])


@query("a16_p15_tile_stats", """
select p_size, count(*) as n, round(min(p_retailprice), 4) as lo, round(max(p_retailprice), 4) as hi, round(avg(p_retailprice), 4) as mean, round(stddev_pop(p_retailprice), 4) as sd, max(p_partkey % 7) = 0 as empty from part group by 1""")
def tile_stats(spark, d):
    v = F.col("p_retailprice").cast("double")
    return rounded(table(spark, d, "part").groupBy("p_size").agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), (F.max(F.col("p_partkey") % 7) == 0).alias("empty")), 4)


@query("a17_w10_box_consistency", """
with b as (select tid, iid, src, cast((tid * 7 + iid * 13) % 40 as double) as size from fx_e), m as (select tid, median(size) as med, count(*) as k from b where src = 'color' and size <> 0 group by 1),
r as (select tid, iid, src, size, med, src = 'color' and size <> 0 and k >= 2 and med >= 1 and not (size / med between 1 / 1.5 and 1.5) as reverted from b left join m using (tid))
select tid, iid, size, round(med, 6) as med, coalesce(reverted, false) as reverted, case when reverted then 'projection' else src end as src from r""", "e")
def boxes(spark, d):
    b = view(spark, d, "e").select("tid", "iid", "src", ((F.col("tid") * 7 + F.col("iid") * 13) % 40).cast("double").alias("size"))
    return rounded(A.box_consistent(b, "tid", "size")).select("tid", "iid", "size", "med", "reverted", "src")


@query("a21_anchor_agreement", """
with f as (select tid % 6 as job, tid, lat, lon, first_value(lat) over (partition by tid % 6 order by tid) as fa, first_value(lon) over (partition by tid % 6 order by tid) as fo from fx_t) select job, round(max(sqrt((lat-fa)*(lat-fa)+(lon-fo)*(lon-fo))), 8) as worst from f group by 1""", "t")
def anchor_agreement(spark, d):
    t = view(spark, d, "t").withColumn("job", F.col("tid") % 6)
    first = t.groupBy("job").agg(F.min_by(F.struct("lat", "lon"), "tid").alias("f"))
    off = F.sqrt((F.col("lat") - F.col("f.lat")) ** 2 + (F.col("lon") - F.col("f.lon")) ** 2)
    return t.join(F.broadcast(first), "job").groupBy("job").agg(F.round(F.max(off), 8).alias("worst"))


@query("a23_rollup_errors", """
with x as (select g.tid, sqrt((g.px - e.px) * (g.px - e.px) + (g.py - e.py) * (g.py - e.py)) as err from fx_g g join fx_e e using (tid, iid)) select tid, count(*) as n, round(avg(err), 6) as mean, round(sqrt(avg(err*err)), 6) as rms, round(max(err), 6) as worst from x group by rollup (tid)""", "ge")
def rollup_errors(spark, d):
    e = view(spark, d, "e").select("tid", "iid", F.col("px").alias("ex"), F.col("py").alias("ey"))
    x = view(spark, d, "g").join(e, ["tid", "iid"]).withColumn("err", F.sqrt((F.col("px") - F.col("ex")) ** 2 + (F.col("py") - F.col("ey")) ** 2))
    return rounded(x.rollup("tid").agg(F.count("*").alias("n"), F.avg("err").alias("mean"), A.rms(F.col("err")).alias("rms"), F.max("err").alias("worst")))


@query("a25_p22_components", """
with s as (select tid % 50 as comp, count(*) as n, avg(px) as cx, var_samp(px) as a, covar_samp(px, py) as b, var_samp(py) as c from fx_e group by 1)
select comp, n, round((a+c)/2 + sqrt(pow((a-c)/2, 2) + b*b), 2) as l1, round((a+c)/2 - sqrt(pow((a-c)/2, 2) + b*b), 2) as l2 from s where n >= 5""", "e")
def components(spark, d):
    return A.pca(view(spark, d, "e").withColumn("comp", F.col("tid") % 50), "comp", "px", "py").where("n >= 5").select("comp", "n", F.round("l1", 2).alias("l1"), F.round("l2", 2).alias("l2"))


@query("f22_affine", "select tid, round(1000 + (lon * 88000 - 1000) * 1.0003 + 12.5, 4) as x, round((lon * 88000 - 100) / 0.5, 4) as col from fx_t", "t")
def affine(spark, d):
    x = F.col("lon") * 88000
    return view(spark, d, "t").select("tid", F.round(M.scale_about(x, 1000.0, 1.0003, 12.5), 4).alias("x"), F.round(M.map_to_pixel(x, F.lit(0.0), [100, 0.5, 0, 0, 0, -0.5])[0], 4).alias("col"))


# ------------------------------------------------------------------ windows, order


@query("w01_repeated_labels", """
with r as (select tid, 'L' || (tid % 7) as label, row_number() over (partition by tid % 7 order by tid) as k from fx_t) select tid, case when k = 1 then label else label || '-' || (k - 1) end as label from r""", "t")
def repeated(spark, d):
    t = view(spark, d, "t").select("tid", F.concat(F.lit("L"), (F.col("tid") % 7).cast("string")).alias("label"))
    return K.ordinal_names(t, "label", ["tid"])


@query("w02_w12_first_and_worst", """
select tid, min_by(iid, (px, iid)) as first_iid, max_by(iid, (py, iid)) as worst_iid from fx_e group by 1""", "e")
def first_and_worst(spark, d):
    e = view(spark, d, "e")
    a = K.first_wins(e, ["tid"], ["px", "iid"]).select("tid", F.col("iid").alias("first_iid"))
    return a.join(K.last_wins(e, ["tid"], ["py", "iid"]).select("tid", F.col("iid").alias("worst_iid")), "tid")


@query("w04_roles", "select tid, cast(row_number() over (order by tid) as integer) as rank, case when row_number() over (order by tid) <= 10 then 'GCP-' else 'CHK-' end as role from fx_t", "t")
def roles(spark, d):
    return K.roles(view(spark, d, "t").select("tid"), ["tid"], 10)


@query("w07_image_order", """
with s as (select tid, iid, sqrt((px - 2640.0) * (px - 2640.0) + (py - 1978.0) * (py - 1978.0)) / (sqrt(5280.0 * 5280 + 3956.0 * 3956) / 2) + case when iid % 5 = 0 then 0.2 else 0 end as score from fx_e)
select tid, iid, round(score, 6) as score, cast(row_number() over (partition by tid order by round(score, 9), iid) as integer) as rank from s""", "e")
def image_order(spark, d):
    e = view(spark, d, "e").join(view(spark, d, "i").select("iid", "img_w", "img_h", "gimbal_pitch"), "iid")
    far = F.sqrt((F.col("px") - F.col("img_w") / 2) ** 2 + (F.col("py") - F.col("img_h") / 2) ** 2) / (F.sqrt(F.col("img_w").cast("double") ** 2 + F.col("img_h").cast("double") ** 2) / 2)
    score = F.coalesce(far, F.lit(0.5)) + F.when(C.is_nadir(F.col("gimbal_pitch")), 0.0).otherwise(0.2)
    e = e.withColumn("score", score)
    return e.select("tid", "iid", F.round("score", 6).alias("score"), F.row_number().over(Window.partitionBy("tid").orderBy(F.round("score", 9), "iid")).alias("rank"))


@query("w09_w18_f29_tiles", """
with t as (select i as tx, j as ty from range(0, 12) a(i), range(0, 9) b(j)) select cast(tx as integer) as tx, cast(ty as integer) as ty, lpad(cast(row_number() over (order by ty, tx) as varchar), 3, '0') as name, cast(least(512, 6000 - tx * 512) as integer) as w, cast(least(512, 4500 - ty * 512) as integer) as h from t""")
def tiles(spark, d):
    t = spark.range(1).select(F.explode(M.tiles(F.lit(6000), F.lit(4500), 512)).alias("t")).select("t.*")
    return t.select("tx", "ty", F.lpad(F.row_number().over(Window.orderBy("ty", "tx")).cast("string"), 3, "0").alias("name"), "w", "h")


@query("w11_best_view", "select tid, min_by(iid, ((tid * 13 + iid * 7) % 90, iid)) as cam, min((tid * 13 + iid * 7) % 90) as angle from fx_e where (tid + iid) % 3 <> 0 group by 1", "e")
def best_view(spark, d):
    v = view(spark, d, "e").select("tid", F.col("iid").alias("cam"), ((F.col("tid") * 13 + F.col("iid") * 7) % 90).alias("angle"), ((F.col("tid") + F.col("iid")) % 3 != 0).alias("valid"))
    return S.best_camera(v, ["tid"])


@query("w13_t01_replay", """
with gone as (select tid, max(seq) as g from fx_m where op = 'RemoveTiePoints' group by 1), last as (select iid, tid, max(seq) as seq, max_by(px, seq) as px from fx_m where op = 'MarkTiePoint' group by 1, 2)
select iid, last.tid, seq, round(px, 6) as px from last left join gone on last.tid = gone.tid where g is null or seq > g""", "m")
def replay(spark, d):
    m = view(spark, d, "m").select("seq", "op", F.col("iid").alias("image"), F.col("tid").alias("label"), "px", F.lit(0.0).alias("py"), F.array("tid").alias("names"))
    return Y.replay(m).select(F.col("image").alias("iid"), F.col("label").alias("tid"), "seq", F.round("px", 6).alias("px"))


@query("a24_counter_rises", """
with e as (select event_id, event_type, epoch(ts) as s, value, lag(value) over (partition by event_type order by ts, event_id) as prev from events), r as (select *, case when prev is null then 0 when value < prev then value else value - prev end as rise from e)
select event_type, count(*) as n, round(sum(rise), 4) as rises from r group by 1""")
def counter_rate(spark, d):
    e = table(spark, d, "events")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    rise = F.col("value") - F.lag("value").over(w)
    e = e.withColumn("rise", F.when(rise < 0, F.col("value")).otherwise(F.coalesce(rise, F.lit(0.0))))
    return rounded(e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("rise").alias("rises")), 4)


@query("w14_trailing_rate", """
with r as (select event_id, user_id, cast(floor(epoch(ts)) as bigint) as s, value, value - lag(value) over (partition by user_id order by cast(floor(epoch(ts)) as bigint), event_id) as d from events),
x as (select event_id, user_id, s, case when d < 0 then value else coalesce(d, 0) end as rise from r)
select event_id, round(sum(rise) over (partition by user_id order by s range between 3600 preceding and current row) / 3600, 6) as rate from x""")
def trailing_rate(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    return A.rate(e, ["user_id"], "ts", "value", 3600, "event_id").select("event_id", F.round("rate", 6).alias("rate"))


@query("w16_sections", "select p_partkey, sum(case when p_partkey % 10 = 1 then 1 else 0 end) over (partition by p_size order by p_partkey) as section from part")
def sections(spark, d):
    w = Window.partitionBy("p_size").orderBy("p_partkey")
    return table(spark, d, "part").select("p_partkey", F.sum((F.col("p_partkey") % 10 == 1).cast("int")).over(w).alias("section"))


@query("w17_t04_idle_runs", """
with a as (select user_id, event_id, value < 40 as idle, sum(case when value < 40 then 0 else 1 end) over (partition by user_id order by event_id rows unbounded preceding) as part from events),
r as (select user_id, event_id, sum(case when idle then 1 else 0 end) over (partition by user_id, part order by event_id rows unbounded preceding) as run from a) select user_id, event_id, cast(run as bigint) as run, run >= 3 as kill from r""")
def idle_runs(spark, d):
    return A.idle_runs(table(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", F.col("value") < 40, 3).select("user_id", "event_id", "run", "kill")


@query("o02_o06_sorted", "select event_type, count(*) as n, max(value) as top from events group by 1")
def sorted_types(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top")).orderBy(F.desc_nulls_last("n"), "event_type")


@query("o03_top_suspects", """
with r as (select tid, iid, px, row_number() over (partition by tid order by px desc, iid) as k, count(*) over (partition by tid) as n from fx_e)
select tid, string_agg(cast(iid as varchar), ',' order by k) || case when max(n) > 5 then ' +' || (max(n) - 5) else '' end as listed from r where k <= 5 group by 1""", "e")
def top_suspects(spark, d):
    return A.overflow_list(view(spark, d, "e"), "tid", "iid", "px")


@query("o05_priority_limit", "select iid, tid, px from fx_e order by px desc, iid, tid limit 20", "e")
def priority_limit_all(spark, d):
    return view(spark, d, "e").orderBy(F.desc("px"), "iid", "tid").limit(20).select("iid", "tid", "px")


@query("j14_near_duplicates")
def near_duplicates(spark, d):
    t = view(spark, d, "t").select((F.col("tid") % 4).cast("string").alias("survey"), "tid", F.col("tid").alias("seq"), "lat", "lon")
    return R.split_near_duplicates(t, 60.0)


@query("w08_o04_structural_order")
def structural(spark, d):
    t = view(spark, d, "t").select((F.col("tid") % 4).cast("string").alias("survey"), "tid", F.col("tid").alias("seq"), (F.col("lon") * 88000).alias("x"), (F.col("lat") * 111319.9).alias("y"), F.col("ellip_alt_m").alias("z"))
    return R.structural_order(t, 0.02)


@query("a14_similarity")
def similarity(spark, d):
    p = view(spark, d, "p").withColumn("key", (F.col("pid") % 4).cast("string"))
    return R.fit_similarity(p.withColumns({"tx": 2 * F.col("y") + 5, "ty": -2 * F.col("x") + 7, "tz": 2 * F.col("z") - 3}), "key")


@query("a15_robust_points")
def robust_points(spark, d):
    e = view(spark, d, "e")
    i, t = F.col("iid"), F.col("tid")
    c = {"x": (i % 40).cast("double") * 5, "y": (i % 30).cast("double") * 7, "z": 100.0 + (i % 9).cast("double")}
    q = {"x": (t % 50).cast("double"), "y": (t % 40).cast("double"), "z": (t % 5).cast("double")}
    f, cx, cy = 1500.0, 5000.0, 5000.0  # looking straight down
    m = F.array(*[F.lit(v) if not hasattr(v, "alias") else v for v in (f, 0.0, -cx, -f * c["x"] + cx * c["z"], 0.0, f, -cy, -f * c["y"] + cy * c["z"], 0.0, 0.0, -1.0, c["z"])])
    depth = c["z"] - q["z"]
    e = e.select(t.cast("string").alias("label"), (f * (q["x"] - c["x"]) / depth + cx).alias("px"), (f * (q["y"] - c["y"]) / depth + cy).alias("py"), m.alias("matrix"), F.lit(10000.0).alias("w"), F.lit(10000.0).alias("h"), *[(q[a] + 1.0).alias(f"{a}0") for a in "xyz"])
    return rounded(R.robust_points(e, "label"), 4)


# ------------------------------------------------------------------ geodesy, cameras, rasters


@query("f16_geodesy", """
with a as (select tid, lat, lon, ellip_alt_m as alt, radians(lat) as la, radians(lon) as lo from fx_t), b as (select *, 1.0 / sqrt(6378137.0e0*6378137.0e0*cos(la)*cos(la) + 6356752.314245e0*6356752.314245e0*sin(la)*sin(la)) as r from a)
select tid, round((6378137.0e0*6378137.0e0*r + alt)*cos(la)*cos(lo), 3) as ex, round((6378137.0e0*6378137.0e0*r + alt)*cos(la)*sin(lo), 3) as ey, round((6356752.314245e0*6356752.314245e0*r + alt)*sin(la), 3) as ez, round(lat, 8) as lat, round(lon, 8) as lon, round(alt, 4) as alt from b""", "t")
def geodesy(spark, d):
    t = view(spark, d, "t")
    x, y, z = G.ecef(F.col("lat"), F.col("lon"), F.col("ellip_alt_m"))
    t = t.withColumns({"ex": x, "ey": y, "ez": z})
    la, lo, al = G.lla(F.col("ex"), F.col("ey"), F.col("ez"))
    return t.select("tid", *[F.round(c, 3).alias(c) for c in ("ex", "ey", "ez")], F.round(la, 8).alias("lat"), F.round(lo, 8).alias("lon"), F.round(al, 4).alias("alt"))


@query("f16_grid_round_trip", "select tid, round(lat, 6) as lat, round(lon, 6) as lon from fx_t", "t")
def grid_round_trip(spark, d):
    g = G.GRIDS[6533]
    t = view(spark, d, "t").select("tid", *[c.alias(n) for c, n in zip(G.to_grid(F.col("lat"), F.col("lon"), g), ("e", "n"))])
    la, lo = G.from_grid(F.col("e"), F.col("n"), g)
    return t.select("tid", F.round(la, 6).alias("lat"), F.round(lo, 6).alias("lon"))


PROJ = """
with q as (select i.iid, t.tid, (t.lon - i.lon) * 111319.9 * cos(radians((i.lat + t.lat) / 2)) as e, (t.lat - i.lat) * 111319.9 as n, t.ellip_alt_m - i.abs_alt as u, radians(gimbal_yaw) as psi, radians(gimbal_pitch) as th, case when abs(gimbal_roll - 180) < 1 then -1.0 else 1.0 end as flip from fx_i i join fx_t t on @FOOT@),
c as (select iid, tid, flip * (cos(psi)*e - sin(psi)*n) as x, flip * (sin(th)*sin(psi)*e + sin(th)*cos(psi)*n - cos(th)*u) as y, cos(th)*sin(psi)*e + cos(th)*cos(psi)*n + sin(th)*u as z from q),
f as (select 43.2666 * 12.29 / 24 / sqrt(1 + pow(5280.0/3956, 2)) as sh), p as (select iid, tid, z, 12.29 * 5280 / (sh * 5280.0/3956) * x / z + 2640 as px, 12.29 * 3956 / sh * y / z + 1978 as py from c, f)
select iid, tid, round(px, 4) as px, round(py, 4) as py from p where z > 0 and px >= 0 and px < 5280 and py >= 0 and py < 3956"""


@query("j01_f18_p14_footprint_projection", PROJ.replace("@FOOT@", f"{FOOT} <= {RADIUS}"), "ti")
def footprint_projection(spark, d):
    images = view(spark, d, "i").drop("image")
    axes = C.exif_axes({c: F.col(c) for c in images.columns})  # once for each camera, not for each pair
    x = _in_footprint(view(spark, d, "t").select("tid", "lat", "lon", "ellip_alt_m"), images.withColumns(axes))
    e, n = G.flat_offset(F.col("c_lat"), F.col("c_lon"), F.col("p_lat"), F.col("p_lon"))
    x = x.withColumns({"e": e, "n": n, "u": F.col("p_ellip_alt_m") - F.col("c_abs_alt")})
    along = lambda a: F.col(f"c_{a}e") * F.col("e") + F.col(f"c_{a}n") * F.col("n") + (F.col(f"c_{a}u") * F.col("u") if a != "x" else F.lit(0.0))
    x = x.withColumns({a: along(a) for a in "xyz"})
    cam = {c[2:]: F.col(c) for c in x.columns if c.startswith("c_")}
    px, py = C.on_sensor(cam, F.col("x"), F.col("y"), F.col("z"))
    return x.select(F.col("c_iid").alias("iid"), F.col("p_tid").alias("tid"), F.round(px, 4).alias("px"), F.round(py, 4).alias("py")).where("px is not null")


@query("f19_f20_gsd_and_uncertainty", """
select iid, round((abs_alt - 1700) * (43.2666 * 12.29 / 24 / sqrt(1 + pow(5280.0/3956, 2)) * 5280.0/3956) / (12.29 * 5280), 8) as gsd, round(0.1 * tan(radians(abs_alt - 1760)) + 0.05, 8) as sigma, round(least(greatest((abs_alt - 1775) / 20, 0.0), 1.0), 6) as shade from fx_i""", "i")
def gsd(spark, d):
    a = F.col("abs_alt")
    return view(spark, d, "i").select("iid", F.round(C.ground_sample(a - 1700, F.col("focal_mm"), F.col("focal35_mm"), F.col("img_w"), F.col("img_h")), 8).alias("gsd"), F.round(M.uncertainty(F.lit(0.1), F.radians(a - 1760), F.lit(0.05)), 8).alias("sigma"), F.round(M.ramp(a, 1775.0, 1795.0), 6).alias("shade"))


@query("f26_bilinear_f27_cells", """
with p as (select * from fx_p) select a.pid, round(0.25 * a.z + 0.25 * b.z + 0.25 * c.z + 0.25 * e.z, 6) as v, cast(least(floor(a.x / 190 * 4), 3) as bigint) as cell from p a join p b on b.pid = a.pid + 1 join p c on c.pid = a.pid + 20 join p e on e.pid = a.pid + 21""", "p")
def bilinear(spark, d):
    p = view(spark, d, "p")
    at = lambda n, k: p.select((F.col("pid") - k).alias("pid"), F.col("z").alias(n))
    x = p.join(at("zb", 1), "pid").join(at("zc", 20), "pid").join(at("ze", 21), "pid")
    half = F.lit(0.5)
    return x.select("pid", F.round(M.bilinear(F.col("z"), F.col("zb"), F.col("zc"), F.col("ze"), half, half), 6).alias("v"), M.grid_cell(F.col("x"), F.lit(0.0), F.lit(190.0), F.lit(4)).alias("cell"))


@query("p23_occlusion")
def occlusion(spark, d):
    c = view(spark, d, "p").select(F.floor(F.col("x") / 10).alias("col"), F.floor(F.col("y") / 10).alias("row"), F.col("z").alias("value"))
    r = view(spark, d, "t").select(F.col("tid").alias("rid"), (F.col("tid") * 7 % 190).cast("double").alias("x0"), (F.col("tid") * 3 % 90).cast("double").alias("y0"), F.lit(1760.0).alias("z0"), F.lit(95.0).alias("x1"), F.lit(45.0).alias("y1"), F.lit(1900.0).alias("z1"))
    return S.occluded(r, c, 10.0)


# ------------------------------------------------------------------ telemetry (batch forms of the streaming operators)


@query("t08_windows", """
select time_bucket(interval '1 hour', ts) as w_start, time_bucket(interval '1 hour', ts) + interval '1 hour' as w_end, event_type, count(*) as n, round(sum(value), 4) as total, round(avg(value), 4) as mean, round(min(value), 4) as low, round(max(value), 4) as high from events group by 1, 2, 3""")
def windows(spark, d):
    return rounded(T.windowed(table(spark, d, "events"), "1 hour"), 4)


@query("t04_sessions", """
with l as (select user_id, ts, case when lag(ts) over (partition by user_id order by ts) is null or ts - lag(ts) over (partition by user_id order by ts) >= interval '6 hours' then 1 else 0 end as new from events),
g as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from l)
select user_id, min(ts) as s_start, max(ts) + interval '6 hours' as s_end, count(*) as n from g group by user_id, k""")
def sessions(spark, d):
    return T.sessions(table(spark, d, "events").select("user_id", "ts"), "6 hours")


@query("t06_phase_changes", """
with b as (select user_id as project, event_id as seq, event_type as phase, lag(event_type) over (partition by user_id order by event_id) as prev from events) select project, seq, phase from b where prev is null or prev <> phase""")
def phases(spark, d):
    return T.phase_changes(table(spark, d, "events").select(F.col("user_id").alias("project"), F.col("event_id").alias("seq"), F.col("event_type").alias("phase")))


@query("t08_running_cost", "select event_id, user_id, round(sum(value) over (partition by user_id order by event_id rows unbounded preceding) * 1.008 / 3600, 6) as cost from events")
def running_cost(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "events").select("event_id", "user_id", F.round(F.sum("value").over(w) * 1.008 / 3600, 6).alias("cost"))


from plumbline.plans import report_queries  # noqa: E402, F401 (registers its queries here)
