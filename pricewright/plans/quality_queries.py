"""Queries of publishing and of data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import lifecycle, publish, quality
from . import market as M
from . import market_sql as R

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the orders: the old one lacks some, has others that are gone, and other prices and stamps."""
    o = M.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.lit(2).alias("computed"))
    k = F.col("o_orderkey") % 10
    old = o.filter(k != 1).withColumn("o_totalprice", F.when(k == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("computed", F.lit(1))
    return o.filter(k != 3), old


_VERSIONS = """with o as (select o_orderkey, o_custkey, o_totalprice, 2::int as computed from orders), new as (select * from o where o_orderkey % 10 <> 3),
old as (select o_orderkey, o_custkey, case when o_orderkey % 10 = 2 then o_totalprice + 1 else o_totalprice end as o_totalprice, 1::int as computed from o where o_orderkey % 10 <> 1)"""


@query(_VERSIONS + " select * from new where o_orderkey in (select o_orderkey from (select o_orderkey, o_custkey, o_totalprice from new except select o_orderkey, o_custkey, o_totalprice from old))")
def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    return publish.changed_rows(*versions(spark, d), ["o_orderkey"], ignore=["computed"])


@query(_VERSIONS + " select o_orderkey from old except select o_orderkey from new")
def snapshot_deletes(spark: SparkSession, d: str) -> DataFrame:
    return publish.deleted_keys(*versions(spark, d), ["o_orderkey"])


@query(_VERSIONS + " select coalesce(old.o_orderkey, new.o_orderkey) as o_orderkey, coalesce(old.o_custkey, new.o_custkey) as o_custkey, case when new.o_orderkey is null then old.o_totalprice else new.o_totalprice end as o_totalprice, coalesce(old.computed, new.computed) as computed from old full join new using (o_orderkey)")
def sale_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The old version merged with the new: prices overwritten, customers filled in, stamps left alone."""
    new, old = versions(spark, d)
    return publish.merged(old, new, ["o_orderkey"], ["o_totalprice"], ["o_custkey"])


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return quality.repeated(M.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_HARVEST = "h as (select source, lang, case when n_chars > 2000 then text end as text, nullif(n_chars % 3, 0) as n from documents)"
_SHARES = " union all ".join(f"select source, count(*) as n, '{f}' as field, round(avg(case when {f} is not null and {f}::varchar <> '' then 1.0 else 0.0 end), 6) as share from h group by source" for f in ("lang", "text", "n"))


def harvest(spark: SparkSession, d: str) -> DataFrame:
    return M.table(spark, d, "documents").select("source", "lang", F.when(F.col("n_chars") > 2000, F.col("text")).alias("text"), F.nullif(F.col("n_chars") % 3, F.lit(0)).alias("n"))


@query(f"with {_HARVEST} {_SHARES}")
def field_population(spark: SparkSession, d: str) -> DataFrame:
    h = harvest(spark, d).withColumnRenamed("n", "n_")
    return quality.population(h, ["lang", "text", "n_"]).select("source", "n", F.when(F.col("field") == "n_", "n").otherwise(F.col("field")).alias("field"), F.round("share", 6).alias("share"))


@query(f"with {_HARVEST}, s as ({_SHARES}) select source, field, n, share, round(0.75 - share, 6) as drop, 0.75 - share > 0.35 as drifted, n < 5 as low from s")
def drift_flags(spark: SparkSession, d: str) -> DataFrame:
    """Shares of filled fields against a baseline of 0.75 everywhere."""
    h = harvest(spark, d).withColumnRenamed("n", "n_")
    now = quality.population(h, ["lang", "text", "n_"]).withColumn("field", F.when(F.col("field") == "n_", "n").otherwise(F.col("field"))).withColumn("share", F.round("share", 6))
    base = now.select("source", "field", F.lit(0.75).alias("base_share"))
    return quality.drift(now, base).select("source", "field", "n", "share", F.round("drop", 6).alias("drop"), "drifted", "low")


@query("select ts::date as day, event_type, count(*) as n, count(distinct user_id) as users, round(sum(value), 2) as total from events group by all")
def daily_histogram(spark: SparkSession, d: str) -> DataFrame:
    return M.table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 2).alias("total"))


@query(f"with {R.TABLES} select source, max(sold_at) as newest, count(*) filter (date_diff('day', sold_at, {R.AS_OF}) <= 14) as last_14, count(*) filter (date_diff('day', sold_at, {R.AS_OF}) <= 30) as last_30, count(*) filter (date_diff('day', sold_at, {R.AS_OF}) <= 90) as last_90 from sale group by source")
def source_freshness(spark: SparkSession, d: str) -> DataFrame:
    return quality.freshness(M.sales(spark, d), "sold_at", M.as_of()).withColumn("newest", F.col("newest").cast("timestamp_ntz"))


@query("""with s as (select event_id, user_id, ts, case event_type when 'purchase' then 'sold' when 'error' then 'ended' else 'live' end as state from events),
c as (select user_id, min({'at': ts, 'tie': event_id, 'state': state}) filter (state in ('sold', 'sold_after', 'ended')) as closed, max({'at': ts, 'tie': event_id, 'state': state}) as last, min(ts) as opened_at, count(*) as n from s group by user_id)
select user_id, coalesce(closed.state, last.state) as state, opened_at, closed.at as closed_at, n from c""")
def lifecycle_close(spark: SparkSession, d: str) -> DataFrame:
    e = M.table(spark, d, "events")
    state = F.when(F.col("event_type") == "purchase", "sold").when(F.col("event_type") == "error", "ended").otherwise("live")
    return lifecycle.closing(e.withColumn("state", state), "user_id", "state", "ts", "event_id")


@query("select case when e is null then 'ok' else e end as problem, count(*) as n from (select unnest(case when len(l) = 0 then [null] else l end) as e from (select list_filter([case when s_name = '' then 'title missing' end, case when l_shipdate > timestamp '2001-06-02 00:00:00' then 'sale date in the future' end, case when l_quantity > 49 then 'mileage negative' end], lambda x: x is not null) as l from lineitem join supplier on s_suppkey = l_suppkey)) group by 1")
def record_problems(spark: SparkSession, d: str) -> DataFrame:
    """Sale records held against the checks as of 2001-06-01, with high mileages turned negative: each problem's count."""
    s = M.sales(spark, d).join(M.table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("title")), "source_id")
    s = s.withColumn("mileage", F.when(F.col("mileage") > 49_000, -F.col("mileage")).otherwise(F.col("mileage")))
    errors = quality.record_errors(F.lit("2001-06-01").cast("timestamp"))
    return s.select(F.explode_outer(errors).alias("problem")).groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"))


@query("""with s as (select user_id, ts, event_id, event_type = 'error' as known from events), g as (select *, sum(case when known then 0 else 1 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as run from s),
r as (select user_id, run, count(*) filter (known) as streak from g group by all) select user_id, max(streak) as longest_streak from r group by user_id""")
def known_streaks(spark: SparkSession, d: str) -> DataFrame:
    """Longest run of consecutive errors of each user: gaps and islands."""
    own = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = M.table(spark, d, "events").withColumn("known", F.col("event_type") == "error")
    runs = e.withColumn("run", F.sum(F.when(F.col("known"), 0).otherwise(1)).over(own)).groupBy("user_id", "run").agg(F.count_if("known").alias("streak"))
    return runs.groupBy("user_id").agg(F.max("streak").alias("longest_streak"))
