"""Queries of the valuation engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..functions import stats as S
from ..functions.desirability import desirability, desirability_reasons
from ..operators import valuation as V
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


def own_values(spark: SparkSession, d: str) -> DataFrame:
    return V.valuations(V.own_scope(M.sales(spark, d)), M.items(spark, d), M.listing_counts(spark, d), M.as_of())


def own_points(spark: SparkSession, d: str) -> DataFrame:
    return V.priced(V.flag_outliers(V.with_context(V.own_scope(M.sales(spark, d)), M.items(spark, d), M.as_of())), M.as_of())


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


@query(R.own(R.GROUPED) + """
select item_id, n, current_value, median_price, price_low, price_high, round(volatility, 6) as volatility, round(annual_return, 6) as annual_return, round(recent_return, 6) as recent_return, round(r2, 6) as r2, signal, round(confidence, 6) as confidence, confidence_level, segment, desirability, timing from v4""")
def valuation_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", "n", "current_value", "median_price", "price_low", "price_high", *r6("volatility", "annual_return", "recent_return", "r2"), "signal", *r6("confidence"), "confidence_level", "segment", "desirability", "timing")


@query(f"with {R.TABLES} select item_id, lot, line, price, mileage, sold_at from sale where not unsold and not abroad and price > 0")
def clean_sales(spark: SparkSession, d: str) -> DataFrame:
    return M.sales(spark, d).filter(V.is_clean()).select("item_id", "lot", "line", "price", "mileage", F.col("sold_at").cast("timestamp_ntz").alias("sold_at"))


@query(R.own() + " select item_id, lot, line, price, round(deviation, 6) as deviation, round(boot_mad, 6) as mad from flagged where outlier")
def mad_outliers(spark: SparkSession, d: str) -> DataFrame:
    flagged = V.flag_outliers(V.with_context(V.own_scope(M.sales(spark, d)), M.items(spark, d), M.as_of()))
    return flagged.filter("outlier").select("item_id", "lot", "line", "price", *r6("deviation"), F.round("boot_mad", 6).alias("mad"))


@query(R.own(R.GROUPED) + " select item_id, n, current_value, median_price, price_low, price_high from v4")
def trimmed_mean_value(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", "n", "current_value", "median_price", "price_low", "price_high")


@query(R.own(R.GROUPED) + " select item_id, n, round(slope, 6) as slope, round(r20, 6) as r2, round(exp(-slope) - 1, 6) as annual from stats")
def trend_fit(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("years_ago"), F.col("log_price")
    fit = own_points(spark, d).groupBy("item_id").agg(F.count("*").alias("n"), S.ols_slope(y, x).alias("slope"), S.ols_r2(y, x).alias("r2"))
    return fit.select("item_id", "n", *r6("slope", "r2"), F.round(F.expm1(-F.col("slope")), 6).alias("annual"))


@query(R.own(R.GROUPED) + " select item_id, trend_df, round(slope_se, 6) as slope_se, round(trend_lcb, 6) as trend_lcb, round(trend_ucb, 6) as trend_ucb from v4 where trend_df is not null")
def trend_standard_error(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).filter("trend_df is not null").select("item_id", "trend_df", *r6("slope_se", "trend_lcb", "trend_ucb"))


@query(R.own(R.GROUPED) + " select signal, count(*) as n, round(avg(annual_return), 6) as mean_return from v4 group by signal")
def signal_classification(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).groupBy("signal").agg(F.count("*").alias("n"), F.round(F.avg("annual_return"), 6).alias("mean_return"))


@query(R.own(R.GROUPED) + " select item_id, round(confidence, 6) as confidence, confidence_level from v4")
def confidence_score(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", *r6("confidence"), "confidence_level")


@query(R.own() + f" select item_id, lot, line, price, mileage, desirability, {R.adjusted('price', 'mileage', 'boot_miles', 'desirability', 'age')} as adjusted from ctx")
def mileage_adjusted_price(spark: SparkSession, d: str) -> DataFrame:
    context = V.with_context(V.own_scope(M.sales(spark, d)), M.items(spark, d), M.as_of())
    return context.select("item_id", "lot", "line", "price", "mileage", "desirability", E.mileage_adjusted(F.col("price"), F.col("mileage"), F.col("boot_miles"), F.col("desirability"), F.col("age")).alias("adjusted"))


@query(R.own(R.GROUPED) + " select item_id, current_value, round(depreciation, 6) as depreciation from v4")
def depreciation_baseline(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", "current_value", *r6("depreciation"))


@query(f"with {R.TABLES} select item_id, {R.desirability('model', 'make', 'msrp', 'msrp', '2001 - year')} as score from item")
def collectibility_score(spark: SparkSession, d: str) -> DataFrame:
    age = F.lit(2001) - F.col("year")
    return M.items(spark, d).select("item_id", desirability(F.col("model"), F.col("make"), F.col("msrp"), F.col("msrp"), age).alias("score"))


@query()
def collectibility_reasons(spark: SparkSession, d: str) -> DataFrame:
    age = F.lit(2001) - F.col("year")
    return M.items(spark, d).select("item_id", desirability_reasons(F.col("model"), F.col("make"), F.col("msrp"), F.col("msrp"), age).alias("reasons"))


@query(R.own(R.GROUPED) + " select segment, count(*) as n, round(avg(annual_return), 6) as avg_return, floor(avg(current_value) + 0.5)::bigint as avg_value from v4 where annual_return is not null group by segment")
def segment_rollup(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).filter("annual_return is not null").groupBy("segment").agg(F.count("*").alias("n"), F.round(F.avg("annual_return"), 6).alias("avg_return"), E.half_up(F.avg("current_value")).alias("avg_value"))


@query(R.own(R.GROUPED, R.FORECAST) + f"""
select item_id, round(rate, 6) as rate, round(damp::double, 6) as damp, forecast_1y, forecast_3y, forecast_5y,
  {R.half_up('greatest(floor_value, forecast_3y * (0.92 - 0.15 * doubt))')} as bear_3y, {R.half_up('forecast_3y * (1.10 + 0.18 * doubt)')} as bull_3y,
  {R.half_up('greatest(floor_value, forecast_5y * (0.88 - 0.22 * doubt))')} as bear_5y, {R.half_up('forecast_5y * (1.15 + 0.28 * doubt)')} as bull_5y from forecast""")
def forecast_bands(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", *r6("rate", "damp"), "forecast_1y", "forecast_3y", "forecast_5y", "bear_3y", "bull_3y", "bear_5y", "bull_5y")


@query(R.own(R.GROUPED, R.FORECAST, R.DECLINE) + " select * from decline")
def decline_simulation(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", "decline.*")


SEASON = """
p as (select *, ln(greatest(price::double, 1.0)) as y, count(*) over (partition by item_id) as n_points from points qualify n_points >= 12),
fit as (select *, regr_slope(y, years_ago) over w as b, avg(y) over w as my, avg(years_ago) over w as mx from p window w as (partition by item_id)),
rest as (select *, y - (my + coalesce(b, 0) * (years_ago - mx)) as residual from fit),
months as (select item_id, month(sold_at) - 1 as month, count(*) as n, avg(residual) as mean from rest group by all),
overall as (select item_id, avg(residual) as o from rest group by item_id),
season as (select item_id, month, n, case when n >= 2 then floor((exp(mean - o) - 1) * 1000 + 0.5) / 1000 end as index from months join overall using (item_id))
"""


@query(R.own(SEASON) + " select item_id, month::int as month, n, index from season")
def seasonality_index(spark: SparkSession, d: str) -> DataFrame:
    return V.seasonality(own_points(spark, d)).select("item_id", "month", "n", "index")


@query(R.own(SEASON) + """
, s as (select item_id, list({'i': -index, 'm': month::int} order by -index, month) as l, max(index) as best, min(index) as worst from season where index is not null group by item_id having count(*) >= 2)
select item_id, array_to_string(list_transform(l[1:2], lambda x: x.m), ',') as best_months, array_to_string(list_transform(l[-2:], lambda x: x.m), ',') as worst_months, round(best - worst, 6) as strength, abs(worst) as buy_discount, best as sell_premium from s""")
def seasonal_extremes(spark: SparkSession, d: str) -> DataFrame:
    s = V.seasonal_summary(V.seasonality(own_points(spark, d)))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return s.select("item_id", text("best_months"), text("worst_months"), *r6("strength"), "buy_discount", "sell_premium")


@query(R.own(R.GROUPED) + """
, s as (select *, n_listings / greatest(0.5, sales_24mo / 2) * 12 as supply from v4)
select item_id, sales_24mo, sales_12mo, n_listings, case when sales_24mo < 4 then 'THIN MARKET' when n_listings <= 1 then 'TIGHT SUPPLY' when supply < 6 then 'SELLER''S MARKET' when supply <= 18 then 'BALANCED' else 'BUYER''S MARKET' end as verdict,
  case when sales_24mo < 4 then null when n_listings <= 1 or supply < 6 then 'high' when supply <= 18 then 'moderate' else 'low' end as tier, case when sales_24mo >= 4 then round(supply, 6) end as months_of_supply from s""")
def liquidity_verdict(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).select("item_id", "sales_24mo", "sales_12mo", "n_listings", F.col("liquidity").alias("verdict"), F.col("liquidity_tier").alias("tier"), *r6("months_of_supply"))


@query(R.own(R.GROUPED) + " select timing, count(*) as n from v4 group by timing")
def timing_label(spark: SparkSession, d: str) -> DataFrame:
    return own_values(spark, d).groupBy("timing").agg(F.count("*").alias("n"))


@query(f"with {R.TABLES}, {R.WINDOW} select item_id, count(*) as pool, round(avg(price), 4) as mean_price, min(sold_at) as first_sale, max(sold_at) as last_sale from scoped group by item_id")
def model_window_pool(spark: SparkSession, d: str) -> DataFrame:
    pool = V.window_totals(M.sales(spark, d), M.items(spark, d))
    at = lambda n: F.col(n).cast("timestamp_ntz").alias(n)
    return pool.select("item_id", "pool", F.round(F.col("price_sum") / F.col("price_n"), 4).alias("mean_price"), at("first_sale"), at("last_sale"))


@query(f"with recursive {R.TABLES}, {R.WINDOW}, {R.POINTS}, {R.GROUPED} select item_id, sales_count, n, current_value, round(annual_return, 6) as annual_return, signal, round(confidence * 0.6, 6) as confidence from v4")
def model_window_valuation(spark: SparkSession, d: str) -> DataFrame:
    """Every item valued from its model line's sales, two model years each way."""
    v = V.window_valuations(M.sales(spark, d), M.items(spark, d), M.listing_counts(spark, d), M.as_of())
    return v.select("item_id", "sales_count", "n", "current_value", *r6("annual_return"), "signal", F.round(F.col("confidence") * V.BORROWED, 6).alias("confidence"))


@query()
def signal_scope(spark: SparkSession, d: str) -> DataFrame:
    """Valuation with the model-line fallback: scope, price and trend of each item."""
    sales, items, counts = M.sales(spark, d), M.items(spark, d), M.listing_counts(spark, d)
    return V.with_fallback(sales, items, counts, M.as_of()).select("item_id", "scope", "sales_count", "current_value", *r6("annual_return", "confidence"), "signal")


@query(R.own(R.GROUPED) + """
, m as (select avg(annual_return) as mu from v4)
select item_id, current_value, round(annual_return, 6) as annual_return, round(mu + (trend_lcb - mu) * (greatest(trend_df, 0) / (greatest(trend_df, 0) + 25.0)), 6) as trend_score from v4, m
where trend_lcb is not null and current_value >= 5000 order by mu + (trend_lcb - mu) * (trend_df / (trend_df + 25.0)) desc, item_id limit 12""")
def shrunk_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    v = V.with_trend_score(own_values(spark, d)).filter("trend_score is not null and annual_return is not null and current_value >= 5000")
    return v.orderBy(F.desc("trend_score"), "item_id").limit(12).select("item_id", "current_value", *r6("annual_return", "trend_score"))


@query(R.own(R.GROUPED) + """
, m as (select avg(annual_return) as mu from v4)
select item_id, current_value, round(annual_return, 6) as annual_return, round(mu + (trend_lcb - mu) * (greatest(trend_df, 0) / (greatest(trend_df, 0) + 25.0)), 6) as trend_score from v4, m
where trend_lcb is not null and current_value >= 5000 order by mu + (trend_lcb - mu) * (trend_df / (trend_df + 25.0)), item_id limit 12""")
def decliners(spark: SparkSession, d: str) -> DataFrame:
    v = V.with_trend_score(own_values(spark, d)).filter("trend_score is not null and annual_return is not null and current_value >= 5000")
    return v.orderBy("trend_score", "item_id").limit(12).select("item_id", "current_value", *r6("annual_return", "trend_score"))


@query(f"""with {R.TABLES}, o as (select item_id, price, count(*) over w as n, row_number() over (partition by item_id order by sold_at, lot, line, price) as up, row_number() over (partition by item_id order by sold_at desc, lot desc, line desc, price desc) as down from sale where not unsold and not abroad window w as (partition by item_id))
select item_id, max(n) as n, round(avg(price) filter (down <= greatest(2, n // 3)) / avg(price) filter (up <= greatest(2, n // 3)), 6) as ratio from o group by item_id having max(n) >= 6""")
def newest_oldest_third_ratio(spark: SparkSession, d: str) -> DataFrame:
    own = Window.partitionBy("item_id")
    o = M.sales(spark, d).filter(V.is_clean()).withColumns({"n": F.count("*").over(own), "up": F.row_number().over(own.orderBy("sold_at", "lot", "line", "price")), "down": F.row_number().over(own.orderBy(F.desc("sold_at"), F.desc("lot"), F.desc("line"), F.desc("price")))})
    k = F.greatest(F.lit(2), F.floor(F.col("n") / 3))
    return o.groupBy("item_id").agg(F.max("n").alias("n"), F.round(F.avg(F.when(F.col("down") <= k, F.col("price"))) / F.avg(F.when(F.col("up") <= k, F.col("price"))), 6).alias("ratio")).filter("n >= 6")
