"""DuckDB SQL of the market's tables and of the valuation, in steps that the catalogue's oracles build on."""

from __future__ import annotations

from ..functions.desirability import BRANDS, CURATED, TIERS
from ..functions.expr import DEPRECIATION, SEGMENTS, T_VALUES, TIMING

AS_OF = "timestamp '2001-12-31 00:00:00'"


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def step(x: str, steps, otherwise, op: str = ">=") -> str:
    return "(case " + " ".join(f"when {x} {op} {b} then {v}" for b, v in steps) + f" else {otherwise} end)"


def half_up(x: str, places: int = 0) -> str:
    return f"floor(({x}) + 0.5)::bigint" if not places else f"floor(({x}) * {10.0**places} + 0.5) / {10.0**places}"


def adjusted(value: str, miles: str, avg: str, h: str, age: str) -> str:
    """The mileage curve as one expression."""
    gap = f"(({miles} - {avg}) / greatest({avg}, 5000.0))"
    off = f"abs({gap})"
    s = step(h, [(9, 1.5), (7, 1.2), (5, 1.0)], 0.7)
    old = step(age, [(30, 1.5), (20, 1.3), (10, 1.1)], 1.0)
    e = step(s, [(1.5, 0.8), (1.2, 0.9)], 1.0)
    up = f"case when {off} < 0.15 then 0.05 * {off} * {s} when {off} < 0.4 then 0.0075 + ({off} - 0.15) * 0.15 * {s} when {off} < 0.7 then (0.045 + ({off} - 0.4) * 0.3 * {s}) * {old} else (0.135 + ({off} - 0.7) * 0.6 * {s}) * {old} * {step(miles, [(500, 1.25), (1000, 1.1)], 1.0, '<=')} end"
    down = f"case when {off} < 0.25 then 0.02 * {off} * {e} when {off} < 0.75 then 0.005 + ({off} - 0.25) * 0.05 * {e} when {off} < 2 then 0.03 + ({off} - 0.75) * 0.08 else 0.13 + ({off} - 2) * 0.1 end"
    low, high = step(h, [(9, 0.30), (7, 0.25)], 0.30), step(h, [(9, 0.45), (7, 0.30), (5, 0.20)], 0.15)
    return half_up(f"{value} * (1 + greatest(-{low}, least({high}, case when {gap} < 0 then {up} else -({down}) end)))")


def any_of(name: str, fragments) -> str:
    return "(" + " or ".join(f"contains({name}, {text(x)})" for x in fragments) + ")"


def desirability(model: str, make: str, value: str, msrp: str, age: str) -> str:
    name = f"upper(coalesce({model}, ''))"
    tier = "case " + " ".join(f"when {any_of(name, f)} then {p}" for p, _, f in TIERS) + " else 0 end"
    brand = "case " + " ".join(f"when {make} in ({', '.join(map(text, m))}) then {p}" for p, _, m in BRANDS) + " else 0 end"
    computed = f"greatest(1, least(10, 5 + {tier} + case when regexp_matches({name}, 'MANUAL|6-SPEED|6 SPEED') then 1 else 0 end + case when {value} > 500000 then 2 when {value} > 200000 then 1 when {value} < 30000 then -1 else 0 end + case when {msrp} > 0 and {value} / {msrp} > 1.5 then 2 when {msrp} > 0 and {value} / {msrp} > 1.1 then 1 else 0 end + case when {age} between 20 and 35 or {age} >= 40 then 1 else 0 end + {brand}))"
    curated = "case " + " ".join(f"when contains({name}, {text(k)}) then {v}" for k, v in sorted(CURATED.items(), key=lambda kv: (-len(kv[0]), kv[0]))) + " end"
    return f"coalesce({curated}, {computed})"


def segment(make: str, value: str) -> str:
    return "case " + " ".join(f"when {make} in ({', '.join(map(text, m))}) or coalesce({value}, 0) > {v} then '{s}'" for s, m, v in SEGMENTS) + " else 'mainstream' end"


def depreciation(value: str) -> str:
    pieces = " ".join(f"when {value} <= {x1} then {y0} + ({value} - {x0}) / {float(x1 - x0)} * ({y1} - {y0})" for (x0, y0), (x1, y1) in zip(DEPRECIATION, DEPRECIATION[1:]))
    return f"case when {value} is null then 0.0 when {value} <= {DEPRECIATION[0][0]} then {DEPRECIATION[0][1]} {pieces} else {DEPRECIATION[-1][1]} end"


def t_critical(df: str) -> str:
    return step(df, T_VALUES, 1.65, "<=")


def timing(sig: str, score: str, annual: str) -> str:
    when = {"sure": f" and {score} > 0.6", "fast": f" and coalesce({annual}, 0) > 0.08", "": ""}
    return "case " + " ".join(f"when {sig} = '{s}'{when[c]} then {text(label)}" for s, c, label, _ in TIMING) + " else 'Watch Closely' end"


TABLES = f"""
item as (select p_partkey as item_id, p_size + 1950 as year, p_brand as make, p_name as model, p_type as model_key, p_retailprice as msrp from part),
sale as (select l_partkey as item_id, l_orderkey as lot, l_linenumber as line, 's' || l_suppkey as source, l_suppkey as source_id, l_extendedprice as price, l_quantity * 1000 as mileage, l_shipdate as sold_at, l_returnflag = 'R' as unsold, l_suppkey % 10 = 0 as abroad from lineitem),
listing as (select l_partkey as item_id, l_orderkey as lot, l_linenumber as line, round(l_extendedprice * (0.8 + 4 * l_discount), 2) as ask, l_quantity * 1000 as mileage, o_orderdate as first_seen from lineitem join orders on o_orderkey = l_orderkey where o_orderstatus = 'O'),
listed as (select item_id, count(*) as n_listings from listing group by item_id)
"""

#: (item_id, scope, sale's columns) of the scope that the valuation below looks at.
OWN = "scoped as (select *, 'own' as scope from sale)"
WINDOW = """scoped as (select t.item_id, s.lot, s.line, s.source, s.source_id, s.price, s.mileage, s.sold_at, s.unsold, s.abroad, 'window' as scope
  from sale s join item f on f.item_id = s.item_id join item t on t.make = f.make and t.model_key = f.model_key and f.year between t.year - 2 and t.year + 2)"""

POINTS = f"""
ctx0 as (select s.*, i.year, i.make, i.model, i.msrp, 2001 - i.year as age, count(*) over w as sales_count, coalesce(nullif(avg(s.mileage) over w, 0), 50000.0) as boot_miles, coalesce(avg(s.price) over w, 0) as boot_value
  from scoped s join item i using (item_id) window w as (partition by item_id, scope)),
ctx as (select *, {desirability('model', 'make', 'boot_value', 'msrp', 'age')} as desirability from ctx0),
clean0 as (select *, count(*) over (partition by item_id, scope) as n_clean, ln(greatest({adjusted('price', 'mileage', 'boot_miles', 'desirability', 'age')}::double, 1.0)) as boot_log from ctx where not unsold and not abroad and price > 0),
clean1 as (select *, abs(boot_log - median(boot_log) over (partition by item_id, scope)) as deviation from clean0),
clean2 as (select *, 1.4826 * median(deviation) over (partition by item_id, scope) as boot_mad from clean1),
flagged as (select *, n_clean >= 8 and boot_mad > 0 and deviation > case when n_clean >= 20 then 3.5 else 4.0 end * boot_mad as outlier from clean2),
kept as (select *, sum(outlier::int) over (partition by item_id, scope)::bigint as outlier_count from flagged),
kept1 as (select *, {half_up('coalesce(nullif(avg(mileage) over (partition by item_id, scope), 0), boot_miles)')} as avg_mileage from kept where not outlier),
points as (select *, ln(greatest(adjusted, 1.0)) as log_price, greatest(1, floor(10 * pow(0.5, years_ago * 365.25 / 365) + 0.5)::int) as repeats
  from (select *, {adjusted('price', 'mileage', 'avg_mileage', 'desirability', 'age')}::double as adjusted, (epoch_us({AS_OF}) - epoch_us(sold_at)) / 86400e6 / 365.25 as years_ago from kept1))
"""

GROUPED = f"""
weighted as (select item_id, scope, list(adjusted order by adjusted) as w from (select item_id, scope, adjusted, unnest(range(repeats)) from points) group by all),
stats as (
  select item_id, scope, any_value(year) as year, any_value(make) as make, any_value(model) as model, any_value(msrp) as msrp, any_value(age) as age, any_value(sales_count) as sales_count, any_value(boot_value) as boot_value, any_value(desirability) as desirability, any_value(avg_mileage) as avg_mileage, any_value(outlier_count) as outlier_count,
    count(*) as n, {half_up('median(price)')} as median_price, min(adjusted) as price_low, max(adjusted) as price_high,
    case when count(*) >= 2 and avg(price) <> 0 then stddev_pop(price) / avg(price) else 0.0 end as vol0,
    (max(years_ago) - min(years_ago)) * 365.25 as span_days,
    case when count(*) >= 2 and regr_sxx(log_price, years_ago) > 0 then regr_slope(log_price, years_ago) else 0.0 end as slope,
    case when regr_syy(log_price, years_ago) > 0 and regr_sxx(log_price, years_ago) > 0 then greatest(0.0, regr_r2(log_price, years_ago)) else 0.0 end as r20,
    case when count(*) >= 3 and regr_sxx(log_price, years_ago) > 0 then sqrt(greatest(0.0, regr_syy(log_price, years_ago) - regr_sxy(log_price, years_ago) * regr_sxy(log_price, years_ago) / regr_sxx(log_price, years_ago)) / (count(*) - 2) / regr_sxx(log_price, years_ago)) end as slope_se,
    count(*) filter (years_ago <= 365 / 365.25) as recent_n,
    (max(years_ago) filter (years_ago <= 365 / 365.25) - min(years_ago) filter (years_ago <= 365 / 365.25)) * 365.25 as recent_span,
    case when count(*) filter (years_ago <= 365 / 365.25) >= 2 and regr_sxx(log_price, years_ago) filter (years_ago <= 365 / 365.25) > 0 then regr_slope(log_price, years_ago) filter (years_ago <= 365 / 365.25) else 0.0 end as recent_slope,
    count(*) filter (years_ago * 365.25 * 86400000 <= 631152e5) as sales_24mo, count(*) filter (years_ago * 365.25 * 86400000 <= 315576e5) as sales_12mo
  from points group by item_id, scope),
v0 as (select s.*, coalesce(n_listings, 0) as n_listings, {half_up('list_avg(w[(floor(len(w) * c))::int + 1 : len(w) - (floor(len(w) * c))::int])')} as current_value
  from (select *, case when n >= 8 then 0.1 else 0.0 end as c from stats) s join weighted using (item_id, scope) left join listed using (item_id)),
v1 as (select *, case when n >= 3 and span_days >= 180 and abs(exp(-slope) - 1) <= 2 then exp(-slope) - 1 end as annual_return, case when n >= 3 and span_days >= 180 then r20 else 0.0 end as r2, case when n >= 3 then vol0 else 0.0 end as volatility from v0),
v2 as (select *, case when annual_return is not null then case when recent_n >= 2 and recent_span >= 180 and abs(exp(-recent_slope) - 1) <= 2 then exp(-recent_slope) - 1 else annual_return end end as recent_return from v1),
v3 as (select *, case when annual_return is null then 'insufficient' when abs(annual_return) < 0.03 then 'stable' when annual_return >= 0.03 then 'appreciating' when recent_return > 0.02 then 'bottomed' when recent_return > -0.02 then 'approaching' else 'depreciating' end as signal,
  0.40 * {step('n', [(20, 1.0), (12, 0.8), (8, 0.6), (5, 0.4), (3, 0.2)], 0.0)} + 0.35 * greatest(0.0, least(1.0, (r2 - 0.10) / 0.35)) + 0.25 * {step('volatility', [(0, 0.50), (0.18, 1.00), (0.28, 0.75), (0.40, 0.50), (0.55, 0.25)], 0.0, '<=')} as confidence,
  case when slope_se is not null and annual_return is not null then n - 2 end as trend_df, {segment('make', 'boot_value')} as segment, {depreciation('current_value')} as depreciation, floor(0.4 * current_value + 0.5)::bigint as floor_value from v2),
v4 as (select *, case when n < 4 then 'low' when confidence >= 0.62 and n >= 12 and volatility <= 0.40 then 'high' when confidence >= 0.36 then 'moderate' else 'low' end as confidence_level, {timing('signal', 'confidence', 'annual_return')} as timing,
  case when trend_df is not null then exp(-(slope + {t_critical('trend_df')} * slope_se)) - 1 end as trend_lcb, case when trend_df is not null then exp(-(slope - {t_critical('trend_df')} * slope_se)) - 1 end as trend_ucb from v3)
"""

_BY_AGE = step("age", [(2, -0.1), (5, -0.06), (10, -0.02), (20, 0.01), (35, 0.03)], 0.04, "<=")
_FLOOR = f"case when age > 6 then {step('desirability', [(8, 0.02), (6, -0.02)], -1.0)} else {step('desirability', [(8, -0.03), (6, -0.04)], -1.0)} end"
_BY_PRICE = "case when not coalesce(msrp > 0, false) then 0.0 when current_value / msrp > 2 then 0.03 when current_value / msrp > 1.2 then 0.02 when current_value / msrp > 0.8 then -0.01 when current_value / msrp > 0.5 then -0.02 else 0.01 end"
_BY_SIGNAL = "case signal when 'appreciating' then 0.02 when 'bottomed' then 0.03 when 'approaching' then 0.01 when 'depreciating' then -0.02 else 0.0 end"
_BLEND = "({0} * coalesce(annual_return, 0) + {1} * (desirability - 5) * 0.01 + {2} * by_age + {3} * by_price + {4} * by_signal)"

FORECAST = f"""
f0 as (select *, greatest({_BY_AGE}, {_FLOOR}) as by_age, {_BY_PRICE} as by_price, {_BY_SIGNAL} as by_signal from v4),
f1 as (select *, greatest({step('desirability', [(8, -0.06), (6, -0.10)], -0.15)}, least({step('desirability', [(9, 0.14), (7, 0.12), (5, 0.10)], 0.08)},
  case when signal in ('depreciating', 'appreciating') then {_BLEND.format(0.65, 0.13, 0.12, 0.06, 0.04)} when signal = 'approaching' then {_BLEND.format(0.55, 0.15, 0.13, 0.10, 0.07)} when n >= 25 and r2 > 0.5 then {_BLEND.format(0.5, 0.2, 0.1, 0.1, 0.1)} when n >= 10 then {_BLEND.format(0.35, 0.25, 0.15, 0.15, 0.10)} else {_BLEND.format(0.2, 0.3, 0.25, 0.15, 0.1)} end)) as blended from f0),
f2 as (select *, case when signal in ('depreciating', 'approaching') and coalesce(annual_return, 0) <= -0.03 then least(blended, case when signal = 'approaching' then 0.34 when age <= 5 then 0.65 else 0.5 end * annual_return) else blended end as rate from f1),
f3 as (select *, case when rate < -0.05 then {step('abs(rate)', [(0.12, 0.62), (0.08, 0.70)], 0.78)} else {step('desirability', [(9, 0.94), (7, 0.90), (5, 0.85)], 0.82)} end as damp, greatest(0.15, 1 - confidence) as doubt from f2),
y1 as (select *, greatest(floor_value, current_value * (1 + rate)) as p1 from f3),
y2 as (select *, greatest(floor_value, p1 * (1 + rate * damp)) as p2 from y1),
y3 as (select *, greatest(floor_value, p2 * (1 + rate * damp * damp)) as p3 from y2),
y4 as (select *, greatest(floor_value, p3 * (1 + rate * damp * damp * damp)) as p4 from y3),
y5 as (select *, greatest(floor_value, p4 * (1 + rate * damp * damp * damp * damp)) as p5 from y4),
forecast as (select *, {half_up('p1')} as forecast_1y, {half_up('p3')} as forecast_3y, {half_up('p5')} as forecast_5y from y5)
"""

DECLINE = f"""
q as (
  select item_id, 0 as q, current_value::double as v, rate / 4 as r, 'did_not_converge' as status, rate, damp, floor_value, current_value from forecast where rate < 0
  union all
  select item_id, q + 1, greatest(floor_value, v * (1 + r)), r * pow(damp, 0.25), case when greatest(floor_value, v * (1 + r)) <= floor_value then 'floor_reached' when abs(greatest(floor_value, v * (1 + r)) - v) / v < 0.005 then 'flattened' else 'did_not_converge' end, rate, damp, floor_value, current_value
  from q where q < 20 and status = 'did_not_converge'),
ended as (select *, case when status = 'did_not_converge' then 5.0 else floor(q / 4 * 10 + 0.5) / 10 end as bottom_years from q qualify row_number() over (partition by item_id order by q desc) = 1),
decline as (
  select f.item_id, {half_up('e.v')} as bottom_value, e.bottom_years, coalesce(e.status, 'not_declining') as status, case when e.status <> 'did_not_converge' then floor(least(e.v + 0.6 * (e.current_value - e.v), e.v * pow(1.015, greatest(0.0, 5 - e.bottom_years))) + 0.5)::bigint end as recovery
  from forecast f left join ended e using (item_id))
"""


def own(*more: str) -> str:
    return "with recursive " + ",".join([TABLES, OWN, POINTS, *more])
