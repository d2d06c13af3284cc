"""Plain SQL with the same meaning as each registered query.

Written against the raw test tables and independently of the Spark code: recursion
instead of array folds, self-contained common table expressions instead of operators.
"""

from __future__ import annotations

import re

from demandloom.models.trees import bag_constants, poisson_limits

START, END, TRAIN_END = "date '2024-01-01'", "date '2024-01-30'", "date '2024-01-23'"

CTES: dict[str, str] = {}

CTES["v_sales"] = """
select case when user_id % 10 < 4 then 'M' when user_id % 10 < 8 then 'B' else 'A' end as country,
       event_type as product_id, cast(ts as date) as date,
       case when event_id % 53 = 0 then null else user_id end as zipcode,
       case when event_id % 97 = 0 then 'xfffx' when event_id % 101 = 0 then null
            when event_id % 6 = 0 then '9999' else cast(value as varchar) end as sales
from events"""
CTES["v_geo"] = """
select case when n_nationkey % 2 = 0 then 'M' else 'B' end as country,
       n_nationkey * w as s_zipcode, (n_nationkey + 1) * w as e_zipcode, n_name as city
from nation cross join (select cast(ceil((max(user_id) + 1) / 20.0) as bigint) as w from events) x"""
CTES["v_overlap"] = """
select country, s_zipcode, e_zipcode + (e_zipcode - s_zipcode) + 1 as e_zipcode, city from v_geo"""
CTES["v_located"] = """
select s.country, s.product_id, s.date, s.zipcode, s.sales, g.city
from v_sales s join v_geo g on s.country = g.country
 and s.zipcode >= g.s_zipcode and s.zipcode < g.e_zipcode"""
CTES["v_input"] = """
select city, product_id, date,
       sum(coalesce(nullif(try_cast(sales as double), cast('NaN' as double)), 0.0)) as sales
from v_located group by city, product_id, date"""
CTES["v_cold"] = """
select * from v_input
where not (city in ('NATION_0', 'NATION_2') and date < date '2024-01-27')"""
CTES["v_orders"] = """
select n_name as city, p_brand as product_id, cast(l_shipdate as date) as date,
       sum(l_quantity) as sales
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
 join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey
group by 1, 2, 3"""


def _filled(source: str, start: str, end: str) -> str:
    return f"""
select c.city, c.product_id, c.date, coalesce(h.sales, 0.0) as sales
from (select city, product_id,
             cast(unnest(generate_series(cast(d0 as timestamp), cast({end} as timestamp), interval 1 day)) as date) as date
      from (select city, product_id, min(date) as d0 from {source}
            where date between {start} and {end} group by city, product_id) f) c
left join {source} h on h.city = c.city and h.product_id = c.product_id and h.date = c.date"""


def _arrays(filled: str) -> str:
    return f"""
select 'test' as h, 7 as steps, city, product_id, count(*) as n,
       list(sales order by date) as y, max(date) as last_day
from {filled} where date <= {TRAIN_END} group by city, product_id
union all
select 'full' as h, 9 as steps, city, product_id, count(*) as n,
       list(sales order by date) as y, max(date) as last_day
from {filled} group by city, product_id"""


def _moving_average(arr: str, ma: str) -> str:
    return f"""
select h, steps, city, product_id, last_day, 1 as k, y[-7:] as tail, list_avg(y[-7:]) as v
from {arr} where n >= 7
union all
select h, steps, city, product_id, last_day, k + 1, list_append(tail[2:], v),
       list_avg(list_append(tail[2:], v))
from {ma} where k < steps"""


def _croston(arr: str, cr: str) -> str:
    return f"""
select h, steps, city, product_id, last_day, n, y, 0 as i, cast(null as double) as z,
       cast(null as double) as p, cast(1 as double) as gap
from {arr}
union all
select h, steps, city, product_id, last_day, n, y, i + 1,
       case when y[i + 1] > 0 then coalesce(z + 0.1 * (y[i + 1] - z), y[i + 1]) else z end,
       case when y[i + 1] > 0 then coalesce(p + 0.1 * (gap - p), gap) else p end,
       case when y[i + 1] > 0 then 1.0 else gap + 1 end
from {cr} where i < n"""


CTES["w_params"] = """
select cast(a as double) as a, cast(b as double) as b, cast(g as double) as g
from (values (0.1), (0.3), (0.6)) t1(a) cross join (values (0.01), (0.1)) t2(b)
cross join (values (0.05), (0.2), (0.4)) t3(g)"""


def _holt_winters(arr: str, hw: str, params: str) -> str:
    return f"""
select h, steps, city, product_id, last_day, n, y, a, b, g, 7 as i,
       list_avg(y[1:7]) as lv, (list_avg(y[8:14]) - list_avg(y[1:7])) / 7.0 as tr,
       [y[1] - list_avg(y[1:7]), y[2] - list_avg(y[1:7]), y[3] - list_avg(y[1:7]),
        y[4] - list_avg(y[1:7]), y[5] - list_avg(y[1:7]), y[6] - list_avg(y[1:7]),
        y[7] - list_avg(y[1:7])] as s,
       cast(0 as double) as sse
from {arr} cross join {params} where n >= 14
union all
select h, steps, city, product_id, last_day, n, y, a, b, g, i + 1,
       a * (y[i + 1] - s[1]) + (1 - a) * (lv + tr),
       b * (a * (y[i + 1] - s[1]) + (1 - a) * (lv + tr) - lv) + (1 - b) * tr,
       list_append(s[2:], g * (y[i + 1] - (a * (y[i + 1] - s[1]) + (1 - a) * (lv + tr))) + (1 - g) * s[1]),
       sse + (y[i + 1] - lv - tr - s[1]) * (y[i + 1] - lv - tr - s[1])
from {hw} where i < n"""


def _hw_rows(label: str, hw: str) -> str:
    return f"""
select h, '{label}' as model, city, product_id, last_day + cast(k as integer) as date,
       lv + k * tr + s[(k - 1) % 7 + 1] as sales
from (select *, unnest(range(1, steps + 1)) as k
      from (select * from {hw} where i = n
            qualify row_number() over (partition by h, city, product_id order by sse) = 1) b) x"""


def _croston_rows(label: str, cr: str, factor: float) -> str:
    return f"""
select h, '{label}' as model, city, product_id, last_day + cast(k as integer) as date,
       coalesce({factor} * z / p, 0.0) as sales
from (select *, unnest(range(1, steps + 1)) as k from {cr} where i = n) x"""


def _mean_rows(label: str, arr: str) -> str:
    return f"""
select h, '{label}' as model, city, product_id, last_day + cast(k as integer) as date,
       list_avg(y) as sales
from (select *, unnest(range(1, steps + 1)) as k from {arr}) x"""


def _ma_rows(label: str, ma: str) -> str:
    return f"""
select h, '{label}' as model, city, product_id, last_day + cast(k as integer) as date, v as sales
from {ma}"""


def _trend_rows(label: str, arr: str) -> str:
    return f"""
select f.h, '{label}' as model, f.city, f.product_id, f.last_day + cast(f.k as integer) as date,
       f.level + f.slope * (f.n + f.k)
       + case when f.n >= 14 then e.effect - avg_effect else 0.0 end as sales
from (select l.*, unnest(range(1, l.steps + 1)) as k
      from (select h, steps, city, product_id, last_day, n, regr_slope(v, t) as slope,
                   regr_intercept(v, t) as level
            from (select h, steps, city, product_id, last_day, n, unnest(y) as v,
                         unnest(range(1, n + 1)) as t from {arr} where n >= 3) p
            group by h, steps, city, product_id, last_day, n) l) f
left join (select h, city, product_id, w, effect,
                  avg(effect) over (partition by h, city, product_id) as avg_effect
           from (select p.h, p.city, p.product_id, (p.t - 1) % 7 as w,
                        avg(p.v - q.level - q.slope * p.t) as effect
                 from (select h, city, product_id, unnest(y) as v, unnest(range(1, n + 1)) as t
                       from {arr} where n >= 3) p
                 join (select h, city, product_id, regr_slope(v, t) as slope,
                              regr_intercept(v, t) as level
                       from (select h, city, product_id, unnest(y) as v,
                                    unnest(range(1, n + 1)) as t from {arr} where n >= 3) r
                       group by h, city, product_id) q
                 on p.h = q.h and p.city = q.city and p.product_id = q.product_id
                 group by 1, 2, 3, 4) z) e
on e.h = f.h and e.city = f.city and e.product_id = f.product_id and e.w = (f.n + f.k - 1) % 7"""


def _chain(prefix: str, source: str) -> None:
    """All views from a demand view to the published demand."""
    p = prefix
    CTES[f"{p}_filled"] = _filled(source, START, END)
    CTES[f"{p}_arr"] = _arrays(f"{p}_filled")
    CTES[f"{p}_ma"] = _moving_average(f"{p}_arr", f"{p}_ma")
    CTES[f"{p}_cr"] = _croston(f"{p}_arr", f"{p}_cr")
    CTES[f"{p}_hw"] = _holt_winters(f"{p}_arr", f"{p}_hw", "w_params")
    CTES[f"{p}_forecast"] = "\nunion all\n".join(
        (
            _hw_rows("ExponentialSmoothing", f"{p}_hw"),
            _trend_rows("TrendSeasonal", f"{p}_arr"),
            _croston_rows("Croston", f"{p}_cr", 0.95),
            _mean_rows("NaiveMean", f"{p}_arr"),
            _ma_rows("NaiveMovingAverage", f"{p}_ma"),
        )
    )
    CTES[f"{p}_pairs"] = f"""
select f.model, f.city, f.product_id, f.date, s.sales as y, f.sales as p
from {p}_forecast f join {p}_filled s
  on s.city = f.city and s.product_id = f.product_id and s.date = f.date
where f.h = 'test' and s.date > {TRAIN_END}"""
    CTES[f"{p}_metrics"] = f"""
select model, city, product_id, 'rmse' as metric, sqrt(avg((y - p) * (y - p))) as value
from {p}_pairs group by 1, 2, 3
union all
select model, city, product_id, 'mae' as metric, avg(abs(y - p)) as value
from {p}_pairs group by 1, 2, 3"""
    CTES[f"{p}_best"] = f"""
select model, city, product_id, metric, value from {p}_metrics where metric = 'mae'
qualify row_number() over (partition by city, product_id order by value, model) = 1"""
    CTES[f"{p}_champion"] = f"""
select f.model, f.city, f.product_id, f.date, f.sales
from {p}_forecast f join {p}_best b
  on b.model = f.model and b.city = f.city and b.product_id = f.product_id
where f.h = 'full'"""
    CTES[f"{p}_weekly"] = f"""
select city, product_id, date, sales from (
  select city, product_id, date,
         sum(sales) over (partition by city, product_id order by date
                          rows between current row and 6 following) as sales,
         row_number() over (partition by city, product_id order by date desc) as r
  from {p}_champion) x where r >= 7"""
    CTES[f"{p}_missing"] = f"""
select i.* from {source} i
where not exists (select 1 from {p}_weekly w where w.city = i.city and w.product_id = i.product_id)"""
    CTES[f"{p}_fallback"] = f"""
select m.city, m.product_id, d.date, m.sales
from (select city, product_id, avg(sales) as sales from {p}_missing group by 1, 2) m
cross join (select distinct date from {p}_weekly) d"""
    CTES[f"{p}_output"] = f"""
select city, product_id, date, greatest(sales, 0.0) as sales from {p}_weekly
union all
select city, product_id, date, greatest(sales, 0.0) as sales from {p}_fallback"""
    CTES[f"{p}_compared"] = f"""
select 'Champion' as model, f.city, f.product_id, f.date, f.sales
from {p}_forecast f join {p}_best b
  on b.model = f.model and b.city = f.city and b.product_id = f.product_id where f.h = 'test'
union
select model, city, product_id, date, sales from {p}_forecast where h = 'test'
union
select 'Sales' as model, city, product_id, date, sales from {p}_filled where date > {TRAIN_END}"""


_chain("a", "v_input")
_chain("c", "v_cold")
CTES["one_param"] = "select cast(0.3 as double) as a, cast(0.1 as double) as b, cast(0.2 as double) as g"
CTES["a_hw1"] = _holt_winters("a_arr", "a_hw1", "one_param")
CTES["o_filled"] = _filled("v_orders", "date '2000-07-02'", "date '2001-06-30'")
CTES["o_arr"] = """
select 'full' as h, 9 as steps, city, product_id, count(*) as n,
       list(sales order by date) as y, max(date) as last_day
from o_filled group by city, product_id"""
CTES["o_cr"] = _croston("o_arr", "o_cr")


def _classes(filled: str) -> str:
    return f"""
select city, product_id, adi, cv2,
       case when pos = 0 then 'no_demand' when adi > 1.32 and cv2 > 0.49 then 'lumpy'
            when adi > 1.32 then 'intermittent' when cv2 > 0.49 then 'erratic'
            else 'smooth' end as class, count
from (select city, product_id, count(*) as count, count(*) filter (where sales > 0) as pos,
             count(*) / nullif(cast(count(*) filter (where sales > 0) as double), 0) as adi,
             (pos * cast(sum(cast(exact as decimal(36, 6)) * exact) as double) - cast(sum(exact) as double) * cast(sum(exact) as double))
               / (cast(sum(exact) as double) * cast(sum(exact) as double)) as cv2
      from (select *, case when sales > 0 then cast(round(sales, 6) as decimal(18, 6)) end as exact from {filled}) e
      group by city, product_id) m"""


CTES["a_classes"] = _classes("a_filled")
CTES["o_classes"] = _classes("o_filled")


def sql(final: str) -> str:
    """The final select behind every view it needs, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(final)
    views = ",\n".join(f"{name} as ({body})" for name, body in CTES.items() if name in needed)
    return f"with recursive {views}\n{final}" if views else final


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_KEYS = "city, product_id"
_VALUE = "round(value, 6) as value"
_SALES = "round(sales, 6) as sales"
_NUMBER = "try_cast(sales as double)"


def _cap(key: str, select: str, total: str = "count(*)", absent: str = "0") -> str:
    capped = f"count(*) filter (where {_NUMBER} = 9999)"
    if absent == "null":
        capped = f"nullif({capped}, 0)"
    return sql(
        f"select {select}, {total} as total, {capped} as capped, "
        f"round({capped} / cast(nullif({total}, 0) as double), 6) as share "
        f"from v_located group by {key}"
    )


def _model(rows: str) -> str:
    return sql(
        f"select model, {_KEYS}, date, round(sales, 6) as sales from ({rows}) x where h = 'full'"
    )


def _profile(view: str, columns: list[str]) -> str:
    return sql(
        "\nunion all\n".join(
            f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as missing,
round(100.0 * (count(*) - count({c})) / count(*), 2) as missing_pct,
count(distinct {c}) as distinct, cast(min({c}) as varchar) as min,
cast(max({c}) as varchar) as max from {view}"""
            for c in columns
        )
    ).replace("as distinct,", 'as "distinct",')


def _lags() -> str:
    lags = ", ".join(
        f"round(lag(sales, {k}) over (partition by {_KEYS} order by date), 6) as lag_{k}"
        for k in range(1, 8)
    )
    return sql(
        f"select * from (select {_KEYS}, date, {_SALES}, {lags}, isodow(date) - 1 as weekday "
        "from a_filled) x where lag_7 is not null"
    )


def _extended() -> str:
    inf = "cast('Infinity' as double)"

    def ratio(top: str, bottom: str) -> str:
        return f"case when {bottom} <> 0 then {top} / {bottom} when {top} <> 0 then {inf} end"

    values = {
        "mae": "avg(abs(y - p))",
        "mse": "avg((y - p) * (y - p))",
        "rmse": "sqrt(avg((y - p) * (y - p)))",
        "mape": f"avg({ratio('abs(y - p)', 'y')})",
        "mape_pct": f"100.0 * avg({ratio('abs(y - p)', 'abs(y)')})",
        "wmape": "100.0 * " + ratio("sum(abs(y - p))", "sum(abs(y))").join("()"),
        "smape": f"200.0 * avg({ratio('abs(y - p)', '(abs(y) + abs(p))')})",
        "bias": "avg(p - y)",
        "r2": "1.0 - sum((y - p) * (y - p)) / nullif(sum(y * y) - sum(y) * sum(y) / count(*), 0)",
        "rmsle": "case when min(least(y, p)) > -1.0 then sqrt(avg("
        "power(ln(1 + greatest(y, -0.5)) - ln(1 + greatest(p, -0.5)), 2))) end",
        "mase": "avg(abs(y - p)) / nullif(any_value(scale), 0)",
        "marre": "100.0 * " + ratio("avg(abs(y - p))", "(max(y) - min(y))").join("()"),
        "ope": "100.0 * abs(" + ratio("(sum(y) - sum(p))", "sum(y)") + ")",
        "coefficient_of_variation": "100.0 * " + ratio("sqrt(avg((y - p) * (y - p)))", "avg(y)").join("()"),
        "rmsse": "sqrt(avg((y - p) * (y - p)) / nullif(any_value(square), 0))",
    }
    values["r2_score"] = values["r2"]
    rows = "\nunion all\n".join(
        f"select model, {_KEYS}, '{name}' as metric, "
        f"round({value}, {2 if name == 'mse' else 6}) as value from q group by 1, 2, 3"
        for name, value in values.items()
    )
    return sql(
        f"""select * from (with q as (select p.*, t.scale, t.square from a_pairs p left join (
select {_KEYS}, avg(abs(change)) as scale, avg(change * change) as square from (
  select {_KEYS}, sales - lag(sales) over (partition by {_KEYS} order by date) as change
  from a_filled where date <= {TRAIN_END}) c group by {_KEYS}) t
  on t.city = p.city and t.product_id = p.product_id)
{rows}) r"""
    )


def _duplicates(columns: str) -> str:
    return sql(
        f"""select cast(sum(n) as bigint) as rows, cast(sum(n - 1) as bigint) as duplicates,
round(100.0 * sum(n - 1) / cast(sum(n) as double), 2) as pct
from (select count(*) as n from v_sales group by {columns}) x"""
    )


# rows that the pooled models learn from: every day with seven days before it, as shares
# of the series' mean
CTES["p_series"] = """
select city, product_id, y, n, last_day,
       case when list_avg([abs(x) for x in y]) > 0 then list_avg([abs(x) for x in y]) else 1.0 end as scale
from a_arr where h = 'full' and n > 7"""
CTES["p_rows"] = """
select [x / scale for x in y[i : i + 6]] as lags, y[i + 7] / scale as label,
       isodow(last_day - cast(n - i - 7 as integer)) - 1 as weekday,
       cast('0x' || substr(md5(city || '|' || product_id || '|' || cast(last_day - cast(n - i - 7 as integer) as varchar)),
                           1, 8) as bigint) % 4294967291 as key
from (select *, unnest(range(1, n - 6)) as i from p_series) x"""

# the plug-in of ``model_failures``: the last value carried forward, complete for every
# fourth city only
CTES["f_series"] = f"""
select t.city, t.product_id, cast(split_part(t.city, '_', 2) as bigint) % 4 as kind, t.y[-1] as last_value,
       list_avg(t.y) as mean_value
from a_arr t where h = 'test'"""
CTES["f_champions"] = f"""
select s.city, s.product_id,
       case when s.kind = 0 and avg(abs(f.sales - last_value)) < avg(abs(f.sales - mean_value))
            then 'Patchy' else 'NaiveMean' end as model
from f_series s join a_filled f on f.city = s.city and f.product_id = s.product_id and f.date > {TRAIN_END}
group by s.city, s.product_id, s.kind"""

# cut points: cells of 1/256, of whole millionths, at which another 64th of the values begins
CTES["p_cells"] = """
select cell, sum(n) over (order by cell) - n as before, sum(n) over () as total
from (select floor(floor(x / scale * 1000000 + 0.5) * 256 / 1000000) as cell, count(*) as n
      from (select unnest(y) as x, scale from p_series) v group by 1) c"""
CTES["p_cuts"] = """
select list(cell order by cell) as cuts from (
  select cell, 64 * before // total as share, lag(64 * before // total) over (order by cell) as last
  from p_cells) c where share > last"""
# one row per training row and feature: the bin of its value
CTES["p_codes"] = """
select row, key, micro, feature - 1 as feature,
       case when feature <= 7
            then len([c for c in cuts if c <= floor(floor(lags[feature] * 1000000 + 0.5) * 256 / 1000000)])
            else weekday end as code
from (select row_number() over () as row, key, lags, weekday, cast(floor(label * 1000000 + 0.5) as bigint) as micro,
             unnest(range(1, 9)) as feature from p_rows) r cross join p_cuts"""
CTES["p_rounds"] = """
select *, floor((base - micro / 1000000) * 1048576 + 0.5) as g
from p_codes cross join (select cast(sum(micro) as double) / count(*) / 1000000 as base from p_codes where feature = 0) b"""

BAGS = 5  # trees whose bags and first splits are compared
_CONSTANTS = ", ".join("({}, {}, {})".format(t, *bag_constants(0, t)) for t in range(BAGS))
CTES["p_bags"] = f"""
select row, t as tree, len([x for x in {poisson_limits()} if x <= (key::hugeint * a + b) % 4294967291]) as w
from p_codes cross join (values {_CONSTANTS}) c(t, a, b) where feature = 0"""


def _histogram(rows: str, keys: str, score: str, least: str = "0") -> str:
    """The best split per group of rows (keys, feature, code, w, g)."""
    return f"""
select {keys}, feature, code as bin, gain from (
  select *, {score.format("lg", "lw")} + {score.format("(tg - lg)", "(tw - lw)")} - {score.format("tg", "tw")} as raw
  from (select *, sum(w) over (partition by {keys}, feature order by code) as lw,
               sum(g) over (partition by {keys}, feature order by code) as lg,
               sum(w) over (partition by {keys}, feature) as tw, sum(g) over (partition by {keys}, feature) as tg
        from (select {keys}, feature, code, cast(sum(w) as double) as w, cast(sum(g) as double) as g
              from ({rows}) r group by {keys}, feature, code) h where w > 0) s
  where lw >= 1 and tw - lw >= 1) q cross join lateral (select {least} as gain) l where gain > 0
qualify row_number() over (partition by {keys} order by gain desc, feature, code) = 1"""


# soft threshold 0.5, l2 1, gamma 0.01; sums of gradients are in 2 ** -20
_BOOSTED = "power(greatest(abs({0} / 1048576) - 0.5, 0), 2) / ({1} + 1)"
CTES["p_root"] = _histogram("select 0 as node, feature, code, 1 as w, g from p_rounds", "node", _BOOSTED, "0.5 * raw - 0.01")
CTES["p_second"] = _histogram(
    """select 1 + cast(s.code > p.bin as integer) as node, r.feature, r.code, 1 as w, r.g
from p_rounds r join p_root p on true join p_rounds s on s.row = r.row and s.feature = p.feature""",
    "node", _BOOSTED, "0.5 * raw - 0.01",
)
CTES["p_forest"] = _histogram(
    "select tree, feature, code, w, w * micro as g from p_codes join p_bags using (row)", "tree",
    "power({0} / 1000000, 2) / {1}", "raw",
)

# one changepoint c at the last of the first 80 percent: y = a + b t + d (t - c)+ with
# penalties (noise / prior) squared, noise 0.05 of the largest value, by determinants
CTES["k_points"] = """
select city, product_id, n, last_day, size, v / size as z, (i - 1) / cast(greatest(n - 1, 1) as double) as t,
       (floor(n * 0.8) - 1) / greatest(n - 1, 1) as c
from (select city, product_id, n, last_day, unnest(y) as v, unnest(range(1, n + 1)) as i,
             case when list_max([abs(x) for x in y]) > 0 then list_max([abs(x) for x in y]) else 1.0 end as size
      from a_arr where h = 'full' and n >= 3) p"""
CTES["k_sums"] = """
select city, product_id, n, last_day, size, c, count(*) + 0.0001 as a11, sum(t) as a12, sum(u) as a13,
       sum(t * t) + 0.0001 as a22, sum(t * u) as a23, sum(u * u) + 1.0 as a33, sum(z) as b1, sum(t * z) as b2,
       sum(u * z) as b3
from (select *, greatest(t - c, 0.0) as u from k_points) p group by city, product_id, n, last_day, size, c"""
CTES["k_solved"] = """
select *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) as det,
       b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3) as d1,
       a11 * (b2 * a33 - b3 * a23) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13) as d2,
       a11 * (a22 * b3 - a23 * b2) - a12 * (a12 * b3 - a13 * b2) + b1 * (a12 * a23 - a22 * a13) as d3
from k_sums"""

_POOLED_DAYS = """
select city, product_id, last_day + cast(k as integer) as date
from (select *, unnest(range(1, 10)) as k from p_series) x"""

ORACLES: dict[str, str] = {
    # demand
    "daily_demand": sql(f"select {_KEYS}, date, {_SALES} from v_input"),
    "zip_to_city": sql("select * from v_located"),
    "zip_to_city_large_ranges": sql("select * from v_located"),
    "daily_demand_large_ranges": sql(f"select {_KEYS}, date, {_SALES} from v_input"),
    "zip_to_city_overlapping": sql(
        """select s.country, s.product_id, s.date, s.zipcode, s.sales, g.city
from v_sales s join v_overlap g on s.country = g.country
 and s.zipcode >= g.s_zipcode and s.zipcode < g.e_zipcode"""
    ),
    "zip_lookup_first_match": sql(
        """select s.country, s.product_id, s.date, s.zipcode, s.sales, m.city
from v_sales s left join (
  select z.country, z.zipcode, arg_min(g.city, g.s_zipcode) as city
  from (select distinct country, zipcode from v_sales) z join v_overlap g
    on z.country = g.country and z.zipcode >= g.s_zipcode and z.zipcode < g.e_zipcode
  group by z.country, z.zipcode) m
on s.country = m.country and s.zipcode = m.zipcode"""
    ),
    "city_filter": sql("select * from v_geo where city in ('NATION_0', 'NATION_1', 'NATION_7')"),
    "orders_daily_demand": sql(f"select {_KEYS}, date, {_SALES} from v_orders"),
    # data quality
    "junk_sales_values": sql(
        f"select sales, count(*) as rows from v_sales "
        f"where sales is not null and {_NUMBER} is null group by sales"
    ),
    "sales_by_weekday": sql(
        f"select isodow(date) - 1 as weekday, round(sum({_NUMBER}), 6) as sales "
        "from v_located group by 1"
    ),
    "value_frequency": sql(
        """select coalesce(sales, 'nan') as sales, count(*) as count,
round(100.0 * round(count(*) / cast((select count(*) from v_located) as double), 4), 2) as percentage
from v_located group by 1"""
    ),
    "cap_share_weekday": _cap("1", "isodow(date) - 1 as weekday", absent="null"),
    "cap_share_city": _cap("city", "city", absent="null"),
    "cap_share_zipcode": _cap("zipcode", "zipcode"),
    "cap_share_product": _cap("product_id", "product_id"),
    "cap_share_series": _cap(_KEYS, _KEYS, total=f"count({_NUMBER})"),
    "capped_keys": sql(
        f"""select 'zipcode' as key, count(distinct zipcode) as capped_keys from v_located where {_NUMBER} = 9999
union all
select 'product_id', count(distinct product_id) from v_located where {_NUMBER} = 9999
union all
select 'city+product_id', count(*) from (
  select distinct {_KEYS} from v_located where {_NUMBER} = 9999) x"""
    ),
    "unmatched_share": sql(
        """select (select count(*) from v_sales) - count(*) as unmatched,
round(100.0 * ((select count(*) from v_sales) - count(*)) / (select count(*) from v_sales), 2) as pct
from v_located"""
    ),
    "series_coverage": sql(
        """select possible, observed, round(100.0 * observed / possible, 2) as pct from (
select (select count(distinct product_id) from v_sales) * (select count(distinct city) from v_geo) as possible,
       (select count(*) from (select distinct city, product_id from v_located) x) as observed) y"""
    ),
    "profile_columns": _profile("v_sales", ["country", "product_id", "date", "zipcode", "sales"]),
    "profile_geo": _profile("v_geo", ["country", "s_zipcode", "e_zipcode", "city"]),
    "numeric_profile": sql(
        """select 'sales' as "column", round(avg(sales), 4) as mean, round(stddev_samp(sales), 4) as std,
count(*) filter (where sales = 0) as zeros, count(*) filter (where sales < 0) as negatives from v_input"""
    ),
    "duplicate_rate": _duplicates("country, product_id, date, zipcode, sales"),
    "duplicate_rate_of_keys": _duplicates("country, product_id, date"),
    # series
    "history_window": sql(
        f"select {_KEYS}, date, {_SALES} from v_input "
        "where date between date '2024-01-17' and date '2024-01-30'"
    ),
    "gap_fill": sql(f"select {_KEYS}, date, {_SALES} from a_filled"),
    "gap_fill_global": sql(
        f"""select {_KEYS}, date, {_SALES} from (
select c.city, c.product_id, c.date, coalesce(h.sales, 0.0) as sales
from (select city, product_id,
             cast(unnest(generate_series(cast(d0 as timestamp), cast(d1 as timestamp), interval 1 day)) as date) as date
      from (select city, product_id, min(date) as d0, (select max(date) from v_input) as d1
            from v_input group by city, product_id) f) c
left join v_input h on h.city = c.city and h.product_id = c.product_id and h.date = c.date) x"""
    ),
    "gap_fill_sparse": sql(f"select {_KEYS}, date, {_SALES} from o_filled"),
    "train_test_split": sql(
        f"select {_KEYS}, date, {_SALES}, "
        f"case when date > {TRAIN_END} then 'test' else 'train' end as split from a_filled"
    ),
    "series_arrays": sql(
        f"""select {_KEYS}, min(date) over (partition by {_KEYS}) as first_day,
count(*) filter (where date <= {TRAIN_END}) over (partition by {_KEYS}) as n_train,
row_number() over (partition by {_KEYS} order by date) - 1 as pos, {_SALES} from a_filled"""
    ),
    "series_count": sql(f"select count(*) as series from (select distinct {_KEYS} from v_input) x"),
    "demand_classes": sql(
        f"select {_KEYS}, round(adi, 10) as adi, round(cv2, 10) as cv2, class, count from a_classes"
    ),
    "demand_classes_sparse": sql(
        f"select {_KEYS}, round(adi, 10) as adi, round(cv2, 10) as cv2, class, count from o_classes"
    ),
    "class_distribution": sql(
        """select class, count(*) as series,
round(100.0 * count(*) / (select count(*) from a_classes), 2) as pct from a_classes group by class"""
    ),
    "class_samples": sql(
        f"""select f.city, f.product_id, f.date, round(f.sales, 6) as sales, round(k.adi, 6) as adi,
round(k.cv2, 6) as cv2, k.class, k.count
from a_filled f join (
  select * from a_classes where count >= 7
  qualify row_number() over (partition by class order by {_KEYS}) <= 9) k
on k.city = f.city and k.product_id = f.product_id"""
    ),
    "erratic_series": sql(
        """select f.city, f.product_id, f.date, round(f.sales, 6) as sales, round(k.adi, 6) as adi,
round(k.cv2, 6) as cv2, k.class, k.count
from a_filled f join a_classes k on k.city = f.city and k.product_id = f.product_id
where k.class = 'erratic' and k.count >= 7"""
    ),
    # forecasts
    "forecast_mean": _model(_mean_rows("mean", "a_arr")),
    "forecast_moving_average": _model(_ma_rows("moving_average", "a_ma")),
    "forecast_croston_sba": _model(_croston_rows("croston", "a_cr", 0.95)),
    "forecast_croston_classic": _model(_croston_rows("croston", "a_cr", 1.0)),
    "forecast_croston_sparse": _model(_croston_rows("croston", "o_cr", 0.95)),
    "forecast_holt_winters": _model(_hw_rows("holt_winters", "a_hw1")),
    "forecast_holt_winters_grid": _model(_hw_rows("holt_winters", "a_hw")),
    "forecast_trend_seasonal": _model(_trend_rows("trend_seasonal", "a_arr")),
    "forecast_plugin_naive": sql(
        f"""select 'last_value' as model, {_KEYS}, last_day + cast(k as integer) as date,
round(y[-1], 6) as sales
from (select *, unnest(range(1, steps + 1)) as k from a_arr where h = 'full') x"""
    ),
    "forecast_plugin_class": sql(
        f"""select 'drift' as model, {_KEYS}, last_day + cast(k as integer) as date,
round(list_avg(y) + 2.0, 6) as sales
from (select *, unnest(range(1, steps + 1)) as k from a_arr where h = 'full') x"""
    ),
    "pooled_training_rows": sql(
        "select " + ", ".join(f"round(lags[{8 - k}], 6) as lag_{k}" for k in range(1, 8))
        + ", weekday, round(label, 6) as label, key from p_rows"
    ),
    "forecast_random_forest_bounds": sql(
        f"select 'random_forest' as model, {_KEYS}, date, true as within from ({_POOLED_DAYS}) x"
    ),
    "forecast_gbt_days": sql(f"select 'gbt' as model, {_KEYS}, date, true as finite from ({_POOLED_DAYS}) x"),
    "model_failures": sql(
        f"""select 'error' as kind, 'Patchy' as model, {_KEYS},
case kind when 1 then 'ValueError: incomplete forecast: values that are not finite'
else 'ValueError: incomplete forecast: not the 7 days ahead' end as detail
from f_series where kind <> 0
union all
select 'champion' as kind, model, {_KEYS}, 'mae' as detail from f_champions"""
    ),
    "lag_features": _lags(),
    "model_eligibility": sql(
        f"""select m.model, s.city, s.product_id, s.points, cast(m.need as bigint) as min_points,
s.points >= m.need as eligible
from (select {_KEYS}, count(*) filter (where date <= {TRAIN_END}) as points
      from c_filled group by {_KEYS}) s
cross join (values ('ExponentialSmoothing', 14), ('ChangepointTrend', 2), ('Croston', 1),
  ('NaiveMean', 1), ('NaiveMovingAverage', 7), ('RandomForest', 8),
  ('GradientBoostedTrees', 8)) m(model, need)"""
    ),
    "model_forecasts_closed_form": sql(
        f"select model, {_KEYS}, date, {_SALES} from a_forecast where h = 'full'"
    ),
    "forecasts_on_test_closed_form": sql(
        f"select model, {_KEYS}, date, {_SALES} from a_forecast where h = 'test'"
    ),
    # evaluation
    "forecast_metrics_closed_form": sql(
        f"""select model, {_KEYS}, metric, round(value, 6) as value from (
select * from a_metrics
union all
select model, {_KEYS}, 'mape' as metric,
       avg(case when y <> 0 then abs(y - p) / y when y <> p then cast('Infinity' as double) end) as value
from a_pairs group by 1, 2, 3) x"""
    ),
    "extended_metrics_closed_form": _extended(),
    "best_models_closed_form": sql(f"select model, {_KEYS}, metric, {_VALUE} from a_best"),
    "champion_forecast_closed_form": sql(f"select model, {_KEYS}, date, {_SALES} from a_champion"),
    "champion_mean_metric_closed_form": sql("select round(avg(value), 6) as value from a_best"),
    "metric_summary_closed_form": sql(
        """select model, round(median(value), 6) as median, round(avg(value), 6) as mean,
count(*) as count from a_metrics where metric = 'mae' group by model"""
    ),
    # publishing
    "weekly_forecast_closed_form": sql(f"select {_KEYS}, date, {_SALES} from c_weekly"),
    "output_periods_closed_form": sql("select distinct date from c_weekly"),
    "unforecast_series_closed_form": sql(f"select distinct {_KEYS} from c_missing"),
    "fallback_forecast_closed_form": sql(f"select {_KEYS}, date, {_SALES} from c_fallback"),
    "demand_output_closed_form": sql(f"select {_KEYS}, date, {_SALES} from c_output"),
    "output_by_date_closed_form": sql("select date, round(sum(sales), 4) as sales from c_output group by date"),
    "published_demand_closed_form": sql(f"select {_KEYS}, date, {_SALES} from a_output"),
    "published_demand_all_models": sql(f"select {_KEYS}, date, true as usable from a_output"),
    # reports
    "metrics_with_champion_closed_form": sql(
        f"""select model, {_KEYS}, metric, {_VALUE} from (
select * from a_metrics where metric = 'mae'
union
select 'Champion' as model, {_KEYS}, metric, value from a_best) x"""
    ),
    "champion_vs_actual_closed_form": sql(f"select model, {_KEYS}, date, {_SALES} from a_compared"),
    "volume_by_model_closed_form": sql(
        "select model, round(sum(sales), 4) as sales from a_compared group by model"
    ),
    "volume_by_model_date_closed_form": sql(
        "select model, date, round(sum(sales), 4) as sales from a_compared group by model, date"
    ),
    "table_diff": sql(
        f"""select 'left' as side, * from (
  (select {_KEYS}, date, {_SALES} from v_cold) except all (select {_KEYS}, date, {_SALES} from v_input)) l
union all
select 'right' as side, * from (
  (select {_KEYS}, date, {_SALES} from v_input) except all (select {_KEYS}, date, {_SALES} from v_cold)) r"""
    ),
    # one SQL, whichever models there are: these rows do not depend on forecast values
    "output_periods": sql("select distinct date from c_weekly"),
    "unforecast_series": sql(f"select distinct {_KEYS} from c_missing"),
    "fallback_forecast": sql(f"select {_KEYS}, date, {_SALES} from c_fallback"),
    "user_metrics_closed_form": sql(
        f"""select model, {_KEYS}, 'worst_day' as metric, round(max(abs(y - p)), 6) as value from a_pairs group by 1, 2, 3
union all
select model, {_KEYS}, 'total_miss' as metric, round(abs(sum(y - p)), 6) as value from a_pairs group by 1, 2, 3"""
    ),
    "boosted_first_tree": sql(
        """select cast(0 as bigint) as tree, cast(node as bigint) as node, cast(feature as bigint) as feature,
cast(bin as bigint) as bin, round(gain, 4) as gain from (select * from p_root union all select * from p_second) x"""
    ),
    "forest_first_splits": sql(
        """select cast(tree as bigint) as tree, cast(0 as bigint) as node, cast(feature as bigint) as feature,
cast(bin as bigint) as bin, round(gain, 4) as gain from p_forest"""
    ),
    "holt_winters_fit_error": sql(f"select {_KEYS}, case when n >= 14 then true end as not_worse from a_arr where h = 'full'"),
    "forecast_one_changepoint": sql(
        f"""select 'changepoint_trend' as model, {_KEYS}, last_day + cast(k as integer) as date,
round(size * (d1 + d2 * t + d3 * (t - c)) / det, 6) as sales
from (select *, (n - 1 + k) / cast(n - 1 as double) as t from (
  select *, unnest(range(1, 10)) as k from k_solved) x) y"""
    ),
    "sketched_quantiles": """select "column", quantile, true as near
from (values ('zipcode'), ('sales')) c("column")
cross join (values (0.05::double), (0.25::double), (0.5::double), (0.75::double), (0.95::double)) q(quantile)""",
    "sketched_columns": sql(
        "\nunion all\n".join(
            f"""select '{c}' as "column", count(*) as rows, count(*) - count({v}) as missing, true as near from v_located"""
            for c, v in (("country", "country"), ("product_id", "product_id"), ("date", "date"), ("zipcode", "zipcode"),
                         ("sales", "nullif(try_cast(sales as double), cast('NaN' as double))"), ("city", "city"))
        )
    ),
    "correlations": "\nunion all\n".join(
        f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a}, {b}), 6) as value from lineitem"
        for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1 :]
    ),
    "largest_sales": sql(
        f"select {_KEYS}, date, {_SALES} from v_input order by round(sales, 6) desc, {_KEYS}, date limit 10"
    ),
    "ordered_diff": sql(
        f"""select side, {_KEYS}, date, sales, position from (with l as (
  select {_KEYS}, date, {_SALES}, row_number() over (order by {_KEYS}, date) - 1 as position from v_input),
r as (
  select {_KEYS}, date, {_SALES}, row_number() over (order by {_KEYS},
    case when city = 'NATION_1' then date '2024-01-31' - date else date - date '2024-01-01' end) - 1 as position
  from v_input)
select 'left' as side, * from (select * from l except all select * from r) x
union all
select 'right' as side, * from (select * from r except all select * from l) y) z"""
    ),
}
