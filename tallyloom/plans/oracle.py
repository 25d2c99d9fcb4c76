"""SQL counterparts of the registered queries, for a check in another engine.

``PARTS`` are named table expressions with their own dependencies; ``_sql`` puts the
ones a query needs in front of it.
"""

from __future__ import annotations

from tallyloom.operators.drift import ADVICE
from tallyloom.operators.coldstart import BLEND_CLUSTER, CLUSTER_MONTHS, LOCAL_MONTHS
from tallyloom.operators.factors import ROUNDS
from tallyloom.plans.catalog import DRIFT_CASES, EXACT, FORECAST_MODEL, HORIZON, REGION_DAYS
from tallyloom.settings import FUTURE_EXTERNALS, LAGS, WINDOWS

PANEL_COLUMNS = [
    "date", "store_id", "brand_id", "country", "sales_amount", "num_transactions",
    "avg_transaction_value", "promotion_flag", "promotion_discount",
]
ENCODED = ["country", "location_type", "tier", "category", "price_tier"]


def r(expression: str, name: str = "", derived: bool = False) -> str:
    """Inputs unchanged, derived doubles by the same rule as the queries use."""
    if not derived and name in EXACT and expression.rsplit(".", 1)[-1] == name:
        return f"cast({expression} as double) as {name}"
    x = f"({expression})"
    scale = f"pow(10.0::double, floor(log10(abs{x})) - 3)"
    rounded = (
        f"case when abs{x} < 5.3e-5 then 0.0::double when abs{x} < 10000 then round({x} + 2.7182818e-6::double, 4) "
        f"when isnan({x}::double) or isinf({x}::double) then {x} else round({x} / {scale} + 2.7182818e-6::double, 4) * {scale} end"
    )
    return f"{rounded} as {name}" if name else rounded


def n(expression: str, name: str) -> str:
    return f"cast({expression} as bigint) as {name}"


def _mape(actual: str, predicted: str, where: str = "true") -> str:
    return f"100 * avg(abs({actual} - {predicted}) / greatest(abs({actual}), 2.220446049250313e-16)) filter (where {where})"


def _days_to(month: int, day: int) -> str:
    this = f"make_date(year(date), {month}, {day})"
    return f"case when date > {this} then make_date(year(date) + 1, {month}, {day}) - date else {this} - date end"


CALENDAR = {
    "day_of_week": n("isodow(date) - 1", "day_of_week"),
    "is_weekend": n("isodow(date) >= 6", "is_weekend"),
    "month": n("month(date)", "month"),
    "year": n("year(date)", "year"),
    "day_of_month": n("day(date)", "day_of_month"),
    "quarter": n("quarter(date)", "quarter"),
    "week_of_year": n("week(date)", "week_of_year"),
    "month_sin": "sin(2 * pi() * month(date) / 12) as month_sin",
    "month_cos": "cos(2 * pi() * month(date) / 12) as month_cos",
    "day_of_week_sin": "sin(2 * pi() * (isodow(date) - 1) / 7) as day_of_week_sin",
    "day_of_week_cos": "cos(2 * pi() * (isodow(date) - 1) / 7) as day_of_week_cos",
    "days_to_black_friday": n(_days_to(11, 25), "days_to_black_friday"),
    "days_to_new_year": n(_days_to(1, 1), "days_to_new_year"),
}
WHOLE = {
    "num_transactions", "promotion_flag_raw", "day_of_week", "is_weekend", "month", "year", "day_of_month",
    "quarter", "week_of_year", "days_to_black_friday", "days_to_new_year", "store_size_sqm", "avg_price_point",
    "order_count", "is_public_holiday", "store_id", *[f"{c}_encoded" for c in ENCODED],
}
TEXT = {"date", "brand_id", "country", "location_type", "tier", "category", "price_tier", "store_cluster"}


def _rolling() -> list[str]:
    out = [f"lag(sales_amount, {k}) over w as sales_amount_lag_{k}d" for k in LAGS]
    for k in WINDOWS:
        frame = f"over (partition by store_id order by date rows between {k - 1} preceding and current row)"
        out += [
            f"{fn}(sales_amount) {frame} as sales_amount_rolling_{name}_{k}d"
            for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))
        ]
    return out


LAG_NAMES = [f"sales_amount_lag_{k}d" for k in LAGS]
ROLLING_NAMES = [f"sales_amount_rolling_{s}_{k}d" for k in WINDOWS for s in ("mean", "std", "max", "min")]


def _calendar_windows(row: str, end: str) -> list[str]:
    """Scalar lookups of lag and window values for the rows of ``row``, from ``end``."""
    out = [
        f"coalesce((select min(h.sales_amount) from {end} h where h.store_id = {row}.store_id "
        f"and h.date = {row}.date - {k}), 0.0) as sales_amount_lag_{k}d"
        for k in LAGS
    ]
    for k in WINDOWS:
        near = f"from {end} h where h.store_id = {row}.store_id and h.date >= {row}.date - {k} and h.date < {row}.date"
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")):
            out.append(
                f"(select case when count(*) = 0 then 0.0 else {fn}(h.sales_amount) end {near}) "
                f"as sales_amount_rolling_{name}_{k}d"
            )
    return out


FEATURE_COLUMNS = [
    *PANEL_COLUMNS, *CALENDAR, "location_type", "store_size_sqm", "tier", "category", "price_tier",
    "avg_price_point", *[f"{c}_encoded" for c in ENCODED], "store_cluster", "order_count", "demand_index",
    "is_public_holiday", *LAG_NAMES, *ROLLING_NAMES,
]
PSI_COLUMNS = [c for c in FEATURE_COLUMNS if c not in TEXT and c != "store_id"]
FEATURES = f"""select i.*, {', '.join(CALENDAR.values()).replace('date', 'i.date').replace('make_i.date', 'make_date')},
                a.location_type, a.store_size_sqm, a.tier, a.category, a.price_tier, a.avg_price_point,
                {', '.join(f"(select code from codes where column_name = '{c}' and label = coalesce(a.{c}, 'nan')) as {c}_encoded" for c in ENCODED)},
                coalesce(a.tier, 'nan') || '_' || coalesce(a.location_type, 'nan') as store_cluster,
                e.order_count, e.demand_index, e.is_public_holiday
              from imputed i join attributed a on i.store_id = a.store_id and i.date = a.date
              left join ext e on i.date = e.date and i.country = e.country"""
PSI_ROWS = " union all ".join(
    f"select '{f}' as feature, period = 'baseline' as base, cast({f} as double) as value from psi_source"
    for f in PSI_COLUMNS
)
CODE_ROWS = " union all ".join(
    f"select '{c}' as column_name, coalesce({c}, 'nan') as label from attributed" for c in ENCODED
)

PARTS: dict[str, tuple[list[str], str]] = {
    "panel": (
        [],
        """select date, store_id, brand_id, country, cast(amt as double) as sales_amount,
             cast(n as bigint) as num_transactions, cast(amt as double) / n as avg_transaction_value,
             cast(case when disc >= 0.05 then 1 else 0 end as int) as promotion_flag,
             cast(disc as double) as promotion_discount
           from (select cast(l_suppkey as bigint) as store_id, cast(l_shipdate as date) as date,
                   n_name as brand_id, r_name as country,
                   sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) as amt,
                   count(distinct l_orderkey) as n, max(cast(l_discount as decimal(4,2))) as disc
                 from lineitem join supplier on l_suppkey = s_suppkey
                 join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
                 group by all) b""",
    ),
    "store_dim": (
        [],
        """select cast(s_suppkey as bigint) as store_id, n_name as brand_id, r_name as country,
             case s_suppkey % 4 when 0 then 'mall' when 1 then 'street' when 2 then 'airport'
               else 'online' end as location_type,
             cast(50 + s_suppkey % 451 as int) as store_size_sqm,
             cast(180 + (s_suppkey * 37) % 1281 as int) as history_days,
             case when 180 + (s_suppkey * 37) % 1281 >= 1095 then 'data_rich'
               when 180 + (s_suppkey * 37) % 1281 >= 365 then 'data_medium' else 'data_poor' end as tier
           from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    ),
    "brand_dim": (
        [],
        """select n_name as brand_id, 'CAT_' || cast(n_nationkey % 8 as varchar) as category,
             case n_nationkey % 3 when 0 then 'ultra_luxury' when 1 then 'luxury' else 'premium' end as price_tier,
             cast(100 + (n_nationkey * 199) % 4901 as int) as avg_price_point
           from nation""",
    ),
    "ext": (
        [],
        """select date, country, cast(n as bigint) as order_count, cast(t as double) / n as demand_index,
             u as is_public_holiday
           from (select cast(o_orderdate as date) as date, r_name as country, count(*) as n,
                   sum(cast(o_totalprice as decimal(14,2))) as t,
                   cast(max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as int) as u
                 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
                 join region on n_regionkey = r_regionkey group by all) b""",
    ),
    "dense": (
        ["panel"],
        """select s.store_id, s.date, coalesce(p.sales_amount, 0.0) as sales_amount
           from (select store_id, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
                 from panel group by store_id) s
           left join panel p on p.store_id = s.store_id and p.date = s.date""",
    ),
    "attributed": (
        ["panel", "store_dim", "brand_dim"],
        """select p.*, s.location_type, s.store_size_sqm, s.tier, b.category, b.price_tier, b.avg_price_point
           from panel p left join store_dim s on p.store_id = s.store_id
           left join brand_dim b on p.brand_id = b.brand_id""",
    ),
    "codes": (
        ["attributed"],
        f"""select column_name, label,
              dense_rank() over (partition by column_name order by label) - 1 as code
            from (select distinct column_name, label from ({CODE_ROWS}) x) y""",
    ),
    "windowed": (
        ["panel"],
        f"select *, {', '.join(_rolling())} from panel window w as (partition by store_id order by date)",
    ),
    "brand_means": (
        ["windowed"],
        "select brand_id, avg(promotion_flag) as m_promotion_flag, "
        + ", ".join(f"avg({c}) as m_{c}" for c in [*LAG_NAMES, *ROLLING_NAMES])
        + " from windowed group by brand_id",
    ),
    "imputed": (
        ["windowed", "brand_means"],
        "select w.* replace ("
        + ", ".join(
            f"coalesce(w.{c}, m.m_{c}, 0) as {c}" for c in ["promotion_flag", *LAG_NAMES, *ROLLING_NAMES]
        )
        + ") from windowed w left join brand_means m on w.brand_id = m.brand_id",
    ),
    "numbered": (
        ["panel"],
        "select *, row_number() over (order by date, store_id) - 1 as pos, count(*) over () as total from panel",
    ),
    "parts": (
        ["numbered"],
        """select * exclude (pos, total),
             case when pos < floor(total * 0.8::double) then 'train'
               when pos < floor(total * 0.9::double) then 'val' else 'test' end as split,
             case when pos < floor(total * 0.8::double) then 'baseline' else 'current' end as period
           from numbered""",
    ),
    "means": (
        ["parts"],
        """select brand_id, isodow(date) as dow, avg(sales_amount) as prediction
           from parts where split = 'train' group by all""",
    ),
    "scored": (
        ["parts", "means"],
        """select p.*, m.prediction from parts p
           left join means m on p.brand_id = m.brand_id and isodow(p.date) = m.dow""",
    ),
    "health": (
        ["scored"],
        f"""select *, case when mape < 5 then 'healthy' when mape < 8 then 'warning' else 'critical' end
              as health_status
            from (select store_id, count(*) as all_rows,
                    count(*) filter (where sales_amount > 1) as num_days,
                    {_mape("sales_amount", "prediction", "sales_amount > 1")} as mape,
                    avg(abs(sales_amount - prediction)) filter (where sales_amount > 1) as mae,
                    avg(sales_amount) filter (where sales_amount > 1) as avg_actual,
                    avg(prediction) filter (where sales_amount > 1) as avg_predicted
                  from scored where split <> 'train' group by store_id) x
            where all_rows >= 7 and num_days >= 3""",
    ),
    "graded": (
        ["panel"],
        "select *, sales_amount * (1 + (store_id % 12 + 0.5::double) / 100) as prediction from panel",
    ),
    "graded_health": (
        ["graded"],
        f"""select *, case when mape < 5 then 'healthy' when mape < 8 then 'warning' else 'critical' end
              as health_status
            from (select store_id, count(*) as all_rows,
                    count(*) filter (where sales_amount > 1) as num_days,
                    {_mape("sales_amount", "prediction", "sales_amount > 1")} as mape,
                    avg(abs(sales_amount - prediction)) filter (where sales_amount > 1) as mae,
                    avg(sales_amount) filter (where sales_amount > 1) as avg_actual,
                    avg(prediction) filter (where sales_amount > 1) as avg_predicted
                  from graded group by store_id) x
            where all_rows >= 7 and num_days >= 3""",
    ),
    "case_errors": (
        ["parts"],
        f"""select c.percent,
              {_mape("sales_amount", "sales_amount * (1 + c.percent / 100)", "period = 'current' and sales_amount > 1")} as current_mape,
              {_mape("sales_amount", "sales_amount * (1 + 3.0::double / 100)", "period = 'baseline' and sales_amount > 1")} as baseline_mape
            from parts, (values {", ".join(f"({x}::double)" for x in DRIFT_CASES)}) c(percent) group by c.percent""",
    ),
    "case_drift": (
        ["case_errors"],
        """select *, (current_mape - baseline_mape) / baseline_mape * 100 as increase_pct,
             case when current_mape >= 12 then 'severe' when current_mape >= 8 then 'moderate'
               when current_mape >= 5 then 'minor'
               when (current_mape - baseline_mape) / baseline_mape * 100 > 30 then 'minor' else 'none' end as severity
           from case_errors""",
    ),
    "adapters": (
        ["scored"],
        """select store_id, avg(sales_amount - prediction) as mean_residual,
             stddev_samp(sales_amount - prediction) as std_residual, count(*) as data_points
           from scored where split = 'train' group by store_id""",
    ),
    "used_adapters": (
        ["adapters"],
        f"select * from adapters where data_points >= {FORECAST_MODEL.min_adapter_rows}",
    ),
    "adapted": (
        ["scored", "used_adapters"],
        """select s.*, greatest(0, s.prediction
               + coalesce(0.7 * least(a.data_points / 1095.0::double, 1) * a.mean_residual, 0)) as adapted_prediction,
             case when a.data_points is null then 'global_only' else 'adapted' end as prediction_type
           from scored s left join used_adapters a on s.store_id = a.store_id where s.split = 'test'""",
    ),
    "errors": (
        ["scored"],
        f"""select {_mape("sales_amount", "prediction", "split <> 'train' and sales_amount > 1")} as current_mape,
              {_mape("sales_amount", "prediction", "split = 'train' and sales_amount > 1")} as baseline_mape,
              avg(sales_amount - prediction) filter (where split <> 'train') as mean_residual
            from scored""",
    ),
    "error_drift": (
        ["errors"],
        """select *, case when baseline_mape > 0 then (current_mape - baseline_mape) / baseline_mape * 100
               else 0 end as increase_pct,
             case when current_mape >= 12 then 'severe' when current_mape >= 8 then 'moderate'
               when current_mape >= 5 then 'minor'
               when baseline_mape > 0 and (current_mape - baseline_mape) / baseline_mape * 100 > 30 then 'minor'
               else 'none' end as severity
           from errors""",
    ),
    "residual_cusum": (
        ["errors"],
        """select mean_residual, greatest(0, mean_residual - 3) as cusum_pos,
             least(0, mean_residual + 3) as cusum_neg from errors""",
    ),
    "features": (["imputed", "attributed", "codes", "ext"], FEATURES),
    "psi_source": (
        ["features", "parts"],
        "select x.*, p.period from features x join parts p on x.store_id = p.store_id and x.date = p.date",
    ),
    "psi_rows": (["psi_source"], PSI_ROWS),
    "psi_edges": (
        ["psi_rows"],
        """select feature, quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) as raw,
             count(*) - count(value) as missing
           from psi_rows where base group by feature""",
    ),
    "psi_bins": (
        ["psi_edges"],
        """select feature, missing, i as bin, edges[i] as lo, edges[i + 1] as hi
           from (select feature, missing, edges, unnest(range(1, len(edges))) as i
                 from (select feature, missing, list_sort(list_distinct(raw)) as edges from psi_edges) d) e""",
    ),
    "psi_counts": (
        ["psi_bins", "psi_rows"],
        """select b.feature, b.missing, b.bin, count(v.value) filter (where v.base) as base_rows,
             count(v.value) filter (where not v.base) as current_rows
           from psi_bins b left join psi_rows v on v.feature = b.feature and v.value <= b.hi
             and (v.value > b.lo or (b.bin = 1 and v.value = b.lo))
           group by all""",
    ),
    "psi_shares": (
        ["psi_counts"],
        """select feature, missing,
             coalesce(base_rows / nullif(sum(base_rows) over (partition by feature), 0)::double, 0.001) + 1e-10 as e,
             coalesce(current_rows / nullif(sum(current_rows) over (partition by feature), 0)::double, 0.001)
               + 1e-10 as a
           from psi_counts""",
    ),
    "psi": (
        ["psi_shares", "psi_edges"],
        """select feature, psi, psi > 0.25 as drift_detected,
             case when psi > 0.25 then 'high' when psi > 0.1 then 'medium' else 'low' end as severity
           from (select d.feature, case when d.missing > 0 then 0.0
                   else coalesce(sum((s.a - s.e) * ln(s.a / s.e)), 0.0) end as psi
                 from psi_edges d left join psi_shares s on d.feature = s.feature
                 group by d.feature, d.missing) x""",
    ),
    "psi_totals": (
        ["psi"],
        """select count(*) filter (where drift_detected) as drifted_features, count(*) as total_features from psi""",
    ),
    "report": (
        ["error_drift", "residual_cusum", "psi_totals"],
        """select d.current_mape, d.baseline_mape, d.severity, t.drifted_features, t.total_features,
             c.cusum_pos, c.cusum_neg,
             case when c.cusum_pos > abs(c.cusum_neg) then 'positive' else 'negative' end as direction,
             (d.severity <> 'none' or t.drifted_features > 0 or c.cusum_pos > 5 or abs(c.cusum_neg) > 5)
               as drift_detected,
             case when d.severity = 'severe' then 'retrain_global_emergency'
               when d.severity = 'moderate' or t.drifted_features >= 5 then 'retrain_cluster'
               when c.cusum_pos > 5 or abs(c.cusum_neg) > 5 then 'investigate_gradual_drift'
               when d.severity <> 'none' or t.drifted_features > 0 then 'alert_only'
               else 'none' end as recommended_action
           from error_drift d, residual_cusum c, psi_totals t""",
    ),
    "days": (
        ["panel"],
        f"""select cast(unnest(generate_series(m + interval 1 day, m + interval {HORIZON} day, interval 1 day)) as date)
              as date from (select max(date) as m from panel) x""",
    ),
    "spine": (
        ["store_dim", "panel", "days"],
        """select s.store_id, s.brand_id, s.country, s.store_size_sqm, d.date from store_dim s, days d
           where s.store_id in (select store_id from panel)""",
    ),
    "future": (
        ["spine", "panel"],
        f"select s.store_id, s.date, {', '.join(_calendar_windows('s', 'panel'))} from spine s",
    ),
    "forecasts_raw": (
        ["spine", "means", "used_adapters"],
        """select s.date, s.store_id, s.brand_id, s.country,
             greatest(0, m.prediction + coalesce(0.7 * least(a.data_points / 1095.0::double, 1) * a.mean_residual, 0))
               as predicted_sales,
             case when a.data_points is null then 'global_only' else 'adapted' end as prediction_type
           from spine s left join means m on s.brand_id = m.brand_id and isodow(s.date) = m.dow
           left join used_adapters a on s.store_id = a.store_id""",
    ),
    "forecasts": (
        ["forecasts_raw"],
        """select f.*, greatest(0, predicted_sales - 1.28 * 0.3 * d) as lower_bound,
             predicted_sales + 1.28 * 0.3 * d as upper_bound, 0.8::double as confidence_level
           from forecasts_raw f, (select stddev_pop(predicted_sales) as d from forecasts_raw) x""",
    ),
    "event_rows": (
        [],
        """select user_id, event_id, ts, (value - 50) / 10 as error,
             row_number() over (partition by user_id order by ts, event_id) as rn from events""",
    ),
    "event_cusum": (
        ["event_rows"],
        """select user_id, event_id, ts, error, rn, greatest(0.0::double, error - 3) as cusum_pos,
             least(0.0::double, error + 3) as cusum_neg from event_rows where rn = 1
           union all
           select e.user_id, e.event_id, e.ts, e.error, e.rn, greatest(0.0::double, c.cusum_pos + e.error - 3),
             least(0.0::double, c.cusum_neg + e.error + 3)
           from event_cusum c join event_rows e on e.user_id = c.user_id and e.rn = c.rn + 1""",
    ),
}


def _sql(final: str, *needs: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in PARTS[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return final
    word = "with recursive" if "event_cusum" in ordered else "with"
    return word + " " + ",\n".join(f"{name} as ({PARTS[name][1]})" for name in ordered) + "\n" + final


def _factors(rounds: int = ROUNDS) -> str:
    """The same rounds of proportional updates as the query, one table expression a step."""
    parts = [
        """cells as (select brand_id, country, store_id, count(*) as n, sum(sales_amount) as y
             from panel where sales_amount is not null group by all)""",
        "c0 as (select distinct country, 1.0::double as f from cells)",
        "s0 as (select distinct store_id, 1.0::double as f from cells)",
    ]

    def update(k: str, a: str, ka: str, b: str, kb: str, target: str) -> str:
        return f"""{target} as (select x.{k}, case when sum(x.n * pa.f * pb.f) > 0
               then sum(x.y) / sum(x.n * pa.f * pb.f) else 0.0::double end as f
             from cells x join {a} pa on x.{ka} is not distinct from pa.{ka}
             join {b} pb on x.{kb} is not distinct from pb.{kb} group by x.{k})"""

    for i in range(1, rounds + 1):
        parts += [
            update("brand_id", f"c{i - 1}", "country", f"s{i - 1}", "store_id", f"rb{i}"),
            update("country", f"rb{i}", "brand_id", f"s{i - 1}", "store_id", f"rc{i}"),
            update("store_id", f"rb{i}", "brand_id", f"rc{i}", "country", f"rs{i}"),
            f"mc{i} as (select coalesce(nullif(avg(f), 0), 1.0::double) as m from rc{i})",
            f"ms{i} as (select coalesce(nullif(avg(f), 0), 1.0::double) as m from rs{i})",
            f"c{i} as (select country, f / (select m from mc{i}) as f from rc{i})",
            f"s{i} as (select store_id, f / (select m from ms{i}) as f from rs{i})",
            f"b{i} as (select brand_id, f * ((select m from mc{i}) * (select m from ms{i})) as f from rb{i})",
        ]
    last = rounds
    final = f"""select x.brand_id, x.country, x.store_id, x.n as rows, {r('x.y', 'total')},
         {r('b.f', 'brand_base')}, {r('c.f', 'country_factor')}, {r('s.f', 'store_factor')},
         {r('x.n * b.f * c.f * s.f', 'fitted_total')}
       from cells x join b{last} b on x.brand_id is not distinct from b.brand_id
       join c{last} c on x.country is not distinct from c.country
       join s{last} s on x.store_id is not distinct from s.store_id"""
    return ",\n".join(parts) + "\n" + final


def _columns(names: list[str]) -> str:
    return ", ".join(c if c in TEXT else n(c, c) if c in WHOLE else r(c, c) for c in names)


def _quality() -> str:
    columns = [*PANEL_COLUMNS, "order_count", "demand_index", "is_public_holiday"]
    rows = ["select 'total_rows' as check, null::varchar as column_name, count(*)::bigint as result from q"]
    rows += [
        f"select 'missing_values', '{c}', (count(*) - count({c}))::bigint from q" for c in columns
    ]
    rows.append("select 'negative_sales', 'sales_amount', (count(*) filter (where sales_amount < 0))::bigint from q")
    rows.append(
        "select 'duplicates', null, ((select count(*) from q) - (select count(*) from (select distinct * from q)))::bigint"
    )
    source = "select p.*, e.order_count, e.demand_index, e.is_public_holiday from panel p left join ext e on p.date = e.date and p.country = e.country"
    return "select * from (" + " union all ".join(rows).replace(" from q", f" from ({source}) q") + ") z"


EVENT_FACTORS = """cast(case when month(date) in (3, 4) then 1 else 0 end as bigint) as is_spring_event,
  cast(case when month(date) = 11 and day(date) between 20 and 29 then 1 else 0 end as bigint) as is_sale_event"""
NATIONAL = " or ".join(
    f"(country = '{c}' and month(date) = {m} and day(date) = {d})" for c, (m, d) in REGION_DAYS.items()
)
PREVIOUS_ROWS = "partition by store_id, year(date) order by date rows unbounded preceding"
FORECAST_COLUMNS = (
    "date, store_id, brand_id, country, "
    + ", ".join(r(c, c) for c in ("predicted_sales", "lower_bound", "upper_bound"))
    + f", {r('confidence_level', 'confidence_level')}, prediction_type"
)
REPORT_COLUMNS = (
    ", ".join(r(c, c) for c in ("current_mape", "baseline_mape", "cusum_pos", "cusum_neg"))
    + ", severity, drifted_features, total_features, direction, drift_detected, recommended_action"
)
HEALTH_COLUMNS = "store_id, num_days, health_status, " + ", ".join(
    r(c, c) for c in ("mape", "mae", "avg_actual", "avg_predicted")
)
EVENT_COLUMNS = (
    f"user_id, event_id, {r('error', 'error')}, {r('cusum_pos', 'cusum_pos')}, {r('cusum_neg', 'cusum_neg')}, "
    "(cusum_pos > 5 or abs(cusum_neg) > 5) as drift_detected, "
    "case when cusum_pos > abs(cusum_neg) then 'positive' else 'negative' end as direction"
)


def _advice(key: str) -> str:
    return "'" + ADVICE[key].replace("'", "''") + "'"


def _accuracy(prediction: str, prefix: str, where: str) -> str:
    return ", ".join(
        [
            r(_mape("sales_amount", prediction, where), f"{prefix}mape"),
            r(f"avg(abs(sales_amount - {prediction})) filter (where {where})", f"{prefix}mae"),
            r(f"sqrt(avg(pow(sales_amount - {prediction}, 2)) filter (where {where}))", f"{prefix}rmse"),
        ]
    )


ORACLE: dict[str, str] = {
    "panel_daily": _sql(f"select {_columns(PANEL_COLUMNS).replace(r('promotion_flag', 'promotion_flag'), n('promotion_flag', 'promotion_flag'))} from panel", "panel"),
    "panel_densify": _sql(f"select store_id, date, {r('sales_amount', 'sales_amount')} from dense", "dense"),
    "quality_profile": _sql(_quality(), "panel", "ext"),
    "duplicate_rows": """select cast(sum(k - 1) as bigint) as duplicates,
        count(*) filter (where k > 1) as repeated_groups
      from (select count(*) as k from lineitem
            group by l_suppkey, cast(l_shipdate as date), l_discount, l_tax) g""",
    "outlier_flags": _sql(
        f"""select store_id, date, {r('sales_amount', 'sales_amount')},
              coalesce(abs(sales_amount - m) / nullif(s, 0) > 3, false) as is_outlier
            from panel, (select avg(sales_amount) as m, stddev_samp(sales_amount) as s from panel) x""",
        "panel",
    ),
    "feature_metadata": _sql(
        f"""select 'v1' as version, count(*) as num_records, {n(str(len(PANEL_COLUMNS)), 'num_features')},
              '{",".join(PANEL_COLUMNS)}' as features, count(distinct store_id) as stores,
              count(distinct brand_id) as brands, min(date) as start, max(date) as "end" from panel""",
        "panel",
    ),
    "dataset_summary": _sql(
        """select 'total_stores' as section, null::varchar as value, count(*) as n from store_dim
           union all select 'total_brands', null, count(*) from brand_dim
           union all select 'total_sales_records', null, count(*) from panel
           union all select 'date_range_start', cast(min(date) as varchar), count(*) from panel
           union all select 'date_range_end', cast(max(date) as varchar), count(*) from panel
           union all select 'data_tiers', tier, count(*) from store_dim group by tier
           union all select 'countries', country, count(*) from store_dim group by country
           union all select 'brands_by_category', category, count(*) from brand_dim group by category""",
        "store_dim", "brand_dim", "panel",
    ),
    "calendar_columns": _sql(
        "select store_id, date, "
        + ", ".join(r(e.rsplit(" as ", 1)[0], c) if c.endswith(("sin", "cos")) else e for c, e in CALENDAR.items())
        + " from panel",
        "panel",
    ),
    "calendar_event_factors": _sql(
        f"""select store_id, date, country,
              {r("case isodow(date) when 1 then 0.8 when 2 then 0.85 when 3 then 0.9 when 4 then 0.95 when 5 then 1.2 when 6 then 1.3 else 1.1 end", "weekday_factor")},
              {EVENT_FACTORS}, cast(case when {NATIONAL} then 1 else 0 end as bigint) as is_national_day,
              {r(f"case when month(date) in (3, 4) then 1.5 else 1 end * case when month(date) = 11 and day(date) between 20 and 29 then 2.0 else 1 end * case when {NATIONAL} then 1.8 else 1 end", "event_factor")}
            from panel""",
        "panel",
    ),
    "dim_join": _sql(
        f"""select store_id, date, location_type, {n('store_size_sqm', 'store_size_sqm')}, tier, category,
              price_tier, {n('avg_price_point', 'avg_price_point')} from attributed""",
        "attributed",
    ),
    "label_encoding": _sql("select column_name, label, cast(code as bigint) as code from codes", "codes"),
    "store_cluster_keys": _sql(
        "select store_id, tier, location_type, tier || '_' || location_type as store_cluster from store_dim",
        "store_dim",
    ),
    "external_join": _sql(
        f"""select p.store_id, p.date, p.country, e.order_count, {r('e.demand_index', 'demand_index')},
              {n('e.is_public_holiday', 'is_public_holiday')}
            from panel p left join ext e on p.date = e.date and p.country = e.country""",
        "panel", "ext",
    ),
    "lag_columns": _sql(
        f"select store_id, date, {_columns(['sales_amount', *LAG_NAMES])} from windowed", "windowed"
    ),
    "rolling_columns": _sql(
        f"select store_id, date, {_columns(['sales_amount', *ROLLING_NAMES])} from windowed", "windowed"
    ),
    "calendar_window_columns": _sql(
        f"""select store_id, date, {_columns(['sales_amount', *LAG_NAMES, *ROLLING_NAMES])}
            from (select p.store_id, p.date, p.sales_amount, {', '.join(_calendar_windows('p', 'panel'))} from panel p) x""",
        "panel",
    ),
    "impute_brand_mean": _sql(
        "select brand_id, store_id, date, "
        + _columns(
            ["promotion_flag", "sales_amount_lag_7d", "sales_amount_lag_365d", "sales_amount_rolling_std_7d"]
        )
        + " from imputed",
        "imputed",
    ),
    "feature_table": _sql(f"select {_columns(FEATURE_COLUMNS)} from features", "features"),
    "split_by_time": _sql("select store_id, date, split from parts", "parts"),
    "gbt_model_checks": _sql(
        """select count(*)::bigint as test_rows, count(*)::bigint as finite_predictions, true as beats_mean,
             1.0::double as importance_sum, 0::bigint as negative_importances from parts where split = 'test'""",
        "parts",
    ),
    "split_baseline": _sql("select store_id, date, period from parts", "parts"),
    "planning_totals": _sql(
        f"""select case when grouping(wk) = 0 then 'week' when grouping(mo) = 0 then 'month' else 'all' end as grain,
             coalesce(wk, mo) as period_start, brand_id, country,
             cast(grouping(wk, mo, brand_id, country) as bigint) as level, count(*) as row_count,
             {r('sum(sales_amount)', 'amount_total')}, cast(sum(num_transactions) as bigint) as count_total,
             cast(sum(promotion_flag) as bigint) as flagged_rows,
             {r('sum(sales_amount) / count(*)', 'amount_per_row')}
           from (select *, cast(date_trunc('week', date) as date) as wk,
                   cast(date_trunc('month', date) as date) as mo from panel) p
           group by grouping sets ((wk, brand_id, country), (wk, brand_id), (wk, country), (wk),
             (mo, brand_id, country), (mo, brand_id), (mo, country), (mo), ())""",
        "panel",
    ),
    "brand_country_store_factors": _sql(", " + _factors(), "panel"),
    "cold_start": _sql(
        f""", opened as (select store_id, min(date) as o from panel group by store_id),
           rows as (select p.store_id, p.date, p.sales_amount, d.tier || '_' || d.location_type as cluster,
               (year(p.date) * 12 + month(p.date)) - (year(o.o) * 12 + month(o.o))
                 - case when day(p.date) < day(o.o) then 1 else 0 end as months_open,
               date_trunc('month', p.date)::date as mo
             from panel p left join opened o using (store_id) left join store_dim d using (store_id)),
           mature as (select cluster, avg(sales_amount) as cluster_mean from rows
             where months_open >= {LOCAL_MONTHS} group by cluster),
           monthly as (select store_id, mo, sum(sales_amount) as s, count(sales_amount) as n
             from rows where mo is not null group by store_id, mo),
           local as (select store_id, mo, sum(s) over w / sum(n) over w as local_mean from monthly
             window w as (partition by store_id order by mo rows between unbounded preceding and 1 preceding)),
           phased as (select r.*, m.cluster_mean, l.local_mean,
               case when months_open is null then null when months_open < {CLUSTER_MONTHS} then 'cluster'
                 when months_open < {LOCAL_MONTHS} then 'blend' else 'local' end as phase
             from rows r left join mature m on r.cluster is not distinct from m.cluster
             left join local l on r.store_id = l.store_id and r.mo = l.mo),
           weighted as (select *, case phase when 'cluster' then 1.0 when 'blend' then {BLEND_CLUSTER}
               when 'local' then 0.0 end::double as cluster_weight from phased)
         select store_id, date, {r('sales_amount', 'sales_amount')}, cluster, cast(months_open as bigint) as months_open,
           phase, {r('cluster_mean', 'cluster_mean')}, {r('local_mean', 'local_mean')},
           {r('cluster_weight', 'cluster_weight')},
           {r("""case when phase is null then null when cluster_mean is null then local_mean
             when local_mean is null then cluster_mean
             else cluster_weight * cluster_mean + (1 - cluster_weight) * local_mean end""", 'prediction')}
         from weighted""",
        "panel", "store_dim",
    ),
    "accuracy_metrics": _sql(
        f"""select split, {_accuracy('prediction', '', 'sales_amount > 1')},
              count(*) filter (where sales_amount > 1) as valid_rows from scored group by split""",
        "scored",
    ),
    "rolling_error": _sql(
        f"""select store_id, date, {r('v', 'rolling_mape')} from (
              select store_id, date, avg(abs((sales_amount - prediction) / nullif(sales_amount, 0)) * 100)
                over (partition by store_id order by date rows between 6 preceding and current row) as v
              from scored) x""",
        "scored",
    ),
    "store_health": _sql(f"select {HEALTH_COLUMNS} from health order by mape desc, store_id", "health"),
    "mape_drift_cases": _sql(
        f"""select {r('percent', 'percent')}, {r('current_mape', 'current_mape')}, {r('baseline_mape', 'baseline_mape')},
              {r('increase_pct', 'increase_pct')}, severity <> 'none' as drift_detected, severity,
              case severity when 'severe' then 'retrain_global_emergency' when 'moderate' then 'retrain_cluster'
                when 'minor' then 'alert_only' else 'none' end as action from case_drift""",
        "case_drift",
    ),
    "store_health_graded": _sql(f"select {HEALTH_COLUMNS} from graded_health", "graded_health"),
    "health_csv_roundtrip": _sql(f"select {HEALTH_COLUMNS} from graded_health", "graded_health"),
    "health_counts_graded": _sql(
        f"""select {n('position', 'position')}, v.health_status, count(h.store_id) as stores,
              {r('coalesce(100.0 * count(h.store_id) / nullif((select count(*) from graded_health), 0), 0)', 'percentage')}
            from (values (0, 'healthy'), (1, 'warning'), (2, 'critical')) v(position, health_status)
            left join graded_health h on h.health_status = v.health_status group by position, v.health_status""",
        "graded_health",
    ),
    "feature_store_roundtrip": _sql(f"select {_columns(FEATURE_COLUMNS)} from features", "features"),
    "raw_tables_roundtrip": _sql(
        f"""select {_columns(PANEL_COLUMNS).replace(r('promotion_flag', 'promotion_flag'), n('promotion_flag', 'promotion_flag'))},
              order_count, {r('demand_index', 'demand_index')}, {n('is_public_holiday', 'is_public_holiday')}
            from panel left join ext using (date, country)""",
        "panel", "ext",
    ),
    "customers_without_events": "select c_custkey as store_id from customer where c_custkey not in (select user_id from events where user_id is not null)",
    "store_health_dense": _sql(
        f"""select {HEALTH_COLUMNS} from (
              select *, case when mape < 5 then 'healthy' when mape < 8 then 'warning' else 'critical' end
                as health_status
              from (select store_id, count(*) as all_rows, count(*) filter (where sales_amount > 1) as num_days,
                      {_mape('sales_amount', '50000.0', 'sales_amount > 1')} as mape,
                      avg(abs(sales_amount - 50000.0)) filter (where sales_amount > 1) as mae,
                      avg(sales_amount) filter (where sales_amount > 1) as avg_actual,
                      50000.0::double as avg_predicted
                    from dense group by store_id) x where all_rows >= 7 and num_days >= 3) y""",
        "dense",
    ),
    "health_counts": _sql(
        f"""select {n('position', 'position')}, v.health_status, count(h.store_id) as stores,
              {r('coalesce(100.0 * count(h.store_id) / nullif((select count(*) from health), 0), 0)', 'percentage')}
            from (values (0, 'healthy'), (1, 'warning'), (2, 'critical')) v(position, health_status)
            left join health h on h.health_status = v.health_status group by position, v.health_status""",
        "health",
    ),
    "critical_top5": _sql(
        f"""select store_id, {r('mape', 'mape')}, {r('mae', 'mae')} from (
              select * from health where health_status = 'critical' order by mape desc, store_id limit 5) x""",
        "health",
    ),
    "adapter_fit": _sql(
        f"""select store_id, {r('mean_residual', 'mean_residual')}, {r('std_residual', 'std_residual')}, data_points
            from adapters where data_points >= 180""",
        "adapters",
    ),
    "adapted_predictions": _sql(
        f"""select store_id, date, {r('prediction', 'prediction')}, {r('adapted_prediction', 'adapted_prediction')},
              prediction_type from adapted""",
        "adapted",
    ),
    "model_comparison": _sql(
        f"""select {_accuracy('prediction', 'global_', 'sales_amount > 0')},
              {_accuracy('adapted_prediction', 'adapted_', 'sales_amount > 0')},
              count(*) as total_samples, count(*) filter (where sales_amount > 0) as valid_samples,
              {r(f"({_mape('sales_amount', 'prediction', 'sales_amount > 0')}) - ({_mape('sales_amount', 'adapted_prediction', 'sales_amount > 0')})", 'mape_reduction')},
              count(*) filter (where not sales_amount > 0) as zero_sales_samples
            from adapted""",
        "adapted",
    ),
    "psi_features": _sql(f"select feature, {r('psi', 'psi')}, drift_detected, severity from psi", "psi"),
    "cusum_per_store": _sql(
        f"""select store_id, date, {r('cusum_pos', 'cusum_pos')}, {r('cusum_neg', 'cusum_neg')},
              (cusum_pos > 5 or abs(cusum_neg) > 5) as drift_detected,
              case when cusum_pos > abs(cusum_neg) then 'positive' else 'negative' end as direction
            from (select store_id, date, up - least(0, min(up) over w) as cusum_pos,
                    down - greatest(0, max(down) over w) as cusum_neg
                  from (select store_id, date,
                          sum((sales_amount - prediction) / 10000 - 0.5::double) over ({PREVIOUS_ROWS}) as up,
                          sum((sales_amount - prediction) / 10000 + 0.5::double) over ({PREVIOUS_ROWS}) as down
                        from scored) x window w as ({PREVIOUS_ROWS})) y""",
        "scored",
    ),
    "cusum_per_user": _sql(f"select {EVENT_COLUMNS} from event_cusum", "event_cusum"),
    "cusum_stream": _sql(
        f"select {EVENT_COLUMNS}, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, false as is_late from event_cusum", "event_cusum"
    ),
    "cusum_mean_residual": _sql(
        f"""select {r('mean_residual', 'mean_residual')}, {r('cusum_pos', 'cusum_pos')}, {r('cusum_neg', 'cusum_neg')},
              (cusum_pos > 5 or abs(cusum_neg) > 5) as drift_detected,
              case when cusum_pos > abs(cusum_neg) then 'positive' else 'negative' end as direction
            from residual_cusum""",
        "residual_cusum",
    ),
    "mape_drift": _sql(
        f"""select {r('current_mape', 'current_mape')}, {r('baseline_mape', 'baseline_mape')},
              {r('increase_pct', 'increase_pct')}, severity <> 'none' as drift_detected, severity,
              case severity when 'severe' then 'retrain_global_emergency' when 'moderate' then 'retrain_cluster'
                when 'minor' then 'alert_only' else 'none' end as action from error_drift""",
        "error_drift",
    ),
    "drift_action": _sql(f"select {REPORT_COLUMNS} from report", "report"),
    "json_report_roundtrip": _sql(f"select {REPORT_COLUMNS} from report", "report"),
    "recommendations": _sql(
        f"""select cast(row_number() over (order by k) as bigint) as position, recommendation from (
              select 1 as k, case recommended_action
                  when 'retrain_global_emergency' then {_advice('emergency')}
                  when 'retrain_cluster' then printf({_advice('cluster')}, c.critical)
                  when 'investigate_gradual_drift' then {_advice('gradual')}
                  when 'alert_only' then {_advice('alert')} else {_advice('none')} end as recommendation
              from report, c
              union all
              select 2, case recommended_action when 'retrain_global_emergency' then {_advice('review')}
                when 'retrain_cluster' then printf({_advice('focus')}, c.named,
                  case when c.critical > 5 then {_advice('others')} else '' end) end from report, c
              union all
              select 3, case when drifted_features >= 3 then printf({_advice('features')}, drifted_features) end
              from report
              union all
              select 4, case when c.critical > 10 then printf({_advice('critical')}, c.critical) end from c) x
            where recommendation is not null""".replace(
            "from report, c", "from report, critical_facts c"
        ).replace("end from c)", "end from critical_facts c)"),
        "report", "health",
    ).replace(
        "\nselect cast(row_number()",
        """,
critical_facts as (select (select count(*) from health where health_status = 'critical') as critical,
  (select string_agg(cast(store_id as varchar), ', ' order by mape desc, store_id) from
    (select * from health where health_status = 'critical' order by mape desc, store_id limit 5) t) as named)
select cast(row_number()""",
    ),
    "future_days": _sql("select store_id, brand_id, country, date from spine", "spine"),
    "stores_without_orders": "select c_custkey as store_id from customer where c_custkey not in (select o_custkey from orders)",
    "calendar_lag_lookup": _sql(f"select store_id, date, {_columns(LAG_NAMES)} from future", "future"),
    "range_window_stats": _sql(f"select store_id, date, {_columns(ROLLING_NAMES)} from future", "future"),
    "forecast_features": _sql(
        f"""select f.store_id, f.date, {_columns(LAG_NAMES)}, {_columns(ROLLING_NAMES)}, s.brand_id, s.country,
              {n('s.store_size_sqm', 'store_size_sqm')}, h.num_transactions,
              {r('h.avg_transaction_value', 'avg_transaction_value', derived=True)},
              {n('coalesce(b.avg_price_point, 500)', 'avg_price_point')},
              {', '.join(f"{r(str(v), k) if isinstance(v, float) else n(str(v), k)}" for k, v in FUTURE_EXTERNALS.items())},
              0::bigint as promotion_flag, 0.0::double as promotion_discount,
              {n('isodow(f.date) - 1', 'day_of_week')},
              {n('make_date(year(f.date) + case when f.date > make_date(year(f.date), 1, 1) then 1 else 0 end, 1, 1) - f.date', 'days_to_new_year')}
            from future f join spine s on f.store_id = s.store_id and f.date = s.date
            join (select store_id, cast(trunc(avg(num_transactions)) as bigint) as num_transactions,
                    avg(avg_transaction_value) as avg_transaction_value from panel group by store_id) h
              on h.store_id = f.store_id
            left join brand_dim b on b.brand_id = s.brand_id""",
        "future", "brand_dim",
    ),
    "forecast_intervals": _sql(f"select {FORECAST_COLUMNS} from forecasts", "forecasts"),
    "csv_roundtrip": _sql(f"select {FORECAST_COLUMNS} from forecasts", "forecasts"),
    "forecast_summary": _sql(
        f"""select store_id, brand_id, country, {r('sum(predicted_sales)', 'total_forecast')},
              {r('avg(predicted_sales)', 'avg_daily_forecast')}, min(prediction_type) as prediction_type
            from forecasts group by store_id, brand_id, country""",
        "forecasts",
    ),
    "forecast_types": _sql(
        "select prediction_type, count(distinct store_id) as stores from forecasts group by prediction_type",
        "forecasts",
    ),
    "forecast_report": _sql(
        f"""select min(date) as start, max(date) as "end", count(distinct date) as days,
              count(distinct store_id) as stores, count(distinct brand_id) as brands,
              count(distinct country) as countries, {r('sum(predicted_sales)', 'total_sales')},
              {r('avg(predicted_sales)', 'avg_daily_sales')}, {r('median(predicted_sales)', 'median_daily_sales')}
            from forecasts""",
        "forecasts",
    ),
    "top_forecast_stores": _sql(
        f"""select store_id, {r('total', 'total_forecast')} from (
              select store_id, sum(predicted_sales) as total from forecasts group by store_id
              order by total desc, store_id limit 5) x""",
        "forecasts",
    ),
    "store_cluster_stats": _sql(
        f"""select {n('g.cluster', 'cluster')}, count(s.store_id) as num_stores,
              {r('avg(s.store_size_sqm)', 'avg_size')}, {r('avg(s.history_days)', 'avg_history_days')},
              (select string_agg(country || ':' || k, ',' order by country) from
                (select country, count(*) as k from store_dim t where t.store_id % 12 = g.cluster group by country) u)
                as countries
            from range(12) g(cluster) left join store_dim s on s.store_id % 12 = g.cluster group by g.cluster""",
        "store_dim",
    ),
    "stream_quality_counts": f"""select strftime(date_trunc('day', ts), '%Y-%m-%d') as window_start, event_type,
        count(*) as total_rows, count(*) - count(value) as missing_values,
        count(*) filter (where value < 0) as negative_values, {r('avg(value)', 'mean_value')}
        , date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) - interval 1 hour as is_final,
        cast(0 as bigint) as late_rows
      from events
      group by date_trunc('day', ts), event_type""",
}

ORACLE["adapter_roundtrip"] = ORACLE["adapter_fit"]
ORACLE["forecast_summary_roundtrip"] = ORACLE["forecast_summary"]
