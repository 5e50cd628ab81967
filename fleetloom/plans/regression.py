"""Order-volume model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.operators import models as M
from fleetloom.operators import order_facts as O
from fleetloom.operators.joins import enrich, small
from fleetloom.plans.views_sql import with_views
from fleetloom.session import materialize
from fleetloom.sources import domain as D

SINCE = "1995-06-06"
MODELS = ("M1 1-URGENT", "M1 2-HIGH", "M2 1-URGENT", "M2 5-LOW", "M1 5-LOW")
PREDICTORS = ("avg_total_discount", "total_spend", "total_clicks", "total_drives", "total_leads",
              "email_opens", "foot_traffic")
LAGGED = PREDICTORS[1:]
MONEY = ("revenue", "base_price", "options_price", "total_price", "total_discount", "referral_discount",
         "price_adjustments", "lease_down_payment_credit", "lease_subvention", "apr_subvention")
X, Y = "avg_total_discount", "total_orders"


def version_ranking(spark: SparkSession, root: str) -> DataFrame:
    return O.version_ranking(D.revenue(spark, root))


def rows_per_version(spark: SparkSession, root: str) -> DataFrame:
    """Revenue rows by version rank; versions join on NULL-safe keys."""
    revenue = D.revenue(spark, root)
    ranks = small(O.version_ranking(revenue))
    keys = {c: c for c in ("forecast_version", "forecast_version_year")}
    ranked = enrich(revenue, ranks, keys, null_safe=True)
    return ranked.groupBy("forecast_version_rank").agg(F.count(F.lit(1)).alias("n"), F.count("forecast_version").alias("named"))


def latest_version(spark: SparkSession, root: str) -> DataFrame:
    latest = O.latest_version(D.revenue(spark, root))
    return latest.select("oms_order_id", "row_id", "forecast_version", "forecast_version_year")


def _fact(spark: SparkSession, root: str) -> DataFrame:
    return O.order_fact(D.placed_orders(spark, root), D.revenue(spark, root), SINCE, MODELS)


def order_fact(spark: SparkSession, root: str) -> DataFrame:
    return _fact(spark, root).withColumns({c: F.round(c, 4) for c in MONEY}).drop("order_type", "vehicle_generation")


def monthly_orders(spark: SparkSession, root: str) -> DataFrame:
    return O.period_rollup(_fact(spark, root), "month")


def weekly_orders(spark: SparkSession, root: str) -> DataFrame:
    return O.period_rollup(_fact(spark, root), "week")


def event_rollup(spark: SparkSession, root: str) -> DataFrame:
    """The same roll-up idea on the event table: distinct users and mean value per week and type."""
    events = spark.read.parquet(f"{root}/events.parquet")
    return events.groupBy(F.trunc("ts", "week").alias("week"), "event_type").agg(
        F.count_distinct("user_id").alias("users"), F.bround(F.avg("value"), 2).alias("avg_value")
    )


def marketing_row_totals(spark: SparkSession, root: str) -> DataFrame:
    return O.row_totals(D.marketing_daily(spark, root)).select("date_pt", *O.NAME_PATTERNS)


def marketing_monthly(spark: SparkSession, root: str) -> DataFrame:
    return O.monthly_marketing(D.marketing_daily(spark, root))


def marketing_monthly_clean(spark: SparkSession, root: str) -> DataFrame:
    return O.monthly_marketing(D.marketing_daily(spark, root), exclude_totals=True)


def _input(spark: SparkSession, root: str) -> DataFrame:
    monthly = O.monthly_marketing(D.marketing_daily(spark, root))
    # One row per month: written once, read by several small model passes.
    return materialize(O.model_input(O.period_rollup(_fact(spark, root)), monthly))


def model_input(spark: SparkSession, root: str) -> DataFrame:
    return _input(spark, root)


def lag_features(spark: SparkSession, root: str) -> DataFrame:
    return O.lag_features(_input(spark, root), LAGGED, 3)


def correlation(spark: SparkSession, root: str) -> DataFrame:
    c = M.correlate(O.period_rollup(_fact(spark, root)), X, Y)
    return c.select(F.round("r", 6).alias("r"), "n", F.round("t", 6).alias("t"))


def correlation_p_value(spark: SparkSession, root: str) -> DataFrame:
    return M.correlate(O.period_rollup(_fact(spark, root)), X, Y)


def correlation_matrix(spark: SparkSession, root: str) -> DataFrame:
    return M.correlation_matrix(_input(spark, root), [Y, *PREDICTORS]).withColumn("r", F.round("r", 6))


def simple_ols(spark: SparkSession, root: str) -> DataFrame:
    fit = M.simple_ols(_input(spark, root), X, Y)
    return fit.select("n", *[F.round(c, 6).alias(c) for c in ("intercept", "slope", "slope_se", "t", "r2", "adj_r2")])


def residuals(spark: SparkSession, root: str) -> DataFrame:
    res = M.residuals(_input(spark, root), Y, [X], ["order_month"])
    return res.select("order_month", F.col(Y).cast("long").alias(Y), F.round("fitted", 5).alias("fitted"),
                      F.round("residual", 5).alias("residual"))


def fit_diagnostics(spark: SparkSession, root: str) -> DataFrame:
    d = M.fit_diagnostics(_input(spark, root), Y, [X], "order_month")
    return d.filter("statistic not in ('f_p_value', 'condition_number')").withColumn("value", F.round("value", 4))


def multiple_ols(spark: SparkSession, root: str) -> DataFrame:
    return M.multiple_ols(_input(spark, root), Y, PREDICTORS)


def multiple_ols_diagnostics(spark: SparkSession, root: str) -> DataFrame:
    return M.fit_diagnostics(_input(spark, root), Y, PREDICTORS, "order_month")


def lasso_select(spark: SparkSession, root: str) -> DataFrame:
    return M.lasso_select(_input(spark, root), Y, PREDICTORS, alpha=2.0)


def lasso_refit(spark: SparkSession, root: str) -> DataFrame:
    df = _input(spark, root)
    table = M.selected_ols(df, Y, PREDICTORS, alpha=2.0)
    return table if table is not None else M.multiple_ols(df, Y, PREDICTORS).limit(0)


def backward_elimination(spark: SparkSession, root: str) -> DataFrame:
    return M.backward_elimination(_input(spark, root), Y, PREDICTORS)


def scenario_forecast(spark: SparkSession, root: str) -> DataFrame:
    """The worked equation applied to every month's discount and the spend of the month before."""
    lagged = O.lag_features(_input(spark, root), ["total_spend"], 1).withColumn("is_holiday", O.holiday_flag())
    score = M.linear_score(1850.0, {X: 0.21, "total_spend_lag_1": 0.04, "is_holiday": 500.0})
    return lagged.select("order_month", F.round(score, 4).alias("predicted_orders"))


def backtest_mae(spark: SparkSession, root: str) -> DataFrame:
    res = M.residuals(_input(spark, root), Y, [X], ["order_month"])
    mae = M.mean_absolute_error(res, Y, "fitted", F.year("order_month"))
    return mae.withColumn("mae", F.round("mae", 5))


def rolling_backtest(spark: SparkSession, root: str) -> DataFrame:
    """How the error of the discount line grows with the months ahead."""
    drift = M.error_drift(M.rolling_backtest(_input(spark, root), "order_month", Y, X, min_train=24, horizon=6))
    return drift.select("ahead", "n", *[F.round(c, 4).alias(c) for c in ("mae", "bias")])


def prediction_interval(spark: SparkSession, root: str) -> DataFrame:
    df = _input(spark, root)
    bounds = M.prediction_interval(df, df, Y, [X])
    return bounds.select("order_month", *[F.round(c, 4).alias(c) for c in ("fitted", "leverage", "lower", "upper")])


def two_stage_orders(spark: SparkSession, root: str) -> DataFrame:
    """Leads follow from spend, orders from the leads that spend explains."""
    df = _input(spark, root).dropna(subset=["total_spend", "total_leads", Y])
    scored = M.two_stage(df, Y, {"total_leads": ["total_spend"]}).transform(df.withColumns({"_total_leads": F.lit(0.0), f"_{Y}": F.lit(0.0)}))
    return scored.select("order_month", F.round("total_leads_fitted", 3).alias("leads_fitted"), F.round("fitted", 3).alias("fitted"))


def stepwise_selection(spark: SparkSession, root: str) -> DataFrame:
    df = _input(spark, root)
    table = M.stepwise(df, Y, PREDICTORS, enter=0.15, leave=0.2)
    return table if table is not None else M.multiple_ols(df, Y, PREDICTORS).limit(0)


_PLACE = ("case when forecast_version is null then 0 when forecast_version = '12+0' then 1 when forecast_version = '9+3' then 2 "
          "when forecast_version = '6+6' then 3 when forecast_version = '3+9' then 4 when forecast_version = '0+12' then 5 else 6 end")
_ORDER = f"(forecast_version_year is not null), forecast_version_year desc nulls last, {_PLACE}"
_SUMS = {
    "total_spend": "coalesce(spend_search,0)+coalesce(spend_social,0)",
    "total_clicks": "clicks_search+clicks_social",
    "total_impressions": "coalesce(impressions_search,0)",
    "total_drives": "drives_demo+drives_total",
    "total_leads": "leads_web+coalesce(leads_total,0)",
}
_REST = {"email_opens": "opens_email", "foot_traffic": "foot_traffic", "web_traffic": "web_traffic_total", "order_total": "orders_total"}


def _monthly_sql(sums: dict[str, str]) -> str:
    cols = ", ".join(f"cast(sum({e}) as bigint) as {n}" for n, e in (sums | _REST).items())
    return f"select cast(date_trunc('month', date_pt) as date) as month, {cols} from marketing_daily group by 1"


_STEPS = {
    "latest": f"""select * from (select *, row_number() over (partition by oms_order_id order by {_ORDER}, row_id) as rn from revenue) where rn = 1""",
    "fact": f"""select p.order_id, p.order_date, p.model_powertrain, coalesce(p.payment_type,'Cash') as payment_type, p.country,
  cast(date_trunc('month', order_date) as date) as order_month, cast(date_trunc('quarter', order_date) as date) as order_quarter,
  cast(date_trunc('week', order_date) as date) as order_week,
  revenue, base_price, options_price, total_price, total_discount, referral_discount, price_adjustments,
  lease_down_payment_credit, lease_subvention, apr_subvention from placed_orders p left join (
  select oms_order_id, coalesce(revenue,0) as revenue, coalesce(base_price,0) as base_price, coalesce(options,0) as options_price,
  coalesce(base_price + options,0) as total_price, coalesce(abs(total_discount),0) as total_discount,
  coalesce(referral_discount,0) as referral_discount, coalesce(price_adjustments,0) as price_adjustments,
  coalesce(lease_down_payment_credit,0) as lease_down_payment_credit, coalesce(lease_subvention,0) as lease_subvention,
  coalesce(apr_subvention,0) as apr_subvention from latest) l on l.oms_order_id = p.order_id
  where order_type = 'Order' and vehicle_generation = 'GEN-2' and order_date >= date '{SINCE}'
  and model_powertrain in ({', '.join(f"'{m}'" for m in MODELS)})""",
    "monthly": "select order_month, count(distinct order_id) as total_orders, round_even(avg(total_discount), 0) as avg_total_discount from fact group by 1",
    "marketing": _monthly_sql(_SUMS),
    "input": """select order_month, total_orders, avg_total_discount, total_spend, total_clicks, total_drives, total_leads,
  email_opens, foot_traffic from monthly left join marketing on order_month = month""",
    "line": f"select regr_slope({Y}, {X}) as b, regr_intercept({Y}, {X}) as a, regr_r2({Y}, {X}) as r2, count(*) as n, regr_sxx({Y}, {X}) as sxx, regr_syy({Y}, {X}) as syy from input",
    "res": f"select order_month, {Y}, a + b * {X} as fitted, {Y} - (a + b * {X}) as e from input, line",
    "shape": """select count(*)::double as n, sum(e*e) as sse, avg(e) as m, sum((e-step)*(e-step)) as dwn,
  avg((e-mean)*(e-mean)*(e-mean)) / pow(avg((e-mean)*(e-mean)), 1.5) as skew,
  avg(pow(e-mean,4)) / pow(avg((e-mean)*(e-mean)), 2) as kurt
  from (select *, lag(e) over (order by order_month) as step, avg(e) over () as mean from res)""",
    "fit": """select s.*, r2, 1 as k, -n/2*(ln(2*pi())+ln(sse/n)+1) as ll, n/6*(skew*skew+(kurt-3)*(kurt-3)/4) as jb
  from (select shape.*, r2 from shape, line) s""",
}


def _sql(body: str, more: dict[str, str] | None = None) -> str:
    return with_views("revenue placed_orders marketing_daily", body, _STEPS | (more or {}))


def _matrix_sql() -> str:
    cols = [Y, *PREDICTORS]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    rows = " union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}::double, {b}::double) as r from input" for a, b in pairs)
    return _sql(f"select a, b, round(r, 6) as r, abs(r) > 0.7 as high from ({rows})")


_STATS = {
    "n": "n", "r2": "r2", "adj_r2": "1-(1-r2)*(n-1)/(n-2)", "f": "r2/((1-r2)/(n-2))", "log_likelihood": "ll",
    "aic": "4-2*ll", "bic": "2*ln(n)-2*ll", "durbin_watson": "dwn/sse", "jarque_bera": "jb",
    "jarque_bera_p_value": "exp(-jb/2)", "skew": "skew", "kurtosis": "kurt",
}
_LAGS = ", ".join(f"lag({c}, 3) over (order by order_month) as {c}_lag_3" for c in LAGGED)
_KNOWN = " and ".join(f"{c} is not null" for c in [*O.MODEL_COLUMNS, *[f"{c}_lag_3" for c in LAGGED]])

QUERIES = {
    "version_ranking": (version_ranking, with_views("revenue", f"""
select *, row_number() over (order by {_ORDER}) as forecast_version_rank from (
  select distinct forecast_version, forecast_version_year from revenue)""")),
    "rows_per_version": (rows_per_version, with_views("revenue", f"""
select forecast_version_rank, count(*) as n, count(r.forecast_version) as named from revenue r join (
  select *, row_number() over (order by {_ORDER}) as forecast_version_rank from (
  select distinct forecast_version, forecast_version_year from revenue)) v on r.forecast_version is not distinct from v.forecast_version
  and r.forecast_version_year is not distinct from v.forecast_version_year group by 1""")),
    "latest_version": (latest_version, _sql("select oms_order_id, row_id, forecast_version, forecast_version_year from latest")),
    "order_fact": (order_fact, _sql("select * replace (" + ", ".join(
        f"round({c},4) as {c}" for c in MONEY) + ") from fact")),
    "period_rollup_month": (monthly_orders, _sql("select * from monthly")),
    "period_rollup_week": (weekly_orders, _sql("select order_week, count(distinct order_id) as total_orders, round_even(avg(total_discount), 0) as avg_total_discount from fact group by 1")),
    "event_rollup": (event_rollup, """select cast(date_trunc('week', ts) as date) as week, event_type, count(distinct user_id) as users,
  round_even(avg(value), 2) as avg_value from events group by 1,2"""),
    "marketing_row_totals": (marketing_row_totals, with_views("marketing_daily", "select date_pt, " + ", ".join(
        f"cast({e} as bigint) as {n}" for n, e in _SUMS.items()) + " from marketing_daily")),
    "marketing_monthly": (marketing_monthly, _sql("select * from marketing")),
    "marketing_monthly_clean": (marketing_monthly_clean, with_views("marketing_daily", _monthly_sql(
        _SUMS | {"total_drives": "drives_demo", "total_leads": "leads_web"}))),
    "model_input": (model_input, _sql("select * from input")),
    "lag_features": (lag_features, _sql(f"select * from (select *, {_LAGS} from input) where {_KNOWN}")),
    "correlation": (correlation, _sql("""select round(r,6) as r, n, round(r*sqrt((n-2)/(1-r*r)),6) as t from (
  select corr(avg_total_discount, total_orders) as r, count(*) as n from monthly)""")),
    "correlation_p_value": (correlation_p_value, None),
    "correlation_matrix": (correlation_matrix, _matrix_sql()),
    "simple_ols": (simple_ols, _sql("""select n, round(a,6) as intercept, round(b,6) as slope, round(se,6) as slope_se, round(b/se,6) as t,
  round(r2,6) as r2, round(1-(1-r2)*(n-1)/(n-2),6) as adj_r2 from (select *, sqrt((1-r2)*syy/(n-2)/sxx) as se from line)""")),
    "residuals": (residuals, _sql(f"select order_month, {Y}, round(fitted,5) as fitted, round(e,5) as residual from res")),
    "fit_diagnostics": (fit_diagnostics, _sql(" union all ".join(
        f"select '{n}' as statistic, round({e},4)::double as value from fit" for n, e in _STATS.items()))),
    "multiple_ols": (multiple_ols, None),
    "multiple_ols_diagnostics": (multiple_ols_diagnostics, None),
    "lasso_select": (lasso_select, None),
    "lasso_refit": (lasso_refit, None),
    "backward_elimination": (backward_elimination, None),
    "scenario_forecast": (scenario_forecast, _sql(f"""select order_month, round(1850.0 + 0.21 * {X} + 0.04 * prev
  + 500.0 * (case when month(order_month) in (10,11,12) then 1 else 0 end), 4)::double as predicted_orders
from (select *, lag(total_spend) over (order by order_month) as prev from input) where prev is not null and total_spend is not null""")),
    "rolling_backtest": (rolling_backtest, _sql(f"""
select cast(ahead as int) as ahead, count(*) as n, round(avg(abs(e)), 4) as mae, round(avg(e), 4) as bias from (
  select ahead, p.{Y} - (o.a + o.b * p.{X}) as e from placed p, (select unnest(generate_series(1, 6)) as ahead) h, origins o
  where o.origin = p.k - ahead) group by 1""", {
        "placed": f"select {X}::double as {X}, {Y}::double as {Y}, row_number() over (order by order_month) as k from input",
        "origins": f"""select origin, regr_slope({Y}, {X}) as b, regr_intercept({Y}, {X}) as a from (
  select unnest(generate_series(24, (select max(k) - 1 from placed))) as origin) join placed on k <= origin group by 1"""})),
    "prediction_interval": (prediction_interval, _sql(f"""
select order_month, round(fitted, 4) as fitted, round(h, 4) as leverage, round(fitted - w, 4) as lower, round(fitted + w, 4) as upper
from (select *, 1.959963984540054::double * sqrt((1 - r2) * syy / (n - 2) * (1 + h)) as w from (
  select order_month, a + b * {X} as fitted, 1.0::double / n + pow({X} - mx, 2) / sxx as h, r2, syy, n
  from input, line, (select avg({X}) as mx from input)))""")),
    "two_stage_orders": (two_stage_orders, _sql(f"""
select order_month, round(l, 3) as leads_fitted, round(c + d * l, 3) as fitted from stage_one, (
  select regr_slope({Y}, l) as d, regr_intercept({Y}, l) as c from stage_one)""", {
        "known": f"select * from input where total_spend is not null and total_leads is not null and {Y} is not null",
        "stage_one": f"""select order_month, {Y}, a1 + b1 * total_spend as l from known, (
  select regr_slope(total_leads, total_spend) as b1, regr_intercept(total_leads, total_spend) as a1 from known)"""})),
    "stepwise_selection": (stepwise_selection, None),
    "backtest_mae": (backtest_mae, _sql("select cast(year(order_month) as int) as period, round(avg(abs(e)),5) as mae, count(*) as n from res group by 1")),
}
