"""The same queries as plain SQL over whole series, for the comparison run."""

from __future__ import annotations

SQL: dict[str, str] = {}


def sig(x: str, digits: int = 8) -> str:
    p = f"({digits - 1} - cast(floor(log10(abs({x}))) as int))"
    return (f"case when {x} is null then null when abs({x}) < 1e-9 then 0.0::double when {p} >= 0 "
            f"then floor({x} * pow(10.0::double, {p}) + 0.5031::double) / pow(10.0::double, {p}) "
            f"else floor({x} / pow(10.0::double, -{p}) + 0.5031::double) * pow(10.0::double, -{p}) end")


def sel(*cols: str, digits: int = 8, **special: int) -> str:
    """Column list; a name starting with ``~`` is rounded."""
    out = []
    for c in cols:
        if c.startswith("~"):
            n = c[1:]
            out.append(f"{sig(n, special.get(n, digits))} as {n}")
        else:
            out.append(c)
    return ", ".join(out)


def interp(name: str, src: str, col: str, out: str) -> str:
    """Time interpolation of ``col`` of ``src`` as two CTEs."""
    up = "over (partition by k order by i rows between unbounded preceding and current row)"
    dn = "over (partition by k order by i rows between current row and unbounded following)"
    return f"""{name}_n as (select *,
        last_value(case when {col} is not null then t end ignore nulls) {up} pt, last_value({col} ignore nulls) {up} px,
        first_value(case when {col} is not null then t end ignore nulls) {dn} nt, first_value({col} ignore nulls) {dn} nx
        from {src}),
    {name} as (select * exclude (pt, px, nt, nx), case when {col} is not null then {col} when px is null then null when nx is null then px
        else px + (nx - px) * ((epoch_us(t) - epoch_us(pt))::double / (epoch_us(nt) - epoch_us(pt))) end as {out} from {name}_n)"""


HOURLY = """raw as (select event_type k, date_trunc('hour', ts) t, sum(value) v from events group by 1, 2),
    ends as (select k, min(t) a, max(t) z from raw group by k),
    grid as (select k, unnest(generate_series(a, z, interval 1 hour)) t from ends),
    hourly as (select g.k, g.t, raw.v, row_number() over (partition by g.k order by g.t) - 1 i
               from grid g left join raw on raw.k = g.k and raw.t = g.t)"""
FENCES = """fences as (select k, quantile_cont(v_filled, 0.25) q1, quantile_cont(v_filled, 0.75) q3 from filled group by k),
    bounds as (select k, q1, q3, q3 - q1 iqr, q1 - 1.5 * (q3 - q1) lower_bound, q3 + 1.5 * (q3 - q1) upper_bound from fences)"""
STEPS = f"""{HOURLY}, {interp('filled', 'hourly', 'v', 'v_filled')}, {FENCES},
    masked as (select f.*, q1, q3, iqr, lower_bound, upper_bound, coalesce(v_filled between lower_bound and upper_bound, false) kept,
               case when v_filled between lower_bound and upper_bound then v_filled end v_masked from filled f join bounds using (k)),
    {interp('steps', 'masked', 'v_masked', 'v_clean')}"""
SERIES = f"""{STEPS}, series as (select k, t, v_clean v, row_number() over (partition by k order by i) - 1 i from steps where v_clean is not null)"""
DAILY = """daily_raw as (select o_orderpriority k, o_orderdate t, sum(o_totalprice) v from orders group by 1, 2),
    daily as (select k, t, v, row_number() over (partition by k order by t, v) - 1 i from daily_raw)"""
SUPPLIER = """supplier_raw as (select cast(l_suppkey as varchar) k, l_shipdate t, sum(l_quantity) v from lineitem group by 1, 2),
    supplier as (select k, t, v, row_number() over (partition by k order by t, v) - 1 i from supplier_raw)"""

# --- sources, profile, cleaning -------------------------------------------------------------

_ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
           "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
_missing = {c: f"{c} is null" + (f" or isnan({c})" if t == "double" else "") for c, t in _ORDERS.items()}
SQL["import_profile"] = " union all ".join(f"""select '{c}' as "column", '{t}' as data_type, n_missing, {sig('missing_pct')} as missing_pct,
    n_rows, 6::bigint as n_columns, first_time, last_time, missing_total, {sig('completeness_pct')} as completeness_pct
    from (select count(*) filter (where {_missing[c]}) n_missing, (count(*) filter (where {_missing[c]})) * 100.0::double / count(*) missing_pct,
          count(*) n_rows, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') first_time, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') last_time,
          {' + '.join(f'count(*) filter (where {m})' for m in _missing.values())} missing_total,
          (count(*) * 6 - ({' + '.join(f'count(*) filter (where {m})' for m in _missing.values())})) * 100.0::double / (count(*) * 6) completeness_pct
          from orders)""" for c, t in _ORDERS.items())
SQL["date_report"] = """select count(*) n_rows, count(t) n_dated, count(*) - count(t) n_bad_dates from (
    select try_cast(case when o_orderpriority = '5-LOW' then 'day ' || cast(o_orderdate as varchar) else cast(o_orderdate as varchar) end as timestamp) t from orders)"""
SQL["preview_rows"] = f"with {HOURLY} select {sel('k', 't', '~v')} from hourly order by k, t, v limit 5"
SQL["hourly_panel"] = f"with {HOURLY} select {sel('k', 't', 'i', '~v')} from hourly"
SQL["supplier_panel"] = f"with {SUPPLIER} select {sel('k', 't', 'i', '~v')} from supplier"
SQL["wide_to_long"] = f"""with l as (select 'l_quantity' k, l_shipdate t, sum(l_quantity) v from lineitem group by 2
    union all select 'l_extendedprice', l_shipdate, sum(l_extendedprice) from lineitem group by 2)
    select k, t, row_number() over (partition by k order by t) - 1 as i, {sel('~v')} from l"""
SQL["interpolate_time"] = f"with {HOURLY}, {interp('filled', 'hourly', 'v', 'v_filled')} select k, t, {sig('v_filled')} as v from filled"
SQL["iqr_fences"] = f"with {HOURLY}, {interp('filled', 'hourly', 'v', 'v_filled')}, {FENCES} select {sel('k', '~q1', '~q3', '~iqr', '~lower_bound', '~upper_bound')} from bounds"
SQL["iqr_clean"] = f"with {STEPS} select {sel('k', 't', '~v_filled', 'kept', '~v_clean')} from steps"
SQL["missing_report"] = f"""with {STEPS}, r as (select k, count(*) n_rows, count(*) - count(v) n_before, count(*) - count(v_filled) n_after from steps group by k)
    select k, n_rows, n_before, {sig('(n_before * 100.0::double / n_rows)')} as before_pct, n_after,
    {sig('(n_after * 100.0::double / n_rows)')} as after_pct, n_before - n_after as n_interpolated from r"""
SQL["outlier_report"] = f"""with {STEPS}, r as (select k, q1, q3, iqr, lower_bound, upper_bound, count(*) filter (where v_filled is not null and not kept) n_outliers,
    count(*) - count(v_filled) n_null, count(*) n from steps group by k, q1, q3, iqr, lower_bound, upper_bound)
    select {sel('k', '~q1', '~q3', '~iqr', '~lower_bound', '~upper_bound')}, n_outliers, n_null, {sig('(n_outliers * 100.0::double / n)')} as removal_pct from r"""
SQL["clean_summary"] = f"with {STEPS} select k, count(*) n_rows, count(*) - count(v_clean) n_missing, min(t) first_t, max(t) last_t from steps group by k"

# --- statistics -----------------------------------------------------------------------------


def describe(src: str) -> str:
    return f"""d as (select k, count(v) n, avg(v) mean, quantile_cont(v, 0.5) median, stddev_samp(v) std, var_samp(v) variance, min(v) "min", max(v) "max",
        quantile_cont(v, 0.25) q25, quantile_cont(v, 0.5) q50, quantile_cont(v, 0.75) q75 from {src} group by k),
    m as (select k, avg(pow(v - mean, 2)) m2, avg(pow(v - mean, 3)) m3, avg(pow(v - mean, 4)) m4 from {src} join d using (k) group by k),
    dm as (select d.*, case when m2 > 0 then m3 / pow(m2, 1.5) end skewness, case when m2 > 0 then m4 / (m2 * m2) - 3 end kurtosis from d join m using (k))"""


_DESC = sel("k", "n", "~mean", "~median", "~std", "~variance", '~"min"', '~"max"', "~q25", "~q50", "~q75", "~skewness", "~kurtosis")
SQL["describe_series"] = f"with {SERIES}, {describe('series')} select {_DESC} from dm"
SQL["describe_suppliers"] = f"with {SUPPLIER}, {describe('supplier')} select {_DESC} from dm"
SQL["quantiles_bracketed"] = f"""with {SUPPLIER}, q as (select k, quantile_cont(v, 0.05) q05, quantile_cont(v, 0.5) q50, quantile_cont(v, 0.95) q95 from supplier group by k)
    select {sel('k', '~q05', '~q50', '~q95')} from q"""
SQL["quantiles_radix"] = SQL["quantiles_bracketed"]


def acf(src: str, max_lag: int, x: str = "v", keys: str = "k") -> str:
    """Autocorrelations of ``x`` for lags 0..max_lag by a join on position."""
    on = " and ".join(f"a.{c} = b.{c}" for c in keys.split(", "))
    ak = ", ".join(f"a.{c}" for c in keys.split(", "))
    return f"""cen as (select {keys}, i, {x} - avg({x}) over (partition by {keys}) c, count(*) over (partition by {keys}) n from {src}),
    lag_l as (select unnest(range({max_lag + 1})) lag),
    prod as (select {ak}, any_value(a.n) n, lag_l.lag, coalesce(sum(a.c * b.c), 0) g from cen a cross join lag_l
             left join cen b on {on} and b.i = a.i - lag_l.lag group by {ak}, lag_l.lag),
    acf as (select {keys}, n, lag, g, g / max(case when lag = 0 then g end) over (partition by {keys}) acf from prod where lag < n)"""


SQL["autocorrelation"] = f"with {SERIES}, {acf('series', 40)} select {sel('k', 'n', '~acf', digits=7)}, cast(lag as int) as lag from acf"
SQL["partial_autocorrelation"] = f"""with recursive {SERIES}, {acf('series', 24)},
    r as (select k, list(acf order by lag) r from acf group by k),
    dl(k, r, m, phi, p) as (
        select k, r, 1, [r[2]], r[2] from r
        union all
        select k, r, m + 1, list_append(list_transform(phi, lambda x, j: x - q * phi[m + 1 - j]), q), q from (
            select k, r, m, phi, (r[m + 2] - list_sum(list_transform(phi, lambda x, j: x * r[m + 2 - j]))) /
                   (1 - list_sum(list_transform(phi, lambda x, j: x * r[j + 1]))) q from dl where m < 24))
    select k, cast(m as int) as lag, {sig('p', 6)} as pacf from dl"""


def decomposition(src: str) -> str:
    return f"""ma as (select k, t, i, v, count(*) over (partition by k) n, case when count(v) over (partition by k order by i rows between 12 preceding and 12 following) = 25 then
        (sum(v) over (partition by k order by i rows between 12 preceding and 11 following)
         + sum(v) over (partition by k order by i rows between 11 preceding and 12 following)) / 48 end trend from {src}),
    ph as (select k, i % 24 phase, avg(v - trend) m from ma group by 1, 2),
    sea as (select k, phase, m - avg(m) over (partition by k) seasonal from ph),
    parts as (select ma.k, t, i, v, n, trend, seasonal, v - trend - seasonal remainder from ma join sea on sea.k = ma.k and sea.phase = ma.i % 24)"""


SQL["decompose_24"] = f"with {SERIES}, {decomposition('series')} select {sel('k', 't', '~v', '~trend', '~seasonal', '~remainder', digits=7)} from parts"
SQL["seasonality"] = f"""with {SERIES}, {decomposition('series')},
    s as (select k, count(*) n, var_pop(remainder) vr, var_pop(seasonal) vs, var_pop(trend) vt from parts group by k),
    s2 as (select k, n, 1 - vr / (vs + vr + 1e-9) strength, 1 - vr / (vt + vr + 1e-9) trend_strength from s)
    select k, n, strength > 0.05 as has_seasonality, 24::bigint as period, {sel('~strength', '~trend_strength')}, least(168, n - 1)::bigint as acf_max_lag from s2"""
SQL["trend_ols"] = f"""with {SERIES}, l as (select k, count(v) n, regr_slope(v, i) slope, regr_intercept(v, i) "intercept", regr_r2(v, i) r_squared,
    min(v) min_value, max(v) max_value, arg_max(v, i) - arg_min(v, i) total_change from series group by k)
    select {sel('k', 'n', '~slope', '~"intercept"', '~r_squared', '~min_value', '~max_value', '~total_change', digits=7)} from l"""
# two-sided t tail by Simpson's rule over theta = atan(t / sqrt(df)), where the density is cos(theta)^(df - 1)
_simpson = "list_sum(list_transform(range(8001), lambda j: (case when j in (0, 8000) then 1 when j % 2 = 1 then 4 else 2 end) * pow(cos({a} + {w} * j / 8000), n - 3))) * {w}"
SQL["trend_test"] = f"""with {DAILY}, l as (select k, count(v) n, regr_slope(v, i) slope, regr_r2(v, i) r2 from daily group by k),
    th as (select *, atan(sqrt(r2 / (1 - r2))) th0, pi() / 2 - atan(sqrt(r2 / (1 - r2))) w from l),
    p as (select k, slope, {_simpson.format(a='th0', w='w')} upper, {_simpson.format(a='0', w='pi() / 2')} whole from th),
    q as (select k, slope, upper / whole p_value from p)
    select k, {sel('~slope', '~p_value', digits=6)}, p_value < 0.05 as significant,
    case when abs(slope) < 0.001 then 'stationary' when slope >= 0.001 then 'rising' else 'falling' end as trend_type,
    case when slope > 0 then 'up' when slope < 0 then 'down' else 'flat' end as direction from q"""

# --- windows and splits ---------------------------------------------------------------------

SQL["moving_average_full"] = f"""with {HOURLY}, w as (select k, t, case when count(v) over f = 7 then avg(v) over f end ma from hourly
    window f as (partition by k order by i rows between 6 preceding and current row)) select {sel('k', 't', '~ma')} from w"""
SQL["moving_average_partial"] = f"""with {SERIES}, w as (select k, t, avg(v) over (partition by k order by i rows between 23 preceding and current row) ma from series)
    select {sel('k', 't', '~ma')} from w"""
SQL["weighted_moving_average"] = f"""with {SERIES}, w as (select k, t, (v * 3 + lag(v, 1) over f * 2 + lag(v, 2) over f) / 6 wma from series
    window f as (partition by k order by i)) select {sel('k', 't', '~wma')} from w"""
SQL["train_test_split"] = f"""with {SERIES}, s as (select *, count(*) over (partition by k) n from series)
    select {sel('k', 't', '~v')}, case when i < greatest(1, floor(n * 0.8::double)) then 'train' else 'test' end as part from s"""
SQL["split_boundary"] = f"""with {SERIES}, s as (select *, greatest(1, floor(count(*) over (partition by k) * 0.7::double)) tn from series)
    select k, max(case when i < tn then t end) as split_t, count(*) filter (where i < tn) as n_train, count(*) filter (where i >= tn) as n_test from s group by k"""
SQL["last_values"] = f"""with {SERIES}, s as (select *, count(*) over (partition by k) n from series)
    select k, {sig('arg_max(v, i)')} as last_v, max(t) as last_t, {sig('avg(v)')} as last_mean, any_value(n) as n from s where i >= n - 7 group by k"""

# --- stationarity ---------------------------------------------------------------------------


def kpss(src: str) -> str:
    """KPSS statistic and automatic lag per series, with all products by a join on position."""
    return f"""kc as (select k, i, v - avg(v) over (partition by k) e, count(*) over (partition by k) n from {src}),
    kl as (select unnest(range(0, 121)) lag),
    kg as (select a.k, any_value(a.n) n, lag, coalesce(sum(a.e * b.e), 0) g from kc a cross join kl left join kc b on b.k = a.k and b.i = a.i - lag group by a.k, lag),
    ks as (select k, any_value(n) n, sum(case when lag = 0 then g when lag <= floor(pow(n, 2.0 / 9)) then 2 * g else 0 end) / any_value(n) s0,
           sum(case when lag between 1 and floor(pow(n, 2.0 / 9)) then 2 * lag * g else 0 end) / any_value(n) s1 from kg group by k),
    ka as (select k, n, least(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) lags from ks),
    kv as (select kg.k, any_value(lags) lags, sum(case when lag = 0 then g when lag <= lags then 2 * (1 - lag / (lags + 1)) * g else 0 end) / any_value(kg.n) lrv from kg join ka using (k) group by kg.k),
    kr as (select k, n, sum(e) over (partition by k order by i) s from kc),
    kq as (select k, any_value(n) n, sum(s * s) q from kr group by k),
    kpss0 as (select kq.k, kq.n, q / (kq.n::double * kq.n) / lrv statistic, cast(lags as bigint) used_lag from kq join kv using (k)),
    kpss as (select *, case when statistic <= 0.347 then 0.1 when statistic <= 0.463 then 0.1 + (statistic - 0.347) * ((0.05 - 0.1) / (0.463 - 0.347))
        when statistic <= 0.574 then 0.05 + (statistic - 0.463) * ((0.025 - 0.05) / (0.574 - 0.463))
        when statistic <= 0.739 then 0.025 + (statistic - 0.574) * ((0.01 - 0.025) / (0.739 - 0.574)) else 0.01 end p_value from kpss0)"""


def adf(src: str) -> str:
    """ADF by Gaussian elimination on nested lists; the recursion walks the pivots (needs WITH RECURSIVE)."""
    norm = ("(case when {x} < -8 then 0.0 when {x} > 8 then 1.0 else 0.5 + exp(-{x} * {x} / 2) / sqrt(2 * pi()) * "
            "list_sum(list_transform(range(0, 150), lambda j: {x} * exp(j * ln({x} * {x} + 1e-300) - list_sum(list_transform(range(1, j + 1), lambda q: ln(2 * q + 1)))))) end)")
    small = "(2.1659 + 1.4412 * statistic + 0.038269 * statistic * statistic)"
    large = "(1.7339 + 0.93202 * statistic - 0.12745 * statistic * statistic - 0.010368 * statistic * statistic * statistic)"
    return f"""ax as (select k, i, v - avg(v) over (partition by k) x, count(*) over (partition by k) n from {src}),
    am as (select *, cast(least(n // 2 - 2, ceil(12.0 * pow(n / 100.0, 0.25))) as bigint) ml from ax),
    ad as (select k, i, n, ml, lag(x) over w x, x - lag(x) over w d from am window w as (partition by k order by i)),
    ar as (select k, i, n, ml, d, x, array_agg(d) over (partition by k order by i rows between 60 preceding and 1 preceding) prior from ad),
    -- columns: constant, level, lagged differences 1..ml, difference
    az as (select k, i, n, ml, [1.0, x] || list_transform(range(1, ml + 1), lambda j: prior[len(prior) + 1 - j]) || [d] z from ar where i > ml),
    ag0 as (select k, any_value(ml) ml, any_value(n) n, p, q, sum(z[p] * z[q]) g from az, (select unnest(range(1, 64)) p) pp, (select unnest(range(1, 64)) q) qq
            where p <= ml + 3 and q <= ml + 3 group by k, p, q),
    ag1 as (select k, any_value(ml) ml, any_value(n) n, p, list(g order by q) r from ag0 group by k, p),
    ag as (select k, any_value(ml) ml, any_value(n) n, list(r order by p) m from ag1 group by k),
    ae(k, ml, n, p, m) as (select k, ml, n, 0, m from ag union all
        select k, ml, n, p + 1, list_transform(m, lambda r, a: case when a <= p + 1 then r else list_transform(r, lambda c, b: c - r[p + 1] / m[p + 1][p + 1] * m[p + 1][b]) end)
        from ae where p < ml + 2),
    aic as (select k, n, ml, p - 2 lag, (n - 1 - ml) * ln(m[ml + 3][ml + 3] / (n - 1 - ml)) + 2 * p aic from ae where p >= 2),
    al as (select k, any_value(n) n, any_value(ml) ml, arg_min(lag, aic) best from aic group by k),
    -- second regression: constant, lagged differences 1..best, level, difference
    bz as (select ar.k, ar.i, al.n, best, [1.0] || list_transform(range(1, best + 1), lambda j: prior[len(prior) + 1 - j]) || [x, d] z from ar join al on al.k = ar.k where ar.i > best),
    bg0 as (select k, any_value(best) best, any_value(n) n, p, q, sum(z[p] * z[q]) g from bz, (select unnest(range(1, 64)) p) pp, (select unnest(range(1, 64)) q) qq
            where p <= best + 3 and q <= best + 3 group by k, p, q),
    bg1 as (select k, any_value(best) best, any_value(n) n, p, list(g order by q) r from bg0 group by k, p),
    bg as (select k, any_value(best) best, any_value(n) n, list(r order by p) m from bg1 group by k),
    be(k, best, n, p, m) as (select k, best, n, 0, m from bg union all
        select k, best, n, p + 1, list_transform(m, lambda r, a: case when a <= p + 1 then r else list_transform(r, lambda c, b: c - r[p + 1] / m[p + 1][p + 1] * m[p + 1][b]) end)
        from be where p < best + 1),
    bt as (select k, n, cast(best as bigint) used_lag, n - 1 - best nobs, m[best + 2][best + 2] xx, m[best + 2][best + 3] xy, m[best + 3][best + 3] yy from be where p = best + 1),
    adf0 as (select k, n, used_lag, nobs, xy / xx / sqrt((yy - xy * xy / xx) / (nobs - used_lag - 2) / xx) statistic from bt),
    adf as (select *, case when statistic > 2.74 then 1.0 when statistic < -18.83 then 0.0 when statistic <= -1.61 then {norm.format(x=small)} else {norm.format(x=large)} end p_value from adf0)"""


SQL["kpss_test"] = f"""with {DAILY}, {kpss('daily')} select k, n, {sel('~statistic', '~p_value', digits=6)}, used_lag,
    0.347::double as crit_10, 0.463::double as crit_5, 0.574::double as crit_2_5, 0.739::double as crit_1, 'ok' as status from kpss"""
SQL["adf_test"] = f"""with recursive {DAILY}, {adf('daily')}, c as (select *, -3.43035 - 6.5393 / nobs - 16.786 / pow(nobs, 2) - 79.433 / pow(nobs, 3) crit_1,
    -2.86154 - 2.8903 / nobs - 4.234 / pow(nobs, 2) - 40.040 / pow(nobs, 3) crit_5, -2.56677 - 1.5384 / nobs - 2.809 / pow(nobs, 2) crit_10 from adf)
    select k, n, {sel('~statistic', '~p_value', digits=6)}, used_lag, nobs, {sel('~crit_1', '~crit_5', '~crit_10', digits=6)}, 'ok' as status from c"""
SQL["stationarity_verdict"] = f"""with recursive {SERIES}, {adf('series')}, {kpss('series')}
    select k, 'ADF' as test, {sel('~statistic', '~p_value', digits=6)}, used_lag, nobs, 'ok' as status, p_value < 0.05 as stationary from adf
    union all select k, 'KPSS', {sel('~statistic', '~p_value', digits=6)}, used_lag, n, 'ok', p_value >= 0.05 from kpss"""

# --- models ---------------------------------------------------------------------------------

SMA7 = """sma as (select k, t, i, v, case when count(v) over f = 7 then avg(v) over f end fitted from series
    window f as (partition by k order by i rows between 6 preceding and current row))"""
LINE = """line as (select k, regr_slope(v, i) slope, regr_intercept(v, i) icpt, regr_r2(v, i) r2 from series group by k),
    lr as (select s.k, s.t, s.i, s.v, icpt + slope * s.i fitted from series s join line using (k))"""


def ses(src: str, alphas: str = "(0.2)", name: str = "ses") -> str:
    """Recursion from a zero start (c) and a unit start (b); row i holds the forecast of row i."""
    return f"""{name}_a(al) as (select unnest([{alphas.strip('()')}])::double),
    {name}_r(k, al, i, c, b) as (select k, al, 0::bigint, 0.0::double, 1.0::double from (select distinct k from {src}), {name}_a
        union all select r.k, r.al, r.i + 1, r.c + r.al * (s.v - r.c), (1 - r.al) * r.b from {name}_r r join {src} s on s.k = r.k and s.i = r.i),
    {name}_j as (select r.*, s.v, s.t from {name}_r r join {src} s on s.k = r.k and s.i = r.i),
    {name}_0 as (select k, al, count(*) n, sum((v - c) * b) / sum(b * b) l0 from {name}_j group by k, al),
    {name} as (select j.k, j.al, t, i, v, c + b * l0 fitted from {name}_j j join {name}_0 using (k, al)),
    {name}_f as (select z.k, z.al, n, l0 level0, r.c + r.b * l0 "level" from {name}_0 z join {name}_r r on r.k = z.k and r.al = z.al and r.i = z.n)"""


def holt(src: str, params: str = "(0.2, 0.1)", name: str = "holt") -> str:
    """Zero start (c), start (1, 0) (u) and start (0, 1) (w), each with level and trend."""
    return f"""{name}_a(al, be) as (select al::double, be::double from (values {params}) p(al, be)),
    {name}_r(k, al, be, i, cl, ct, ul, ut, wl, wt) as (
        select k, al, be, 0::bigint, 0.0::double, 0.0::double, 1.0::double, 0.0::double, 0.0::double, 1.0::double from (select distinct k from {src}), {name}_a
        union all select r.k, r.al, r.be, r.i + 1, cl + ct + al * (s.v - cl - ct), ct + al * be * (s.v - cl - ct),
            (ul + ut) * (1 - al), ut - al * be * (ul + ut), (wl + wt) * (1 - al), wt - al * be * (wl + wt)
        from {name}_r r join {src} s on s.k = r.k and s.i = r.i),
    {name}_j as (select r.*, s.v, s.t, s.v - cl - ct y, ul + ut g1, wl + wt g2 from {name}_r r join {src} s on s.k = r.k and s.i = r.i),
    {name}_s as (select k, al, be, count(*) n, sum(g1 * g1) a, sum(g1 * g2) b, sum(g2 * g2) d, sum(y * g1) p, sum(y * g2) q from {name}_j group by k, al, be),
    {name}_0 as (select k, al, be, n, (p * d - q * b) / (a * d - b * b) l0, (a * q - b * p) / (a * d - b * b) b0 from {name}_s),
    {name} as (select j.k, j.al, j.be, t, i, v, cl + ct + g1 * l0 + g2 * b0 fitted from {name}_j j join {name}_0 using (k, al, be)),
    {name}_f as (select z.k, z.al, z.be, n, l0 level0, b0 trend0, cl + ul * l0 + wl * b0 "level", ct + ut * l0 + wt * b0 trend
        from {name}_0 z join {name}_r r on r.k = z.k and r.al = z.al and r.be = z.be and r.i = z.n)"""


SQL["sma_fit"] = f"with {SERIES}, {SMA7} select {sel('k', 't', '~v', '~fitted')} from sma"
SQL["linear_fit"] = f"with {SERIES}, {LINE} select {sel('k', 't', '~v', '~fitted')} from lr"
SQL["ses_fit"] = f"""with recursive {SERIES}, {ses('series')}, e as (select k, sum((v - fitted) * (v - fitted)) sse from ses group by k)
    select k, n, {sel('~level0', '~"level"', '~sse', digits=7)} from ses_f join e using (k)"""
SQL["holt_fit"] = f"""with recursive {SERIES}, {holt('series')}, e as (select k, sum((v - fitted) * (v - fitted)) sse from holt group by k)
    select k, n, {sel('~level0', '~trend0', '~"level"', '~trend', '~sse', digits=7)} from holt_f join e using (k)"""
SQL["ses_fitted"] = f"with recursive {DAILY}, {ses('daily')} select {sel('k', 't', '~v', '~fitted', digits=7)} from ses"
SQL["holt_fitted"] = f"with recursive {DAILY}, {holt('daily')} select {sel('k', 't', '~v', '~fitted', digits=7)} from holt"


def hw(src: str, mul: bool, m: int = 24) -> str:
    """All candidates of the default grid; the season list is turned so that its first entry is the next one."""
    s, base = "r.s[1]", "(r.l + r.t)"
    f = f"{base} * {s}" if mul else f"{base} + {s}"
    lev = f"r.al * (x.v {'/' if mul else '-'} {s}) + (1 - r.al) * {base}"
    sea = f"r.ga * (x.v {'/' if mul else '-'} {base}) + (1 - r.ga) * {s}"
    return f"""hw_c as (select row_number() over () - 1 cand, al, be, ga from (select unnest([0.1, 0.3, 0.5, 0.7, 0.9])::double al) a, (select unnest([0.01, 0.1, 0.3])::double be) b,
        (select unnest([0.05, 0.2, 0.5])::double ga) c order by al, be, ga),
    hw_h as (select k, avg(v) filter (where i < {m}) l0, avg(v) filter (where i >= {m}) l1, list(v order by i) ys from {src} where i < {2 * m} group by k),
    hw_r(k, al, be, ga, i, l, t, s, sse, es, f) as (
        select k, al, be, ga, 0::bigint, l0, (l1 - l0) / {m}, list_transform(ys[1:{m}], lambda y: y {'/' if mul else '-'} l0), 0.0::double, 0.0::double, null::double from hw_h, hw_c
        union all select k, al, be, ga, i + 1, nl, be * (nl - l) + (1 - be) * t, s[2:] || [ns], sse + (v - nf) * (v - nf), es + (v - nf), nf from (
            select r.*, x.v, {lev} nl, {sea} ns, {f} nf from hw_r r join {src} x on x.k = r.k and x.i = r.i)),
    hw_n as (select k, max(i) n from hw_r group by k),
    hw_best as (select r.k, r.i n, arg_min(r.al, sse) al, arg_min(r.be, sse) be, arg_min(r.ga, sse) ga from hw_r r join hw_n on hw_n.k = r.k and hw_n.n = r.i group by r.k, r.i),
    hw_f as (select r.* from hw_r r join hw_best b on b.k = r.k and b.al = r.al and b.be = r.be and b.ga = r.ga and b.n = r.i),
    hw as (select x.k, x.i, x.t, x.v, r.f fitted from hw_r r join hw_best b on b.k = r.k and b.al = r.al and b.be = r.be and b.ga = r.ga join {src} x on x.k = r.k and x.i = r.i - 1)"""


for _name, _mul in (("additive", False), ("multiplicative", True)):
    SQL[f"holt_winters_{_name}_grid"] = f"""with recursive {SERIES}, {hw('series', _mul)}
        select k, 'ok' as status, i as n, al as alpha, be as beta, ga as gamma, {sig('sse', 7)} as sse, {sig('l', 7)} as "level", {sig('t', 7)} as trend from hw_f"""
    SQL[f"holt_winters_{_name}_fitted"] = f"with recursive {SERIES}, {hw('series', _mul)} select {sel('k', 't', '~v', '~fitted', digits=7)} from hw"

def renamed(sql: str, tag: str) -> str:
    """Give the Holt-Winters CTEs names of their own, so that both forms fit in one statement."""
    return sql.replace("hw_", f"{tag}_").replace(" hw as", f" {tag} as")


# --- diagnostics and forecasts --------------------------------------------------------------

ROWS = f"""{SERIES}, {SMA7}, {LINE}, {ses('series')}, {holt('series')}, {renamed(hw('series', False), 'wa')}, {renamed(hw('series', True), 'wm')},
    fit_rows as (select k, 'sma' model, i, v, fitted from sma union all select k, 'lr', i, v, fitted from lr
        union all select k, 'ses', i, v, fitted from ses union all select k, 'holt', i, v, fitted from holt
        union all select k, 'holt_hw_add', i, v, fitted from wa union all select k, 'holt_hw_mul', i, v, fitted from wm),
    res as (select k, model, v, v - fitted e, row_number() over (partition by k, model order by i) - 1 i from fit_rows where fitted is not null)"""
MEASURES = f"""{ROWS}, {acf('res', 10, 'e', 'k, model')},
    mo as (select k, model, count(*) n, avg(e * e) mse, avg(abs(e)) mae, avg(abs(e / nullif(v, 0))) * 100 mape, sum(e * e) sse, stddev_samp(e) resid_std, avg(e) me from res group by k, model),
    sh as (select res.k, res.model, avg(pow(e - me, 2)) m2, avg(pow(e - me, 3)) m3, avg(pow(e - me, 4)) m4 from res join mo using (k, model) group by res.k, res.model),
    jb as (select k, model, n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4) jb_stat from mo join sh using (k, model)),
    lb as (select k, model, any_value(n) * (any_value(n) + 2) * sum(case when lag > 0 then acf * acf / (n - lag) else 0 end) lb_stat from acf group by k, model),
    diag as (select mo.*, jb_stat, exp(-jb_stat / 2) jb_pvalue, lb_stat, exp(-lb_stat / 2) * (1 + lb_stat / 2 + pow(lb_stat / 2, 2) / 2 + pow(lb_stat / 2, 3) / 6 + pow(lb_stat / 2, 4) / 24) lb_pvalue
        from mo join jb using (k, model) join lb using (k, model))"""
SQL["residual_tests"] = f"""with recursive {MEASURES} select k, model, n as fitted_values_count,
    {sel('~mse', '~mae', '~mape', '~sse', '~resid_std', '~jb_stat', '~jb_pvalue', '~lb_stat', '~lb_pvalue', digits=6)} from diag"""
SQL["residual_histogram"] = f"""with recursive {ROWS}, re as (select k, model, min(e) lo, max(e) hi from res group by k, model),
    c as (select r.k, r.model, least(30, cast(floor((e - lo) / (hi - lo) * 30) as int) + 1) bin, count(*) n from res r join re using (k, model) group by 1, 2, 3),
    g as (select *, unnest(range(1, 31)) bin from re), h as (select g.k, g.model, cast(g.bin as int) bin, lo + (g.bin - 1) * ((hi - lo) / 30) "lower", lo + g.bin * ((hi - lo) / 30) "upper", coalesce(c.n, 0)::bigint n
    from g left join c on c.k = g.k and c.model = g.model and c.bin = g.bin) select k, model, bin, {sel('~"lower"', '~"upper"', digits=7)}, n from h"""
_P19 = [j / 20 for j in range(1, 20)]
_Z19 = [__import__("statistics").NormalDist().inv_cdf(p) for p in _P19]
SQL["residual_qq"] = f"""with recursive {ROWS}, g as (select unnest({_P19}::double[]) p, unnest({_Z19!r}::double[]) normal_quantile),
    q as (select k, model, avg(e) me, stddev_samp(e) sd, quantile_cont(e, {_P19}) qs from res group by k, model),
    f as (select k, model, p, normal_quantile, qs[cast(round(p * 20) as int)] residual_quantile, me + sd * normal_quantile line from q, g)
    select k, model, {sel('~p', '~normal_quantile', '~residual_quantile', '~line', digits=7)} from f"""
SEASONED = """case model when 'holt_hw_add' then l + step * b + sea[cast((step - 1) % 24 as int) + 1] when 'holt_hw_mul' then (l + step * b) * sea[cast((step - 1) % 24 as int) + 1] else l + step * b end"""
CRITERIA = f"""{MEASURES}, est(model, name, kk) as (values ('sma', 'Simple Moving Average', null), ('lr', 'Linear Regression Trend', null),
        ('ses', 'Simple Exponential Smoothing', 2), ('holt', 'Holt Linear Trend', 4), ('holt_hw_add', 'Holt-Winters Additive', 29), ('holt_hw_mul', 'Holt-Winters Multiplicative', 29)),
    crit as (select diag.k, model, name, mse, n, n * ln(sse / n) + 2 * kk aic, n * ln(sse / n) + kk * ln(n) bic,
        n * ln(sse / n) + 2 * kk + 2.0 * kk * (kk + 1) / (n - kk - 1) aicc, case when model = 'lr' then r2 end r_squared from diag join est using (model) join line on line.k = diag.k)"""
SQL["information_criteria"] = f"""with recursive {CRITERIA} select k, model, name, {sel('~mse', '~aic', '~bic', '~aicc', '~r_squared', digits=7)}, n as fitted_values_count from crit"""
SQL["compare_models"] = f"""with recursive {CRITERIA}, r as (select *, row_number() over (partition by k order by case when aic is not null then 0 when mse is not null then 1 else 2 end, coalesce(aic, mse), model) "rank" from crit)
    select k, model, {sel('~mse', '~aic', '~bic', digits=7)}, "rank" from r"""
for _by in ("aic", "bic"):
    SQL[f"select_by_{_by}"] = f"""with recursive {CRITERIA}, r as (select *, row_number() over (partition by k order by {_by}, list_position(['sma', 'lr', 'ses', 'holt', 'holt_hw_add', 'holt_hw_mul'], model)) rn
        from crit where aic is not null) select k, model as selected, {sig(_by, 7)} as score, '{_by}' as score_metric, '{_by.upper()}' as preferred from r where rn = 1"""
SQL["fallback_forecast"] = f"""with s as (select cast(l_orderkey as varchar) k, l_extendedprice v, row_number() over (partition by l_orderkey order by l_shipdate, l_extendedprice) - 1 i from lineitem),
    l as (select k, count(*) n, any_value(v) v, regr_slope(v, i) b, regr_intercept(v, i) a from s group by k),
    f as (select k, cast(step as int) step, case when n = 1 then v else a + b * (n - 1 + step) end f, case when n = 1 then 'fallback' else 'ok' end status from l, (select unnest([1, 2]) step) g)
    select k, step, {sig('f', 7)} forecast, status from f"""
SQL["future_grid"] = f"""with {SERIES}, l as (select k, max(t) last_t from series group by k)
    select k, step, last_t + to_hours(cast(step as int)) as t from (select k, last_t, unnest(range(1, 25)) step from l)"""
SQL["forecast_table"] = f"""with recursive {ROWS}, sd as (select k, model, stddev_samp(e) sd from res group by k, model), n as (select k, count(*) n, max(t) last_t from series group by k),
    st as (select s.k, 'sma' model, avg(v) l, 0.0::double b, null::double[] sea from series s join n using (k) where i >= n - 7 group by s.k
        union all select k, 'lr', icpt + slope * (n - 1), slope, null from line join n using (k)
        union all select k, 'ses', "level", 0.0, null from ses_f union all select k, 'holt', "level", trend, null from holt_f
        union all select k, 'holt_hw_add', l, t, s from wa_f union all select k, 'holt_hw_mul', l, t, s from wm_f),
    pt as (select st.*, step, {SEASONED} f from st, (select unnest(range(1, 25)) step) g),
    f as (select st.k, st.model, cast(step as int) step, last_t + to_hours(cast(step as int)) t, f forecast, f - 1.96 * sd lower_95, f + 1.96 * sd upper_95
        from pt st join n using (k) join sd on sd.k = st.k and sd.model = st.model)
    select k, model, step, t, {sel('~forecast', '~lower_95', '~upper_95', digits=7)}, 'ok' as status from f"""
SQL["interval_validation"] = f"""with {SERIES}, n as (select k, cast(greatest(1, floor(count(*) * 0.8::double)) as bigint) tn from series group by k),
    tr as (select s.*, tn from series s join n using (k) where i < tn),
    f as (select k, i, v - case when count(v) over w = 7 then avg(v) over w end e from tr window w as (partition by k order by i rows between 6 preceding and current row)),
    sd as (select k, stddev_samp(e) sd from f group by k), l as (select k, avg(v) l from tr where i >= tn - 7 group by k),
    r as (select s.k, avg(case when v between l - 1.96 * sd and l + 1.96 * sd then 1.0 else 0.0 end) coverage, avg((l + 1.96 * sd) - (l - 1.96 * sd)) mean_width, count(*) horizon
        from series s join n using (k) join sd using (k) join l using (k) where i >= tn and i < tn + 24 group by s.k)
    select k, {sel('~coverage', '~mean_width')}, horizon from r"""

_TRAIN = f"""{SERIES}, tn as (select k, greatest(1, floor(count(*) * 0.8::double)) tn from series group by k),
    train as (select s.* from series s join tn using (k) where i < tn)"""
SQL["evaluate_models"] = f"""with recursive {_TRAIN}, {ses('train')}, {holt('train')}, {renamed(hw('train', False), 'wa')}, {renamed(hw('train', True), 'wm')}, n as (select k, count(*) n from train group by k),
    st as (select t.k, 'sma' model, avg(v) l, 0.0::double b, null::double[] sea from train t join n using (k) where i >= n - 24 group by t.k
        union all select k, 'lr', any_value(icpt + slope * (n - 1)), any_value(slope), null from (select k, regr_slope(v, i) slope, regr_intercept(v, i) icpt from train group by k) join n using (k) group by k
        union all select k, 'ses', "level", 0.0, null from ses_f union all select k, 'holt', "level", trend, null from holt_f
        union all select k, 'holt_hw_add', l, t, s from wa_f union all select k, 'holt_hw_mul', l, t, s from wm_f),
    f as (select k, model, cast(step as int) step, {SEASONED} forecast from st, (select unnest(range(1, 25)) step) g)
    select k, model, step, {sel('~forecast', digits=7)}, 'ok' as status from f"""
SQL["csv_source"] = f"""with l as (select 'quantity' k, l_shipdate t, sum(l_quantity) v from lineitem group by 2
    union all select 'tax', l_shipdate, sum(l_tax) from lineitem group by 2)
    select k, t, row_number() over (partition by k order by t) - 1 as i, {sel('~v')} from l"""
# Damage to order lines, as the query writes it; lines 5 and 6 have another number of fields.
DIRTY = """dirty as (select l_linenumber not in (5, 6) whole, l_linenumber = 2 bad_quantity, l_linenumber = 4 and l_orderkey % 3 = 0 bad_date,
    case when not (l_linenumber = 4 and l_orderkey % 3 = 0) then l_shipdate end t from lineitem)"""
SQL["csv_malformed"] = f"""with {DIRTY}, c as (select count(*) n_rows, count(*) filter (not whole) n_bad_lines, count(*) filter (whole and bad_date) d, count(*) filter (whole and bad_quantity) q from dirty)
    select n_rows, n_bad_lines, 'date' as column, d n_bad_cells from c union all select n_rows, n_bad_lines, 'quantity', q from c union all select n_rows, n_bad_lines, 'tax', 0 from c"""
SQL["csv_malformed_panel"] = f"""with {DIRTY}, o as (select k, t from dirty, (values ('quantity'), ('tax')) s(k) where whole),
    r as (select coalesce(sum(c - 1), 0)::bigint n_repeated from (select count(*) c from o where t is not null group by k, t)),
    b as (select count(*) filter (not whole) n_bad_lines, count(*) filter (whole and bad_date) + count(*) filter (whole and bad_quantity) n_bad_cells from dirty)
    select count(*) n_rows, count(*) filter (t is null) n_without_time, 0::bigint n_without_key, any_value(n_repeated) n_repeated, any_value(n_bad_lines) n_bad_lines, any_value(n_bad_cells) n_bad_cells from o, r, b"""
SQL["csv_set_aside"] = f"""with {DIRTY} select case when whole and bad_date then 'date' when whole and bad_quantity then 'quantity' else '' end bad_columns, not whole bad_line, count(*) n, 1::bigint n_texts
    from dirty where not whole or bad_date or bad_quantity group by 1, 2"""
SQL["forecast_sink"] = f"""with {SERIES}, {SMA7}, n as (select k, count(*) n, max(t) last_t from series group by k), sd as (select k, stddev_samp(v - fitted) sd from sma group by k),
    st as (select s.k, avg(v) l from series s join n using (k) where i >= n - 7 group by s.k),
    f as (select st.k series_id, cast(step as int) step, last_t + to_hours(cast(step as int)) date, l forecast, l - 1.96 * sd lower_95, l + 1.96 * sd upper_95
        from st join n using (k) join sd using (k), (select unnest(range(1, 25)) step) g)
    select series_id, step, date, {sel('~forecast', '~lower_95', '~upper_95', digits=7)}, 'run-1' as run_id, 'sma' as model from f"""
SQL["event_sink"] = f"""with {SERIES} select 'run-1' as run_id, 'process_header' as event, '' as k, '' as model, 0::bigint as n
    union all select 'run-1', 'model_completion', k, 'sma', count(*) - 6 from series group by k
    union all select 'run-1', 'model_error', k, 'holt_hw_add', 0 from series group by k union all select 'run-1', 'exported_files', '', 'sma', 0"""

# --- validation and selection ---------------------------------------------------------------

ROLL = "greatest(2, floor(count(*) * 0.5::double))::bigint n0, 24::bigint st, 24::bigint hz"
HOLD = "greatest(1, floor(count(*) * 0.7::double))::bigint n0, count(*) st, count(*) - greatest(1, floor(count(*) * 0.7::double))::bigint hz"


def plan(folds: str = ROLL) -> str:
    return f"""pl as (select k, count(*) n, {folds} from series group by k),
    orig as (select k, unnest(generate_series(n0, n - 1, st)) origin, hz from pl),
    tests as (select o.k, o.origin, s.i - o.origin + 1 sx, s.v actual from orig o join series s on s.k = o.k and s.i >= o.origin and s.i < o.origin + o.hz)"""


# per model: states(k, cand, origin, l, b, sea, sd)
SMA_STATES = """sw(cand, w) as (values (0, 24), (1, 48), (2, 168)),
    sm as (select k, i, v, cand, avg(v) over (partition by k, cand order by i rows between 167 preceding and current row) m from series, sw where cand = 2
        union all select k, i, v, cand, avg(v) over (partition by k, cand order by i rows between 47 preceding and current row) from series, sw where cand = 1
        union all select k, i, v, cand, avg(v) over (partition by k, cand order by i rows between 23 preceding and current row) from series, sw where cand = 0),
    sma_states as (select o.k, cand, origin, arg_max(m, i) l, 0.0::double b, null::double[] sea, stddev_pop(v - m) sd from orig o join sm on sm.k = o.k and sm.i < o.origin group by o.k, cand, origin)"""
LR_STATES = """lf as (select o.k, origin, regr_slope(v, i) b, regr_intercept(v, i) a from orig o join series s on s.k = o.k and s.i < o.origin group by o.k, origin),
    lr_states as (select lf.k, 0 cand, lf.origin, any_value(a + b * (lf.origin - 1)) l, any_value(b) b, null::double[] sea, stddev_pop(v - a - b * i) sd
        from lf join series s on s.k = lf.k and s.i < lf.origin group by lf.k, lf.origin)"""
SES_STATES = f"""{ses('series', '(0.1, 0.2, 0.3)', 'sc')},
    s0 as (select o.k, al, origin, sum((v - c) * b) / sum(b * b) l0 from orig o join sc_j j on j.k = o.k and j.i < o.origin group by o.k, al, origin),
    s1 as (select s0.k, s0.al, s0.origin, any_value(l0) l0, stddev_pop(v - c - b * l0) sd from s0 join sc_j j on j.k = s0.k and j.al = s0.al and j.i < s0.origin group by s0.k, s0.al, s0.origin),
    ses_states as (select s1.k, cast(round(s1.al * 10) as int) - 1 cand, origin, c + b * l0 l, 0.0::double b, null::double[] sea, sd from s1 join sc_r r on r.k = s1.k and r.al = s1.al and r.i = s1.origin)"""
HOLT_STATES = f"""{holt('series', '(0.1, 0.05), (0.1, 0.1), (0.2, 0.05), (0.2, 0.1)', 'hc')},
    h0 as (select o.k, al, be, origin, sum(g1 * g1) a, sum(g1 * g2) b, sum(g2 * g2) d, sum(y * g1) p, sum(y * g2) q from orig o join hc_j j on j.k = o.k and j.i < o.origin group by o.k, al, be, origin),
    h1 as (select k, al, be, origin, (p * d - q * b) / (a * d - b * b) l0, (a * q - b * p) / (a * d - b * b) b0 from h0),
    h2 as (select h1.k, h1.al, h1.be, h1.origin, any_value(l0) l0, any_value(b0) b0, stddev_pop(y - g1 * l0 - g2 * b0) sd from h1 join hc_j j on j.k = h1.k and j.al = h1.al and j.be = h1.be and j.i < h1.origin group by h1.k, h1.al, h1.be, h1.origin),
    holt_states as (select h2.k, case when h2.al = 0.1 then 0 else 2 end + case when h2.be = 0.05 then 0 else 1 end cand, origin, cl + ul * l0 + wl * b0 l, ct + ut * l0 + wt * b0 b, null::double[] sea, sd
        from h2 join hc_r r on r.k = h2.k and r.al = h2.al and r.be = h2.be and r.i = h2.origin)"""


def hw_states(mul: bool) -> str:
    return f"""{hw('series', mul)},
    hw_o as (select r.*, row_number() over (partition by r.k, r.i order by sse, al, be, ga) rn from hw_r r join orig o on o.k = r.k and o.origin = r.i),
    hw_states as (select k, 0 cand, i origin, l, t b, s sea, sqrt(sse / i - pow(es / i, 2)) sd from hw_o where rn = 1)"""


def score(states: str, mul: bool = False) -> str:
    season = f"(l + sx * b) {'*' if mul else '+'} sea[cast((sx - 1) % 24 as int) + 1]"
    return f"""pts as (select t.k, cand, t.origin, actual, case when sea is null then l + sx * b else {season} end f, sd from tests t join {states} s on s.k = t.k and s.origin = t.origin),
    folds as (select k, cand, origin, avg(pow(actual - f, 2)) mse, avg(case when abs(actual - f) <= 1.96 * sd then 1.0 else 0.0 end) coverage from pts group by k, cand, origin),
    cvs as (select k, cand, avg(mse) mean_mse, stddev_pop(mse) std_mse, avg(coverage) mean_coverage, count(*) n_folds, 0::bigint n_failed from folds group by k, cand)"""


def folds_out(model: str) -> str:
    return f"""select f.k, '{model}' as model, cast(cand as int) as cand, origin, s.t as train_end, {sel('~mse', '~coverage', digits=6)}
        from folds f join series s on s.k = f.k and s.i = f.origin - 1"""


SQL["rolling_origin_sma"] = f"with {SERIES}, {plan()}, {SMA_STATES}, {score('sma_states')} {folds_out('sma')}"
SQL["rolling_origin_linear"] = f"with {SERIES}, {plan()}, {LR_STATES}, {score('lr_states')} {folds_out('lr')}"
SQL["rolling_origin_ses"] = f"with recursive {SERIES}, {plan(ROLL.replace('24::bigint hz', '36::bigint hz'))}, {SES_STATES}, {score('ses_states')} {folds_out('ses')}"
SQL["rolling_origin_holt"] = f"with recursive {SERIES}, {plan()}, {HOLT_STATES}, {score('holt_states')} {folds_out('holt')}"
SQL["rolling_origin_hw_add"] = f"with recursive {SERIES}, {plan()}, {hw_states(False)}, {score('hw_states')} {folds_out('holt_hw_add')}"
SQL["rolling_origin_hw_mul"] = f"with recursive {SERIES}, {plan()}, {hw_states(True)}, {score('hw_states', True)} {folds_out('holt_hw_mul')}"
SQL["holdout_ses"] = f"with recursive {SERIES}, {plan(HOLD)}, {SES_STATES}, {score('ses_states')} {folds_out('ses')}"
SQL["holdout_sma"] = f"with {SERIES}, {plan(HOLD)}, {SMA_STATES}, {score('sma_states')} {folds_out('sma')}"
SQL["holdout_linear"] = f"with {SERIES}, {plan(HOLD)}, {LR_STATES}, {score('lr_states')} {folds_out('lr')}"
SQL["holdout_holt"] = f"with recursive {SERIES}, {plan(HOLD)}, {HOLT_STATES}, {score('holt_states')} {folds_out('holt')}"
SQL["holdout_hw_add"] = f"with recursive {SERIES}, {plan(HOLD)}, {hw_states(False)}, {score('hw_states')} {folds_out('holt_hw_add')}"
SQL["holdout_hw_mul"] = f"with recursive {SERIES}, {plan(HOLD)}, {hw_states(True)}, {score('hw_states', True)} {folds_out('holt_hw_mul')}"
SQL["grid_tested"] = f"""with {SERIES}, {plan()}, {SMA_STATES}, {score('sma_states')} select k, 'sma' as model, cast(cand as int) as cand,
    {sel('~mean_mse', '~std_mse', '~mean_coverage', digits=6)}, n_folds, n_failed, w::double as "window" from cvs join sw using (cand)"""


def best_of(model: str, states: str, mul: bool = False) -> str:
    """Best candidate of a model as one CTE chain with its own names."""
    body = score(states, mul)
    for n in ("pts", "folds", "cvs"):
        body = body.replace(f"{n} as", f"{n}_{model} as").replace(f"from {n} ", f"from {n}_{model} ")
    return f"""{body}, best_{model} as (select k, '{model}' model, cast(cand as int) cand, mean_mse, std_mse from (
        select *, row_number() over (partition by k order by mean_mse, cand) rn from cvs_{model}) where rn = 1)"""


_FOUR = (("sma", "sma_states"), ("lr", "lr_states"), ("ses", "ses_states"), ("holt", "holt_states"))
_BEST4 = f"{SERIES}, {plan()}, {SMA_STATES}, {LR_STATES}, {SES_STATES}, {HOLT_STATES}, " + ", ".join(best_of(*x) for x in _FOUR)


_ALL = (f"{_BEST4}, {renamed(hw_states(False), 'wa')}, {renamed(hw_states(True), 'wm')}, {best_of('holt_hw_add', 'wa_states')}, "
        f"{best_of('holt_hw_mul', 'wm_states', True)}, scores as (" + " union all ".join(
            f"select k, model, cand, mean_mse mse, std_mse, {o} o from best_{m}" for o, m in enumerate(("sma", "lr", "ses", "holt", "holt_hw_add", "holt_hw_mul"))) + ")")
SQL["grid_select"] = f"with recursive {_ALL} select k, model, cand, {sig('mse', 6)} as mean_mse, {sel('~std_mse', digits=6)} from scores"
SQL["validation_run"] = f"with recursive {_ALL} select k, model, cand, {sel('~mse', '~std_mse', digits=6)} from scores"
SQL["select_model"] = f"""with recursive {_ALL}, r as (select *, row_number() over (partition by k order by mse, o) rn from scores)
    select k, model as selected, {sig('mse', 6)} as score, 'mse' as score_metric, 'AIC' as preferred from r where rn = 1"""
_HALTON = [0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875, 0.0625, 0.5625, 0.3125, 0.8125, 0.1875, 0.6875, 0.4375, 0.9375, 0.03125, 0.53125, 0.28125, 0.78125, 0.15625]
_BOX = ", ".join(repr(0.01 + u * 0.49) for u in _HALTON)
_BOX_STATES = SES_STATES.replace("0.1, 0.2, 0.3", _BOX).replace("cast(round(s1.al * 10) as int) - 1 cand", f"cast(list_position([{_BOX}]::double[], s1.al) - 1 as int) cand")
SQL["box_search"] = f"""with recursive {SERIES}, {plan()}, {_BOX_STATES}, {best_of('ses', 'ses_states')}
    select k, model, cand, ([{_BOX}]::double[])[cand + 1] as alpha, {sel('~mean_mse', digits=6)} from best_ses"""

# --- rows and series that must not get lost ---------------------------------------------------

SQL["duplicate_times"] = """select o_orderpriority k, o_orderdate t, o_totalprice v,
    row_number() over (partition by o_orderpriority order by o_orderdate, o_totalprice) - 1 i from orders"""
SQL["ties_by_mean"] = f"""with d as (select o_orderpriority k, o_orderdate t, avg(o_totalprice) v from orders group by 1, 2)
    select k, t, {sig('v')} v, row_number() over (partition by k order by t) - 1 i from d"""
_GAPPY = "sum(case when event_type <> 'view' then value end)"
SQL["all_null_clean"] = f"with {STEPS} select {sel('k', 't', '~v_filled', 'kept', '~v_clean')} from steps".replace("sum(value)", _GAPPY)
SQL["all_null_describe"] = f"""with {HOURLY},
    d as (select k, count(v) n, min(v) mn, max(v) mx, quantile_cont(v, 0.25) a, quantile_cont(v, 0.5) b, quantile_cont(v, 0.75) c from hourly group by k)
    select k, n, {sig('mn')} as "min", {sig('mx')} as "max", {sig('a')} q25, {sig('b')} q50, {sig('c')} q75, {sig('a')} b25, {sig('b')} b50, {sig('c')} b75
    from d""".replace("sum(value)", _GAPPY)
SQL["short_series_validation"] = f"""with s as (select cast(l_orderkey as varchar) k, l_extendedprice v,
        row_number() over (partition by l_orderkey order by l_shipdate, l_extendedprice) - 1 i, count(*) over (partition by l_orderkey) n from lineitem),
    o as (select *, greatest(2, cast(floor(n * 0.5) as bigint)) first from s),
    level as (select k, avg(v) m from o where i < first group by k),
    e as (select o.k, case when i >= first then (v - m) * (v - m) end e2 from o join level using (k)),
    f as (select k, avg(e2) mse from e group by k)
    select k, 0 cand, {sig('mse', 6)} mean_mse, case when mse is null then 0 else 1 end::bigint n_folds, 0::bigint n_failed from f"""
