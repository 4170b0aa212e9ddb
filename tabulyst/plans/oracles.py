"""The same queries in plain SQL, as an independent check of the results.

Nothing here shares code with the operators: tail probabilities are integrated
numerically, least squares is solved by sweeping the moment matrix, and names
and roles follow from literal rules.
"""

from __future__ import annotations

TRIPS = """
select l_orderkey as trip_key, l_linenumber as leg,
  l_shipdate + to_hours(cast((l_orderkey*7+l_linenumber)%24 as int)) as trip_start_timestamp,
  case when (l_orderkey*13+l_linenumber)%11=0 then null else o_orderpriority end as payment_type,
  case when (l_orderkey+l_linenumber)%17=0 then null else s_name end as company,
  l_extendedprice as fare,
  case when (l_orderkey*3+l_linenumber)%9=0 then null else l_extendedprice*l_discount end as tips,
  l_extendedprice*(1e0+l_discount+l_tax) as trip_total,
  l_quantity as trip_miles,
  case when (l_orderkey+l_linenumber*5)%13=0 then null
       else l_quantity*60e0+cast(l_suppkey as double) end as trip_seconds,
  case when (l_orderkey+l_linenumber)%50=0 then 1e0 end as mostly_missing,
  case when l_linenumber%2=0 then cast(l_quantity as varchar)
       when (l_orderkey+l_linenumber)%10=1 then 'bad'
       else cast(l_tax as varchar) end as miles_text,
  l_suppkey as pickup_zone_code
from lineitem join orders on l_orderkey=o_orderkey join supplier on l_suppkey=s_suppkey
"""
WITH_TRIPS = f"with trips as ({TRIPS})"
WITH_REPEATED = f"{WITH_TRIPS}, rep as (select * from trips union all select * from trips where leg = 1)"
NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
CLEANED = f"""{WITH_REPEATED}, uniq as (select distinct * from rep),
  num as (select *, try_cast(miles_text as double) as mt from uniq),
  med as (select quantile_cont(tips, 0.5) as m_tips, quantile_cont(trip_seconds, 0.5) as m_sec,
                 quantile_cont(mt, 0.5) as m_mt from num),
  clean as (select trip_key, leg, trip_start_timestamp,
      coalesce(payment_type,'Missing') as payment_type, coalesce(company,'Missing') as company,
      fare, coalesce(tips, m_tips) as tips, trip_total, trip_miles,
      coalesce(trip_seconds, m_sec) as trip_seconds, coalesce(mt, m_mt) as miles_text,
      pickup_zone_code from num, med)"""

TRIP_COLUMNS = (
    "trip_key", "leg", "trip_start_timestamp", "payment_type", "company", "fare", "tips",
    "trip_total", "trip_miles", "trip_seconds", "mostly_missing", "miles_text", "pickup_zone_code",
)
LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)
METRICS = ("fare", "tips", "trip_total", "trip_miles", "trip_seconds")

# Upper tails by Simpson's rule after the substitution x = u*u, for rows of
# (test, x, y, statistic, d1, d2).
P_VALUES = """
  grid as (select range as i, case when range in (0, 4000) then 1e0 when range % 2 = 1 then 4e0 else 2e0 end as w
           from range(4001)),
  bounded as (select *, case test when 'pearsonr' then abs(statistic)*sqrt(d1/(1e0-statistic*statistic))
                else abs(statistic) end as s from tests),
  ends as (select *, case when test in ('chi2','anova') then sqrt(s) else least(s, 40e0) end as top from bounded),
  density as (select test, x, y, w*top/12000e0*
      case when test = 'chi2' then
        case when u = 0 then case when d1 = 1 then 2e0/sqrt(2e0*pi()) else 0e0 end
        else 2e0*exp((d1-1e0)*ln(u)-u*u/2e0-d1/2e0*ln(2e0)-lgamma(d1/2e0)) end
      when test = 'anova' then
        case when u = 0 then 0e0
        else 2e0*exp(lgamma((d1+d2)/2e0)-lgamma(d1/2e0)-lgamma(d2/2e0)+d1/2e0*ln(d1/d2)
             +(d1-1e0)*ln(u)-(d1+d2)/2e0*ln(1e0+d1*u*u/d2)) end
      else 2e0*exp(lgamma((d1+1e0)/2e0)-lgamma(d1/2e0)-0.5e0*ln(d1*pi())-(d1+1e0)/2e0*ln(1e0+u*u/d1)) end as part
    from (select e.*, g.w, e.top*g.i/4000e0 as u from ends e, grid g)),
  tailed as (select t.test, t.x, t.y, t.statistic,
      case when t.test in ('pearsonr','t_test') and b.s > 38 then 0e0
           else 1e0-(select sum(part) from density d where d.test=t.test and d.x=t.x and d.y=t.y) end as p_value
    from tests t join bounded b on t.test=b.test and t.x=b.x and t.y=b.y),
  results as (select test, x, y, statistic, p_value,
      case when p_value < 1e-300 then '<1e-300'
           when p_value < 0.001 then printf('%.2e', p_value) else printf('%.4f', p_value) end as p_value_fmt
    from tailed)
"""


def _shown_tests(digits: int = 6) -> str:
    return (f"select test, x, y, round(statistic,{digits}) as statistic, "
            f"round(p_value,{digits}) as p_value, p_value_fmt from results")


def _anova(table: str, key: str, value: str, where: str = "true", used: str = "rn <= 5") -> str:
    """One row of an ANOVA over the first five groups or those ``used``, or Welch's t for two."""
    return f"""(
    with g as (select {key} as k, count(*) as size, count({value}) as n, avg({value}) as m, var_samp({value}) as v
               from {table} where {key} is not null and {where} group by 1 having count(*) >= 5),
    o as (select *, row_number() over (order by k) as rn, count(*) over () as gs from g),
    u as (select * from o where {used}),
    c as (select sum(n*m)/sum(n) as grand, count(*) as k, sum(n) as n from u)
    select case when max(gs) = 2 then 't_test' else 'anova' end as test, '{key}' as x, '{value}' as y,
      case when max(gs) = 2 then
        (max(m) filter (rn=1) - max(m) filter (rn=2)) / sqrt(sum(v/n))
      else (sum(u.n*(m-grand)*(m-grand))/(max(c.k)-1)) / (sum((u.n-1)*v)/(max(c.n)-max(c.k))) end as statistic,
      case when max(gs) = 2 then sum(v/n_)*sum(v/n_)/sum((v/n_)*(v/n_)/(n_-1)) else cast(max(c.k)-1 as double) end as d1,
      cast(max(c.n)-max(c.k) as double) as d2
    from (select *, n as n_ from u) u, c having max(gs) >= 2)""".replace("sum(v/n))", "sum(v/n_))")


def _chi2(table: str, x: str, y: str, names: tuple[str, str] | None = None) -> str:
    a, b = names or (x, y)
    return f"""(
    with o as (select {x} as a, {y} as b, cast(count(*) as double) as o from {table}
               where {x} is not null and {y} is not null group by 1, 2),
    r as (select a, sum(o) as r from o group by 1), c as (select b, sum(o) as c from o group by 1),
    t as (select sum(o) as t from o),
    cells as (select coalesce(o.o, 0e0) as o, r.r*c.c/t.t as e from r cross join c cross join t
              left join o on o.a = r.a and o.b = c.b),
    dof as (select cast((select count(*)-1 from r)*(select count(*)-1 from c) as double) as d)
    select 'chi2' as test, '{a}' as x, '{b}' as y,
      sum(power(abs(o-e) - case when d = 1 then least(0.5e0, abs(o-e)) else 0e0 end, 2)/e) as statistic,
      max(d) as d1, 0e0 as d2 from cells, dof)"""


def _pearson(table: str, columns: tuple[str, ...], x_y: tuple[str, str] | None = None) -> str:
    pairs = [x_y] if x_y else [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    rows = " union all ".join(
        f"select '{a}' as x, '{b}' as y, corr({a},{b}) as r, count(*) filter ({a} is not null and {b} is not null) as n"
        f" from {table}" for a, b in pairs)
    return (f"(select 'pearsonr' as test, x, y, r as statistic, cast(n-2 as double) as d1, 0e0 as d2"
            f" from ({rows}) order by abs(r) desc, x, y limit 1)")


def _unpivot(columns, expression: str, table: str = "trips") -> str:
    return " union all ".join(
        "select " + expression.format(c=c, i=i) + f" from {table}" for i, c in enumerate(columns))


def _summary(columns) -> str:
    return _unpivot(
        columns,
        "{i} as position, '{c}' as name, count({c}) as n, round(avg({c}),6) as mean, "
        "round(stddev_samp({c}),6) as std, round(min({c}),6) as min, round(quantile_cont({c},0.25),6) as p25, "
        "round(quantile_cont({c},0.5),6) as median, round(quantile_cont({c},0.75),6) as p75, "
        "round(max({c}),6) as max", "n")


def _sweep(matrix: str, size: int) -> str:
    """CTEs m1..m{size}: the matrix m0(i, j, v) with its first columns swept."""
    steps = []
    for k in range(1, size + 1):
        steps.append(f"""m{k} as (select a.i, a.j, case
      when a.i={k} and a.j={k} then -1e0/p.v when a.i={k} or a.j={k} then a.v/p.v
      else a.v - r.v*c.v/p.v end as v
    from m{k-1} a join m{k-1} p on p.i={k} and p.j={k}
      join m{k-1} r on r.i=a.i and r.j={k} join m{k-1} c on c.i={k} and c.j=a.j)""")
    return f"m0 as ({matrix}),\n" + ",\n".join(steps)


def _ols(source: str, columns: list[str], target: str, terms: list[str], with_: str = "with") -> str:
    """CTEs ending in coefficients(term, coef, std_err, t) and fit(...)."""
    names = [*columns, target]
    p = len(columns)
    means = ", ".join(f"avg({c}) as c{i}" for i, c in enumerate(names, 1))
    vals = ", ".join(f"{c} - c{i} as z{i}" for i, c in enumerate(names, 1))
    cells = " union all ".join(
        f"select {i} as i, {j} as j, sum(z{i}*z{j}) as v from centred"
        for i in range(1, p + 2) for j in range(1, p + 2))
    mean_rows = " union all ".join(f"select {i} as i, c{i} as m from mu" for i in range(1, p + 2))
    labels = " union all ".join(f"select {i} as i, '{t}' as term" for i, t in enumerate(terms, 1))
    return f"""{with_} src as ({source}), mu as (select {means}, count(*) as n from src),
  centred as (select {vals} from src, mu), {_sweep(cells, p)},
  means as ({mean_rows}), labels as ({labels}),
  rest as (select v as rss, (select n from mu) as n, (select v from m0 where i={p+1} and j={p+1}) as tss
           from m{p} where i={p+1} and j={p+1}),
  noise as (select rss/(n-{p}-1) as s2, * from rest),
  slopes as (select l.term, b.v as coef, sqrt(-d.v*s2) as std_err from labels l
    join m{p} b on b.i=l.i and b.j={p+1} join m{p} d on d.i=l.i and d.j=l.i, noise),
  intercept as (select 'const' as term,
     (select m from means where i={p+1}) - (select sum(m.m*b.v) from means m join m{p} b on b.i=m.i and b.j={p+1} where m.i<={p}) as coef,
     sqrt(s2*(1e0/n - (select sum(a.m*b.m*v.v) from means a, means b, m{p} v where v.i=a.i and v.j=b.i and a.i<={p} and b.i<={p}))) as std_err
     from noise),
  coefficients as (select term, coef, std_err, coef/std_err as t from (select * from slopes union all select * from intercept)),
  fit as (select n, 1e0-rss/tss as r2, ((tss-rss)/{p})/s2 as f,
     -n/2e0*(ln(2e0*pi())+ln(rss/n)+1e0) as ll from noise)
"""


def _vif(table: str, columns: tuple[str, ...]) -> str:
    """1 / (1 - uncentred R2) of each column on the others, by sweeping the rest."""
    p = len(columns)
    cells = " union all ".join(
        f"select {i} as i, {j} as j, sum({a}*{b}) as v from {table}"
        for i, a in enumerate(columns, 1) for j, b in enumerate(columns, 1))
    parts = []
    for i, c in enumerate(columns, 1):
        order = [j for j in range(1, p + 1) if j != i] + [i]
        place = {old: new for new, old in enumerate(order, 1)}
        case_i = "case i " + " ".join(f"when {o} then {n}" for o, n in place.items()) + " end"
        case_j = "case j " + " ".join(f"when {o} then {n}" for o, n in place.items()) + " end"
        inner = _sweep(f"select {case_i} as i, {case_j} as j, v from gram", p - 1)
        parts.append(f"select '{c}' as feature, round(g.v/s.v, 6) as vif from (with {inner} "
                     f"select v from m{p-1} where i={p} and j={p}) s, gram g where g.i={i} and g.j={i}")
    return f"with gram as ({cells}) " + " union all ".join(parts)


def _name_rules() -> str:
    tables = {
        "lineitem": [*LINE_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
        "documents": ["doc_id", "text", "lang", "source", "n_chars"],
        "pages": ["page_id", "url", "html"],
    }
    rows = " union all ".join(
        f"select '{t}' as table_name, '{c}' as name, avg(case when {c} is null then 1e0 else 0e0 end) as missing_rate from {t}"
        for t, cs in tables.items() for c in cs)
    return f"""select table_name, name, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') as canonical,
      regexp_matches(lower(name), '(^|[^a-z0-9])(tract|geoid|zipcode|zip|zone|code|id)([^a-z0-9]|$)') as code_like,
      regexp_matches(lower(name), 'date|time|created|updated|start|end') as time_like,
      name || '_raw' as safe, missing_rate from ({rows})"""


def _column_roles() -> str:
    typed = {
        "trip_key": 0, "leg": 1, "fare": 5, "tips": 6, "trip_total": 7, "trip_miles": 8,
        "trip_seconds": 9, "mostly_missing": 10, "pickup_zone_code": 12,
    }
    code = r"'(^|_)(tract|geoid|zipcode|zip|zone|code|id)(_|$)'"
    numbers = " union all ".join(
        f"select {i} as position, '{c}' as name, case when regexp_matches('{c}', 'lat|lon|lng') then 'numeric' "
        f"when regexp_matches('{c}', {code}) then 'categorical' else 'numeric' end as role"
        for c, i in typed.items())
    texts = " union all ".join(
        f"select {i} as position, '{c}' as name, case "
        f"when avg(case when regexp_matches({c}, {NUMBER}) then 1e0 else 0e0 end) > 0.8 then 'numeric' "
        f"when count(distinct {c}) > 200 or count(distinct {c}) > 0.5*(select count(*) from trips) then 'text' "
        f"else 'categorical' end as role from trips where {c} is not null"
        for c, i in (("payment_type", 3), ("company", 4), ("miles_text", 11)))
    return f"""{WITH_TRIPS} select position, name, role from ({numbers} union all {texts}
      union all select 2, 'trip_start_timestamp', 'datetime')"""


def _text_roles() -> str:
    tables = {
        "documents": [("doc_id", "code"), ("text", "s"), ("lang", "s"), ("source", "s"), ("n_chars", "n")],
        "customer": [("c_custkey", "n"), ("c_name", "s"), ("c_nationkey", "n"), ("c_acctbal", "n"), ("c_mktsegment", "s")],
        "part": [("p_partkey", "n"), ("p_name", "s"), ("p_brand", "s"), ("p_type", "s"), ("p_size", "n"), ("p_retailprice", "n")],
        "events": [("event_id", "code"), ("ts", "t"), ("user_id", "code"), ("event_type", "s"), ("value", "n"), ("props", "s")],
    }
    known = {"code": "'categorical'", "n": "'numeric'", "t": "'datetime'"}
    rows = []
    for t, cs in tables.items():
        for i, (c, kind) in enumerate(cs):
            role = known.get(kind) or (
                f"(select case when count(distinct {c}) > 200 or count(distinct {c}) > 0.5*count(*) "
                f"then 'text' else 'categorical' end from {t})")
            rows.append(f"select '{t}' as table_name, {i} as position, '{c}' as name, {role} as role")
    return " union all ".join(rows)


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
REPLIES = """replies as (select conv_id, turn, case turn % 4
      when 0 then text
      when 1 then '1. ' || replace(text, chr(10), chr(10) || '- ')
      when 2 then '["' || replace(replace(text, '"', ''), chr(10), '","') || '"]'
      else '{"points": ["' || replace(replace(text, '"', ''), chr(10), '","') || '"]}' end as text,
      turn % 4 as form, replace(text, '"', '') as plain, text as raw from conversations)"""
# The written form is known by the turn, so each is read back the simple way.
POINTS = REPLIES + r""",
  lines as (select conv_id, turn, form,
      case when form in (2, 3) then string_split(plain, chr(10)) else string_split(text, chr(10)) end as parts
    from replies),
  items as (select conv_id, turn, form, p.i as pos,
      case when form in (2, 3) then trim(parts[p.i], ' ') else
        trim(regexp_replace(regexp_replace(trim(regexp_replace(trim(parts[p.i], ' '), '^[-*•]+', ''), ' '), '^[0-9]+', ''), '^[.、)]+', ''), ' ') end as item
    from lines, (select unnest(range(1, 200)) as i) p where p.i <= len(parts)),
  firsts as (select conv_id, turn, form, item, min(pos) as pos from items where length(item) > 0
    group by conv_id, turn, form, item, case when form in (2, 3) then pos else 0 end),
  ranked as (select *, row_number() over (partition by conv_id, turn order by pos) as rn from firsts),
  points as (select r.conv_id, r.turn, list(k.item order by k.pos) filter (k.rn <= 6) as points
    from replies r left join ranked k on r.conv_id=k.conv_id and r.turn=k.turn group by 1, 2)"""

PLANS = """plans as (select event_id, event_id % 5 as form, event_type, value,
    cast(props->>'$.k' as bigint) as k from events)"""

FINDING_TEXTS = {
    "missing": "缺失率最高的列是 `' || name || '`（missing_rate=' || printf('%.2f', missing_rate*100e0) || '%），建议确认采集流程或考虑剔除/重采样。",
    "duplicates": "检测到并移除了重复行 ' || n || ' 条，后续分析基于去重后的数据。",
    "test": "统计检验 `' || test || '` 显示 `' || x || '` 与 `' || y || '` 存在显著关系（p=' || p_value_fmt || '）。",
    "none": "未发现特别突出的缺失/重复/显著关系信号（可能需要指定目标列或更细分的业务问题）。",
}

LINE_CHI2 = _chi2("lineitem", "l_returnflag", "l_linestatus")
LINE_PEARSON = _pearson("lineitem", LINE_NUMBERS)


def _group_summary(metrics, rate: bool) -> str:
    cells = ", ".join(
        f"round(avg({m}),6) as {m}_mean, round(quantile_cont({m},0.5),6) as {m}_median" for m in metrics)
    extra = ", round(avg(tips)/(avg(trip_total)+1e-9),6) as tip_rate_mean" if rate else ""
    return (f"{WITH_TRIPS} select payment_type, count(*) as count, {cells}{extra} from trips "
            "group by 1 order by count(*) desc, payment_type nulls first limit 12")


def _pattern(name: str, unit: str) -> str:
    means = ", ".join(f"round(avg({m}),6) as {m}_mean" for m in METRICS)
    return (f"{WITH_TRIPS} select cast({unit} as int) as {name}, count(*) as count, {means} from trips "
            "where trip_start_timestamp is not null group by 1")


def _wide_pairs() -> str:
    """Correlations of all pairs of 70 columns with gaps."""
    named = [
        (f"{m}_{k}", f"case when (trip_key*{k + 3}+leg)%{k + 5}=0 then null else {m}*cast(trip_key%{k + 2}+1 as double) end")
        for k in range(14) for m in METRICS
    ]
    pairs = [(a, b) for i, (a, _) in enumerate(named) for b, _ in named[i + 1:]]
    sums = ", ".join(f"{{'x': '{a}', 'y': '{b}', 'n': regr_count({a},{b}), 'r': round(corr({a},{b}),6)}}" for a, b in pairs)
    columns = ", ".join(f"{sql} as {name}" for name, sql in named)
    return f"""{WITH_TRIPS}, wide as (select {columns} from trips), one as (select [{sums}] as p from wide),
      rows as (select unnest(p) as s from one) select s.x as x, s.y as y, cast(s.n as bigint) as n, s.r as r from rows"""


_TEST = "md5('42|' || cast(trip_key as varchar) || '|' || cast(leg as varchar)) < '33333333'"


def _regression_checked() -> str:
    """A linear fit on the rows whose key's digest isn't low, scored on the others."""
    levels = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    dummies = [f"d{i}" for i in range(1, 5)]
    columns = ["tips", "trip_miles", "fare", *dummies]
    cases = ", ".join(f"case when payment_type = '{v}' then 1e0 else 0e0 end as d{i}" for i, v in enumerate(levels) if i)
    guess = " + ".join(f"(select coef from coefficients where term = '{c}') * {c}" for c in columns)
    fit = _ols("select * from ready where not test", columns, "trip_seconds", columns, f"""{WITH_TRIPS},
      known as (select *, {_TEST} as test from trips where trip_seconds is not null),
      middle as (select quantile_cont(tips, 0.5) as tip from known where not test),
      often as (select payment_type as pay from known where not test and payment_type is not null group by 1 order by count(*) desc, 1 limit 1),
      filled as (select trip_seconds, trip_miles, fare, test, coalesce(tips, tip) as tips, coalesce(payment_type, pay) as payment_type from known, middle, often),
      ready as (select *, {cases} from filled),""")
    return f"""{fit}, guessed as (select trip_seconds as y, (select coef from coefficients where term = 'const') + {guess} as p from ready where test)
      select true as enabled, 'regression' as task_type, 'LinearRegression' as model_name,
        (select count(*) from known where not test) as n_train, count(*) as n_test,
        printf('%.4e', 1e0 - sum(power(y-p, 2)) / (var_pop(y) * count(*))) as r2, printf('%.4e', avg(abs(y-p))) as mae from guessed"""


def _classification_checked(steps: int = 10) -> str:
    """Newton's steps for a logistic fit with a penalty of one half of the squared slopes."""
    parts = ["""src as (select l_quantity as x1, l_discount as x2,
      case when l_quantity + 300e0*l_discount + (l_orderkey*7+l_partkey*13)%40 > 60 then 1e0 else 0e0 end as y,
      md5('42|' || cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar)) < '33333333' as test from lineitem)""",
             "b0 as (select 0e0 as c, 0e0 as w1, 0e0 as w2)"]
    for t in range(1, steps + 1):
        parts.append(f"""s{t} as materialized (select any_value(c) as c, any_value(w1) as w1, any_value(w2) as w2,
          sum(y-p) as g0, sum((y-p)*x1) - any_value(w1) as g1, sum((y-p)*x2) - any_value(w2) as g2,
          sum(p*(1-p)) as a, sum(p*(1-p)*x1) as b, sum(p*(1-p)*x2) as d, sum(p*(1-p)*x1*x1) + 1 as e,
          sum(p*(1-p)*x1*x2) as f, sum(p*(1-p)*x2*x2) + 1 as h
          from (select *, 1e0/(1e0+exp(-(c+w1*x1+w2*x2))) as p from src, b{t-1} where not test))""")
        parts.append(f"""b{t} as materialized (select
          c + (g0*(e*h-f*f) - b*(g1*h-f*g2) + d*(g1*f-e*g2))/z as c,
          w1 + (a*(g1*h-f*g2) - g0*(b*h-f*d) + d*(b*g2-g1*d))/z as w1,
          w2 + (a*(e*g2-g1*f) - b*(b*g2-g1*d) + g0*(b*f-e*d))/z as w2
          from (select *, a*(e*h-f*f) - b*(b*h-f*d) + d*(b*f-e*d) as z from s{t}))""")
    return f"""with {", ".join(parts)},
      g as (select y as a, case when c+w1*x1+w2*x2 > 0 then 1e0 else 0e0 end as b from src, b{steps} where test),
      k as (select unnest([0e0, 1e0]) as k),
      f as (select k, (select count(*) from g where a=k and b=k) as h, (select count(*) from g where a=k) as n,
        (select count(*) from g where b=k) as m from k)
      select true as enabled, 'classification' as task_type, 'LogisticRegression' as model_name,
        (select count(*) from src where not test) as n_train, (select count(*) from g) as n_test,
        round(sum(h)*1e0/sum(n),6) as accuracy, round(avg(2e0*h/(n+m)),6) as f1 from f"""


def _design_selection() -> str:
    """Constants and near copies of an earlier column go, then all but the 30 nearest to the price."""
    of = {f"d{k}": f"cast((l_orderkey*{k + 3}+l_partkey*{2 * k + 1})%{101 + k} as double)*{900 + 40 * ((k * 7) % 36)}e0 + l_extendedprice" for k in range(36)}
    of |= {"c1": "7e0", "c2": "1e0", "copy": of["d2"], "multiple": f"3e0*({of['d4']})"}
    columns = ", ".join(f"{sql} as {c}" for c, sql in of.items())
    spread = ", ".join(f"{{'c': '{c}', 'i': {i}, 'v': var_samp({c}), 'r': abs(case when var_samp({c}) > 0 then corr({c}, l_extendedprice) end)}}" for i, c in enumerate(of))
    varying = [(i, c) for i, c in enumerate(of) if c not in ("c1", "c2")]
    near = ", ".join(f"{{'j': {j}, 'r': abs(corr({a}, {b}))}}" for i, a in varying for j, b in varying if i < j)
    return f"""with wide as (select l_extendedprice, {columns} from lineitem),
      one as (select [{spread}] as s, [{near}] as n from wide),
      cols as (select x.c as c, x.i as i, x.v as v, x.r as r from (select unnest(s) as x from one)),
      near as (select distinct x.j as j from (select unnest(n) as x from one) where x.r > 0.9999),
      kept as (select * from cols where v > 0 and i not in (select j from near))
      select cast(row_number() over (order by r desc, i) - 1 as int) as place, c as term from (select * from kept order by r desc, i limit 30)"""


def _findings() -> str:
    rates = _unpivot(TRIP_COLUMNS, "{i} as position, '{c}' as name, avg(case when {c} is null then 1e0 else 0e0 end) as missing_rate", "rep")
    t = FINDING_TEXTS
    return f"""{WITH_REPEATED}, rates as ({rates}),
  tests as (select * from {LINE_PEARSON} union all select * from {_anova('lineitem', 'l_linestatus', 'l_extendedprice')}
            union all select * from {LINE_CHI2}), {P_VALUES},
  dup as (select (select count(*) from rep) - (select count(*) from (select distinct * from rep)) as n),
  found as (
    select 1 as place, 'missing' as kind, name as subject, '{t["missing"]}' as message
      from (select * from rates order by missing_rate desc, position limit 1) where missing_rate > 0.3
    union all select 2, 'duplicates', null, '{t["duplicates"]}' from dup where n > 0
    union all select case test when 'pearsonr' then 3 when 'chi2' then 5 else 4 end, 'test', test, '{t["test"]}'
      from results where p_value < 0.05)
  select * from found union all select 9, 'none', null, '{t["none"]}' where (select count(*) from found) = 0"""


def oracle_queries() -> dict[str, str]:
    lines_6 = "l_quantity*1500e0+l_tax*1000e0"
    hist = []
    for c in ("l_extendedprice", "l_quantity", "l_tax"):
        hist.append(f"""select '{c}' as name, b.bin, round(lo+b.bin*w,6) as low, round(lo+(b.bin+1)*w,6) as high,
          coalesce(n,0) as count from (select cast(range as int) as bin from range(40)) b
          cross join (select min({c}) as lo, (max({c})-min({c}))/40e0 as w from lineitem) s
          left join (select least(cast(floor(({c}-lo)/w) as int),39) as bin, count(*) as n from lineitem,
            (select min({c}) as lo, (max({c})-min({c}))/40e0 as w from lineitem) group by 1) h on h.bin=b.bin""")
    pair_cols = sorted(LINE_NUMBERS)
    line_pairs = " union all ".join(
        f"select '{a}' as x, '{b}' as y, count(*) as n, round(corr({a},{b}),8) as r from lineitem"
        for i, a in enumerate(pair_cols) for b in pair_cols[i + 1:])
    gap_pairs = " union all ".join(
        f"select '{a}' as x, '{b}' as y, count(*) filter ({a} is not null and {b} is not null) as n, round(corr({a},{b}),8) as r from trips"
        for i, a in enumerate(METRICS) for b in METRICS[i + 1:])
    five = ("trip_key", "fare", "tips", "trip_total", "trip_miles")
    trivial = {("fare", "trip_total"), ("tips", "trip_total")}
    five_pairs = " union all ".join(
        f"select '{a}' as x, '{b}' as y, {'false' if (a, b) in trivial else 'true'} as meaningful, round(abs(corr({a},{b})),8) as abs_r from trips"
        for i, a in enumerate(five) for b in five[i + 1:])
    levels = ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "Missing")
    dummies = [f"(case when pt='{v}' then 1e0 else 0e0 end)" for v in levels]
    ols_trip_source = f"""select leg, fare, coalesce(tips, (select quantile_cont(tips,0.5) from seconds)) as tips,
      trip_miles, trip_seconds, coalesce(payment_type,'Missing') as pt from seconds"""
    three = ["l_quantity", "l_discount", "l_tax"]
    line_ols = _ols("select * from lineitem", three, "l_extendedprice", three)
    documents_top = "select cast(least(10, count(distinct {c})) as int) from documents"
    split_rows = "cast(floor(0.2e0*(count(*)-1)) as bigint)+1"
    shown = ("case when abs({c}) >= 1000 then printf('%.2f', {c}) else printf('%.4f', {c}) end")
    return {
        "payment_money_summary": _group_summary(("fare", "tips", "trip_total"), True),
        "payment_trip_summary": _group_summary(("trip_miles", "trip_seconds"), False),
        "company_summary": f"""{WITH_TRIPS},
          top as (select coalesce(company,'Unknown') as label from trips group by 1 order by count(*) desc, 1 limit 10)
          select company, count(*) as count, {", ".join(f"round(avg({m}),6) as {m}_mean" for m in METRICS)}
          from trips where coalesce(company,'Unknown') in (select label from top) group by 1""",
        "hour_pattern": _pattern("hour", "hour(trip_start_timestamp)"),
        "dow_pattern": _pattern("dow", "isodow(trip_start_timestamp)-1"),
        "requested_summaries": f"""{WITH_TRIPS},
          top as (select coalesce(company,'Unknown') as label, count(*) as n from trips group by 1 order by 2 desc, 1 limit 10)
          select 'company' as summary, count(distinct coalesce(company,'<none>')) as groups, count(*) as rows from trips
            where coalesce(company,'Unknown') in (select label from top)
          union all select 'hour', count(distinct hour(trip_start_timestamp)), count(*) from trips
          union all select 'dow', count(distinct isodow(trip_start_timestamp)), count(*) from trips""",
        "sizeable_groups": """select o_custkey as key, count(*) as size, count(o_totalprice) as n,
          round(avg(o_totalprice),7) as mean, printf('%.8e', var_samp(o_totalprice)) as variance
          from orders group by 1 having count(*) >= 5""",
        "column_roles": _column_roles(),
        "column_roles_text": _text_roles(),
        "parse_rates": f"{WITH_TRIPS}, t as (select *, cast(trip_start_timestamp as varchar) as start_text from trips) "
        + _unpivot(("miles_text", "payment_type", "company", "start_text"),
                   "'{c}' as name, round(avg(case when regexp_matches({c}, " + NUMBER.replace("{", "{{").replace("}", "}}")
                   + ") then 1e0 else 0e0 end) filter ({c} is not null),6) as number_rate, "
                   "round(avg(case when try_cast({c} as timestamp) is not null then 1e0 else 0e0 end) filter ({c} is not null),6) as time_rate", "t"),
        "task_types": f"""{WITH_TRIPS}
          select 'leg' as target, case when count(distinct leg) <= 20 then 'classification' else 'regression' end as task_type from trips
          union all select 'trip_seconds', case when count(distinct trip_seconds) <= 20 then 'classification' else 'regression' end from trips
          union all select 'payment_type', 'classification'""",
        "missing_rates_topk": f"""{WITH_TRIPS} select * from (
          {_unpivot(TRIP_COLUMNS, "{i} as position, '{c}' as name, round(avg(case when {c} is null then 1e0 else 0e0 end),6) as missing_rate")})
          order by missing_rate desc, name limit 12""",
        "numeric_summary": f"""{WITH_TRIPS}, n as (select * replace (case when regexp_matches(miles_text, {NUMBER})
            then try_cast(miles_text as double) end as miles_text) from trips) {_summary((*METRICS, "miles_text"))}""",
        "distinct_counts": f"""{WITH_TRIPS} {_unpivot(TRIP_COLUMNS, "{i} as position, '{c}' as name, count(distinct {c}) as n_unique")}""",
        "top_values": f"""{WITH_TRIPS} select name, cast(rank as int) as rank, value, count from (
          select *, row_number() over (partition by name order by count desc, value) as rank from ({" union all ".join(
            f"select '{c}' as name, coalesce(cast({c} as varchar),'NaN') as value, count(*) as count from trips group by 2"
            for c in ("payment_type", "company", "pickup_zone_code"))})) where rank <= 10""",
        "column_profile": f"""{WITH_TRIPS}, n as (select *, try_cast(miles_text as double) as miles_number from trips),
          tops as (select name, value, count from (select *, row_number() over (partition by name order by count desc, value) as rn
            from ({" union all ".join(
            f"select '{c}' as name, coalesce(cast({c} as varchar),'NaN') as value, count(*) as count from trips group by 2"
            for c in ("payment_type", "company", "pickup_zone_code"))})) where rn = 1)
          select p.*, t.value as top_value, t.count as top_count from ({" union all ".join(
            f"select {i} as position, '{c}' as name, '{role}' as role, '{dtype}' as dtype, "
            f"round(avg(case when {c} is null then 1e0 else 0e0 end),6) as missing_rate, count(distinct {c}) as n_unique, "
            + (f"round(quantile_cont({num},0.5),6) as median, round(stddev_samp({num}),6) as std from n" if num
               else "cast(null as double) as median, cast(null as double) as std from n")
            for i, (c, role, dtype, num) in enumerate((
                ("trip_key", "numeric", "bigint", "trip_key"), ("leg", "numeric", "int", "leg"),
                ("trip_start_timestamp", "datetime", "timestamp_ntz", None), ("payment_type", "categorical", "string", None),
                ("company", "categorical", "string", None), ("fare", "numeric", "double", "fare"),
                ("tips", "numeric", "double", "tips"), ("trip_total", "numeric", "double", "trip_total"),
                ("trip_miles", "numeric", "double", "trip_miles"), ("trip_seconds", "numeric", "double", "trip_seconds"),
                ("mostly_missing", "numeric", "double", "mostly_missing"), ("miles_text", "numeric", "string", "miles_number"),
                ("pickup_zone_code", "categorical", "bigint", None))))}) p left join tops t on t.name = p.name""",
        "text_profile": f"""select 'doc_id' as name, 'categorical' as role, count(distinct doc_id) as n_unique, cast(null as double) as mean,
            ({documents_top.format(c='doc_id')}) as n_top from documents
          union all select 'text', 'text', count(distinct text), null, null from documents
          union all select 'lang', 'categorical', count(distinct lang), null, ({documents_top.format(c='lang')}) from documents
          union all select 'source', 'categorical', count(distinct source), null, ({documents_top.format(c='source')}) from documents
          union all select 'n_chars', 'numeric', count(distinct n_chars), round(avg(n_chars),6), null from documents""",
        "dataset_profile": f"""{WITH_TRIPS} select count(*) as n_rows, 13 as n_cols, round((
            8e0*(count(trip_key)+count(trip_start_timestamp)+count(fare)+count(tips)+count(trip_total)+count(trip_miles)
            +count(trip_seconds)+count(mostly_missing)+count(pickup_zone_code)) + 4e0*count(leg)
            + sum(coalesce(strlen(payment_type),0)+coalesce(strlen(company),0)+strlen(miles_text)))/1048576e0, 6) as memory_mb from trips""",
        "random_sample": f"""{WITH_TRIPS}, n as (select least(5000, count(*)) as n_rows from trips)
            select n_rows, n_rows as n_distinct, n_rows-n_rows as dropped_duplicates from n""",
        "analysis_digest": f"""{WITH_TRIPS}, rates as ({_unpivot(TRIP_COLUMNS, "{i} as position, '{c}' as name, round(avg(case when {c} is null then 1e0 else 0e0 end),4) as missing_rate")}),
            tests as (select * from {LINE_CHI2}), {P_VALUES}
            select 'dataset' as part, '{{"n_rows":' || (select count(*) from trips) || ',"n_cols":13}}' as json
            union all select 'top_missing_cols', '[' || string_agg('{{"name":"' || name || '","missing_rate":' || cast(missing_rate as varchar) || '}}', ','
              order by missing_rate desc, position) || ']' from (select * from rates order by missing_rate desc, position limit 8)
            union all select 'tests', '[{{"test":"chi2","x":"' || x || '","y":"' || y || '","statistic":' || cast(round(statistic,4) as varchar)
              || ',"p_value":' || cast(round(p_value,4) as varchar) || ',"p_value_fmt":"' || p_value_fmt || '"}}]' from results
            union all select 'rule_insights', '[{{"message":"{FINDING_TEXTS["missing"]}"}}]' from (select * from rates order by missing_rate desc, position limit 1)""",
        "column_variances": _unpivot(LINE_NUMBERS, "{i} as position, '{c}' as name, printf('%.8e', var_samp({c})) as variance", "lineitem"),
        "top_variance": f"""select name, printf('%.8e', v) as variance from ({_unpivot(LINE_NUMBERS, "'{c}' as name, var_samp({c}) as v", "lineitem")})
          where v > 0 order by v desc, name limit 3""",
        "footprint": " union all ".join([
            "select 'documents' as table_name, 0 as position, 'doc_id' as name, cast(count(doc_id)*8 as bigint) as bytes from documents",
            *[f"select 'documents', {i}, '{c}', cast(sum(octet_length(encode({c}))) as bigint) from documents"
              for i, c in ((1, "text"), (2, "lang"), (3, "source"))],
            "select 'documents', 4, 'n_chars', cast(count(n_chars)*8 as bigint) from documents",
            "select 'embeddings', 0, 'vec_id', cast(count(vec_id)*8 as bigint) from embeddings",
            "select 'embeddings', 1, 'embedding', cast(sum(len(embedding)*4) as bigint) from embeddings",
            "select 'embeddings', 2, 'label', cast(count(label)*4 as bigint) from embeddings",
            *[f"select 'lineitem', {i}, '{c}', cast({e} as bigint) from lineitem" for i, (c, e) in enumerate([
                ("l_orderkey", "count(l_orderkey)*8"), ("l_partkey", "count(l_partkey)*8"), ("l_suppkey", "count(l_suppkey)*8"),
                ("l_linenumber", "count(l_linenumber)*4"), ("l_quantity", "count(l_quantity)*8"),
                ("l_extendedprice", "count(l_extendedprice)*8"), ("l_discount", "count(l_discount)*8"), ("l_tax", "count(l_tax)*8"),
                ("l_returnflag", "sum(octet_length(encode(l_returnflag)))"), ("l_linestatus", "sum(octet_length(encode(l_linestatus)))"),
                ("l_shipdate", "count(l_shipdate)*8")])],
        ]),
        "first_rows_in_order": "select o_custkey, o_orderkey, o_totalprice from orders order by o_custkey, o_orderkey limit 700",
        "load_facts": "select 'lineitem.parquet' as filename, count(*) as loaded_rows, 11 as loaded_cols from lineitem",
        "learnt_dates": " union all ".join(
            f"select '{c}' as name, 'datetime' as role, round(count(*) filter (o_orderkey % 20 <> 3)*1e0/count(*),6) as time_rate, "
            "min(date_trunc('day', o_orderdate)) filter (o_orderkey % 20 <> 3) as first, max(date_trunc('day', o_orderdate)) filter (o_orderkey % 20 <> 3) as last "
            "from orders" for c in ("date_points", "date_slashes", "date_us", "date_words", "date_short")),
        "dedup_rows": f"""{WITH_REPEATED} select trip_key, leg, payment_type, round(fare,6) as fare, round(trip_seconds,6) as trip_seconds
          from (select distinct * from rep)""",
        "dedup_count": f"""{WITH_REPEATED}, c as (select (select count(*) from rep) as n_rows,
          (select count(*) from (select distinct * from rep)) as n_distinct)
          select n_rows, n_distinct, n_rows-n_distinct as dropped_duplicates from c""",
        "drop_sparse": f"""{WITH_TRIPS} select trip_key, leg, trip_start_timestamp, payment_type, company, round(fare,6) as fare, round(tips,6) as tips,
          round(trip_total,6) as trip_total, round(trip_miles,6) as trip_miles, round(trip_seconds,6) as trip_seconds,
          miles_text, pickup_zone_code from trips""",
        "cast_numeric": f"""{WITH_TRIPS} select trip_key, leg, case when regexp_matches(miles_text, {NUMBER})
          then try_cast(miles_text as double) end as miles_text from trips""",
        "cast_datetime": f"{WITH_TRIPS} select trip_key, leg, case when leg <> 2 then trip_start_timestamp end as start_time from trips",
        "fill_missing_category": f"""{WITH_TRIPS} select trip_key, leg, coalesce(payment_type,'Missing') as payment_type,
          coalesce(company,'Missing') as company, coalesce(cast(pickup_zone_code as varchar),'Missing') as pickup_zone_code from trips""",
        "fill_median": f"""{CLEANED.replace('uniq as (select distinct * from rep)', 'uniq as (select * from trips)')}
          select trip_key, leg, round(tips,6) as tips, round(trip_seconds,6) as trip_seconds, round(miles_text,6) as miles_text from clean""",
        "cleaning_log": f"""{CLEANED} select 'duplicates' as step, cast(null as varchar) as "column", 'dropped' as detail,
            cast((select count(*) from rep)-(select count(*) from uniq) as varchar) as value
          union all select 'dropped_column', 'mostly_missing', 'missing_rate>=0.95', null
            where (select count(mostly_missing)*1e0/count(*) from uniq) <= 0.05
          union all select 'conversion', 'miles_text', 'numeric', null
          union all select 'imputation', 'payment_type', 'missing_category', 'Missing'
          union all select 'imputation', 'company', 'missing_category', 'Missing'
          union all select 'imputation', 'tips', 'median', printf('%.4f', m_tips) from med
          union all select 'imputation', 'trip_seconds', 'median', printf('%.4f', m_sec) from med
          union all select 'imputation', 'miles_text', 'median', printf('%.4f', m_mt) from med""",
        "clean_table": f"""{CLEANED} select payment_type, cast(isodow(trip_start_timestamp)-1 as int) as trip_start_timestamp_dow,
          count(*) as rows, count(*) filter (company='Missing') as companies_missing, round(avg(tips),6) as tips_mean,
          round(avg(trip_seconds),6) as trip_seconds_mean, round(avg(miles_text),6) as miles_text_mean from clean group by 1, 2""",
        "date_features": """select o_orderkey, cast(year(o_orderdate) as int) as o_orderdate_year, cast(month(o_orderdate) as int) as o_orderdate_month,
          cast(isodow(o_orderdate)-1 as int) as o_orderdate_dow from orders""",
        "target_rows": f"""{WITH_TRIPS} select trip_key, leg, round(fare,6) as fare, round(tips,6) as tips, round(trip_total,6) as trip_total,
          round(trip_miles,6) as trip_miles, pickup_zone_code from trips where trip_seconds is not null""",
        "histogram40": " union all ".join(hist),
        "correlation_pairs": line_pairs,
        "correlation_wide": _wide_pairs(),
        "correlation_with_gaps": f"{WITH_TRIPS} {gap_pairs}",
        "ranked_pairs": f"{WITH_TRIPS} {five_pairs}",
        "target_correlation": " union all ".join(
            f"select '{c}' as x, round(abs(corr({c}, l_extendedprice)),8) as abs_r from lineitem"
            for c in LINE_NUMBERS if c != "l_extendedprice"),
        "category_bars": f"""{WITH_TRIPS} select name, cast(rank as int) as rank, value, count from (
          select *, row_number() over (partition by name order by count desc, value) as rank from ({" union all ".join(
            f"select '{c}' as name, {c} as value, count(*) as count from trips where {c} is not null group by 2"
            for c in ("payment_type", "company"))})) where rank <= 10""",
        "lowest_cardinality": f"""{WITH_TRIPS} select cast(row_number() over (order by n, i) as int) as rank, name from (
          {_unpivot(("company", "miles_text", "payment_type", "pickup_zone_code"), "{i} as i, '{c}' as name, count(distinct {c}) as n")})
          order by n, i limit 2""",
        "contingency": "select l_returnflag as x, l_linestatus as y, count(*) as observed from lineitem group by 1, 2",
        "chi2_stat": f"with tests as (select * from {LINE_CHI2}), {P_VALUES} {_shown_tests()}",
        "chi2_yates": "with l as (select *, case when l_returnflag = 'R' then 'yes' else 'no' end as returned from lineitem), "
        f"tests as (select * from {_chi2('l', 'returned', 'l_linestatus')}), {P_VALUES} {_shown_tests()}",
        "pearson_test": f"with tests as (select * from {LINE_PEARSON}), {P_VALUES} {_shown_tests(8)}",
        "welch_t_stat": f"with tests as (select * from {_anova('lineitem', 'l_linestatus', 'l_extendedprice')}), {P_VALUES} {_shown_tests()}",
        "anova_f_stat": f"""with tests as (select * from {_anova('orders', 'o_orderpriority', 'o_totalprice')}
          union all select * from {_anova('events', 'event_type', 'value')}), {P_VALUES} {_shown_tests()}""",
        "stat_tests_all": f"""with tests as (select * from {LINE_PEARSON} union all
          select * from {_anova('lineitem', 'l_returnflag', 'l_orderkey')} union all select * from
          {_chi2('lineitem', 'l_linestatus', 'l_returnflag')}), {P_VALUES} {_shown_tests()}""",
        "trip_tests": f"""{CLEANED.replace('uniq as (select distinct * from rep)', 'uniq as (select * from trips)')},
          tests as (select * from {_pearson('clean', (), ('trip_miles', 'trip_seconds'))} union all
            select * from {_anova('clean', 'payment_type', 'trip_seconds', used='true')} union all
            select * from {_chi2('clean', 'payment_type', 'company')} where (select count(distinct company) from clean) <= 80),
          {P_VALUES} {_shown_tests()}""",
        "findings": _findings(),
        "no_findings": f"select 9 as place, 'none' as kind, cast(null as varchar) as subject, '{FINDING_TEXTS['none']}' as message",
        "model_matrix": f"""{WITH_TRIPS}, n as (select count(distinct company) as companies, count(distinct miles_text) as miles from trips)
          select unnest(['trip_key','leg','fare','tips','trip_total','trip_miles','mostly_missing','pickup_zone_code']) as name, 'numeric' as part
          union all select 'payment_type', 'categorical'
          union all select 'company', case when companies <= 50 then 'categorical' else 'dropped_high_cardinality' end from n
          union all select 'miles_text', case when miles <= 50 then 'categorical' else 'dropped_high_cardinality' end from n
          union all select 'trip_start_timestamp', 'dropped_datetime'""",
        "train_test_split": f"select o_orderpriority, {split_rows} as n_test, count(*)-({split_rows}) as n_train from orders group by 1",
        "score_regression": f"""select round(1e0-sum(power(l_extendedprice-({lines_6}),2))/(var_pop(l_extendedprice)*count(*)),6) as r2,
          round(avg(abs(l_extendedprice-({lines_6}))),6) as mae from lineitem""",
        "score_classification": """with g as (select o_orderstatus as a, case o_orderkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end as b from orders),
          c as (select a as k from g union select b from g),
          s as (select k, (select count(*) from g where a=k and b=k) as h, (select count(*) from g where a=k) as n, (select count(*) from g where b=k) as m from c)
          select round(sum(h)*1e0/sum(n),6) as accuracy, round(avg(2e0*h/(n+m)),6) as f1 from s""",
        "regression_checked": _regression_checked(),
        "classification_checked": _classification_checked(),
        "design_selection": _design_selection(),
        "random_sample_rows": f"""{WITH_TRIPS} select trip_key, leg, payment_type, round(fare,6) as fare from trips
          order by md5('42|' || cast(trip_key as varchar) || '|' || cast(leg as varchar)), trip_key, leg limit 5000""",
        "training_fills": f"""{WITH_TRIPS}
          select 'tips' as name, printf('%.4f', quantile_cont(tips,0.5)) as fill from trips
          union all select 'trip_seconds', printf('%.4f', quantile_cont(trip_seconds,0.5)) from trips
          union all select 'payment_type', (select payment_type from trips where payment_type is not null group by 1 order by count(*) desc, 1 limit 1)
          union all select 'company', (select company from trips where company is not null group by 1 order by count(*) desc, 1 limit 1)""",
        "vif_top10": _vif("lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        "ols_coefficients": f"{line_ols} select term, printf('%.5e', coef) as coef, printf('%.5e', std_err) as std_err, printf('%.5e', t) as t from coefficients",
        "ols_fit": f"""{line_ols} select n as n_obs, round(r2,9) as r2, round(f,5) as f_statistic, round(ll,3) as log_likelihood,
          round(8e0-2e0*ll,3) as aic from fit""",
        "ols_simple": f"""{WITH_TRIPS} select count(*) as n_obs, round(regr_intercept(trip_seconds,trip_miles),6) as intercept,
          round(regr_slope(trip_seconds,trip_miles),6) as slope, round(regr_r2(trip_seconds,trip_miles),6) as r2
          from trips where trip_seconds is not null""",
        "ols_trips": _ols(ols_trip_source, ["leg", "fare", "tips", "trip_miles", *dummies], "trip_seconds",
                          ["leg", "fare", "tips", "trip_miles", *[f"payment_type_{v}" for v in levels]],
                          f"{WITH_TRIPS}, seconds as (select * from trips where trip_seconds is not null),")
        + " select term, printf('%.5e', coef) as coef, printf('%.5e', std_err) as std_err, printf('%.5e', t) as t from coefficients",
        "time_range_page": """select * from orders where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1996-01-01'
          order by o_orderdate desc, o_orderkey limit 500 offset 100""",
        "deep_page": "select * from lineitem order by l_shipdate desc, l_orderkey, l_linenumber limit 300 offset 5500",
        "first_n_extract": "select * from orders order by o_orderkey limit 1000",
        "csv_roundtrip": f"""{WITH_TRIPS} select trip_key, cast(leg as bigint) as leg, payment_type, round(fare,6) as fare,
          round(trip_seconds,6) as trip_seconds, miles_text from trips""",
        "json_roundtrip": f"{WITH_TRIPS} select cast(hour(trip_start_timestamp) as int) as hour, count(*) as count, round(avg(fare),6) as fare_mean from trips group by 1",
        "number_formats": f"""select l_orderkey, l_linenumber, {shown.format(c='l_extendedprice')} as price_text, {shown.format(c='l_discount')} as discount_text,
          case when p < 1e-300 then '<1e-300' when p < 0.001 then printf('%.2e', p) else printf('%.4f', p) end as p_text
          from (select *, power(l_tax, l_linenumber) as p from lineitem)""",
        "name_rules": _name_rules(),
        "response_json": f"""with {PLANS} select event_id, form < 3 as found, case when form < 3 then k end as k,
          case when form < 3 then event_type end as first_analysis from plans""",
        "plan_fields": f"""with {PLANS} select event_id, case when form < 3 then event_type else 'payment_summary|company_summary|time_patterns' end as extra_analyses,
          form < 3 and value > 20 as stop, '' as insights_md from plans""",
        "response_bullets": f"with {POINTS} select conv_id, turn, coalesce(array_to_string(points, '|'), '') as points from points",
        "merge_findings": f"""with {POINTS},
          both_ as (select a.conv_id, a.turn, list_concat(coalesce(a.points, []), coalesce(b.points, [])) as l
            from points a left join points b on a.conv_id=b.conv_id and b.turn=a.turn+1),
          flat as (select conv_id, turn, trim(l[p.i], ' ') as item, p.i as pos from both_, (select unnest(range(1, 13)) as i) p where p.i <= len(l)),
          once as (select conv_id, turn, item, min(pos) as pos from flat group by 1, 2, 3)
          select b.conv_id, b.turn, coalesce(string_agg(o.item, '|' order by o.pos), '') as merged
          from both_ b left join once o on o.conv_id=b.conv_id and o.turn=b.turn group by 1, 2""",
    }
