"""DuckDB oracle SQL for the registered queries.

Every statement starts from the fixture views (``FIXTURE_HEAD``): the same
statements / snapshot feed / estimates definitions the Spark side derives
from ``lineitem`` and ``orders``.  Divisions are done in double and cast
to DECIMAL(10,4), which reproduces Spark's exact-decimal results.
"""

from __future__ import annotations

from quarterline.sources import fixtures as fx

FIXTURE_HEAD = """
li as (
  select l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_returnflag, l_linestatus,
         concat('Q', cast(quarter(l_shipdate) as varchar(10)), ' ', cast(year(l_shipdate) as varchar(10))) fiscal_period,
         cast(l_quantity as decimal(9,2)) qty, cast(l_extendedprice as decimal(9,2)) ext,
         cast(l_discount as decimal(3,2)) disc, cast(l_tax as decimal(3,2)) tax
  from lineitem),
base as (
  select l_suppkey ticker, fiscal_period,
    sum(ext*(1-disc)) rev, sum(qty) qty, sum(ext*tax) tax, sum(ext*disc) dsc, sum(ext) ext,
    sum(case when l_linestatus='O' then ext else 0 end) opn,
    sum(case when l_returnflag='A' then ext else 0 end) fa,
    sum(case when l_returnflag='N' then ext else 0 end) fn,
    sum(case when l_returnflag='R' then ext else 0 end) fr
  from li group by l_suppkey, fiscal_period),
financial_statements as (
  select ticker, fiscal_period, left(fiscal_period,2) period_type,
    cast(rev*0.001 as decimal(10,4)) revenue, cast(qty as decimal(10,4)) cost_of_revenue,
    cast(rev*0.001-qty as decimal(10,4)) gross_profit, cast(tax*0.001 as decimal(10,4)) operating_expenses,
    cast(rev*0.001-qty-tax*0.001 as decimal(10,4)) operating_income,
    cast(rev*0.001-qty-tax*0.001-dsc*0.001 as decimal(10,4)) net_income,
    cast((rev*0.001-qty-tax*0.001-dsc*0.001)*0.01 as decimal(10,4)) eps,
    cast(ext*0.001+qty as decimal(10,4)) total_assets, cast(opn*0.001 as decimal(10,4)) total_liabilities,
    cast(ext*0.001+qty-opn*0.001 as decimal(10,4)) total_equity,
    cast(fa*0.001 as decimal(10,4)) current_assets, cast(fn*0.001 as decimal(10,4)) current_liabilities,
    cast(fr*0.001 as decimal(10,4)) cash, cast(opn*0.0005 as decimal(10,4)) total_debt,
    cast(rev*0.001-qty as decimal(10,4)) operating_cash_flow, cast(rev*0.001-qty-dsc*0.001 as decimal(10,4)) free_cash_flow
  from base),
eps_estimate as (
  select cast(o_orderdate as date) snap_date, l_suppkey act_symbol, l_orderkey, l_linenumber,
    case when l_linenumber <= 4 then 'Current Quarter' else 'Next Quarter' end period,
    last_day(cast(concat(cast(year(l_shipdate) as varchar(10)),'-',lpad(cast(quarter(l_shipdate)*3 as varchar(10)),2,'0'),'-01') as date)) period_end_date,
    cast(ext*0.00005 as decimal(10,4)) consensus, l_linenumber num,
    cast(ext*0.00006 as decimal(10,4)) high, cast(ext*0.00004 as decimal(10,4)) low
  from li join orders on l_orderkey=o_orderkey),
first_snap as (
  select *, row_number() over (partition by act_symbol, period_end_date order by snap_date, l_orderkey, l_linenumber, consensus) rn
  from eps_estimate where period='Current Quarter' and period_end_date > date '1994-12-31' and period_end_date < date '2001-10-31'),
analyst_estimates as (
  select act_symbol ticker, concat('Q', cast(row_number() over (partition by act_symbol, year(period_end_date) order by period_end_date) as varchar(10)), ' ', cast(year(period_end_date) as varchar(10))) fiscal_period,
   consensus consensus_eps, num num_analysts, high eps_high, low eps_low from first_snap where rn=1)
"""

W = "(partition by ticker order by right(fiscal_period,4), left(fiscal_period,2))"


def dec(expr: str) -> str:
    return f"cast({expr} as decimal(10,4))"


def pct(cur: str, prev: str) -> str:
    """Unrounded percent change in double, as SQL text."""
    return f"(cast(({cur}) - ({prev}) as double) / nullif(cast({prev} as double), 0)) * 100"


def div(num: str, den: str, percent: bool = False) -> str:
    out = f"(cast({num} as double) / nullif(cast({den} as double), 0))"
    return f"{out} * 100" if percent else out


def q(body: str, extra_ctes: str = "") -> str:
    """Fixture head + optional CTEs + final SELECT."""
    ctes = FIXTURE_HEAD.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"with {ctes}\n{body.strip()}"


RATIOS = {
    "net_margin": div("net_income", "revenue", True),
    "gross_margin": div("gross_profit", "revenue", True),
    "oper_margin": div("operating_income", "revenue", True),
    "roe": div("net_income", "(total_assets - total_liabilities)", True),
    "de_ratio": div("total_liabilities", "(total_assets - total_liabilities)"),
    "current_ratio": div("current_assets", "current_liabilities"),
    "cash_ratio": div("cash", "current_liabilities"),
    "asset_turn": div("revenue", "total_assets"),
}

FEATURES = ["qoq_rev", "yoy_rev", "qoq_eps", "yoy_eps", "momentum", "net_margin", "gross_margin",
            "oper_margin", "roe", "de_ratio", "current_ratio", "cash_ratio", "asset_turn"]

# Statement-side growth and ratios (unrounded doubles) and estimate-side growth.
GROWTH_CTES = f"""
sg0 as (
  select ticker, fiscal_period, eps, revenue,
    lag(revenue, 1) over {W} r1, lag(revenue, 4) over {W} r4,
    {', '.join(f'{v} {k}_d' for k, v in RATIOS.items())}
  from financial_statements),
sg1 as (
  select *, {pct('revenue', 'r1')} qoq_d, {pct('revenue', 'r4')} yoy_d from sg0),
sg as (
  select ticker, fiscal_period, eps, {dec('qoq_d')} qoq_rev, {dec('yoy_d')} yoy_rev,
    {dec(f'yoy_d - lag(yoy_d, 4) over {W}')} momentum,
    {', '.join(f'{dec(k + "_d")} {k}' for k in RATIOS)}
  from sg1),
eg as (
  select ticker, fiscal_period, consensus_eps,
    {dec(pct('consensus_eps', f'lag(consensus_eps, 1) over {W}'))} qoq_eps,
    {dec(pct('consensus_eps', f'lag(consensus_eps, 4) over {W}'))} yoy_eps
  from analyst_estimates),
features as (
  select s.ticker, s.fiscal_period, {', '.join(('e.' if k in ('qoq_eps', 'yoy_eps') else 's.') + k for k in FEATURES)},
    case when e.ticker is null then null when s.eps > e.consensus_eps then 'beat' else 'miss' end eps_status,
    {dec(pct('s.eps', 'e.consensus_eps'))} eps_surprise
  from sg s left join eg e on s.ticker = e.ticker and s.fiscal_period = e.fiscal_period)
"""

MATRIX_CTE = f"""
matrix as (
  select ticker, fiscal_period, {', '.join(FEATURES)},
    cast(case when eps_surprise > 0 then 1 when eps_surprise < 0 then 0
              when eps_status = 'beat' then 1 when eps_status = 'miss' then 0 end as double) eps_status,
    eps_surprise
  from features)
"""
FEAT = GROWTH_CTES.strip() + ",\n" + MATRIX_CTE.strip()

# Fixture calendar used by the split keys (see plans.queries).
SPLIT_CASE = ("case when contains(fiscal_period, '1997') or contains(fiscal_period, '1998') then 'train' "
              "when contains(fiscal_period, '1999') then 'val' when contains(fiscal_period, '2000') then 'test' end")

ROWS_CTE = FEAT + f""",
splitted as (select *, {SPLIT_CASE} split from matrix),
rows_ds as (
  select ticker, fiscal_period, eps_surprise, split, {', '.join(f'cast({c} as double) {c}' for c in FEATURES)},
    eps_status label
  from splitted
  where split is not null and eps_status is not null and {' and '.join(f'{c} is not null' for c in FEATURES)}),
scored as (
  select *, cast(0.3 as double) + cast(0.05 as double) * coalesce(qoq_eps, 0)
          + cast(0.01 as double) * coalesce(yoy_rev, 0) + cast(-0.02 as double) * coalesce(momentum, 0) logit
  from rows_ds),
predicted as (select *, round_even(1 / (1 + exp(-logit)), 0) prediction from scored)
"""

SEQ_CTE = FEAT + """,
mp as (
  select *, cast(split_part(fiscal_period, ' ', 2) as integer) as year, cast(substr(fiscal_period, 2, 1) as integer) as quarter
  from matrix where ticker is not null),
sq as (select *, row_number() over (partition by ticker order by year, quarter, fiscal_period) rn from mp)
"""


def sheet_sql(sheet: str) -> str:
    """The long form of one fixture sheet, straight from the statements."""
    parts = []
    for title, column in fx.SHEETS[sheet]:
        expr = column or fx.FILLER_ROWS[title]
        parts.append(f"select ticker, '{title}' Metrics, fiscal_period, cast({expr} as decimal(10,4)) value "
                     "from financial_statements")
    return "\n  union all ".join(parts)


def scan_cte(sheet: str) -> str:
    """Sheet cells after the wide round trip: (ticker, title) x every period."""
    return f"""
sheet_{sheet} as ({sheet_sql(sheet)}),
scan_{sheet} as (
  select k.ticker, k.Metrics, p.fiscal_period, s.value
  from (select distinct ticker, Metrics from sheet_{sheet}) k
  cross join (select distinct fiscal_period from sheet_{sheet}) p
  left join sheet_{sheet} s on s.ticker = k.ticker and s.Metrics = k.Metrics and s.fiscal_period = p.fiscal_period)
"""


COMPANIES_CTE = """
co as (
  select s_suppkey ticker, s_name company_name, n_name sector, cast(null as varchar) industry,
    cast(round(s_acctbal * 1000) as bigint) market_cap
  from supplier left join nation on s_nationkey = n_nationkey where s_acctbal >= 0)
"""

STATEMENT_COLS = ("ticker, fiscal_period, period_type, revenue, cost_of_revenue, gross_profit, operating_expenses, "
                  "operating_income, net_income, eps, total_assets, total_liabilities, total_equity, current_assets, "
                  "current_liabilities, cash, total_debt, operating_cash_flow, "
                  "cast(operating_cash_flow - free_cash_flow as decimal(10,4)) capex, free_cash_flow")
INCOME_COLS = ("ticker, fiscal_period, period_type, revenue, cost_of_revenue, gross_profit, operating_expenses, "
               "operating_income, net_income, eps")
BALANCE_COLS = "total_assets, total_liabilities, total_equity, current_assets, current_liabilities, cash, total_debt"
INCOME_REGEX = "(?i)Revenue|Cost of revenue|Gross Profit|Operating Expenses|Operating Income|Net Income|eps"
FEED_COLS = ('snap_date "date", act_symbol, l_orderkey, l_linenumber, period, period_end_date, consensus, '
             'num "count", high, low')
POSITION_CTES = """
sp as (select ticker, fiscal_period, eps,
         row_number() over (order by ticker, right(fiscal_period,4), left(fiscal_period,2), fiscal_period) position
       from financial_statements),
ep as (select e.ticker est_ticker, e.fiscal_period est_fiscal_period, consensus_eps,
         row_number() over (order by -e.ticker, right(e.fiscal_period,4), left(e.fiscal_period,2), e.fiscal_period) position
       from analyst_estimates e join supplier on s_suppkey = e.ticker)
"""

ORACLES: dict[str, str] = {}


def register(key: str, sql: str) -> None:
    ORACLES[key] = sql


# 2.1 sources / sinks
for _s in ("income", "balance", "cash"):
    # every file holds the quarters of its own company
    register(f"scan_wide_{_s}", q(f"select cast(ticker as varchar) ticker, Metrics, fiscal_period, value from sheet_{_s}", scan_cte(_s)))
register("derived_metric_pick", q(
    "select ticker, case Metrics when 'EPS (Diluted)' then 'eps' when 'Free Cash Flow' then 'free_cash_flow' "
    "else Metrics end Metrics, fiscal_period, value from scan_derived "
    "where Metrics in ('EPS (Diluted)', 'Free Cash Flow', 'Total Debt')", scan_cte("derived")))
register("scan_estimates", q(
    'select snap_date "date", cast(act_symbol as varchar) act_symbol, period, period_end_date, consensus, '
    'cast(num as integer) "count", high, low from eps_estimate'))
SEEDED = """
raw as (
  select l_orderkey % 97 k, l_orderkey % 2 part, cast(snap_date as varchar) "date", cast(act_symbol as varchar) act_symbol,
    case when l_orderkey % 97 = 7 then concat(period, ', late') else period end period,
    case when l_orderkey % 97 in (4, 5) then strftime(period_end_date, '%m/%d/%Y') else cast(period_end_date as varchar) end period_end_date,
    case l_orderkey % 97 when 3 then 'oops' when 4 then '1234567.5' else cast(consensus as varchar) end consensus,
    concat(cast(num as varchar), case l_orderkey % 97 when 1 then '.0' when 2 then '.5' else '' end) "count",
    case when l_orderkey % 97 = 6 then 'n/a' else cast(high as varchar) end high, cast(low as varchar) low,
    snap_date, period_end_date ped, consensus c, num, high h, low l
  from eps_estimate)
"""
register("feed_accepted", q(
    """select snap_date "date", act_symbol, period, ped period_end_date, c consensus, cast(num as integer) "count",
      case when k <> 6 then h end high, l low from raw where k not in (2, 3, 4, 5, 7)""", SEEDED))
register("feed_violations", q(
    """select concat_ws('|', "date", act_symbol, period, period_end_date, consensus, '', "count", high, low, '') record,
      unnest(case k when 2 then ['count'] when 3 then ['consensus'] when 4 then ['consensus', 'period_end_date'] when 5 then ['period_end_date'] else [] end) "column",
      unnest(case k when 2 then ['whole number'] when 3 then ['number'] when 4 then ['decimal(10,4)', 'date'] when 5 then ['date'] else [] end) rule,
      unnest(case k when 2 then ["count"] when 3 then ['oops'] when 4 then ['1234567.5', period_end_date] when 5 then [period_end_date] else [] end) "value"
    from raw where k in (2, 3, 4, 5)
    union all
    select null, null, 'cells', case part when 0 then concat("date", ',', act_symbol, ',', period, ',', period_end_date, ',', consensus, ',,', "count", ',', high, ',', low, ',')
      else concat(',', low, ',', high, ',', "count", ',,', consensus, ',', period_end_date, ',', period, ',', act_symbol, ',', "date") end from raw where k = 7""", SEEDED))
register("sink_statements", q(f"select cast(ticker as varchar) ticker, * exclude (ticker) from "
                              f"(select {STATEMENT_COLS} from financial_statements)"))
register("sink_estimates", q("select * from analyst_estimates"))
register("export_matrix", q(
    "select cast(ticker as varchar) ticker, fiscal_period, "
    + ", ".join(f"cast({c} as double) {c}" for c in FEATURES)
    + ", eps_status, cast(eps_surprise as double) eps_surprise from matrix", FEAT))
register("idempotent_reload", ORACLES["sink_statements"])
register("matrix_violations", q(
    """select cast(ticker as varchar) ticker, fiscal_period, unnest(['roe', 'cash_ratio']) "column", 'number' rule, unnest(['#DIV/0!', '1.2.3']) "value"
    from matrix where left(fiscal_period, 2) = 'Q2'""", FEAT))
register("snapshot_reload", ORACLES["sink_statements"])
PROFILES_CTE = """
companies as (
  select s_suppkey ticker, s_name company_name, n_name sector, cast(null as varchar) industry, cast(round(s_acctbal*1000) as bigint) market_cap
  from supplier left join nation on s_nationkey = n_nationkey where s_acctbal >= 0)
"""
register("seed_stored", q(
    """select * from companies union all
    select s_suppkey, case when s_suppkey % 2 = 1 or s_suppkey not in (select ticker from financial_statements) then s_name end, null, null, null
    from supplier where s_suppkey not in (select ticker from companies)""", PROFILES_CTE))
register("update_stored", q(
    f"""select f.ticker, f.fiscal_period, {', '.join('f.' + c for c in FEATURES)},
      case when e.ticker is not null then 'restated' else f.eps_status end eps_status,
      case when e.ticker is not null then e.consensus_eps else f.eps_surprise end eps_surprise, cast(right(f.fiscal_period, 4) as integer) "year"
    from features f left join analyst_estimates e on e.ticker = f.ticker and e.fiscal_period = f.fiscal_period
      and right(e.fiscal_period, 4) in ('1998', '1999') and left(e.fiscal_period, 2) = 'Q2'""", GROWTH_CTES))
LOAD_CTE = PROFILES_CTE.strip() + """,
seeded0 as (
  select ticker, case when right(fiscal_period, 4) = '1997' then concat('FY ', fiscal_period) when fiscal_period = 'Q3 1998' then concat(fiscal_period, ' (a)') else fiscal_period end fiscal_period,
    case when fiscal_period = 'Q2 1999' then 0 else revenue end revenue, total_assets, total_liabilities, current_liabilities,
    case when fiscal_period = 'Q4 1999' then 1000000 else total_debt end total_debt
  from financial_statements),
seeded as (select * from seeded0 union all select * from seeded0 where fiscal_period = 'Q1 1996'),
looked as (
  select *, count(*) over (partition by ticker, fiscal_period) copies,
    lag(revenue, 1) over (partition by ticker order by right(fiscal_period, 4), left(fiscal_period, 2), fiscal_period) r1,
    lag(revenue, 4) over (partition by ticker order by right(fiscal_period, 4), left(fiscal_period, 2), fiscal_period) r4
  from seeded),
judged as (
  select ticker, fiscal_period, copies > 1 r_dup, ticker not in (select ticker from companies) r_fk, length(fiscal_period) > 10 r_len, total_debt >= 1000000 r_dec,
    not regexp_full_match(fiscal_period, 'Q[1-4] [0-9]{4}') r_per,
    coalesce(revenue = 0, false) or coalesce(total_assets = 0, false) or coalesce(total_assets - total_liabilities = 0, false) or coalesce(current_liabilities = 0, false)
      or coalesce(r1 = 0, false) or coalesce(r4 = 0, false) r_zero
  from looked)
"""
register("load_report", q(
    """select 'rows' rule, count(*) n_rows from judged union all
    select 'loaded', count(*) filter (not (r_dup or r_fk or r_len or r_dec or r_per or r_zero)) from judged union all
    select 'duplicate key', count(*) filter (r_dup) from judged union all select 'unknown ticker', count(*) filter (r_fk) from judged union all
    select 'varchar length', count(*) filter (r_len) from judged union all select 'decimal range', count(*) filter (r_dec) from judged union all
    select 'bad period', count(*) filter (r_per) from judged union all select 'zero denominator', count(*) filter (r_zero) from judged""", LOAD_CTE))
register("load_quarantine", q(
    """select ticker, fiscal_period, concat_ws(',', case when r_dup then 'duplicate key' end, case when r_fk then 'unknown ticker' end, case when r_len then 'varchar length' end,
      case when r_dec then 'decimal range' end, case when r_per then 'bad period' end, case when r_zero then 'zero denominator' end) rules
    from judged where r_dup or r_fk or r_len or r_dec or r_per or r_zero""", LOAD_CTE))
CALENDAR_CTE = """
gapped as (
  select ticker, fiscal_period, revenue, cast(right(fiscal_period, 4) as integer) * 4 + cast(substr(fiscal_period, 2, 1) as integer) - 1 n
  from financial_statements),
kept as (select * from gapped where (ticker * 7 + n) % 11 <> 0),
back as (
  select k.ticker, k.fiscal_period, k.revenue, a.revenue r1, b.revenue r4, c.revenue r8
  from kept k left join kept a on a.ticker = k.ticker and a.n = k.n - 1 left join kept b on b.ticker = k.ticker and b.n = k.n - 4
    left join kept c on c.ticker = k.ticker and c.n = k.n - 8)
"""
register("growth_calendar", q(
    f"select ticker, fiscal_period, {dec(pct('revenue', 'r1'))} qoq_rev, {dec(pct('revenue', 'r4'))} yoy_rev, "
    f"{dec(pct('revenue', 'r4') + ' - ' + pct('r4', 'r8'))} momentum from back", CALENDAR_CTE))
register("split_by_year", q(
    "select cast(ticker as varchar) ticker, fiscal_period, " + ", ".join(f"cast({c} as double) {c}" for c in FEATURES)
    + f", eps_status, cast(eps_surprise as double) eps_surprise, split from (select *, {SPLIT_CASE} split from matrix) "
    "where split is not null", FEAT))
register("seed_upsert_new", q(
    "select * from co union all select distinct ticker, null, null, null, null from financial_statements "
    "where ticker not in (select ticker from co)", COMPANIES_CTE))
register("feature_skeleton", q("select ticker, fiscal_period from financial_statements"))
register("schema_conform", ORACLES["sink_statements"])

# 2.2 quality
register("dup_keys", q("select act_symbol, period, period_end_date, count(*) n_rows from eps_estimate "
                       "group by act_symbol, period, period_end_date having count(*) > 1"))
register("fk_orphans", q("select ticker, fiscal_period from financial_statements where fiscal_period <> 'Q1 1996' "
                         "and ticker not in (select ticker from co)", COMPANIES_CTE))
_base_cols = ["rev", "qty", "tax", "dsc", "ext", "opn", "fa", "fn", "fr"]
register("domain_violations", q("\nunion all ".join(
    f"select ticker, fiscal_period, '{c}' \"column\", 'decimal(10,4) range' rule, cast({c} as double) value "
    f"from base where abs({c}) >= 1000000" for c in _base_cols)))
register("overflow_violations", q("\nunion all ".join(
    f"select ticker, fiscal_period, '{c}' \"column\", cast({c} * 1000 as double) value from financial_statements "
    f"where abs({c} * 1000) >= 1000000" for c in fx.STATEMENT_FORMULAS)))
register("bad_periods", q(
    "select * from (select 'financial_statements' source, ticker, case when right(fiscal_period, 4) = '1997' then 'FY 1997' "
    "else fiscal_period end fiscal_period from financial_statements union all select 'analyst_estimates', ticker, "
    "case when fiscal_period = 'Q4 1998' then 'Q5 1998' else fiscal_period end from analyst_estimates) "
    "where not coalesce(regexp_matches(fiscal_period, '^Q[1-4] [0-9]{4}$'), false)"))
register("zero_denominators", q(f"""
select ticker, fiscal_period, 'revenue' denominator from zs where revenue = 0
union all select ticker, fiscal_period, 'total_assets' from zs where total_assets = 0
union all select ticker, fiscal_period, 'total_assets - total_liabilities' from zs where total_assets - total_liabilities = 0
union all select ticker, fiscal_period, 'current_liabilities' from zs where current_liabilities = 0
union all select ticker, fiscal_period, 'revenue lag 1' from zs where r1 = 0
union all select ticker, fiscal_period, 'revenue lag 4' from zs where r4 = 0
union all select ticker, fiscal_period, 'consensus_eps' from ze where consensus_eps = 0
union all select ticker, fiscal_period, 'consensus_eps lag 1' from ze where c1 = 0
union all select ticker, fiscal_period, 'consensus_eps lag 4' from ze where c4 = 0
""", f"""
zs as (select *, lag(revenue, 1) over {W} r1, lag(revenue, 4) over {W} r4 from financial_statements),
ze as (select *, lag(consensus_eps, 1) over {W} c1, lag(consensus_eps, 4) over {W} c4 from analyst_estimates)
"""))

# 2.3 reshape
register("dropna_any", q("""
select d.ticker, d.Metrics, d.fiscal_period, d.value from scan_income d
join (select ticker, Metrics, count(value) n from scan_income group by ticker, Metrics) pm
  on pm.ticker = d.ticker and pm.Metrics = d.Metrics
join (select ticker, count(distinct fiscal_period) np from scan_income where value is not null group by ticker) pt
  on pt.ticker = d.ticker
where pm.n = pt.np""", scan_cte("income")))
register("append_by_name", q(
    "select ticker, Metrics, fiscal_period, value, cast(null as varchar) sheet from scan_income union all "
    "select ticker, 'eps', fiscal_period, value, 'derived' from scan_derived where Metrics = 'EPS (Diluted)'",
    scan_cte("income") + "," + scan_cte("derived")))
register("transpose_income", q(f"select {INCOME_COLS} from financial_statements"))
register("transpose_balance", q(f"select ticker, fiscal_period, {BALANCE_COLS} from financial_statements"))
register("transpose_cash", q("select ticker, fiscal_period, operating_cash_flow, cast(0 as decimal(10,4)) capex, "
                             "free_cash_flow from financial_statements"))
register("metric_rename", q(
    "select ticker, case Metrics when 'Revenue' then 'revenue' when 'Cost of revenue' then 'cost_of_revenue' "
    "when 'Gross Profit' then 'gross_profit' when 'Operating Expenses' then 'operating_expenses' "
    "when 'Operating Income (Loss)' then 'operating_income' when 'Net Income' then 'net_income' else Metrics end "
    "Metrics, fiscal_period, value from scan_income", scan_cte("income")))
register("statement_projection", q(f"select {INCOME_COLS} from financial_statements"))
register("statement_projection_missing", q(
    "select ticker, fiscal_period, net_income, operating_income, case when ticker % 3 <> 0 then operating_expenses end operating_expenses, "
    "gross_profit, cost_of_revenue, revenue from financial_statements"))
register("period_type", q("select ticker, fiscal_period, left(fiscal_period, 2) period_type from financial_statements"))
register("period_parts", q(
    "select ticker, fiscal_period, right(fiscal_period, 4) year_text, left(fiscal_period, 2) quarter_text, "
    "cast(split_part(fiscal_period, ' ', 2) as integer) as year, cast(substr(fiscal_period, 2, 1) as integer) as quarter "
    "from financial_statements"))
register("capex", q("select ticker, fiscal_period, cast(operating_cash_flow - free_cash_flow as decimal(10,4)) capex "
                    "from financial_statements"))

# 2.4 filters
register("metric_regex_filter", q(f"select * from scan_income where regexp_matches(Metrics, '{INCOME_REGEX}')",
                                  scan_cte("income")))
register("estimate_filter", q(
    f"select {FEED_COLS} from eps_estimate where period = 'Current Quarter' "
    "and period_end_date > date '1994-12-31' and period_end_date < date '2001-10-31'"))
register("estimate_filter_clustered", q(
    f"select {FEED_COLS} from eps_estimate where period = 'Current Quarter' and act_symbol in (1, 2, 3) "
    "and period_end_date > date '1996-12-31' and period_end_date < date '1999-01-01'"))
register("universe_semi", q("select ticker, fiscal_period from financial_statements "
                            "where ticker in (select ticker from co)", COMPANIES_CTE))
register("split_by_target", q("""
select ticker, fiscal_period target_period, cast(eps_status as double) label,
  case when year < 1999 or (year = 1999 and quarter < 3) then 'train'
       when year < 2000 or (year = 2000 and quarter < 1) then 'val' else 'test' end split
from sq where rn > 4""", SEQ_CTE))

# 2.5 joins
register("join_income_balance", q(f"select {INCOME_COLS}, {BALANCE_COLS} from financial_statements"))
register("financial_statements", q(f"select {STATEMENT_COLS} from financial_statements"))
register("eps_compare_key", q(
    "select s.ticker, s.fiscal_period, s.eps, e.consensus_eps, e.ticker is not null matched "
    "from financial_statements s left join analyst_estimates e "
    "on s.ticker = e.ticker and s.fiscal_period = e.fiscal_period"))
register("eps_compare_position", q(
    "select position, ticker, fiscal_period, eps, est_ticker, est_fiscal_period, consensus_eps "
    "from sp join ep using (position)", POSITION_CTES))
register("feature_matrix", q("select * from matrix", FEAT))
register("feature_matrix_estimate_keys", q(
    "select ae.ticker, ae.fiscal_period, " + ", ".join("m." + c for c in FEATURES) + ", m.eps_status, m.eps_surprise "
    "from analyst_estimates ae right join matrix m on right(ae.fiscal_period, 4) = right(m.fiscal_period, 4) "
    "and left(ae.fiscal_period, 2) = left(m.fiscal_period, 2) and ae.ticker = m.ticker", FEAT))
register("update_from", q("""
select s.ticker, s.fiscal_period, p.consensus, p.num "count"
from financial_statements s left join p on s.ticker = p.ticker and s.fiscal_period = p.fiscal_period and p.rn = 1""", """
f as (select act_symbol ticker,
        concat('Q', cast(quarter(period_end_date) as varchar(10)), ' ', cast(year(period_end_date) as varchar(10))) fiscal_period,
        snap_date, l_orderkey, l_linenumber, consensus, num from eps_estimate),
p as (select *, row_number() over (partition by ticker, fiscal_period
        order by snap_date, l_orderkey, l_linenumber, consensus, num) rn from f)
"""))
register("features_all", q("select * from features", GROWTH_CTES))
register("features_sql", ORACLES["features_all"])
register("matrix_sql", q("select * from matrix where cast(right(fiscal_period, 4) as integer) between 1997 and 1999", FEAT))
register("features_position_aligned", q(f"""
select f.ticker, f.fiscal_period, {', '.join('f.' + c for c in FEATURES)}, pf.eps_status, pf.eps_surprise
from features f left join pf on f.ticker = pf.ticker and f.fiscal_period = pf.fiscal_period""",
    GROWTH_CTES.strip() + "," + POSITION_CTES + f""",
pf as (select s.ticker, s.fiscal_period, case when s.eps > e.consensus_eps then 'beat' else 'miss' end eps_status,
         {dec(pct('s.eps', 'e.consensus_eps'))} eps_surprise
       from sp s join ep e using (position))
"""))

# 2.6 aggregations
register("distinct_tickers", q("select distinct ticker from financial_statements"))
register("first_snapshot", q(f"select {FEED_COLS} from first_snap where rn = 1"))
register("accuracy_by_split", q(
    "select split, count(*) n, round(avg(case when prediction = label then cast(1 as double) "
    "else cast(0 as double) end) * 100, 6) accuracy from predicted group by split", ROWS_CTE))
register("bce_by_split", q(
    "select split, count(*) n, round(avg(greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))), 6) bce "
    "from predicted group by split", ROWS_CTE))

# 2.7 windows
register("lag_revenue_1", q(f"select ticker, fiscal_period, revenue, lag(revenue, 1) over {W} prev_revenue "
                            "from financial_statements"))
register("lag_revenue_4", q(f"select ticker, fiscal_period, revenue, lag(revenue, 4) over {W} revenue_4_back "
                            "from financial_statements"))
register("lag_consensus_1", q(f"select ticker, fiscal_period, consensus_eps, lag(consensus_eps, 1) over {W} "
                              "prev_consensus from analyst_estimates"))
register("lag_consensus_4", q(f"select ticker, fiscal_period, consensus_eps, lag(consensus_eps, 4) over {W} "
                              "consensus_4_back from analyst_estimates"))
register("momentum", q("select ticker, fiscal_period, momentum from sg", GROWTH_CTES))
register("quarter_number", q(
    "select act_symbol ticker, period_end_date, cast(year(period_end_date) as integer) as year, cast(row_number() over "
    "(partition by act_symbol, year(period_end_date) order by period_end_date) as integer) quarter_num "
    "from first_snap where rn = 1"))
register("quarter_number_appearance", q(
    "select act_symbol ticker, period_end_date, cast(year(period_end_date) as integer) as year, cast(row_number() "
    "over (partition by act_symbol, year(period_end_date) order by snap_date, period_end_date) as integer) quarter_num "
    "from first_snap where rn = 1"))
register("sequence_dataset", q(f"""
select cast(t.ticker as varchar) ticker, t.fiscal_period target_period, t.year, t.quarter, t.eps_status label, cast(s.rn - t.rn + 5 as integer) step,
  {', '.join(f'cast(s.{c} as double) {c}' for c in FEATURES)}
from sq t join sq s on s.ticker = t.ticker and s.rn between t.rn - 4 and t.rn - 1
where t.rn > 4""", SEQ_CTE))

# 2.8 sorts
register("ordered_statements", q(
    "select ticker, fiscal_period, row_number() over (order by ticker, right(fiscal_period,4), "
    "left(fiscal_period,2), fiscal_period) load_position from financial_statements"))

# 2.9 set operations
register("union_all_by_name", q(
    "select *, 'income' sheet from scan_income union all select *, 'balance' from scan_balance "
    "union all select *, 'cash' from scan_cash",
    scan_cte("income") + "," + scan_cte("balance") + "," + scan_cte("cash")))

# 2.10 scalar functions
register("quarter_label", q(
    "select act_symbol ticker, period_end_date, concat('Q', cast(row_number() over (partition by act_symbol, "
    "year(period_end_date) order by period_end_date) as varchar(10)), ' ', cast(year(period_end_date) as varchar(10))) "
    "fiscal_period from first_snap where rn = 1"))
register("eps_status", q("select ticker, fiscal_period, eps_status from features", GROWTH_CTES))
register("eps_surprise", q("select ticker, fiscal_period, eps_surprise from features", GROWTH_CTES))
register("final_label", q("select ticker, fiscal_period, eps_status from matrix", FEAT))
register("predict_from_logit", q(
    "select ticker, fiscal_period, logit, round(1 / (1 + exp(-logit)), 6) probability, prediction from predicted",
    ROWS_CTE))

# 2.11 domain features
register("analyst_estimates", q("select * from analyst_estimates"))
for _f in ("qoq_rev", "yoy_rev"):
    register(_f, q(f"select ticker, fiscal_period, {_f} from sg", GROWTH_CTES))
for _f in ("qoq_eps", "yoy_eps"):
    register(_f, q(f"select s.ticker, s.fiscal_period, e.{_f} from financial_statements s left join eg e "
                   "on s.ticker = e.ticker and s.fiscal_period = e.fiscal_period", GROWTH_CTES))
for _f in RATIOS:
    register(_f, q(f"select ticker, fiscal_period, {_f} from sg", GROWTH_CTES))

# 2.12 datasets
register("row_dataset", q("select cast(ticker as varchar) ticker, cast(eps_surprise as double) eps_surprise, "
                          "* exclude (ticker, eps_surprise) from rows_ds", ROWS_CTE))
register("row_dataset_float32", q(
    "select ticker, fiscal_period, split, cast(label as double) as label, " + ", ".join(f"cast({c} as float) {c}" for c in FEATURES) + " from rows_ds", ROWS_CTE))
register("mlp_predictions", q("select ticker, fiscal_period, split, label, true in_range, true consistent from rows_ds "
                              "where split <> 'train'", ROWS_CTE))
register("null_feature_rows", q(
    "select ticker, fiscal_period, " + " + ".join(f"cast({c} is null as integer)" for c in FEATURES)
    + " n_null_features from matrix where " + " or ".join(f"{c} is null" for c in FEATURES), FEAT))
register("sequence_increment", f"select * replace (cast(ticker as bigint) as ticker) from ({ORACLES['sequence_dataset']})")
SEQ_ROWS_CTE = SEQ_CTE.rstrip() + f""",
seq_rows as (
  select t.ticker, t.fiscal_period, cast(t.eps_status as double) label,
    case when t.year < 1999 or (t.year = 1999 and t.quarter < 3) then 'train'
         when t.year < 2000 or (t.year = 2000 and t.quarter < 1) then 'val' else 'test' end split,
    count(*) filter (where {' and '.join(f's.{c} is not null' for c in FEATURES)}) full_rows
  from sq t join sq s on s.ticker = t.ticker and s.rn between t.rn - 4 and t.rn - 1
  where t.rn > 4 group by t.ticker, t.fiscal_period, t.eps_status, t.year, t.quarter)
"""
register("sequence_predictions", q(
    "select ticker, fiscal_period target_period, split, label, true in_range, true consistent from seq_rows "
    "where full_rows = 4 and label is not null and split <> 'train'", SEQ_ROWS_CTE))
register("model_splits", q(
    """select 'row' model, split, count(*) n, cast(sum(label) as bigint) n_beat, count(*) n_scored from rows_ds group by split union all
    select 'sequence', split, count(*), cast(sum(label) as bigint), count(*) from seq_rows where full_rows = 4 and label is not null group by split""",
    ROWS_CTE.rstrip() + SEQ_ROWS_CTE[len(FEAT):]))
# 13-16-8-2 and 52-15-2 with biases
register("parameter_count", "select 'row' model, 378 parameters union all select 'sequence', 827")
