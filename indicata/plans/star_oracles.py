"""SQL for the registered queries, written the long way round.

The SQL does not follow the library's plans: it joins rows before averaging them, counts every
condition apart and joins the counts, and joins the ten countries one by one. Equal results thus check
the plans' rewrites as well as their values.
"""

from __future__ import annotations

from indicata.functions import fixed_values as V
from indicata.sources import star_views as S


def _list(items: list) -> str:
    cells = [f"'{item.replace(chr(39), chr(39) * 2)}'" if isinstance(item, str) else str(item) for item in items]
    return f"([{', '.join(cells)}])"


def _brand(labels: list[str]) -> str:
    return f"{_list(labels)}[CAST(substr(p_brand, 7, 3) AS INT)]"


def _type(labels: list[str]) -> str:
    return f"{_list(labels)}[list_position({_list(S.PART_TYPES)}, p_type)]"


def _priority(labels: list[str]) -> str:
    return f"{_list(labels)}[CAST(substr(o_orderpriority, 1, 1) AS INT)]"


def _month(date: str, shift: int = S.MONTH_SHIFT) -> str:
    return f"CAST(year({date}) + {shift} AS VARCHAR) || '-' || lpad(CAST(month({date}) AS VARCHAR), 2, '0')"


_PLACE = f"nullif({_list(S.PLACES)}[n_nationkey + 1], '')"
_LINES = "lineitem JOIN part ON l_partkey = p_partkey"

VIEWS = {
    "gdp": f"""SELECT {_month('l_shipdate')} AS ref_date,
        CASE l_returnflag WHEN 'A' THEN 'Seasonally adjusted at annual rates'
             WHEN 'R' THEN 'Trading-day adjusted' ELSE 'Unadjusted' END AS adj,
        CASE l_linestatus WHEN 'F' THEN 'Chained (2012) dollars' ELSE '2012 constant prices' END AS prices,
        {_brand(S.GDP_INDUSTRIES)} AS naics,
        CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_extendedprice / 1000) AS INT) END AS value
        FROM {_LINES}""",
    "trade": f"""SELECT {_month('l_shipdate')} AS ref_date,
        CASE l_linestatus WHEN 'F' THEN 'Import' ELSE 'Export' END AS trade,
        CASE l_returnflag WHEN 'A' THEN 'Customs' ELSE 'Balance of payments' END AS basis,
        CASE WHEN l_discount < 0.03 THEN 'Unadjusted' ELSE 'Seasonally adjusted' END AS adj,
        {_type(S.TRADE_PRODUCTS)} AS napcs,
        CASE WHEN l_linenumber <> 7 THEN floor(l_extendedprice / 1000) END AS value
        FROM {_LINES}""",
    "hours": f"""SELECT {_month('l_shipdate')} AS ref_date, {_brand(S.HOURS_INDUSTRIES)} AS naics,
        CASE l_returnflag WHEN 'N' THEN 'Standard error' ELSE 'Estimate' END AS stat,
        CASE WHEN l_linenumber <> 6 THEN l_extendedprice / 100 END AS value
        FROM {_LINES}""",
    "retail": f"""SELECT {_month('l_shipdate')} AS ref_date, {_PLACE} AS geo, {_type(S.RETAIL_INDUSTRIES)} AS naics,
        CASE l_returnflag WHEN 'N' THEN 'Unadjusted' ELSE 'Seasonally adjusted' END AS adj,
        CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_extendedprice) AS INT) END AS value
        FROM {_LINES} JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "cpi": f"""SELECT {_month('o_orderdate')} AS ref_date, {_PLACE} AS geo,
        {_priority(S.PRODUCT_GROUPS)} AS product, floor(o_totalprice / 1000) AS value
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "tsx": f"""SELECT {_month('o_orderdate')} AS ref_date, {_priority(S.TSX_STATISTICS)} AS statistic,
        CASE o_orderstatus WHEN 'P' THEN 'Dollars' ELSE 'Index' END AS uom,
        floor(o_totalprice / 1000) - 50 AS value FROM orders""",
    "tsx_totals": """SELECT CAST(ref_date || '-01' AS DATE) AS month, statistic, sum(value) AS total
        FROM tsx WHERE uom = 'Index' AND value > 0 GROUP BY ALL""",
    "leads": f"""SELECT {_month('o_orderdate', S.BASE_YEAR_SHIFT)} AS ref_date,
        {_priority(S.LEADING_INDICATORS)} AS indicator,
        CASE o_orderstatus WHEN 'O' THEN 'Unsmoothed' ELSE 'Smoothed' END AS composite,
        floor(o_totalprice / 1000) - 100 AS value FROM orders""",
    "spending": f"""SELECT {_month("date_trunc('quarter', l_shipdate)")} AS ref_date,
        CASE l_linestatus WHEN 'F' THEN 'Current prices' ELSE '2012 constant prices' END AS prices,
        CASE l_returnflag WHEN 'A' THEN 'Unadjusted' ELSE 'Seasonally adjusted at quarterly rates' END AS adj,
        CASE WHEN l_linenumber <= 3 THEN 'Household final consumption expenditure' ELSE 'Goods' END AS estimates,
        CASE WHEN l_quantity < 50 THEN CAST(floor(l_extendedprice) AS INT) END AS value FROM lineitem""",
    "stock": f"""SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN {_month('o_orderdate')} END AS ref_date,
        floor(o_totalprice / 100) AS high, floor(o_totalprice / 1000) AS low, floor(o_totalprice) AS volume
        FROM orders""",
    "stock_means": """SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, avg(volume) AS avg_stock_traded,
        avg(high) AS avg_highest_stock, avg(low) AS avg_lowest_stock FROM stock
        WHERE ref_date BETWEEN '2010-01' AND '2020-10' GROUP BY 1""",
    "codes": """SELECT o_orderkey AS case_identifier_number,
        CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 7
             ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS region,
        ([9, 1, 2])[o_custkey % 3 + 1] AS gender,
        CASE WHEN floor(o_totalprice / 50000) > 8 THEN 99 ELSE CAST(floor(o_totalprice / 50000) AS INT) END AS age_group,
        ([1, 2, 3, 4, 9])[month(o_orderdate) % 5 + 1] AS occupation,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS transmission,
        ([1, 2, 3, 9])[day(o_orderdate) % 4 + 1] AS hospital_status,
        CASE WHEN month(o_orderdate) = 2 AND o_orderstatus = 'P' THEN NULL
             ELSE CAST(dayofyear(o_orderdate) // 7 + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS INT)
             END AS episode_week,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(dayofyear(o_orderdate) // 7
             + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END + 2 AS INT) END AS recovery_week,
        ([9, 1, 2])[day(o_orderdate) % 3 + 1] AS asymptomatic,
        CASE o_orderstatus WHEN 'P' THEN 9 ELSE CAST(o_custkey % 2 + 1 AS INT) END AS recovered,
        CASE WHEN month(o_orderdate) % 4 = 1 THEN 1 ELSE 2 END AS death
        FROM orders""",
}


def _decode(column: str, known: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {code} THEN '{label}'" for code, label in known.items())
    return f"CASE {column} {whens} END"


def _boolean(column: str) -> str:
    return f"CASE {column} WHEN 1 THEN TRUE WHEN 2 THEN FALSE END"


def _week(column: str) -> str:
    """The month of a week, from the published table of weeks; stated here apart from the library's."""
    return f"""CASE WHEN {column} BETWEEN 0 AND 4 THEN '2020-01' WHEN {column} BETWEEN 5 AND 8 THEN '2020-02'
        WHEN {column} BETWEEN 9 AND 12 THEN '2020-03' WHEN {column} BETWEEN 13 AND 17 THEN '2020-04'
        WHEN {column} BETWEEN 18 AND 21 THEN '2020-05' WHEN {column} BETWEEN 22 AND 25 THEN '2020-06'
        WHEN {column} BETWEEN 26 AND 30 THEN '2020-07' WHEN {column} BETWEEN 31 AND 34 THEN '2020-08'
        WHEN {column} BETWEEN 35 AND 38 THEN '2020-09' WHEN {column} BETWEEN 39 AND 43 THEN '2020-10'
        WHEN {column} BETWEEN 44 AND 47 THEN '2020-11' WHEN {column} BETWEEN 48 AND 52 THEN '2020-12' END"""


_CODED = {name.lower().replace(" ", "_"): known for name, known in V.CASE_CODES.items()}
_LABELS = ", ".join(f"{_decode(name, known)} AS {name}" for name, known in _CODED.items())
_BOOLEANS = ", ".join(f"{_boolean(name.lower())} AS {name.lower()}" for name in V.BOOLEAN_ATTRIBUTES)
_MONTHS = f"{_week('episode_week')} AS episode_month, {_week('recovery_week')} AS recovery_month"
_ATTRIBUTES = [name.lower().replace(" ", "_") for name in V.CASE_ATTRIBUTES]

VIEWS["eav"] = " UNION ALL ".join(
    f"SELECT case_identifier_number, '{name}' AS attribute, {name} AS value FROM codes" for name in _ATTRIBUTES
)
VIEWS["wide"] = (
    "SELECT case_identifier_number, "
    + ", ".join(f"max(value) FILTER (WHERE attribute = '{name}') AS {name}" for name in _ATTRIBUTES)
    + " FROM eav GROUP BY case_identifier_number"
)
VIEWS["cases"] = (
    f"SELECT case_identifier_number, episode_week, recovery_week, {_MONTHS}, {_LABELS}, {_BOOLEANS} FROM wide"
)

_AGES = [(label, label.replace("-", "_")) for label in V.CASE_CODES["Age group"].values()]
_AGES = [(label, "80" if label.startswith("80") else name.lower().replace(" ", "_")) for label, name in _AGES]
_AGE_FILTERS = ", ".join(f"count(*) FILTER (WHERE age_group = '{label}') AS \"{name}\"" for label, name in _AGES)
_AGE_COLUMNS = ", ".join(f"coalesce(\"{name}\", 0) AS \"{name}\"" for _, name in _AGES)


def _weekly(name: str, condition: str, week: str = "episode_week") -> str:
    return f"(SELECT {week} AS w, region AS r, count(*) AS {name} FROM cases WHERE {condition} GROUP BY 1, 2)"


_PROVINCIAL = f"""SELECT coalesce(n.w, 0) AS week_number, n.r AS region, total_new_cases,
    coalesce(recovered_cases, 0) AS recovered_cases, coalesce(deaths, 0) AS deaths, {_AGE_COLUMNS},
    coalesce(international_transmissions, 0) AS international_transmissions,
    coalesce(asymptomatic_cases, 0) AS asymptomatic_cases
    FROM {_weekly('total_new_cases', 'TRUE')} n
    LEFT JOIN {_weekly('recovered_cases', 'recovered', 'recovery_week')} a ON n.w = a.w AND n.r = a.r
    LEFT JOIN {_weekly('deaths', 'death')} b ON n.w = b.w AND n.r = b.r
    LEFT JOIN (SELECT episode_week AS w, region AS r, {_AGE_FILTERS} FROM cases GROUP BY 1, 2) c
        ON n.w = c.w AND n.r = c.r
    LEFT JOIN {_weekly('international_transmissions', "transmission LIKE '%International%travel%'")} d
        ON n.w = d.w AND n.r = d.r
    LEFT JOIN {_weekly('asymptomatic_cases', 'asymptomatic')} e ON n.w = e.w AND n.r = e.r"""


def _monthly(name: str, condition: str, month: str = "episode_month") -> str:
    return f"(SELECT {month} AS m, count(*) AS {name} FROM cases WHERE {condition} GROUP BY 1)"


_STATUSES = list(zip(V.CASE_CODES["Hospital status"].values(), ["icu", "ward", "not_hospitalized", "unknown_status"]))
_TREND = f"""SELECT n.m AS month, new_cases, recovered_cases, deaths,
    {', '.join(name for _, name in _STATUSES)}, workers
    FROM {_monthly('new_cases', 'TRUE')} n
    LEFT JOIN {_monthly('recovered_cases', 'recovered', 'recovery_month')} a ON n.m = a.m
    LEFT JOIN {_monthly('deaths', 'death')} b ON n.m = b.m
    JOIN (SELECT episode_month AS m, {', '.join(
        f"nullif(count(*) FILTER (WHERE hospital_status = '{label}'), 0) AS {name}" for label, name in _STATUSES)}
        FROM cases GROUP BY 1) c ON n.m = c.m
    LEFT JOIN {_monthly('workers', "occupation = 'Health care worker'")} d ON n.m = d.m"""
VIEWS["trend"] = _TREND

_CANNABIS = ", ".join(f"'{name}'" for name in V.CANNABIS_INDUSTRIES)
_DECADE = "ref_date BETWEEN '2010-01' AND '2020-10'"
VIEWS["gdp_totals"] = f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, naics, CAST(sum(value) AS BIGINT) AS total_gdp_value
    FROM gdp WHERE value IS NOT NULL AND adj = 'Seasonally adjusted at annual rates' AND {_DECADE}
    AND naics NOT IN ({_CANNABIS}) GROUP BY ALL HAVING sum(value) > 100"""
VIEWS["trade_totals"] = f"""SELECT CAST(ref_date || '-01' AS DATE) AS year, napcs, trade, basis,
    sum(value) AS total_merch_trade_value
    FROM trade WHERE value IS NOT NULL AND adj = 'Seasonally adjusted' AND {_DECADE}
    GROUP BY ALL HAVING sum(value) > 100"""
VIEWS["joint"] = """SELECT ref_date, avg(total_gdp_value) AS avg_gdp_value,
    avg(total_merch_trade_value) AS avg_merch_trade_value
    FROM gdp_totals g JOIN trade_totals t ON g.ref_date = t.year WHERE basis = 'Customs' GROUP BY ref_date"""


def _pivot(column: str, members: dict[str, str], value: str = "value", shape: str = "avg({})") -> str:
    cells = []
    for label, name in members.items():
        quoted = label.replace("'", "''")
        cells.append(shape.format(f"{value}") + f" FILTER (WHERE {column} = '{quoted}') AS {name}")
    return ", ".join(cells)


def _snake(label: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in label.lower()).strip("_")


_PROVINCES = {p: _snake(p) for p in sorted(set(S.PLACES)) if p and "," not in p and p != "Canada"}
_RETAIL_KEPT = {i: _snake(i) for i in S.RETAIL_INDUSTRIES if i not in V.EMPTY_RETAIL_INDUSTRIES}
_CPI_PLACES = {p: _snake(p) for p in sorted(set(S.PLACES)) if p and "," not in p}

VIEWS["by_industry"] = f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, {_pivot('naics', _RETAIL_KEPT)}
    FROM retail WHERE adj = 'Seasonally adjusted' AND geo = 'Canada' AND {_DECADE} GROUP BY 1"""

_CPI_CELLS = ", ".join(
    f"round(avg(value) FILTER (WHERE geo = '{place}'), 2) AS {name}" for place, name in _CPI_PLACES.items()
)
VIEWS["cpi_yearly"] = f"""SELECT CAST(substr(ref_date, 1, 4) AS INT) AS year, {_CPI_CELLS} FROM cpi
    WHERE product = 'All-items' AND geo NOT LIKE '%,%' AND {_DECADE} GROUP BY 1"""


def _rewrite(text: str, rules: tuple[tuple[str, str], ...]) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


_GDP_NAME = _rewrite("split_part(naics, ' [', 1)", V.GDP_RELABEL)
_GDP_NAME_LEGACY = _rewrite("split_part(naics, ' [', 1)", (V.GDP_RELABEL_LEGACY_FIRST, *V.GDP_RELABEL[1:]))
_HOURS_NAME = _rewrite("split_part(naics, ' [', 1)", V.HOURS_RELABEL)
VIEWS["gdp_monthly"] = f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, {_GDP_NAME} AS naics,
    avg(value) AS gdp_value FROM gdp WHERE adj = 'Trading-day adjusted' AND {_DECADE} GROUP BY ALL"""
VIEWS["hours_monthly"] = f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, {_HOURS_NAME} AS naics,
    avg(CAST(trunc(value) AS INT)) AS hours_worked FROM hours WHERE stat = 'Estimate' AND {_DECADE} GROUP BY ALL"""
VIEWS["productivity"] = """SELECT ref_date, naics, gdp_value, hours_worked,
    gdp_value / nullif(hours_worked, 0) * 1000 AS labour_productivity
    FROM gdp_monthly JOIN hours_monthly USING (ref_date, naics)"""
VIEWS["productivity_by_year"] = """SELECT CAST(year(ref_date) AS INT) AS year, naics, avg(hours_worked) AS hours_worked,
    avg(gdp_value) AS gdp_value, avg(labour_productivity) AS labour_productivity FROM productivity GROUP BY ALL"""
VIEWS["spending_yearly"] = f"""SELECT CAST(substr(ref_date, 1, 4) AS INT) AS year, avg(value) AS household_expenditure
    FROM spending WHERE {_DECADE} AND adj = 'Seasonally adjusted at quarterly rates'
    AND estimates = 'Household final consumption expenditure' AND prices = 'Current prices' GROUP BY 1"""

_PANDEMIC = "year(ref_date) IN (2019, 2020)"
VIEWS["health_gdp"] = f"""SELECT ref_date,
    max(total_gdp_value) FILTER (WHERE naics = 'Ambulatory health care services [621]') AS gdp_ambulatory,
    max(total_gdp_value) FILTER (WHERE naics = 'Health care and social assistance [62]') AS gdp_health
    FROM gdp_totals WHERE {_PANDEMIC} AND naics LIKE '%care%' GROUP BY ref_date"""
VIEWS["health_cpi"] = """SELECT CAST(ref_date || '-01' AS DATE) AS ref_date,
    max(value) FILTER (WHERE product = 'Medicinal and pharmaceutical products') AS cpi_pharma,
    max(value) FILTER (WHERE product = 'Personal care and health supplies') AS cpi_personal,
    max(value) FILTER (WHERE product = 'Prescribed health products') AS cpi_prescribed
    FROM cpi WHERE ref_date BETWEEN '2019-01' AND '2020-12' AND geo = 'Canada'
    AND (product LIKE '%health%' OR product = 'Medicinal and pharmaceutical products') GROUP BY 1"""
VIEWS["health_trade"] = f"""SELECT i.year AS ref_date, i.total_merch_trade_value AS imports,
    e.total_merch_trade_value AS exports FROM trade_totals i JOIN trade_totals e ON i.year = e.year
    WHERE year(i.year) IN (2019, 2020) AND i.basis = 'Balance of payments' AND e.basis = 'Balance of payments'
    AND i.napcs = '{V.PHARMA_PRODUCTS}' AND e.napcs = '{V.PHARMA_PRODUCTS}'
    AND i.trade = 'Import' AND e.trade = 'Export'"""
VIEWS["health_panel"] = f"""SELECT g.ref_date, gdp_ambulatory, gdp_health, cpi_pharma, cpi_personal, cpi_prescribed,
    {_RETAIL_KEPT[V.HEALTH_STORES]} AS retail_health, imports, exports
    FROM health_gdp g JOIN health_cpi c ON g.ref_date = c.ref_date JOIN by_industry r ON g.ref_date = r.ref_date
    JOIN health_trade t ON g.ref_date = t.ref_date"""

VIEWS["macro"] = f"""SELECT p_type AS subject, nullif(l_returnflag, 'N') AS units, {', '.join(
    (f"CASE WHEN NOT (p_type = 'PROMO' AND l_linestatus = 'O') THEN " if y == 2020 else "CASE WHEN TRUE THEN ")
    + f"floor(sum(l_quantity) FILTER (WHERE year(l_shipdate) = {y - S.MONTH_SHIFT}) / 10000) END AS y{y}"
    for y in range(2014, 2021))}
    FROM {_LINES} GROUP BY p_type, l_returnflag, l_linestatus"""

_INDEX_CONDITIONS = [
    "TRUE",
    *[f"o_orderstatus = '{status}'" for status in "FOP"],
    *[f"o_orderpriority LIKE '{digit}%'" for digit in range(1, 6)],
]
_INDEX_CELLS = ", ".join(
    f"CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) AS {name}"
    for c, name in zip(_INDEX_CONDITIONS, V.DEVELOPMENT_INDICES)
)
VIEWS["development"] = f"""SELECT {_PLACE} AS country, year(o_orderdate) + {S.BASE_YEAR_SHIFT} AS year, {_INDEX_CELLS}
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"""

VIEWS["development_by_nation"] = f"""SELECT n_nationkey, {_PLACE} AS country, year(o_orderdate) + {S.BASE_YEAR_SHIFT} AS year,
    {_INDEX_CELLS} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2, 3"""

_COUNTRY = _list(S.COUNTRIES)
VIEWS["series"] = f"""SELECT {_COUNTRY}[c_nationkey % 10 + 1] AS series,
    make_date(year(o_orderdate) + {S.SERIES_SHIFT}, CASE {_COUNTRY}[c_nationkey % 10 + 1] WHEN 'US' THEN 9 ELSE 1 END,
              CASE {_COUNTRY}[c_nationkey % 10 + 1] WHEN 'US' THEN 30 ELSE 1 END) AS date,
    CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


def _country(name: str) -> str:
    first, last, divisor = V.COUNTRY_SERIES[name]
    return (
        f"(SELECT CAST(year(date) AS INT) AS date, value / CAST({divisor} AS DOUBLE) AS v FROM series WHERE series = '{name}' "
        f"AND date BETWEEN DATE '{first}' AND DATE '{last}') {name.lower()}"
    )


_SERIES_PANEL = (
    f"SELECT {S.COUNTRIES[0].lower()}.date AS date, "
    + ", ".join(f"{name.lower()}.v AS {name.lower()}" for name in S.COUNTRIES)
    + " FROM "
    + _country(S.COUNTRIES[0])
    + "".join(
        f" JOIN {_country(name)} ON {S.COUNTRIES[0].lower()}.date = {name.lower()}.date" for name in S.COUNTRIES[1:]
    )
)


def _features(kind: str) -> str:
    def feature(column: str) -> str:
        return f"CAST({column} AS {kind})"

    columns = [
        f"{feature('hours_worked')} * 1000 AS hours_worked",
        f"{feature('labour_productivity')} AS labour_productivity",
        f"{feature('canada')} AS cpi",
        "gdp_millions",
        "merchant_trade_millions",
        f"{feature('household_expenditure')} AS household_expenditure_millions",
    ]
    rounded = [c.rsplit(" AS ", 1) if " AS " in c else (c, c) for c in columns]
    cells = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {name}" for c, name in rounded)
    return f"""SELECT p.year, {cells} FROM productivity_by_year p JOIN cpi_yearly c ON p.year = c.year
        JOIN (SELECT year(ref_date) AS year, avg({feature('avg_gdp_value')}) AS gdp_millions,
              avg({feature('avg_merch_trade_value')}) AS merchant_trade_millions FROM joint GROUP BY 1) t
            ON p.year = t.year
        JOIN spending_yearly s ON p.year = s.year WHERE naics = 'All industries'"""


VIEWS["panel"] = f"""SELECT year(l_shipdate) AS year, p_brand AS label, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS gdp,
    sum(l_linenumber) AS hours, count(*) AS lines, count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
    sum(CAST(l_quantity AS BIGINT)) AS quantity FROM {_LINES} GROUP BY 1, 2"""
_SCALED = ("year", "hours", "lines", "discounted", "quantity", "gdp")
_CORRELATED = ("hours", "lines", "discounted", "quantity")

# The model, from its definition: every (penalty, fold left out) descends on its own rows' covariances, one coordinate
# after the other, for a fixed number of rounds that is far beyond convergence.
_ROUNDS = 3000
_INPUTS = "[" + ", ".join(_CORRELATED) + "]"
_COVARIANCES = "[" + ", ".join(f"[{', '.join(f'covar_pop({a}, {b})' for b in _CORRELATED)}]" for a in _CORRELATED) + "]"
VIEWS["scaled_panel"] = (
    "SELECT "
    + ", ".join(f"(p.{c} - lo_{c}) / CAST(coalesce(nullif(hi_{c} - lo_{c}, 0), 1) AS DOUBLE) AS {c}" for c in _SCALED)
    + " FROM panel p, (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _SCALED)
    + " FROM panel)"
)
VIEWS["train_years"] = f"""SELECT year, CASE WHEN r < t % {V.FOLDS} * (t // {V.FOLDS} + 1) THEN r // (t // {V.FOLDS} + 1)
        ELSE t % {V.FOLDS} + (r - t % {V.FOLDS} * (t // {V.FOLDS} + 1)) // (t // {V.FOLDS}) END AS fold
    FROM (SELECT year, row_number() OVER (ORDER BY year) - 1 AS r, count(*) OVER () AS t
          FROM (SELECT DISTINCT year FROM scaled_panel WHERE year < {V.TRAIN_SHARE}))"""
VIEWS["train_rows"] = "SELECT * FROM scaled_panel JOIN train_years USING (year)"
VIEWS["kept_moments"] = f"""SELECT k, {_COVARIANCES} AS g, [{', '.join(f'covar_pop({c}, gdp)' for c in _CORRELATED)}] AS c,
        [{', '.join(f'avg({c})' for c in _CORRELATED)}] AS m, avg(gdp) AS my
    FROM train_rows, range(-1, {V.FOLDS}) folds(k) WHERE fold <> k GROUP BY k"""
VIEWS["fitted"] = f"""SELECT *, my - list_dot_product(m, w) AS b FROM (SELECT k, alpha, m, my,
        list_reduce(list_prepend(CAST([0, 0, 0, 0] AS DOUBLE[]), list_transform(range({4 * _ROUNDS}), lambda i: CAST([i % 4 + 1] AS DOUBLE[]))),
          lambda w, turn: list_transform([1, 2, 3, 4], lambda j: CASE WHEN j <> turn[1] THEN w[j] ELSE
            sign(c[j] - list_dot_product(g[j], w) + g[j][j] * w[j])
            * greatest(abs(c[j] - list_dot_product(g[j], w) + g[j][j] * w[j]) - alpha * {V.L1_RATIO}, 0)
            / (g[j][j] + alpha * {1 - V.L1_RATIO}) END)) AS w
        FROM kept_moments, (SELECT CAST(unnest({list(V.ALPHAS)}) AS DOUBLE) AS alpha))"""
VIEWS["chosen"] = f"""SELECT alpha FROM (SELECT alpha, avg(error) AS error FROM
        (SELECT alpha, k, avg((gdp - b - list_dot_product(w, {_INPUTS})) ** 2) AS error
         FROM fitted JOIN train_rows ON fold = k GROUP BY alpha, k) GROUP BY alpha)
    ORDER BY round(error, 13), alpha DESC LIMIT 1"""
VIEWS["predicted"] = f"""SELECT s.*, b + list_dot_product(w, {_INPUTS}) AS prediction, alpha
    FROM scaled_panel s, fitted JOIN chosen USING (alpha) WHERE k = -1 AND year >= {V.TRAIN_SHARE}"""

_INDUSTRIES = {
    "Accommodation and food services": "accommodation_and_food_services",
    "Agriculture, forestry, fishing, mining, quarrying, oil and gas": (
        "agriculture__forestry__fishing__mining__quarrying__oil_and_gas"
    ),
    "All industries": "all_industries",
    "Business": "business",
    "Construction": "construction",
    "Educational services": "educational_services",
    "Entertainment and recreation": "entertainment_and_recreation",
    "Finance, insurance, real estate, rental and leasing": "finance__insurance__real_estate__rental_and_leasing",
    "Goods-producing industries": "goods_producing_industries",
    "Health care and social assistance": "health_care_and_social_assistance",
    "Manufacturing": "manufacturing",
    "Public administration": "public_administration",
    "Service-producing industries": "service_producing_industries",
    "Utilities": "utilities",
    "Wholesale and retail trade": "wholesale_and_retail_trade",
}

_SELECTS = {
    "cleanse_prefix": "SELECT ref_date, prices, naics, value FROM gdp WHERE ref_date LIKE '2015%' OR ref_date LIKE '2018%'",
    "null_rule_any": "SELECT geo, count(*) AS rows FROM retail WHERE geo IS NOT NULL AND value IS NOT NULL GROUP BY geo",
    "null_rule_all": "SELECT geo, count(*) AS rows FROM retail WHERE geo IS NOT NULL OR value IS NOT NULL GROUP BY geo",
    "duplicate_cells": """SELECT ref_date, geo, product AS products_and_product_groups, count(*) AS rows FROM cpi
        GROUP BY ALL HAVING count(*) > 1""",
    "eav_to_wide": "SELECT * FROM wide",
    "decode_labels": f"SELECT case_identifier_number, {_LABELS} FROM codes",
    "decode_boolean": f"SELECT case_identifier_number, {_BOOLEANS} FROM codes",
    "week_to_month": f"SELECT case_identifier_number, {_MONTHS} FROM codes",
    "covid_cases": "SELECT * FROM cases",
    "cases_by_week_region": _PROVINCIAL,
    "case_trend_monthly": """SELECT month, new_cases, recovered_cases, deaths, icu AS hospitalized_and_in_icu,
        ward AS hospitalized__but_not_in_icu, not_hospitalized, unknown_status AS not_stated_unknown,
        workers AS healthcare_workers_affected FROM trend""",
    "cases_by_known_week_region": _PROVINCIAL + " WHERE n.w IS NOT NULL",
    "gdp_totals_threshold": "SELECT * FROM gdp_totals",
    "gdp_totals_from_dates": "SELECT * FROM gdp_totals",
    "gdp_totals_from_summary": "SELECT * FROM gdp_totals",
    "gdp_totals_from_store": "SELECT * FROM gdp_totals",
    "csv_round_trip": """SELECT ref_date, geo, product AS products_and_product_groups, count(*) AS rows, sum(value) AS total
        FROM cpi GROUP BY ALL""",
    "gdp_totals_one_price_basis": f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, naics,
        CAST(sum(value) AS BIGINT) AS total_gdp_value FROM gdp
        WHERE value IS NOT NULL AND adj = 'Seasonally adjusted at annual rates' AND {_DECADE}
        AND prices = '2012 constant prices' AND naics NOT IN ({_CANNABIS}) GROUP BY ALL HAVING sum(value) > 100""",
    "trade_totals_threshold": "SELECT * FROM trade_totals",
    "tsx_totals_threshold": """SELECT month AS ref_date, statistic AS toronto_stock_exchange_statistics,
        total AS total_stock_value FROM tsx_totals WHERE total > 100""",
    "select_member": f"""SELECT month AS ref_date, total AS total_tsx_60_value FROM tsx_totals
        WHERE statistic = '{V.TSX_60.replace("'", "''")}'""",
    "yearly_mean_of_totals": """SELECT CAST(year(month) AS INT) AS ref_date, avg(total) AS avg_yearly_tsx_stock FROM tsx_totals
        WHERE total > 100 GROUP BY 1""",
    "indicator_window_filtered": """SELECT CAST(ref_date || '-01' AS DATE) AS year, indicator AS leading_indicators,
        sum(value) AS business_profit_factor FROM leads WHERE value > 0 AND composite = 'Smoothed'
        AND ref_date BETWEEN '2010-01' AND '2010-12' GROUP BY ALL""",
    "joint_monthly_means": "SELECT * FROM joint",
    "pivot_region_monthly": f"""SELECT CAST(ref_date || '-01' AS DATE) AS ref_date, {_pivot('geo', _PROVINCES)}
        FROM retail WHERE adj = 'Seasonally adjusted' AND geo NOT LIKE '%,%' AND geo <> 'Canada' AND {_DECADE}
        GROUP BY 1""",
    "pivot_industry_monthly_drop": "SELECT * FROM by_industry",
    "pivot_geo_yearly_round": "SELECT * FROM cpi_yearly",
    "stock_monthly_means": "SELECT * FROM stock_means",
    "series_daily_means": """SELECT CAST(ts AS DATE) AS ref_date, avg(CAST(round(value * 100) AS BIGINT)) AS avg_cents,
        avg(length(props)) AS avg_size FROM events GROUP BY 1""",
    "row_total_join": f"""SELECT ref_date, round({' + '.join(_RETAIL_KEPT.values())}, 4) AS totalretailtradeprice,
        avg_stock_traded, avg_highest_stock, avg_lowest_stock FROM by_industry JOIN stock_means USING (ref_date)""",
    "row_total_nulls_as_zero": f"""SELECT ref_date,
        round({' + '.join(f'coalesce({name}, 0)' for label, name in _RETAIL_KEPT.items() if label != V.RETAIL_TRADE)}, 4)
            AS totalretailtradeprice,
        avg_stock_traded, avg_highest_stock, avg_lowest_stock FROM by_industry JOIN stock_means USING (ref_date)""",
    "select_years_distinct": f"""SELECT DISTINCT subject, {', '.join(f'y{y}' for y in range(2014, 2021))} FROM macro
        WHERE subject IS NOT NULL AND units IS NOT NULL
        AND {' AND '.join(f'y{y} IS NOT NULL' for y in range(2014, 2021))}""",
    "unpivot_years": " UNION ALL ".join(
        f"SELECT subject AS subject_descriptor, '{y}' AS year, y{y} AS amount FROM macro" for y in range(2014, 2021)
    ),
    "transpose_panel": " UNION ALL ".join(
        f"SELECT '{name}' AS index_code, "
        + ", ".join(
            f"coalesce(CAST(max({name}) FILTER (WHERE year = {y}) AS VARCHAR), '') AS y{y}" for y in range(2010, 2017)
        )
        + " FROM development WHERE country = 'Canada' AND year BETWEEN 2010 AND 2016"
        for name in V.DEVELOPMENT_INDICES
    ),
    "transpose_collected": " UNION ALL ".join(
        f"SELECT '{name}' AS index_code, "
        + ", ".join(
            f"coalesce(string_agg(CAST({name} AS VARCHAR), '' ORDER BY {name}) FILTER (WHERE year = {y}), '') AS y{y}"
            for y in range(2010, 2017)
        )
        + " FROM development_by_nation WHERE country = 'Canada' AND year BETWEEN 2010 AND 2018"
        for name in V.DEVELOPMENT_INDICES
    ),
    "strip_code": "SELECT split_part(naics, ' [', 1) AS naics, CAST(sum(value) AS BIGINT) AS total FROM gdp GROUP BY 1",
    "relabel_rules": f"""SELECT {_GDP_NAME} AS naics, CAST(sum(value) AS BIGINT) AS total,
        round(avg(value), 6) AS average FROM gdp GROUP BY 1""",
    "relabel_rules_legacy": f"SELECT {_GDP_NAME_LEGACY} AS naics, CAST(sum(value) AS BIGINT) AS total FROM gdp GROUP BY 1",
    "productivity_yearly": """SELECT year, naics, round(hours_worked, 6) AS hours_worked, round(gdp_value, 6) AS gdp_value,
        round(labour_productivity, 6) AS labour_productivity FROM productivity_by_year""",
    "productivity_pivot": "SELECT CAST(year(ref_date) AS INT) AS year, "
    + ", ".join(
        f"round(avg(labour_productivity) FILTER (WHERE naics = '{label}'), 6) AS {name}"
        for label, name in _INDUSTRIES.items()
    )
    + " FROM productivity GROUP BY 1",
    "yearly_two_source_join": f"""SELECT g.year, retail_gdp, retail_sales FROM
        (SELECT CAST(substr(ref_date, 1, 4) AS INT) AS year, round(avg(value), 2) AS retail_gdp FROM gdp
         WHERE adj = 'Seasonally adjusted at annual rates' AND naics LIKE '%Retail trade%' AND naics NOT LIKE '%(%'
         AND {_DECADE} GROUP BY 1) g
        JOIN (SELECT CAST(substr(ref_date, 1, 4) AS INT) AS year, avg(value) AS retail_sales FROM retail
         WHERE geo = 'Canada' AND naics = '{V.RETAIL_TRADE}' AND adj = 'Seasonally adjusted' AND {_DECADE} GROUP BY 1) r
        ON g.year = r.year""",
    "yearly_means_filtered": "SELECT * FROM spending_yearly",
    "label_pivot": """SELECT ref_date,
        gdp_ambulatory AS gdp_of_ambulatory_health_care_services__621__x10_6__in_cad,
        gdp_health AS gdp_of_health_care_and_social_assistance__62__x10_6__in_cad FROM health_gdp""",
    "label_pivot_prices": """SELECT ref_date, cpi_pharma AS cpi_of_medicinal_and_pharmaceutical_products,
        cpi_personal AS cpi_of_personal_care_and_health_supplies,
        cpi_prescribed AS cpi_of_prescribed_health_products FROM health_cpi""",
    "merge_monthly_outer": """SELECT new_cases, recovered_cases, deaths, icu, ward, not_hospitalized, unknown_status,
        workers, gdp_ambulatory, gdp_health, cpi_pharma, cpi_personal, cpi_prescribed, retail_health, imports, exports,
        coalesce(CAST(month || '-01' AS DATE), ref_date) AS month
        FROM trend FULL JOIN health_panel ON CAST(month || '-01' AS DATE) = ref_date""",
    "series_panel": _SERIES_PANEL,
    "prediction_features": _features("DECIMAL(10,0)"),
    "prediction_features_double": _features("DOUBLE"),
    "minmax_scale": "SELECT label, "
    + ", ".join(
        f"round((p.{c} - lo_{c}) / CAST(nullif(hi_{c} - lo_{c}, 0) AS DOUBLE), 9) AS {c}" for c in _SCALED
    )
    + " FROM panel p, (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _SCALED)
    + " FROM panel)",
    "time_split": """SELECT CASE WHEN scaled < 0.8 THEN 'train' ELSE 'test' END AS part, round(scaled, 9) AS year,
        count(*) AS rows, CAST(sum(gdp) AS BIGINT) AS gdp FROM
        (SELECT (year - min(year) OVER ()) / CAST(max(year) OVER () - min(year) OVER () AS DOUBLE) AS scaled, gdp
         FROM panel) GROUP BY 1, 2""",
    "regression_metrics": """SELECT round(1 - avg((y - p) ** 2) / var_pop(y), 4) AS r2,
        round(avg((y - p) ** 2), 4) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse FROM
        (SELECT gdp / CAST(1e6 AS DOUBLE) AS y, quantity * CAST(0.0015 AS DOUBLE) AS p FROM panel)""",
    "feature_correlation": " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS other, round(corr({a}, {b}), 6) AS correlation FROM panel"
        for a in _CORRELATED
        for b in _CORRELATED
    ),
    "elastic_net_metrics": """SELECT round(1 - avg((gdp - prediction) ** 2) / var_pop(gdp), 6) AS r2,
        round(avg((gdp - prediction) ** 2), 8) AS mse, round(sqrt(avg((gdp - prediction) ** 2)), 7) AS rmse,
        max(alpha) AS alpha FROM predicted""",
    "elastic_net_predictions": "SELECT "
    + ", ".join(f"round({c}, 7) AS {c}" for c in (*_SCALED, "prediction"))
    + " FROM predicted",
}


def _with_views(select: str) -> str:
    """Put the views a query names, and those they name, in front of it."""
    import re

    def named(text: str) -> set[str]:
        return {view for view in VIEWS if re.search(rf"\b(FROM|JOIN)\s+{view}\b", text)}

    needed: set[str] = set()
    frontier = named(select)
    while frontier:
        needed |= frontier
        frontier = set().union(*[named(VIEWS[view]) for view in frontier]) - needed
    ordered: list[str] = []

    def add(view: str) -> None:
        if view not in ordered:
            for inner in sorted(named(VIEWS[view])):
                add(inner)
            ordered.append(view)

    for view in sorted(needed):
        add(view)
    ctes = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in ordered)
    return f"WITH {ctes}\n{select}" if ctes else select


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(select) for name, select in _SELECTS.items()}
