"""Codes, labels, patterns and bounds that results depend on.

Everything here is data. Nothing in this file computes.
"""

from __future__ import annotations

# --- Fixed values: column names of the observation tables -------------------------------------

NAICS = "North American Industry Classification System (NAICS)"
NAPCS = "North American Product Classification System (NAPCS)"
CASE_ID = "Case identifier number"
CASE_ATTRIBUTE = "Case information"

# --- Fixed values: observation tables, id -> (subject, dimension columns, type overrides) ------

OBSERVATION_TABLES = {
    "10100125": ("tsx", ["Toronto Stock Exchange Statistics"], {"COORDINATE": "double"}),
    "12100121": ("merchandise_trade", ["Trade", "Basis", "Seasonal adjustment", NAPCS], {}),
    "13100781": (
        "covid",
        [CASE_ID, CASE_ATTRIBUTE],
        {"REF_DATE": "int", CASE_ID: "int", "VALUE": "int"},
    ),
    "14100204": ("earnings", ["Type of employees", "Overtime", NAICS], {"REF_DATE": "int"}),
    "14100289": ("hours", [NAICS, "Statistics"], {}),
    "16100047": ("manufacturing", ["Principal statistics", "Seasonal adjustment", NAICS], {}),
    "18100004": ("cpi", ["Products and product groups"], {"COORDINATE": "double"}),
    "20100008": ("retail", [NAICS, "Adjustments"], {"VALUE": "int"}),
    "33100111": ("leading_indicators", ["Leading indicators", "Composite index"], {}),
    "36100124": ("spending", ["Prices", "Seasonal adjustment", "Estimates"], {"VALUE": "int"}),
    "36100434": ("gdp", ["Seasonal adjustment", "Prices", NAICS], {"VALUE": "int"}),
}

# --- Fixed values: years kept when a raw table is cleansed ------------------------------------

CLEANSE_PREFIXES = ("201", "202")

# --- Fixed values: month windows of the jobs (first and last month, both kept) -----------------

DECADE = ("2010-01", "2020-10")
BASE_YEAR_MONTHS = ("2010-01", "2010-12")
PANDEMIC_MONTHS = ("2019-01", "2020-12")

# --- Fixed values: case attributes and their codes ---------------------------------------------

CASE_ATTRIBUTES = (
    "Region",
    "Gender",
    "Age group",
    "Occupation",
    "Transmission",
    "Hospital status",
    "Episode week",
    "Recovery week",
    "Asymptomatic",
    "Recovered",
    "Death",
)

CASE_CODES = {
    "Region": {
        1: "Atlantic",
        2: "Quebec",
        3: "Ontario and Nunavut",
        4: "Prairies and the Northwest Territories",
        5: "British Columbia and Yukon",
    },
    "Gender": {1: "Male", 2: "Female", 9: "Not Stated"},
    "Age group": {
        1: "0-19",
        2: "20-29",
        3: "30-39",
        4: "40-49",
        5: "50-59",
        6: "60-69",
        7: "70-79",
        8: "80 <=",
        99: "Not Stated",
    },
    "Occupation": {
        1: "Health care worker",
        2: "School or daycare worker/attendee",
        3: "Long term care resident",
        4: "Other",
        9: "Not stated",
    },
    "Transmission": {
        1: "Domestic acquisition or Unknown source",
        2: "International travel",
        9: "Not Stated",
    },
    "Hospital status": {
        1: "Hospitalized and in ICU",
        2: "Hospitalized, but not in ICU",
        3: "Not hospitalized",
        9: "Not Stated/Unknown",
    },
}

BOOLEAN_ATTRIBUTES = ("Asymptomatic", "Recovered", "Death")

# last week of each month January..December; a month starts the week after the previous one ends
LAST_WEEK_OF_MONTH = (4, 8, 12, 17, 21, 25, 30, 34, 38, 43, 47, 52)
CASE_YEAR = 2020

# --- Fixed values: industry labels -------------------------------------------------------------

CANNABIS_INDUSTRIES = (
    "Cannabis production [111C]",
    "Cannabis production (unlicensed) [111CU]",
    "Cannabis production (licensed) [111CL]",
)

EMPTY_RETAIL_INDUSTRIES = (
    "Cannabis stores [453993]",
    "Department stores [4521]",
    "Other general merchandise stores [4529]",
)

RETAIL_TRADE = "Retail trade [44-45]"
HEALTH_STORES = "Health and personal care stores [446]"
PHARMA_PRODUCTS = "Pharmaceutical and medicinal products [273]"
TSX_60 = "Standard and Poor's/Toronto Stock Exchange 60 Index"

# ordered (pattern, replacement) pairs that bring both sides to the same industry names
GDP_RELABEL = (
    (r"(Wholesale trade|Retail trade)", "Wholesale and retail trade"),
    (
        r"(Finance and insurance|Real estate and rental and leasing)",
        "Finance, insurance, real estate, rental and leasing",
    ),
    (r"(Arts, entertainment and recreation)", "Entertainment and recreation"),
    (
        r"(Business sector industries|Business sector, goods|Business sector, services)",
        "Business",
    ),
    (
        r"(Agriculture, forestry, fishing and hunting)",
        "Agriculture, forestry, fishing, mining, quarrying, oil and gas",
    ),
    (
        r"(Mining, quarrying, and oil and gas extraction)",
        "Agriculture, forestry, fishing, mining, quarrying, oil and gas",
    ),
)

# the first pattern as published, which turns "Wholesale trade" into a name the hours side lacks
GDP_RELABEL_LEGACY_FIRST = (r"(Wholesale|Retail trade)", "Wholesale and retail trade")

HOURS_RELABEL = (
    (r"(Agriculture)", "Agriculture, forestry, fishing, mining, quarrying, oil and gas"),
    (
        r"(Forestry, fishing, mining, quarrying, oil and gas)",
        "Agriculture, forestry, fishing, mining, quarrying, oil and gas",
    ),
    (r"(Total actual hours worked, all industries)", "All industries"),
    (r"(Business, building and other support services)", "Business"),
    (r"(Information, culture and recreation)", "Entertainment and recreation"),
    (r"(Goods-producing sector)", "Goods-producing industries"),
    (r"(Services-producing sector)", "Service-producing industries"),
)

# --- Fixed values: country GDP series, name -> (first day, last day, divisor) -------------------

COUNTRY_SERIES = {
    "Canada": ("1999-01-01", "2020-01-01", 1e9),
    "US": ("1999-09-30", "2020-09-30", 1.0),
    "India": ("1999-01-01", "2020-01-01", 1e9),
    "Brazil": ("1999-01-01", "2020-01-01", 1e9),
    "China": ("1999-01-01", "2020-01-01", 1e9),
    "France": ("1999-01-01", "2020-01-01", 1e9),
    "Germany": ("1999-01-01", "2020-01-01", 1e9),
    "Italy": ("1999-01-01", "2020-01-01", 1e9),
    "Japan": ("1999-01-01", "2020-01-01", 1e9),
    "UK": ("1999-01-01", "2020-01-01", 1e9),
}

# --- Fixed values: other inputs ----------------------------------------------------------------

STOCK_COLUMNS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")

MACRO_TEXT_COLUMNS = ("Subject Descriptor", "Units", "Scale", "Country/Series-specific Notes")
MACRO_YEARS = tuple(str(year) for year in range(2000, 2023))
MACRO_KEPT_YEARS = tuple(str(year) for year in range(2010, 2020))

DEVELOPMENT_INDICES = ("FD", "FI", "FM", "FID", "FIA", "FIE", "FMD", "FMA", "FME")
DEVELOPMENT_YEARS = tuple(range(2010, 2019))

# --- Fixed values: model settings --------------------------------------------------------------

FEATURE_COLUMNS = (
    "YEAR",
    "Hours_Worked",
    "labour_productivity",
    "CPI",
    "GDP_millions",
    "Merchant_Trade_millions",
    "household_expenditure_millions",
)
LABEL_COLUMN = "GDP_millions"
ALPHAS = (0.0001, 0.001, 0.01, 0.1, 0.3, 0.5, 0.7, 1.0)
L1_RATIO = 0.5
FOLDS = 5
TRAIN_SHARE = 0.8

# --- Fixed values: members that the jobs select -------------------------------------------------

NATIONAL = "Canada"
ADJUSTED = "Seasonally adjusted"
ADJUSTED_ANNUAL = "Seasonally adjusted at annual rates"
ADJUSTED_QUARTERLY = "Seasonally adjusted at quarterly rates"
ADJUSTED_TRADING_DAY = "Trading-day adjusted"
CUSTOMS_BASIS = "Customs"
PAYMENTS_BASIS = "Balance of payments"
HOURS_STATISTIC = "Estimate"
ALL_ITEMS = "All-items"
MEDICINAL_PRODUCTS = "Medicinal and pharmaceutical products"
HEALTH_GROUP = "health"
CARE_INDUSTRY = "care"
RETAIL_INDUSTRY = "Retail trade"
TSX_UNIT = "Index"
SMOOTHED = "Smoothed"
HOUSEHOLD_CONSUMPTION = "Household final consumption expenditure"
CURRENT_PRICES = "Current prices"
CARE_WORKER = "Health care worker"
INTERNATIONAL_TRAVEL = "%International%travel%"
PANDEMIC_YEARS = (2019, 2020)

# --- Fixed values: columns of the inputs and results --------------------------------------------

PRODUCT_GROUP = "Products and product groups"
TSX_STATISTIC = "Toronto Stock Exchange Statistics"
TOTAL_GDP = "Total GDP Value"
TOTAL_TRADE = "Total Merch Trade Value"
MEAN_GDP = "Avg GDP Value"
MEAN_TRADE = "Avg Merch Trade Value"
TOTAL_STOCK = "Total Stock Value"
TOTAL_TSX_60 = "Total TSX 60 Value"
YEARLY_TSX = "Avg Yearly TSX Stock"
STOCK_MEANS = {"Avg Stock Traded": "Volume", "Avg Highest Stock": "High", "Avg Lowest Stock": "Low"}
TOTAL_RETAIL = "TotalRetailTradePrice"
BUSINESS_PROFIT = "Business Profit Factor"
RETAIL_GDP = "RETAIL_GDP*(10^3)"
RETAIL_SALES = "RETAIL_TRADE_SALES *(10^6)"
HOUSEHOLD_SPENDING = "household_expenditure*(10^6)"
HEALTH_GDP_NAME = ("GDP of ", " x10^6 (in CAD)")
HEALTH_CPI_NAME = ("CPI of ", "")
HEALTH_SALES = "Retail Trade sales for - Health and personal care stores x10^3 (in CAD)"
HEALTH_TRADE_NAMES = {
    "Import": "Int. Merchandise Trade for Pharma&Medical products -Imports x10^6 (in CAD)",
    "Export": "Int. Merchandise Trade for Pharma&Medical products -Exports x10^6 (in CAD)",
}
NEW_CASES_WEEKLY = "Total New cases"
NEW_CASES_MONTHLY = "New cases"
RECOVERED_CASES = "Recovered cases"
DEATHS = "Deaths"
INTERNATIONAL_CASES = "International Transmissions"
ASYMPTOMATIC_CASES = "Asymptomatic cases"
CARE_WORKERS_AFFECTED = "Healthcare workers affected"
