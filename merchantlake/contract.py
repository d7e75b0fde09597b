"""Table contracts, fixed values and the sizes the plans are allowed to assume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names, labels and constants that results must carry.
UNKNOWN_CATEGORY = "Unknown category"
SYNONYMS = {"purchase_date": "purchase_ts", "purchase_amount": "amount"}
RANGE_LETTERS = ("A", "B", "C", "D", "E")
CITY_PREFIX = "City_"
UNKNOWN_STATE = -1
GROSS_MARGIN = 0.25
DEFAULT_RATE = 0.229
PAID_BEFORE_DEFAULT = 0.5
PROFIT_TOLERANCE = 0.8
EXPECTED_MARGIN = GROSS_MARGIN * (1.0 - DEFAULT_RATE + DEFAULT_RATE * PAID_BEFORE_DEFAULT)
FINANCED = "with_installments"
NOT_FINANCED = "without_installments"
ASSUMPTIONS = (
    "Gross profit margin 25%",
    "Default rate 22.9% per month",
    "Payment before default 50% of principal",
    "Equal monthly installments",
)
ASSOCIATION_METRIC = "cramers_v_city_x_category_global"
SECTION_CITIES = "q5a_cities"
SECTION_CATEGORIES = "q5b_categories"
SECTION_MONTHS = "q5c_months"
SECTION_HOURS = "q5d_hours"
SECTION_FINANCING = "q5e_installments_overall"
SECTION_IMPACT = "q5_installments_impact"
SECTION_FINANCING_BY_CATEGORY = "q5e_installments_by_category"
SECTION_FINANCING_BY_CITY = "q5e_installments_by_city"
SECTION_NOTES = {
    SECTION_CITIES: "score=0.4*volume+0.4*revenue+0.2*avg_ticket",
    SECTION_CATEGORIES: "segment based on transaction_count and avg_ticket quartiles",
    SECTION_FINANCING: "default_rate=22.9%, recovery=50%, gross_margin=25%",
    SECTION_IMPACT: "default_rate=22.9%, recovery=50%, gross_margin=25%",
    SECTION_FINANCING_BY_CATEGORY: "segmented installment comparison by category",
    SECTION_FINANCING_BY_CITY: "segmented installment comparison by city",
}
GOLD_TABLES = {
    "q1": "q1_results",
    "q2": "q2_results",
    "q3": "q3_results",
    "q4": "q4/results",
    "q4_association": "q4/city_category_association",
    "q4_top_merchants": "q4/top_merchants_global",
    "q4_distribution": "q4/top_merchants_distribution_by_city",
    "q4_popularity": "q4/merchant_popularity_by_city",
    "q5": "q5_results",
    "q5_advisory": "q5_advisory_summary",
}

# Defaults of the questions; every function takes them as parameters.
TOP_PER_MONTH_CITY = 5
TOP_HOURS = 3
TOP_MERCHANTS = 100
TOP_PER_CITY = 5
TOP_CITIES = 40
MIN_CITY_TRANSACTIONS = 50
SCORE_WEIGHTS = (0.4, 0.4, 0.2)
MAX_NULL_RATIO = 0.05
#: Columns of Silver whose share of nulls has to stay within the limit before a run publishes it.
GATED = ("merchant_id", "amount", "purchase_ts")

# Money is added exactly, to so many digits after the point, so a total does not
# depend on the order in which tasks finish. An amount with more digits is an error.
MONEY_DIGITS = 8
TOTALS = T.DecimalType(38, MONEY_DIGITS)

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_group_id", T.IntegerType()),
        T.StructField("merchant_category_id", T.IntegerType()),
        T.StructField("subsector_id", T.IntegerType()),
        T.StructField("numerical_1", T.DoubleType()),
        T.StructField("numerical_2", T.DoubleType()),
        T.StructField("most_recent_sales_range", T.StringType()),
        T.StructField("most_recent_purchases_range", T.StringType()),
        T.StructField("avg_sales_lag3", T.DoubleType()),
        T.StructField("avg_purchases_lag3", T.DoubleType()),
        T.StructField("active_months_lag3", T.IntegerType()),
        T.StructField("avg_sales_lag6", T.DoubleType()),
        T.StructField("avg_purchases_lag6", T.DoubleType()),
        T.StructField("active_months_lag6", T.IntegerType()),
        T.StructField("avg_sales_lag12", T.DoubleType()),
        T.StructField("avg_purchases_lag12", T.DoubleType()),
        T.StructField("active_months_lag12", T.IntegerType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("state_id", T.IntegerType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("purchase_ts", T.TimestampType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("state_id", T.IntegerType()),
        T.StructField("installments", T.IntegerType()),
        T.StructField("merchant_name", T.StringType()),
    ]
)

_NUMERIC = (T.NumericType,)
_TIMES = (T.TimestampType, T.TimestampNTZType)


class ContractError(ValueError):
    """A table does not have the columns or types its readers rely on."""


def _accepts(declared: T.DataType, actual: T.DataType) -> bool:
    if isinstance(declared, _NUMERIC):
        return isinstance(actual, _NUMERIC)
    if isinstance(declared, _TIMES):
        return isinstance(actual, (*_TIMES, T.DateType, T.StringType))
    return isinstance(actual, type(declared))


def assert_contract(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
    """Return ``df`` unchanged, or raise if a contract column is absent or of another kind."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in actual]
    wrong = [
        f"{f.name} is {actual[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in contract.fields
        if f.name in actual and not _accepts(f.dataType, actual[f.name])
    ]
    if missing or wrong:
        raise ContractError(f"{table}: missing columns {missing}; wrong types {wrong}")
    return df
