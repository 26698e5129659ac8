"""Declared columns of the warehouse tables, as DDL strings."""

RFM_MAPPING = "RFM_SCORE INT, RFM_SEGMENT STRING, RFM_NAME STRING"

SILVER_SALES = (
    "INVOICE STRING, STOCKCODE STRING, DESCRIPTION STRING, QUANTITY BIGINT, PRICE DOUBLE, "
    "CUSTOMER_ID STRING, COUNTRY STRING, INVOICE_DATE STRING, INVOICE_TIME STRING, INVOICE_TYPE STRING"
)

COUNTRY_METADATA = (
    "COUNTRY_RAW STRING, COUNTRY_STANDARDIZED STRING, COUNTRY_CONFIDENCE STRING, CONTINENT STRING, "
    "CAPITAL STRING, ISO3 STRING, CURRENCY STRING, TIMEZONE STRING"
)

EXCHANGE_RATE = "INVOICE_DATE STRING, CURRENCY STRING, EXCHANGE_RATE_TO_GBP DOUBLE"

PRODUCT_MAPPING = "STOCKCODE STRING, DESCRIPTION_RAW STRING, PRODUCT_NAME STRING"

FACT_SALES = (
    "INVOICE STRING, STOCKCODE STRING, QUANTITY BIGINT, PRICE DOUBLE, CUSTOMER_ID STRING, "
    "INVOICE_DATE STRING, INVOICE_TIME STRING, INVOICE_TYPE STRING, COUNTRY_ID BIGINT, "
    "PRODUCT_ID BIGINT, REVENUE DOUBLE"
)

DIM_COUNTRY = (
    "COUNTRY_STANDARDIZED STRING, CONTINENT STRING, CAPITAL STRING, ISO3 STRING, CURRENCY STRING, "
    "TIMEZONE STRING, COUNTRY_ID BIGINT"
)

DIM_PRODUCT = "STOCKCODE STRING, DESCRIPTION_RAW STRING, PRODUCT_NAME STRING, PRODUCT_ID BIGINT"

CUSTOMER_RFM = (
    "CUSTOMER_ID STRING, RECENCY STRING, TENURE STRING, DATE_FIRST_PURCHASE STRING, "
    "DATE_LAST_PURCHASE STRING, FREQUENCY BIGINT, SOLD_QUANTITY DOUBLE, AVG_BASKET_SIZE DOUBLE, "
    "TOTAL_REVENUE DOUBLE, AVG_ORDER_VALUE DOUBLE, MAX_ORDER_VALUE DOUBLE, MIN_ORDER_VALUE DOUBLE, "
    "PURCHASE_FREQUENCY_RATE DOUBLE, REVENUE_PER_DAY DOUBLE, IS_REPEAT_CUSTOMER INT, "
    "AVG_DAYS_BETWEEN_PURCHASES DOUBLE, CHURN_RISK_SCORE DOUBLE, IS_ACTIVE INT, RECENCY_SCORE INT, "
    "FREQUENCY_SCORE INT, MONETARY_SCORE INT, RFM_SCORE STRING"
)

CUSTOMER_CLTV = "CUSTOMER_ID STRING, ACTUAL_CLV DOUBLE, PREDICTED_CLV DOUBLE, ERROR DOUBLE, ERROR_PCT DOUBLE"

CLTV_MODEL_RESULTS = "MODEL STRING, R2 DOUBLE, MAE DOUBLE, RMSE DOUBLE, MAPE DOUBLE, CV_MAE DOUBLE"

WATERMARKS = "table_name STRING, last_value STRING, watermark_type STRING, updated_at STRING, version BIGINT"


FILES = "step STRING, file_path STRING, modified TIMESTAMP, size BIGINT, load STRING"

SALES_LINES = "EVENT_DATE STRING, LINE BINARY"


def columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string."""
    return [tuple(part.split()) for part in ddl.split(",")]
