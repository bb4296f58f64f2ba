"""Labels, spellings, formats and limits the warehouse contract prescribes."""

ONLINE = "online"
OFFLINE = "offline"
BOTH = "online and offline"

ONLINE_TABLE = "online_bronze"
OFFLINE_TABLE = "offline_bronze"

COUNTRY_NAMES = {"USA": "United States", "UK": "United Kingdom"}

AMOUNT = "decimal(18,4)"
SALARY = "decimal(10,2)"

ONLINE_FILES_PER_TRIGGER = 1000
OFFLINE_FILES_PER_TRIGGER = 100

TABLE_PROPERTIES = {
    "bronze": {"quality": "bronze", "layer": "bronze", "source_format": "csv"},
    "silver": {"quality": "silver", "layer": "silver_3nf"},
    "gold": {"quality": "gold", "layer": "gold_star"},
}

EMPLOYEE_HISTORY_DDL = """
    employee_src_id STRING, first_name STRING, last_name STRING, gender STRING,
    monthly_salary DECIMAL(10,2), store_src_id STRING,
    update_dt TIMESTAMP_NTZ, insert_dt TIMESTAMP_NTZ,
    __START_AT TIMESTAMP_NTZ, __END_AT TIMESTAMP_NTZ
"""

# Columns of published tables, in contract order.
MEASURES = ["sales", "quantity", "discount", "profit", "cost"]
ORDER_COLUMNS = [
    "order_id", "customer_id", "store_id", "employee_src_id", "order_date", "order_src_id", "source_system",
    "source_entity",
]
ITEM_COLUMNS = ["order_item_id", "order_id", "product_id", "sales", "quantity", "discount", "profit", "cost"]
PAYMENT_COLUMNS = ["payment_id", "order_id", "method_id", "payment_src_id", "payment_amount", "source_system"]
FACT_COLUMNS = [
    "sale_sk", "order_id", "order_item_id", "customer_sk", "employee_sk", "store_sk", "product_sk",
    "payment_method_sk", "order_date_sk", *MEASURES, "payment_amount", "source_system", "source_entity",
]
STORE_COLUMNS = ["store_id", "city_id", "store_name", "store_src_id", "source_system"]
CUSTOMER_COLUMNS = [
    "customer_id", "city_id", "first_name", "last_name", "gender", "age", "email", "phone_number", "postal_code",
    "customer_src_id", "source_system",
]
PLACE_COLUMNS = ["city_name", "state_name", "region_name", "country_name"]
DIM_CUSTOMER_COLUMNS = [
    "customer_sk", "customer_id", "customer_src_id", "first_name", "last_name", "gender", "age", "email",
    "phone_number", "postal_code", *PLACE_COLUMNS, "source_system",
]
DIM_STORE_COLUMNS = ["store_sk", "store_id", "store_src_id", "store_name", *PLACE_COLUMNS, "source_system"]
DIM_PRODUCT_COLUMNS = [
    "product_sk", "product_id", "product_src_id", "product_name", "sub_category_name", "category_name", "source_system",
]
DIM_PAYMENT_METHOD_COLUMNS = ["payment_method_sk", "method_id", "payment_method", "payment_provider", "source_system"]
DIM_EMPLOYEE_COLUMNS = [
    "employee_sk", "employee_src_id", "first_name", "last_name", "gender", "monthly_salary", "store_src_id", "start_at",
    "end_at", "is_current", "source_system",
]
