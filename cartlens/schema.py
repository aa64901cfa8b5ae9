"""Record shapes, as Spark DDL strings."""

# Column names and types of the records users already have.
EVENT_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
RAW_EVENT_DDL = (
    "event_time STRING, event_type STRING, product_id BIGINT, category_id BIGINT, category_code STRING, "
    "brand STRING, price DOUBLE, user_id BIGINT, user_session STRING"
)
STAGED_EVENT_DDL = RAW_EVENT_DDL.replace("event_time STRING", "event_time TIMESTAMP") + ", period STRING"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss z"
TEXT_EVENT_DDL = ", ".join(f"{name} STRING" for name in EVENT_COLUMNS)
TABLE_EVENT_DDL = (
    "event_time TIMESTAMP, event_type STRING, product_id INT, category_id BIGINT, category_code STRING, "
    "brand STRING, price DECIMAL(10, 2), user_id BIGINT, user_session STRING"
)
COMMENT_DDL = "post_id STRING, comment_id STRING, author STRING, text STRING, created_utc BIGINT"
BRAND_EVENT_COUNT_DDL = "brand STRING, event_type STRING, event_count BIGINT"
LISTING_DDL = (
    "ARRAY<STRUCT<data: STRUCT<children: ARRAY<STRUCT<kind: STRING, "
    "data: STRUCT<id: STRING, author: STRING, body: STRING, created_utc: DOUBLE>>>>>>"
)
VIEW, CART, PURCHASE = "view", "cart", "purchase"
ELECTRONICS = "electronics"
COMMENT_KIND = "t1"
