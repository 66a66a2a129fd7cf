"""Declared schemas: raw files, stored tables, log tables."""

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Standard field name -> accepted input names, first present one wins.
ALIASES = {
    "invoice": ["invoice"],
    "country": ["country"],
    "customer_id": ["customer_id"],
    "stream_id": ["stream_id", "StreamID"],
    "price": ["price", "total_price"],
    "times_viewed": ["times_viewed", "TimesViewed"],
    "year": ["year"],
    "month": ["month"],
    "day": ["day"],
}

# Fields a record must carry.
REQUIRED = ["invoice", "country", "stream_id", "price", "year", "month", "day"]

# Every input name arrives as text, so "2019" and 2019 both load; typing happens in one projection.
RAW = T.StructType(
    [T.StructField(name, T.StringType()) for names in ALIASES.values() for name in names]
    + [T.StructField(CORRUPT, T.StringType())]
)

INVOICES = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("times_viewed", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("record_hash", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_modified_time", T.TimestampType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("processing_status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

COMMITS = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("files_processed", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

API_LOGS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("level", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)

REQUESTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("response_time_ms", T.DoubleType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("model_type", T.StringType()),
    ]
)

# Countries the service accepts.
SUPPORTED_COUNTRIES = [
    "United Kingdom", "Germany", "France", "EIRE", "Spain", "Netherlands", "Belgium",
    "Switzerland", "Portugal", "Australia", "Italy", "Austria", "Cyprus", "Japan", "Denmark",
    "Finland", "Norway", "Poland", "Sweden", "Greece",
]

# Other spellings of accepted countries, in title case.
COUNTRY_SYNONYMS = {
    "Uk": "United Kingdom",
    "England": "United Kingdom",
    "Britain": "United Kingdom",
    "Great Britain": "United Kingdom",
    "Ireland": "EIRE",
    "Republic Of Ireland": "EIRE",
    "Holland": "Netherlands",
    "Deutschland": "Germany",
}
