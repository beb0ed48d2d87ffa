"""Record layouts (money is always an exact decimal)."""

from pyspark.sql import types as T

_TEXT, _INT, _LONG, _TIME, _DOUBLE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.TimestampType(),
    T.DoubleType(),
)
MONEY = T.DecimalType(13, 2)
UNIT_PRICE = T.DecimalType(8, 2)
LINE_TOTAL = T.DecimalType(11, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def expiring(schema: T.StructType) -> T.StructType:
    """Layout of a stored document that lives for a limited time."""
    return T.StructType([*schema.fields, T.StructField("expires_at", _TIME)])


LINE_ITEM_IN = _struct(sku=_TEXT, qty=_INT, unit_price=UNIT_PRICE)
LINE_ITEM_OUT = _struct(sku=_TEXT, qty=_INT, unit_price=UNIT_PRICE, line_total=LINE_TOTAL)
QUOTE_REQUEST = _struct(items=T.ArrayType(LINE_ITEM_IN), region=_TEXT, coupon=_TEXT)
HEADERS = T.ArrayType(_struct(key=_TEXT, value=T.BinaryType()))
MESSAGE = _struct(
    key=_TEXT,
    value=_TEXT,
    timestamp=_TIME,
    topic=_TEXT,
    partition=_INT,
    offset=_LONG,
    headers=HEADERS,
)
QUOTE_EVENT = _struct(
    job_id=_TEXT,
    position=_INT,
    region=_TEXT,
    item_count=_INT,
    gross_amount_cents=_LONG,
    coupon=_TEXT,
)
QUOTE = _struct(
    id=_TEXT,
    region=_TEXT,
    currency=_TEXT,
    coupon=_TEXT,
    line_items=T.ArrayType(LINE_ITEM_OUT),
    subtotal=MONEY,
    discount=MONEY,
    tax=MONEY,
    shipping=MONEY,
    total=MONEY,
    created_at=_TEXT,
)
QUOTE_JOB = _struct(
    job_id=_TEXT,
    status=_TEXT,
    total_requests=_INT,
    quote_ids=T.ArrayType(_TEXT),
    error=_TEXT,
)
REGION_TOTALS = _struct(quote_count=_LONG, item_count=_LONG, gross_amount_cents=_LONG)
REGION_STATS = T.StructType(
    [*_struct(region=_TEXT, window_start=_TIME, window_end=_TIME).fields, *REGION_TOTALS.fields]
)
DEAD_LETTER = _struct(key=_TEXT, value=_TEXT, headers=HEADERS)
REQUEST_LOG = _struct(
    seq=_LONG,
    request_id=_TEXT,
    ts=_TIME,
    backend=_TEXT,
    status=_INT,
    latency_ms=_DOUBLE,
    consumer=_TEXT,
    api_key=_TEXT,
    service=_TEXT,
)
SNAPSHOT = _struct(
    samples=_LONG,
    errors=_LONG,
    by_backend=T.MapType(_TEXT, _LONG),
    p95_ms=_DOUBLE,
    updated_at=_TIME,
)
MESSAGE_OUTCOME = _struct(
    partition=_INT, offset=_LONG, key=_TEXT, value=_TEXT, job_id=_TEXT, outcome=_TEXT, reason=_TEXT
)
STREAM_CLOCK = _struct(stream=_TEXT, stream_time=_TIME)
LATE_EVENT = T.StructType([*QUOTE_EVENT.fields, *_struct(timestamp=_TIME, stream_time=_TIME).fields])
