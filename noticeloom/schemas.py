"""Column lists and schemas of the tables that pass between the operators."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PAGES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# The field names of the two JSONL record shapes, in their written order.
BOARD_ONE_FIELDS = (
    "pbancSn", "category", "dday", "title", "program",
    "org", "start", "deadline", "agency_type", "url",
)
UNIFIED_FIELDS = (
    "source", "id", "title", "field", "org", "apply_start", "apply_end", "reg_date", "url",
)

BOARD_ONE = _strings(*BOARD_ONE_FIELDS)
UNIFIED = _strings(*UNIFIED_FIELDS)
# Every named field of either shape, each once.
RECORD = _strings(*dict.fromkeys((*UNIFIED_FIELDS, *BOARD_ONE_FIELDS)))

KEY = ["source", "id"]

DIFF_STATUSES = (
    "new", "closed", "deadline_changed", "unchanged", "first_time", "not_recrawled",
)
