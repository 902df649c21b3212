"""Fixed values. They must stay exactly as written: model services, files and job specs depend on them."""

# Model ids are matched by these substrings, case-sensitively, in this order.
TEXT_MODEL_MARK = "anthropic"
EMBEDDING_MODEL_MARK = "amazon.titan-embed-text-v2:0"

# Request wire format of the text model.
TEXT_API_VERSION = "bedrock-2023-05-31"
BATCH_MAX_TOKENS = 1024
INLINE_MAX_TOKENS = 500
INLINE_TEMPERATURE = 0.7

# Job limits and the environment variables that override them.
DEFAULT_RECORDS_PER_JOB = 1000
RECORDS_PER_JOB_ENV = "MAX_RECORDS_PER_JOB"
TOTAL_RECORDS_ENV = "MAX_TOTAL_RECORDS"
INLINE_MAX_RECORDS = 10

# Job names.
JOB_NAME_LENGTH = 63
JOB_NAME_FORBIDDEN = "[^a-zA-Z0-9-]"

# Job states.
JOB_STATUSES = (
    "Submitted",
    "InProgress",
    "Completed",
    "Failed",
    "Stopping",
    "Stopped",
    "PartiallyCompleted",
    "Expired",
    "Validating",
    "Scheduled",
)
SUCCESS_STATUSES = ("Completed",)
FAILURE_STATUSES = ("Failed", "Stopped", "PartiallyCompleted", "Expired")

# File names.
INPUT_FORMATS = ("csv", "parquet")
OUTPUT_FILE_GLOB = "*.jsonl.out"
INDEX_COLUMN = "Unnamed: 0"
BLANK_HEADER = "_c0"

# Lengths of previews in reports.
RESPONSE_PREVIEW = 200
INPUT_PREVIEW = 100

# Failure alarm.
ALARM_PERIOD = "5 minutes"
ALARM_THRESHOLD = 1
JOB_TIMEOUT_HOURS = 24

# Characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
