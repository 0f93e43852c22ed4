"""Fixed values.

These must equal the original jobs' values for the results to be the same
(output formats, literals, window and lateness settings, topic names).
They are kept here, together and in plain text, and imported elsewhere.
"""

# --- fixed values (must match the original jobs) -----------------------------

# windows, triggers and lateness
JOIN_WINDOW = "20 seconds"          # tumbling window of both stream joins
EARLY_FIRING_DELAY = "20 seconds"   # early panes after the first element
ALLOWED_LATENESS = "20 seconds"     # late data accepted after the watermark
FILE_WINDOW = "5 seconds"           # window of the windowed Parquet job
BOUNDED_STAMP_OFFSET = "30 seconds"  # bounded rows: pipeline start + 30 s

# text formats
COGROUP_LINE = ("K: [", "], SVs: ", ", BVs: ")   # K: [k], SVs: <s>, BVs: <b>
BRACKET_ITEM = ("[", "],")                       # one grouped value: [v],
NULL_TEXT = "null"                               # NULL as Java prints it; lookup miss
DUPLICATE_KEY_MESSAGE = "Duplicate values for "  # + key
SEQUENCE_LINE = "IO IT Test line of text. Line seed: %s"
EMPLOYEE_TEMPLATE = "key: %s, val: Employee{Name='%s', Address=%s}"

# separators
CSV_SEPARATOR = ","       # k,v lines
EMPLOYEE_SEPARATOR = "_"  # name_country records
PREFIX_SEPARATOR = "_"    # <userValue>_<word>

# routing, parameters, sinks
ROUTE_TOPICS = ("topic2", "topic1")  # even sequence -> topic2, odd -> topic1
USER_VALUE = "UserValue"             # default run-time parameter
KINESIS_PARTITION_KEY = "key"        # constant partition key of the stream writer
REGISTRY_MAGIC_HEX = "00"            # registry frame: magic byte
REGISTRY_HEADER_BYTES = 5            # magic byte + 4-byte schema id
