"""Fixed values of the warehouse: topic names, sink kinds, time settings.

These are the values the original jobs use; results depend on them, so they
are stated here once, plainly, and imported everywhere else.
"""

# --- fixed values: topic names per layer -----------------------------------
TOPIC_ODS_LOG = "ods_log"
TOPIC_ODS_DB = "ods_db"
TOPIC_DWD_PAGE = "dwd_page"
TOPIC_DWD_DISPLAY = "dwd_display"
TOPIC_DWD_START = "dwd_start"
TOPIC_DWD_ORDER_INFO = "dwd_order_info"
TOPIC_DWD_ORDER_DETAIL = "dwd_order_detail"
TOPIC_DWM_UV = "dwm_uv"
TOPIC_DWM_UJ = "dwm_uj"

# --- fixed values: routing targets named in the config table ---------------
SINK_TO_KAFKA = "kafka"
SINK_TO_HBASE = "hbase"

# --- fixed values: change-record handling ----------------------------------
BOOTSTRAP_PREFIX = "bootstrap-"
KEPT_CHANGE_TYPES = ("insert", "update")
DEFAULT_DIM_PK = "id"

# --- fixed values: event-time settings (milliseconds) ----------------------
WATERMARK_DELAY_MS = 3_000        # bounded out-of-orderness
WINDOW_MS = 5_000                 # tumbling window of repair and unique visitor
BOUNCE_GAP_MS = 5_000             # "within" limit of the bounce pattern
JOIN_LOWER_MS = -5_000            # interval join, detail time relative to order
JOIN_UPPER_MS = 5_000
TRIGGER_INTERVAL = "3 seconds"    # checkpoint / micro-batch period

# --- how a device is split by time in the bounce search (any value gives the same rows)
BOUNCE_BUCKET_MS = 600_000

# --- fixed values: date formats --------------------------------------------
DAY_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
