"""Column functions (built-in expressions only, no Python UDFs)."""

from natspark.functions.split import jsplit, item, text_lines
from natspark.functions.timefns import (floor_minutes_ms, event_time, msg_time,
                                        task_time, task_time_now)
from natspark.functions.ipaddr import ip_to_long, ip_to_long_strict
from natspark.functions.hashing import md5_hex, rowkey
from natspark.functions.docs import to_json_doc, strip_protocol

__all__ = ["jsplit", "item", "text_lines", "floor_minutes_ms",
           "event_time", "msg_time", "task_time", "task_time_now", "ip_to_long",
           "ip_to_long_strict", "md5_hex", "rowkey", "to_json_doc", "strip_protocol"]
