"""Sources: readings CSV, the sensor view, text, and message streams."""

from thermograph.sources.messages import (MESSAGE_SCHEMA, PAYLOAD_SCHEMA, REQUEST_SCHEMA,
                                          read_message_stream, read_request_stream,
                                          telemetry_messages)
from thermograph.sources.readings import (read_readings_csv, readings_schema,
                                          sensor_readings, table)
from thermograph.sources.text import documents, read_text_files

__all__ = [
    "MESSAGE_SCHEMA", "PAYLOAD_SCHEMA", "REQUEST_SCHEMA", "documents",
    "read_message_stream", "read_readings_csv", "read_request_stream",
    "read_text_files", "readings_schema", "sensor_readings", "table",
    "telemetry_messages",
]
