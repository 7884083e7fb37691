"""Structured Streaming jobs and stateful operators."""

from thermograph.streaming.actuators import (actuator_state_stream, bucketed_actuator_writer,
                                             transitions_stream)
from thermograph.streaming.telemetry import actuators, location_assignment, telemetry_ingest

__all__ = ["actuator_state_stream", "actuators", "bucketed_actuator_writer",
           "location_assignment", "telemetry_ingest", "transitions_stream"]
