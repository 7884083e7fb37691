"""Column expressions (built-in Spark functions only)."""

from thermograph.functions.calendar import epoch_micros, is_daytime, is_night
from thermograph.functions.exact import cents_to_double, half_even_div, mean_2dp, to_cents
from thermograph.functions.location import location_part, location_prefix, valid_location
from thermograph.functions.text import letter_occurrences, split_words
from thermograph.functions.topics import (config_reply_topic, location_to_topic,
                                          route_direction, sensor_location,
                                          topic_matches, topic_to_location)

__all__ = [
    "cents_to_double", "config_reply_topic", "epoch_micros", "half_even_div",
    "is_daytime", "is_night", "letter_occurrences", "location_part",
    "location_prefix", "location_to_topic", "mean_2dp", "route_direction",
    "sensor_location", "split_words", "to_cents", "topic_matches",
    "topic_to_location", "valid_location",
]
