"""DataFrame -> DataFrame operators."""

from thermograph.operators.actuators import (actuator_events, actuator_states,
                                             actuator_transitions, final_states)
from thermograph.operators.daynight import (daily_means, day_night_diff,
                                            day_night_diff_from_partials,
                                            room_day_partials)
from thermograph.operators.enrich import enrich, enrich_calendar, enrich_location
from thermograph.operators.months import max_month, monthly_diff_means
from thermograph.operators.moving import (level_view, moving_average, moving_averages,
                                          moving_averages_all_levels)
from thermograph.operators.readings import dedupe_readings, generate_readings
from thermograph.operators.telemetry import (check_locations, config_replies, filter_topics,
                                             parse_telemetry, route_topics,
                                             telemetry_with_location)
from thermograph.operators.words import (corpus_sizes, distinct_words_per_doc, letter_count,
                                         letter_count_per_doc, tokens, word_count,
                                         word_count_per_doc)

__all__ = [
    "actuator_events", "actuator_states", "actuator_transitions", "check_locations",
    "config_replies", "corpus_sizes", "daily_means", "day_night_diff",
    "day_night_diff_from_partials", "dedupe_readings", "distinct_words_per_doc",
    "enrich", "enrich_calendar", "enrich_location", "filter_topics", "final_states",
    "generate_readings", "letter_count", "letter_count_per_doc", "level_view",
    "max_month", "monthly_diff_means", "moving_average", "moving_averages",
    "moving_averages_all_levels", "parse_telemetry", "room_day_partials", "route_topics",
    "telemetry_with_location", "tokens", "word_count", "word_count_per_doc",
]
