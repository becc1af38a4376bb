"""Session-rate analytics on Spark: parse JSON game events, window them per session,
compute rates/counts/spans/grouped lists, and turn results into metrics and feedback.

Every operator is a ``DataFrame -> DataFrame`` function that runs on batch and
streaming DataFrames alike.
"""

from sessionrate.operators.metrics import (feedback_checked, metric_feedback,
                                           to_kafka_record, to_metric)
from sessionrate.operators.parse import (empty_record_flags, parse_events, schema_violation_counts,
                                         schema_violations, sentinels_to_null, split_rejects)
from sessionrate.operators.rates import (action_rate, activity_span, event_count, event_rate,
                                         filter_actor_type, filter_event_type, session_activity,
                                         window_summary, windowed_group, windowed_group_text)
from sessionrate.operators.windows import expand_windows, windowed_aggregate
from sessionrate.plans.jobs import (decoded_events, feedback_job, fine_rates_job, grouped_job,
                                    kill_rate_job, move_rate_job)
from sessionrate.session import checkpoint_root, get_spark
from sessionrate.sources.kafka import decode_envelope, kafka_options, read_kafka

__all__ = [
    "action_rate", "activity_span", "checkpoint_root", "decode_envelope", "decoded_events",
    "empty_record_flags", "event_count", "event_rate", "expand_windows", "feedback_checked",
    "feedback_job", "filter_actor_type", "filter_event_type", "fine_rates_job", "get_spark",
    "grouped_job", "kafka_options", "kill_rate_job", "metric_feedback", "move_rate_job",
    "parse_events", "read_kafka", "schema_violation_counts", "schema_violations",
    "sentinels_to_null", "session_activity", "split_rejects", "to_kafka_record", "to_metric",
    "window_summary", "windowed_aggregate", "windowed_group", "windowed_group_text",
]
