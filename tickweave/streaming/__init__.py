"""Structured Streaming versions of the feed, bars, rule and scoring."""

from tickweave.streaming.bars import (  # noqa: F401
    CorrectedBars,
    RuleStream,
    dedup_stream,
    file_feed,
    stream_bars,
    with_event_time,
)
from tickweave.streaming.learn import OnlineLogisticBag, stream_score  # noqa: F401
