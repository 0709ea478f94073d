from ledgerloom.functions.numeric import (
    MONEY,
    RATIO,
    money,
    parse_whole_number,
    ratio,
    round_half_away,
    safe_ratio,
    spread_bucket,
    to_double,
    whole_number,
)
from ledgerloom.functions.temporal import hours_between, parse_date, parse_timestamp

__all__ = [
    "MONEY", "RATIO", "money", "ratio", "round_half_away", "safe_ratio", "spread_bucket",
    "to_double", "whole_number", "parse_whole_number", "hours_between", "parse_date", "parse_timestamp",
]
