from txvigil.functions.clock import epoch_minute, epoch_us, parse_timestamp, stamp
from txvigil.functions.nulls import checked_cast, null_if_token

__all__ = [
    "checked_cast",
    "epoch_minute",
    "epoch_us",
    "null_if_token",
    "parse_timestamp",
    "stamp",
]
