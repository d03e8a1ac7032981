from tidemark.functions.scalars import (
    average_whole,
    day,
    kb_to_gb,
    local_day,
    moment,
    qualified,
    seconds_between,
)

__all__ = ["average_whole", "day", "kb_to_gb", "local_day", "moment", "qualified", "seconds_between"]
