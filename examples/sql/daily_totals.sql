select cast(floor(unix_timestamp(ts) / 86400) * 86400 as bigint) as day,
       event_type,
       sum(value) as total
from events
group by 1, 2
