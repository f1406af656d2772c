select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time,
       event_type,
       approx_percentile(value, 0.9) as val,
       count(1) as sample_size
from events
where ts >= to_timestamp_ntz(:dt_start) and ts < to_timestamp_ntz(:dt_end)
group by 1, 2
