select t.day as measure_time,
       t.event_type,
       t.total as val,
       p.val as func_var_median
from daily_totals t
join daily_p50 p on p.measure_time = t.day and p.event_type = t.event_type
