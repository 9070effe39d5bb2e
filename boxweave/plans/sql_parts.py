"""Named subqueries shared by the oracle SQL."""

from __future__ import annotations

from boxweave import config


def values(columns: str, rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "null"
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) v({columns})"


CLASSES = values("class_id, class_name", list(enumerate(config.CLASS_NAMES)))
CLASS_NAME = "coalesce(c.class_name, concat('unknown_id_', cast(b.class_id as varchar)))"

MEASURED = """
select *, w * h as area, case when least(w, h) <= 0 then cast('inf' as double) else greatest(w, h) / least(w, h) end as elong
from boxes"""

FENCES = """
select source, class_id, measure, max(n) as n,
  max(case when i = 1 then q end) as q1, max(case when i = 2 then q end) as median, max(case when i = 3 then q end) as q3,
  case when max(n) >= 20 then max(case when i = 3 then q end)
    + cast(1.5 as double) * (max(case when i = 3 then q end) - max(case when i = 1 then q end)) end as fence
from (
  select source, class_id, measure, n, i,
    case when max(d) = 0 then max(case when rn = j then value end)
    else (max(case when rn = j then value end) * (4 - max(d)) + max(case when rn = j + 1 then value end) * max(d)) / 4 end as q
  from (
    select r.*, i, greatest(1, least(n - 1, (i * (n + 1)) // 4)) as j,
      i * (n + 1) - 4 * greatest(1, least(n - 1, (i * (n + 1)) // 4)) as d
    from (
      select *, row_number() over (partition by source, class_id, measure order by value) as rn,
        count(*) over (partition by source, class_id, measure) as n
      from (select source, class_id, 'area' as measure, area as value from measured
            union all select source, class_id, 'elong', elong from measured where elong < cast('inf' as double)) m
    ) r cross join (values (1), (2), (3)) t(i)
  ) k where rn in (j, j + 1)
  group by source, class_id, measure, n, i
) s group by source, class_id, measure"""

WIDE_FENCES = """
select source, class_id, max(case when measure = 'area' then median end) as area_median,
  max(case when measure = 'elong' then median end) as elong_median,
  max(case when measure = 'area' then fence end) as area_fence,
  max(case when measure = 'elong' then fence end) as elong_fence
from fences group by source, class_id"""

INVALID_KIND = """case when w <= 0 or h <= 0 then 'non-positive width/height'
  when greatest(-(cx - w / 2), -(cy - h / 2), cx + w / 2 - 1, cy + h / 2 - 1, 0) > {eps} then 'box extends outside image bounds' end"""

FLAGGED = f"""
select * from (
  select m.*, f.area_fence, f.elong_fence,
    ({INVALID_KIND.format(eps='cast(1e-4 as double)')}) is not null as r_invalid,
    area < cast(1e-4 as double) as r_tiny,
    coalesce(area > area_fence, false) as r_area,
    coalesce(elong > elong_fence, false) as r_shape
  from measured m left join wide_fences f on m.source = f.source and m.class_id = f.class_id
) x where r_invalid or r_tiny or r_area or r_shape"""

REASON_KEYS = """concat_ws(',', case when r_invalid then 'invalid' end, case when r_tiny then 'tiny_box' end,
  case when r_area then 'large_area_outlier' end, case when r_shape then 'shape_outlier' end)"""

AUDIT = {"measured": MEASURED, "fences": FENCES, "wide_fences": WIDE_FENCES, "flagged": FLAGGED, "classes": CLASSES}
