"""DuckDB SQL of the queries that SQL can express."""

from match_lake.llm import licenses

ORACLES: dict[str, str] = {"op9_license_notices": licenses.oracle_sql()}

ORACLES["op6_exact_dedup"] = r"""
with hashed as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), grouped as (
  select text_sha256, min(doc_id) as keep_id, count(*) as group_size from hashed group by text_sha256
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from hashed join grouped using (text_sha256)
"""

ORACLES["op10_curriculum_mix"] = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5(coalesce(doc_id::varchar, '')) as turn
  from documents
), sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source asc nulls last) as r from sized group by source
), weighed as (
  select *, ((r - 1) % 3 + 1)::bigint as w, source_size * 3 as cap,
    ([1.5, 1.0, 0.5])[(r - 1) % 3 + 1]::double as ramp_start, ([0.5, 1.0, 1.5])[(r - 1) % 3 + 1]::double as ramp_end
  from sources
), filled as (
  select *, cap * (sum(w) over () - coalesce(sum(w) over lower, 0))
    <= w * (sum(source_size) over () - coalesce(sum(cap) over lower, 0)) as is_full
  from weighed
  window lower as (order by cap::double / w, r rows between unbounded preceding and 1 preceding)
), targets as (
  select source, source_size, ramp_start, ramp_end,
    case when is_full then cap::double
      else (w * (sum(source_size) over () - sum(case when is_full then cap else 0 end) over ()))::double
        / nullif(sum(w) over () - sum(case when is_full then w else 0 end) over (), 0)::double end as target
  from filled
), placed as (
  select doc_id, s.source, size, source_size, target, ramp_start, ramp_end,
    coalesce(sum(size) over (partition by s.source order by turn, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from sized s join targets t on s.source is not distinct from t.source
), timed as (
  select *, least(1.0::double, before::double / nullif(target, 0)) as part, floor(target)::bigint as budget from placed
)
select doc_id, source, size, source_size, target,
  (greatest(0, least(size, budget - before)) + greatest(0, least(size, budget - source_size - before))
    + greatest(0, least(size, budget - 2 * source_size - before)))::bigint as taken,
  coalesce(2.0::double * part / (ramp_start + sqrt(ramp_start * ramp_start + 2.0::double * (ramp_end - ramp_start) * part)), 0.0::double) as first_position
from timed
"""

ORACLES["op12_line_dedup"] = r"""
with numbered as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select r, doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from numbered
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), common as (
  select key from keyed where length(key) >= 1 group by key having count(distinct r) >= 10
), marked as (
  select keyed.*, common.key is not null as gone from keyed left join common using (key)
)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (gone))::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by r, doc_id
"""
