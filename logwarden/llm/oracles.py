"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Rows are numbered by plain windows over whole sources or shards; the operators use cells.
_MIXING = r"""
with sized as (
  select doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    source is null as no_source, coalesce(source, '') as source, coalesce(doc_id::varchar, '') as spread
  from documents),
sources as (
  select no_source, source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as top,
    (row_number() over (order by no_source, source) - 1) % 3 + 1 as weight
  from sized group by no_source, source),
shares as (
  select *, sum(source_size) over () - coalesce(sum(top) over (order by top / weight, no_source, source rows between unbounded preceding and 1 preceding), 0) as remaining,
    sum(weight) over (order by top / weight, no_source, source rows between current row and unbounded following) as heft,
    row_number() over (order by top / weight, no_source, source) as place
  from sources),
level as (select place, remaining, heft from shares where remaining * weight <= top * heft order by place limit 1),
aims as (
  select s.no_source, s.source, s.source_size,
    case when l.place is null or s.place < l.place then s.top::double else (s.weight * l.remaining)::double / l.heft::double end as target
  from shares s left join level l on true),
ranked as (
  select *, (('0x' || substr(md5(spread), 1, 12))::ubigint % 4096) as cell, length(bin(size + 1)) * 16 + (((size + 1) * 16) >> length(bin(size + 1))) as band
  from sized),
numbered as (
  select *, row_number() over (partition by no_source, source order by band, cell, size, spread) as place from ranked),
crossed as (
  select n.doc_id, n.size, a.source_size, a.target, n.place,
    case when a.source_size > 0 then floor(a.target / a.source_size * 16777216)::hugeint else 0 end as rate,
    (('0x' || substr(md5('mix/' || n.no_source::varchar || '/' || n.source), 1, 12))::ubigint % 16777216)::hugeint as first
  from numbered n join aims a on n.no_source = a.no_source and n.source = a.source)
select doc_id, size, source_size, target,
  (size * ((place * rate + first) // 16777216 - ((place - 1) * rate + first) // 16777216))::bigint as taken
from crossed
"""

# With equal weights the highest draw has the highest score. The checksum takes one table step per byte.
_SHARDING = """
with steps as (
  select list_transform(range(256), lambda n: list_reduce(
    list_concat([n::ubigint], [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: case when c % 2 = 1 then xor(c // 2, 3988292384::ubigint) else c // 2 end)) as step),
rows as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text, coalesce(doc_id::varchar, '') as key from documents),
summed as (
  select row, doc_id, key, (strlen(text) + 1)::bigint as size,
    xor(4294967295::ubigint, list_reduce(
      list_concat([4294967295::ubigint], list_transform(regexp_extract_all(hex(text), '..'), lambda b: ('0x' || b)::ubigint)),
      lambda c, b: xor(c // 256, step[(xor(c, b) % 256 + 1)::bigint])))::bigint as text_crc32
  from rows, steps),
draws as (
  select row, shard, ('0x' || substr(md5('shard/' || shard::varchar || '/' || key), 1, 12))::ubigint as draw
  from rows, range(17) r(shard)),
chosen as (
  select row, min(shard) filter (draw = most and shard < 16) as shard, min(shard) filter (draw = most_grown) as grown_shard
  from (select row, shard, draw, max(draw) filter (shard < 16) over (partition by row) as most, max(draw) over (partition by row) as most_grown from draws) d
  group by row)
select doc_id, size, text_crc32, 'key' as law, shard::integer as shard,
  row_number() over (partition by shard order by ('0x' || substr(md5(key), 1, 8))::ubigint % 1024, doc_id nulls first, text_crc32, size) - 1 as slot,
  grown_shard::integer as grown_shard
from summed join chosen using (row)
"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _overlapping(words: int, percent: int, columns: str) -> str:
    """Components of texts whose word shingles overlap, by a plain join on shingles."""
    return rf"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
classes as (
  select row_number() over (order by min(doc_id), w) as c, w, min(doc_id) as least from texts where len(w) > 0 and doc_id is not null group by w),
shingles as (
  select c, unnest(list_distinct(case when len(w) < {words} then [array_to_string(w, ' ')]
    else [array_to_string(w[i:i + {words - 1}], ' ') for i in range(1, len(w) - {words - 2})] end)) as s from classes),
sizes as (select c, count(*) as n from shingles group by c),
links as (
  select a, b from (select x.c as a, y.c as b, count(*) as k from shingles x join shingles y on x.s = y.s and x.c < y.c group by all) p
  join sizes m on m.c = a join sizes o on o.c = b where 100 * k >= {percent} * (m.n + o.n - k)),
both_ways as (select a, b from links union all select b, a from links),
reached as (select c, c as r from classes union select reached.c, b from reached join both_ways on a = r),
components as (select reached.c, min(least) as component_id from reached join classes on classes.c = r group by all),
every as (
  select doc_id, len(list_distinct(case when len(t.w) = 0 then [] when len(t.w) < {words} then [array_to_string(t.w, ' ')]
      else [array_to_string(t.w[i:i + {words - 1}], ' ') for i in range(1, len(t.w) - {words - 2})] end)) as n_shingles,
    case when doc_id is null then null when len(t.w) = 0 then doc_id else component_id end as component_id
  from texts t left join classes on classes.w = t.w left join components on components.c = classes.c)
select {columns} from every"""


_INFILL = """
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (
  select *, len(u) as n, cast('0x' || h[1:8] as ubigint) as h1, cast('0x' || h[9:16] as ubigint) as h2,
    cast('0x' || h[17:24] as ubigint) as h3, cast('0x' || h[25:32] as ubigint) as h4 from units),
cut as (
  select *, cast(least(h1 % (n + 1), h2 % (n + 1)) as bigint) as a, cast(greatest(h1 % (n + 1), h2 % (n + 1)) as bigint) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
parts as (
  select *, array_to_string(u[1:a], '') as head, array_to_string(u[a + 1:b], '') as body, array_to_string(u[b + 1:], '') as tail from cut)
select doc_id, n, form, case when form <> 'plain' then length(head) end as prefix_chars,
  case when form <> 'plain' then length(body) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || head || '<S>' || tail || '<M>' || body
    else '<S>' || tail || '<P>' || head || '<M>' || body end) as output_sha256,
  sha256(text) as restored_sha256
from parts"""

ORACLES: dict[str, str] = {
    "op5_mixing": _MIXING,
    "op8_sharding": _SHARDING,
    "op4_near_duplicates": _overlapping(5, 75, "doc_id, n_shingles, component_id, coalesce(doc_id = component_id, true) as kept"),
    "op12_infill": _INFILL,
    "op13_overlap": _overlapping(4, 85, "doc_id, n_shingles, component_id"),
}
