"""The queries as SQL for DuckDB, over the test tables."""

from __future__ import annotations

from tessellar.plans.queries import BAND, BUDGET, CITY, LEAF_Z, REGION, SPLIT_BUDGET, VINTAGE
from tessellar.plans.view import FEATURES

LAT = 85.0511287798066
F = f"f as ({FEATURES.format(events='events')})"
#: rows with a box
B = f"{F}, b as (select * from f where xmin is not null)"


def tile_x(lng: str, z: int) -> str:
    n = 1 << z
    return f"greatest(0, least({n - 1}, cast(floor(({lng} + 180.0::double) / 360.0::double * {n}) as int)))"


def tile_y(lat: str, z: int) -> str:
    n = 1 << z
    c = f"radians(greatest(-{LAT}::double, least({LAT}::double, {lat})))"
    return f"greatest(0, least({n - 1}, cast(floor((1.0::double - ln(tan({c}) + 1.0::double / cos({c})) / pi()) / 2.0::double * {n}) as int)))"


def edge_lng(x: str, z: str) -> str:
    return f"(({x}) / power(2.0::double, {z}) * 360.0::double - 180.0::double)"


def edge_lat(y: str, z: str) -> str:
    v = f"(pi() - 2.0::double * pi() * (({y}) / power(2.0::double, {z})))"
    return f"degrees(atan((exp({v}) - exp(-{v})) / 2.0::double))"


def extent(z: str, x: str, y: str) -> dict[str, str]:
    return {"west": edge_lng(x, z), "south": edge_lat(f"{y} + 1", z), "east": edge_lng(f"{x} + 1", z), "north": edge_lat(y, z)}


def overlaps(west: str, south: str, east: str, north: str) -> str:
    return f"(xmin < {east} and xmax > {west} and ymin < {north} and ymax > {south})"


def in_box(box) -> str:
    return overlaps(*(f"{v}::double" for v in (box.west, box.south, box.east, box.north)))


K = f"{B}, k as (select *, {tile_x('(xmin + xmax) / 2.0::double', 6)} as bx, {tile_y('(ymin + ymax) / 2.0::double', 6)} as b_y from b)"


def leaves(z: int) -> str:
    """CTEs up to ``l``: a row for each leaf of its own bucket that a box overlaps."""
    n, side = 1 << z, 1 << (z - 6)
    e = extent(str(z), "x", "y")
    c = lambda v: f"floor(({v} + 180.0::double) / 360.0::double * {n})"
    return f"""{K}, lx as (select *, unnest(range(cast(greatest({c("xmin")} - 1, bx * {side}) as bigint), cast(least({c("xmax")} + 1, bx * {side} + {side - 1}) as bigint) + 1)) as x from k),
    lxy as (select *, unnest(range(greatest({tile_y("ymax", z)} - 1, b_y * {side})::bigint, least({tile_y("ymin", z)} + 1, b_y * {side} + {side - 1})::bigint + 1)) as y from lx),
    l as materialized (select id, theme, xmin, ymin, xmax, ymax, {z} as z, cast(x as int) as x, cast(y as int) as y from lxy where {overlaps(e["west"], e["south"], e["east"], e["north"])})"""


def merged(z: int, floor_z: int, budget: int) -> str:
    """CTEs of the merge from zoom z up, over t0 (z, x, y, n); the last is named ``done``."""
    out, last = [], "t0"
    for i, level in enumerate(range(z, floor_z, -1), 1):
        out.append(f"""p{i} as materialized (select z - 1 as z, x >> 1 as x, y >> 1 as y, sum(n) as n from {last} where z = {level} group by 1, 2, 3 having count(*) = 4 and sum(n) <= {budget}),
        t{i} as materialized (select * from {last} t where not (z = {level} and exists (select 1 from p{i} p where p.x = t.x >> 1 and p.y = t.y >> 1)) union all select * from p{i})""")
        last = f"t{i}"
    return ", ".join([*out, f"done as (select * from {last})"])


C = f"""{B}, c0 as (select *, greatest(cast(floor((xmin + 180.0::double) / 0.1::double) as int), 0) as lon_lo, least(cast(floor((xmax + 180.0::double) / 0.1::double) as int), 3599) as lon_hi,
  greatest(cast(floor((ymin + 90.0::double) / 0.1::double) as int), 0) as lat_lo, least(cast(floor((ymax + 90.0::double) / 0.1::double) as int), 1799) as lat_hi from b),
  c as (select * from c0 where lon_hi - lon_lo <= 200 and lat_hi - lat_lo <= 200)"""

_edges = [int((REGION.west + 180) / 0.1), int((REGION.east + 180) / 0.1), int((REGION.south + 90) / 0.1), int((REGION.north + 90) / 0.1)]


def coarse(where: str = "true", clip: bool = False) -> str:
    e = [v // 10 for v in _edges]
    lon = ("lon_lo // 10", "lon_hi // 10") if not clip else (f"greatest(lon_lo // 10, {e[0]})", f"least(lon_hi // 10, {e[1]})")
    lat = ("lat_lo // 10", "lat_hi // 10") if not clip else (f"greatest(lat_lo // 10, {e[2]})", f"least(lat_hi // 10, {e[3]})")
    return f"""with {C}, x as (select *, unnest(range({lon[0]}, {lon[1]} + 1)) as coarse_lon from c where {where}),
    y as (select *, unnest(range({lat[0]}, {lat[1]} + 1)) as coarse_lat from x)
    select cast(coarse_lon as int) as coarse_lon, cast(coarse_lat as int) as coarse_lat, count(*) as n from y group by 1, 2"""


FINE = f"{C}, fx as (select *, unnest(range(lon_lo, lon_hi + 1)) as y from c), fine as (select *, unnest(range(lat_lo, lat_hi + 1)) as x from fx)"


def quadtree() -> str:
    """CTEs up to ``q`` (theme, z, x, y, n): depth by depth, the rows of tiles over budget go to quadrants."""
    out = [FINE, """r0 as materialized (select theme, 0 as z, cast(x as bigint) as x, cast(y as bigint) as y, xmin, ymin, xmax, ymax,
      y * 0.1::double + -180.0::double as west, x * 0.1::double + -90.0::double as south,
      least(y * 0.1::double + -180.0::double + 0.1::double, 180.0::double) as east, least(x * 0.1::double + -90.0::double + 0.1::double, 90.0::double) as north from fine)""",
      "h as materialized (select greatest(3, coalesce(max(n), 0) // 3) as budget from (select count(*) as n from fine group by theme, x, y))"]
    done = []
    for d in range(9):
        over = f"n > (select budget from h) and east - west > 0.001::double + 1e-9::double"
        out.append(f"s{d} as materialized (select theme, z, x, y, west, south, east, north, count(*) as n from r{d} group by all)")
        done.append(f"select theme, z, x, y, n from s{d} where not ({over})")
        parts = []
        for q in range(4):
            e, n = q & 1, q >> 1
            lon, lat = "(west + east) / 2.0::double", "(south + north) / 2.0::double"
            parts.append(f"select theme, z + 1 as z, x * 2 + {e} as x, y * 2 + {n} as y, xmin, ymin, xmax, ymax, {lon if e else 'west'} as west, {lat if n else 'south'} as south, {'east' if e else lon} as east, {'north' if n else lat} as north from big{d}")
        out.append(f"big{d} as materialized (select r.* from r{d} r where exists (select 1 from s{d} s where s.theme is not distinct from r.theme and s.x = r.x and s.y = r.y and s.z = r.z and {over.replace('n >', 's.n >').replace('east - west', 's.east - s.west')}))")
        out.append(f"r{d + 1} as materialized (select * from ({' union all '.join(parts)}) where {overlaps('west', 'south', 'east', 'north')})")
    return ", ".join([*out, f"q as ({' union all '.join(done)})"])


STATUS = f"""{K}, st as (select theme, bx as x, b_y as y, case b_y % 5 when 0 then 'failed' when 1 then 'empty' when 2 then 'in_progress' else 'done' end as status, count(*) * 1000 as size_bytes, count(*) as n from k group by all)"""

PEELS = "pl as (select cast(range as int) as peel_idx, cast((range + 18) % 36 as int) as ord, range * 10.0::double - 180.0::double as lng_lo, range * 10.0::double - 170.0::double as lng_hi from range(36))"

BASE = f"{leaves(6)}, t0 as materialized (select z, x, y, count(*) as n from l group by all)"
BASE_8 = f"{leaves(LEAF_Z)}, t0 as materialized (select z, x, y, count(*) as n from l group by all)"
DONE = "select cast(z as int) as z, cast(x as int) as x, cast(y as int) as y, cast(n as bigint) as n from done"
_e6 = extent("6", "x", "y")
IN_PEELS = f"{K}, {PEELS}, ip as (select * from k join pl on xmin < lng_hi and xmax > lng_lo)"
_box = {k: f"round({v}, 9) as {k}" for k, v in extent("z", "x", "y").items()}


def addresses(zooms: str) -> str:
    return f"select cast(z as int) as z, cast(x as int) as x, cast(y as int) as y from (select z, x, unnest(range(1::bigint << z)) as y from (select z, unnest(range(1::bigint << z)) as x from (select unnest({zooms}) as z)))"


INDEX = f"{BASE}, ix as (select z, x, y, n, {_e6['west']} as west, {_e6['south']} as south, {_e6['east']} as east, {_e6['north']} as north from t0)"

ORACLES = {
    "features_scan": f"with {F} select * from f",
    "theme_counts": f"with {F} select theme, count(*) as n from f group by 1",
    "filtered_count": f"with {B} select count(*) as n from b where {in_box(REGION)}",
    "union_themes": f"with {F} select theme, count(*) as n, count(*) filter (theme not in ('infrastructure', 'land_use', 'water')) as n_null_extra, count(*) filter (theme in ('buildings', 'land', 'segments')) as n_names from f group by 1",
    "theme_literal": f"with {F} select 'water' as theme, count(*) as n from f where theme in ('water', 'land')",
    "bbox_overlap": f"with {B} select id from b where {in_box(CITY)}",
    "region_filter": f"with {C} select id from c where {in_box(REGION)}",
    "lng_band": f"with {B} select id from b where xmin < {BAND[1]} and xmax > {BAND[0]}",
    "z6_key": f"with {K} select id, bx as x, b_y as y from k",
    "z6_counts": f"with {K} select bx as x, b_y as y, count(*) as n from k group by 1, 2",
    "z6_theme_counts": f"with {K} select bx as x, b_y as y, theme, count(*) as n from k group by 1, 2, 3",
    "z14_key": f"with {B} select id, {tile_x('(xmin + xmax) / 2.0::double', 14)} as x, {tile_y('(ymin + ymax) / 2.0::double', 14)} as y from b",
    "tile_extent": f"with a as ({addresses('[0, 1, 2, 3, 4]')}) select z, x, y, {', '.join(_box.values())} from a",
    "parent_child": f"with a as ({addresses('[1, 2, 3, 4]')}) select z, x, y, x >> 1 as parent_x, y >> 1 as parent_y from a",
    "bucket_leaves": f"select x6, y6, cast(x as int) as x, cast(y as int) as y from (select *, unnest(range(y6 * {1 << LEAF_Z - 6}, (y6 + 1) * {1 << LEAF_Z - 6})) as y from (select *, unnest(range(x6 * {1 << LEAF_Z - 6}, (x6 + 1) * {1 << LEAF_Z - 6})) as x from (values (33, 20), (0, 63)) v(x6, y6)))",
    "peel_table": f"with {PEELS} select peel_idx, lng_lo, lng_hi, ord from pl",
    "peel_order": f"with {PEELS} select peel_idx, ord from pl where peel_idx not in (18, 20) and ord >= 1 order by ord limit 10",
    "peel_keys": f"with {PEELS} select peel_idx, cast(x as int) as x, cast(y as int) as y from (select *, unnest(range(64)) as y from (select peel_idx, unnest(range(cast(floor((lng_lo + 180.0) / 360.0 * 64) as bigint), cast(floor((lng_hi + 180.0) / 360.0 * 64 - 1e-12) as bigint) + 1)) as x from pl))",
    "peel_partition": f"with {IN_PEELS} select peel_idx, bx as x, b_y as y, count(*) as n from ip group by 1, 2, 3",
    "peel_own_partition": f"with {IN_PEELS} select peel_idx, bx as x, b_y as y, count(*) as n from ip where bx between floor((lng_lo + 180.0) / 360.0 * 64) and floor((lng_hi + 180.0) / 360.0 * 64 - 1e-12) group by 1, 2, 3",
    "leaf_tiles": f"with {leaves(LEAF_Z)} select z, x, y, theme, count(*) as n from l group by all",
    "leaf_manifest": f"with {leaves(LEAF_Z)} select z, x, y, count(*) as feature_count, cast(sum(1 + id % 3) as bigint) as weight, sum(1 + id % 3) > {BUDGET} as oversize from l group by 1, 2, 3",
    "leaf_theme_maps": f"with {leaves(6)} select z, x, y, count(*) filter (theme = 'water') as water, count(*) filter (theme = 'land') as land, cast(count(distinct coalesce(theme, 'unknown')) as int) as themes, {', '.join(f'round({v}, 9) as {k}' for k, v in _e6.items())} from l group by 1, 2, 3",
    "empty_tiles": f"with {BASE} select case when n is null then 'empty' else 'done' end as status, count(*) as n, cast(coalesce(sum(n), 0) as bigint) as features from ({addresses('[6]')}) a left join t0 using (z, x, y) group by 1",
    "run_counters": f"with {BASE} select count(n) as written, count(*) - count(n) as empty, count(*) filter (n > {BUDGET}) as oversize, 0::bigint as failed from ({addresses('[6]')}) a left join t0 using (z, x, y)",
    "phase_a_split": f"""with {BASE}, big as (select z, x, y from t0 where n > {SPLIT_BUDGET}),
      ch as (select 7 as z, x * 2 + i as x, y * 2 + j as y, x as px, y as p_y from big, range(2) a(i), range(2) b(j)),
      kids as (select ch.z, ch.x, ch.y, count(*) as n from l join ch on l.x = px and l.y = p_y where {overlaps(*(v.replace("x /", "x/") for v in (edge_lng("ch.x", "7"), edge_lat("ch.y + 1", "7"), edge_lng("ch.x + 1", "7"), edge_lat("ch.y", "7"))))} group by 1, 2, 3)
      select z, cast(x as int) as x, cast(y as int) as y, n from (select * from t0 where n <= {SPLIT_BUDGET} union all select * from kids)""",
    "phase_b_step": f"with {BASE} select 5 as z, x >> 1 as x, y >> 1 as y, cast(sum(n) as bigint) as n from t0 group by 1, 2, 3 having count(*) = 4 and sum(n) <= {BUDGET}",
    "phase_b_full": f"with {BASE}, {merged(6, 0, BUDGET)} {DONE}",
    "phase_b_wide": f"with {BASE}, {merged(6, 0, 60)} {DONE}",
    "phase_b_floor6": f"with {BASE_8}, {merged(8, 6, BUDGET)} {DONE}",
    "phase_b_rekey": f"with {BASE}, {merged(6, 0, BUDGET)} select cast(d.z as int) as z, cast(d.x as int) as x, cast(d.y as int) as y, theme, count(*) as n from l join done d on d.x = l.x >> (6 - d.z) and d.y = l.y >> (6 - d.z) group by 1, 2, 3, 4",
    "merged_entries": f"with {BASE}, {merged(6, 0, BUDGET)} select cast(d.z as int) as z, cast(d.x as int) as x, cast(d.y as int) as y, count(*) as feature_count, count(*) > {BUDGET} as oversize, count(*) filter (theme = 'water') as water, cast(count(distinct coalesce(theme, 'unknown')) as int) as themes, {', '.join(f'round({v}, 9) as {k}' for k, v in extent('d.z', 'd.x', 'd.y').items())} from l join done d on d.x = l.x >> (6 - d.z) and d.y = l.y >> (6 - d.z) group by d.z, d.x, d.y",
    "cell_bounds": f"with {C} select id, lon_lo, lon_hi, lat_lo, lat_hi from c0",
    "span_clamp": f"with {C} select id from c",
    "cell_extent": f"with {C} select count(*) as rows, min(lon_lo) as lon_lo_min, max(lon_hi) as lon_hi_max, min(lat_lo) as lat_lo_min, max(lat_hi) as lat_hi_max from c",
    "fold_extents": f"with {C} select count(distinct theme) as files, count(*) as total_rows, count(*) * 10 as total_bytes, min(lon_lo) as lon_lo_min, max(lon_hi) as lon_hi_max, min(lat_lo) as lat_lo_min, max(lat_hi) as lat_hi_max from c",
    "coarse_explode": coarse(),
    "coarse_explode_region": coarse(f"lon_hi >= {_edges[0]} and lon_lo <= {_edges[1]} and lat_hi >= {_edges[2]} and lat_lo <= {_edges[3]}"),
    "coarse_explode_clipped": coarse(clip=True),
    "fine_cells": f"with {FINE} select cast(x as int) as x, cast(y as int) as y, count(*) as n from fine group by 1, 2",
    "region_fine_cells": f"select cast(a as int) as cell_lon, cast(b as int) as cell_lat from range({max(1900, int((CITY.west + 180) / 0.1))}, {min(1949, int((CITY.east + 180) / 0.1)) + 1}) r(a), range({max(1430, int((CITY.south + 90) / 0.1))}, {min(1469, int((CITY.north + 90) / 0.1)) + 1}) s(b)",
    "quadtree": f"with {quadtree()} select cast(z as int) as z, x, y, cast(sum(n) as bigint) as n, count(*) as themes from q group by 1, 2, 3",
    "quadtree_plan": f"with {quadtree()} select cast(z as int) as z, count(*) as tiles, cast(sum(n) as bigint) as n from q group by 1",
    "resume_todo": f"with {STATUS} select cast(a as int) as x, cast(b as int) as y from range(64) r(a), range(64) s(b) where not exists (select 1 from st where x = a and y = b and theme = 'water' and status in ('done', 'empty')) and not exists (select 1 from st where x = a and y = b and theme = 'land' and x < 10)",
    "existing_buckets": f"with {STATUS} select distinct x, y from st where x in (32, 33)",
    "bucket_sets": f"""with {STATUS}, w as (select x, y from st where theme = 'water'), d as (select x, y from st where theme = 'land')
      select 'union' as set, count(*) as n, cast(sum(x) as bigint) as sx from (select * from w union select * from d)
      union all select 'intersect', count(*), cast(sum(x) as bigint) from (select * from w intersect select * from d)
      union all select 'except', count(*), cast(sum(x) as bigint) from (select * from w except all select * from d)""",
    "bucket_counts": f"with {STATUS} select count(distinct (x, y)) as buckets, cast(sum(size_bytes) as bigint) as bytes from st",
    "status_rollup": f"with {STATUS} select theme, count(*) filter (status = 'done') as n_done, count(*) filter (status = 'empty') as n_empty, count(*) filter (status = 'failed') as n_failed, count(*) filter (status = 'in_progress') as n_in_progress, cast(coalesce(sum(size_bytes) filter (status = 'done'), 0) as bigint) as bytes, count(*) as visited, round(count(*) filter (status = 'done') * 100.0::double / count(*), 6) as percent from st group by 1",
    "downloads": "select 's3://data/part-' || o_orderkey || '.parquet' as file_key, o_orderkey * 10 as size_bytes, case when o_orderkey % 3 = 1 and o_orderkey % 2 = 0 and o_orderkey % 8 <> 0 then 'skip' when o_orderkey % 3 <> 0 then 'requeue' else 'fetch' end as action from orders",
    "counts_match": f"with {STATUS} select x, y, x % 4 = 1 as complete from st where theme = 'water'",
    "upsert_tiles": f"with {STATUS} select x, y, case when x % 2 = 0 then n * 100 else n end as n from st where theme = 'water'",
    "sorted_manifest": f"with {BASE} select row_number() over (order by z, x, y) as place, z, x, y, n as feature_count, z || ':' || x || ':' || y as key, z || '_' || x || '_' || y || '.parquet.gz' as name from t0 where x % 7 <> 0",
    "manifest_json": f"""with {BASE} select '{{"z":' || z || ',"x":' || x || ',"y":' || y || ',"size_bytes":' || n || ',"feature_count":' || n || '}}' as json from t0""",
    "index_refresh": f"with {INDEX}, o as (select *, (west + east) / 2.0 as mid from ix) select z, x, y, n as feature_count, '2025-01-01T00:00:00Z' as vintage from o where not (mid >= 0 and mid < 10) and x not in (32, 33) union all select z, x, y, n + 1, '{VINTAGE}' from o where x in (32, 33)",
    "index_peels": f"with {PEELS} select peel_idx, lng_lo, lng_hi, case when peel_idx = 18 then '{VINTAGE}' end as vintage from pl",
    "index_remove_peel": f"with {INDEX} select z, x, y from ix where not ((west + east) / 2.0 >= 0 and (west + east) / 2.0 < 10)",
    "viewport": f"with {INDEX} select z, x, y, n as feature_count from ix where east > -11.25 and west < 33.75 and north > 30 and south < 60",
    "file_hash": "select o_orderkey, substr(sha1('part-' || o_orderkey), 1, 12) as digest from orders",
    "byte_names": """with n as (select o_orderkey, power(10.0::double, o_orderkey % 14) * (1 + o_orderkey % 9) as n from orders)
      select o_orderkey, case when n >= 1e12 then format('{:.1f} TB', n / 1e12) when n >= 1e9 then format('{:.1f} GB', n / 1e9) when n >= 1e6 then format('{:.0f} MB', n / 1e6) else format('{:.0f} KB', n / 1e3) end as size, 'peel_' || lpad(cast(o_orderkey % 36 as varchar), 2, '0') as peel from n""",
    "checked_names": "select o_orderkey, o_orderkey % 3 <> 2 as release, cast(o_orderkey % 64 as int) as x, cast(o_custkey % 64 as int) as y from orders",
    "tile_round_trip": f"with {BASE}, {merged(6, 0, 400)} select cast(z as int) as z, cast(x as int) as x, cast(y as int) as y, true as same from done",
    "manifest_round_trip": f"with {BASE} select z, x, y, 'done' as status, n as feature_count, n as size_bytes from t0",
    "sorted_files": f"with {C} select count(*) as n, 0::bigint as rows_out_of_order, 0::bigint as files_that_overlap from c",
    "partition_round_trip": f"with {K} select count(distinct (bx, b_y)) as buckets, count(*) filter (bx = 34 and b_y = 20) as rows_34_20, false as leaks from k",
    "index_stream": f"with {INDEX} select z, x, y, n as feature_count from ix where x = 32 or x = 34",
}
