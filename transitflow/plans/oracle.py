"""Reference SQL (DuckDB dialect) for every registered query.

Each query is a plain, brute-force SQL statement over the driver's tables:
ordinary windows per shape and an unrestricted stop x segment join per shape,
so it checks the Spark jobs (chunked windows, grid-keyed corridor join)
against the direct formulation.  Geometry is expanded inline.
"""

from __future__ import annotations

from .oracle_geometry import (along_sql, between_sql, cross_track_sql, dist_sql, haversine_sql, line_code_sql,
                              near_side_sql, nearest_latlon_sql, on_segment_sql, planar_distance_sql,
                              planar_projection_sql, signed_along_sql, signed_cross_track_sql, turn_sql)

LINE_GROUP = r"\bBRS?\b (([A-D]|I|[0-9])+, ?)+([A-Za-z0-9 -])+"

# ---- fixture projections (FIXTURES.md section 3, same text as the Spark side)
FX = {
    "fx_shape_points": """
select cast(l_orderkey as varchar) as shape_id,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
            l_shipdate, l_extendedprice) as int) as sequence,
       -22.9e0 + cast((l_partkey * 7919) % 101 as double) / 1e3 as lat,
       -43.2e0 - cast((l_partkey * 104729) % 103 as double) / 1e3 as lon
from lineitem""",
    "fx_stops": """
select cast(p_partkey as varchar) as id,
       case when p_partkey % 10 = 0 then '' when p_partkey % 10 = 1
            then concat(p_brand, '-LONG-CODE-0123456789') else p_brand end as code,
       p_name as name,
       case when p_partkey % 7 = 0 then null else p_type end as info,
       -22.9e0 + cast((p_partkey * 7919) % 101 as double) / 1e3 as lat,
       -43.2e0 - cast((p_partkey * 104729) % 103 as double) / 1e3 as lon
from part""",
    "fx_trips": """
select o_orderkey as id, cast(o_custkey as varchar) as route_id, cast(o_orderkey % 2 as int) as direction,
       o_orderpriority as headsign, cast(o_orderkey as varchar) as shape_id
from orders""",
    "fx_stop_times": """
select l_orderkey as trip_id, cast(l_partkey as varchar) as stop_id, l_linenumber as sequence from lineitem""",
    "fx_fares": """
select cast(n_nationkey as varchar) as id, cast(2.5e0 + n_nationkey * 0.25e0 as float) as price,
       cast(n_nationkey % 3 as int) as transfers, cast(n_nationkey * 60 as int) as transfer_duration
from nation""",
    "fx_fare_rules": """
select cast(c_nationkey as varchar) as fare_id, cast(c_custkey as varchar) as route_id from customer
where c_custkey % 11 <> 0
union all
select cast((c_nationkey + 1) % 25 as varchar) as fare_id, cast(c_custkey as varchar) as route_id
from customer where c_custkey % 5 = 0""",
    "fx_routes": """
select cast(c_custkey as varchar) as route_id, cast(c_custkey % 1000 as varchar) as code,
       case when c_custkey % 13 = 0 then c_mktsegment else concat(c_mktsegment, ' - VIA - ', c_name) end as name,
       concat('desc ', c_mktsegment) as description, '0000FF' as color
from customer""",
    "fx_gps": """
select event_id, ts as datetime, concat('A', cast(user_id as varchar)) as serial_number,
       case cast(event_id % 7 as int) when 0 then '' when 1 then '12' when 2 then '123' when 3 then '12.0'
            when 4 then '2345' when 5 then '123.0' else 'SV9171' end as line,
       -22.9e0 + cast((event_id * 7919) % 101 as double) / 1e3 as lat,
       -43.2e0 - cast((event_id * 104729) % 103 as double) / 1e3 as lon,
       value as vel, event_type as direction
from events""",
}


def with_fx(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} as ({FX[n]})" for n in names] + [f"{n} as ({q})" for n, q in (extra or [])]
    return "with " + ",\n".join(parts) + "\n"


# ---- shared pipeline stages ------------------------------------------------------

SHAPES = f"""
select shape_id as id, row_number() over w2 - 1 as sequence, lat1, lon1, lat2, lon2, dist,
       sum(dist) over (w2 rows between unbounded preceding and current row) as total_dist
from (
  select shape_id, sequence as pseq, lat1, lon1, lat2, lon2, {dist_sql('lat1', 'lon1', 'lat2', 'lon2')} as dist
  from (select shape_id, sequence, lat as lat1, lon as lon1,
               lead(lat) over w as lat2, lead(lon) over w as lon2
        from fx_shape_points window w as (partition by shape_id order by sequence, lat, lon)) p
  where lat2 is not null and lat1 <> lat2 and lon1 <> lon2
) s
window w2 as (partition by shape_id order by pseq, lat1, lon1)"""

TRIPS = """
select t.id, t.route_id, t.direction, t.headsign, t.shape_id
from fx_trips t join (select min(id) as id from fx_trips group by route_id) m on t.id = m.id"""

STOP_TIMES = """
select st.trip_id, st.stop_id, st.sequence, t.shape_id
from fx_stop_times st join trips t on st.trip_id = t.id"""

MATCHES = f"""
select r.trip_id, r.stop_id, r.sequence, r.lat, r.lon, s.sequence as seg_sequence,
       s.lat1, s.lon1, s.lat2, s.lon2, s.dist, s.total_dist,
       {along_sql('r.lat', 'r.lon', 's.lat1', 's.lon1', 's.lat2', 's.lon2')} as along
from (select st.trip_id, st.stop_id, st.sequence, st.shape_id, p.lat, p.lon
      from stop_times st join fx_stops p on st.stop_id = p.id) r
join shapes s on r.shape_id = s.id
where {on_segment_sql('r.lat', 'r.lon', 's.lat1', 's.lon1', 's.lat2', 's.lon2')}"""

_PIPE = ("fx_shape_points", "fx_trips", "fx_stop_times", "fx_stops")
_PIPE_STAGES = [("shapes", SHAPES), ("trips", TRIPS), ("stop_times", STOP_TIMES), ("matches", MATCHES)]


def _matches_query(select: str) -> str:
    return with_fx(*_PIPE, extra=_PIPE_STAGES) + select


GPS_CLEAN_COLS = (f"date_trunc('second', datetime) as datetime, serial_number, {line_code_sql('line')} "
                  f"as route_code, lat, lon, vel, direction")


ROUTES = """
select r.route_id as id, r.code
from fx_routes r join fx_fare_rules f on r.route_id = f.route_id"""


def _gps_on_routes(max_offset_m: str = "100e0", fixes: str | None = None,
                   keep: str = "serial_number, datetime, route_code") -> str:
    fixes = fixes or f"(select event_id, {GPS_CLEAN_COLS} from fx_gps)"
    a6 = ("g.lat", "g.lon", "s.lat1", "s.lon1", "s.lat2", "s.lon2")
    near_side = near_side_sql(*a6)
    off = (f"case when {between_sql(*a6)} and ({near_side}) and not (s.lat1 = s.lat2 and s.lon1 = s.lon2) "
           f"then {cross_track_sql(*a6)} else least({dist_sql('g.lat', 'g.lon', 's.lat1', 's.lon1')}, "
           f"{dist_sql('g.lat', 'g.lon', 's.lat2', 's.lon2')}) end")
    cand = f"""
select g.event_id, g.serial_number, g.datetime, g.route_code, s.id as shape_id, s.sequence as seg_sequence,
       {off} as offset_m, s.total_dist - s.dist + {along_sql(*a6)} as route_dist
from {fixes} g
join (select distinct r.code as route_code, t.shape_id
      from (select distinct id, code from routes) r join trips t on r.id = t.route_id) c
  on g.route_code = c.route_code
join shapes s on s.id = c.shape_id"""
    return with_fx("fx_shape_points", "fx_trips", "fx_routes", "fx_fare_rules", "fx_gps", extra=[
        ("shapes", SHAPES), ("trips", TRIPS), ("routes", ROUTES), ("cand", cand)]) + f"""
select {keep}, shape_id, seg_sequence, round(offset_m, 2) as offset_m,
       round(route_dist, 2) as route_dist
from (select *, row_number() over (partition by event_id order by round(offset_m, 3), shape_id, seg_sequence) as rn
      from cand where offset_m <= {max_offset_m}) x
where rn = 1"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["shape_pairs"] = with_fx("fx_shape_points") + """
select * from (
  select shape_id, sequence, lead(sequence) over w as sequence2, lat as lat1, lon as lon1,
         lead(lat) over w as lat2, lead(lon) over w as lon2
  from fx_shape_points window w as (partition by shape_id order by sequence, lat, lon)) p
where lat2 is not null"""
    q["shapes_build"] = with_fx("fx_shape_points", extra=[("shapes", SHAPES)]) + """
select id, sequence, lat1, lon1, lat2, lon2, round(dist, 3) as dist, round(total_dist, 3) as total_dist
from shapes"""
    q["shape_lengths"] = with_fx("fx_shape_points", extra=[("shapes", SHAPES)]) + """
select id, count(*) as n_segments, round(max(total_dist), 3) as length from shapes group by id"""
    hot_points = """
select o.o_orderpriority as shape_id,
       row_number() over (partition by o.o_orderpriority order by l.l_orderkey, l.l_linenumber, l.l_partkey,
                          l.l_suppkey, l.l_shipdate, l.l_extendedprice) as sequence,
       -22.9e0 + cast((l.l_partkey * 7919) % 101 as double) / 1e3 as lat,
       -43.2e0 - cast((l.l_partkey * 104729) % 103 as double) / 1e3 as lon
from lineitem l join orders o on l.l_orderkey = o.o_orderkey"""
    q["hot_shape_lengths"] = "with " + ",\n".join([
        f"fx_shape_points as ({hot_points})", f"shapes as ({SHAPES})"]) + """
select id, count(*) as n_segments, round(max(total_dist), 3) as length from shapes group by id"""
    stitched = "with " + ",\n".join([f"fx_shape_points as ({hot_points})", f"shapes as ({SHAPES})"]) + """
select id, sequence, lat1, lon1, lat2, lon2, round(dist, 3) as dist, round(total_dist, 2) as total_dist from shapes"""
    q["shapes_stitched"] = q["shapes_by_position"] = stitched
    street = hot_points.replace("/ 1e3", "/ 1e6")
    q["street_passes"] = "with " + ",\n".join([f"fx_shape_points as ({street})", f"shapes as ({SHAPES})"]) + f"""
select shape_id, stop_id, count(*) as n_passes, round(min(total_dist - dist + along), 2) as first_dist,
       round(max(total_dist - dist + along), 2) as last_dist
from (select s.id as shape_id, p.stop_id, s.dist, s.total_dist, {along_sql('p.lat', 'p.lon', 's.lat1', 's.lon1', 's.lat2', 's.lon2')} as along
      from (select cast(n_nationkey as varchar) as stop_id, -22.9e0 + cast((n_nationkey * 7919) % 101 as double) / 1e6 as lat,
                   -43.2e0 - cast((n_nationkey * 104729) % 103 as double) / 1e6 as lon from nation) p, shapes s
      where {on_segment_sql('p.lat', 'p.lon', 's.lat1', 's.lon1', 's.lat2', 's.lon2')}) x
group by shape_id, stop_id"""
    q["shapes_ordered"] = with_fx("fx_shape_points", extra=[("shapes", SHAPES)]) + """
select id, try_cast(id as bigint) as id_num, sequence, lat1, lon1, lat2, lon2, round(dist, 3) as dist,
       round(total_dist, 3) as total_dist
from shapes"""
    q["shape_turns"] = with_fx("fx_shape_points", extra=[("shapes", SHAPES)]) + f"""
select id, sequence, lat1 as lat, lon1 as lon, {turn_sql('lat0', 'lon0', 'lat1', 'lon1', 'lat2', 'lon2')} as turn
from (select *, lag(lat1) over w as lat0, lag(lon1) over w as lon0, lag(lat2) over w as end_lat, lag(lon2) over w as end_lon
      from shapes window w as (partition by id order by sequence)) s
where end_lat = lat1 and end_lon = lon1"""
    q["trips_representative"] = with_fx("fx_trips", extra=[("trips", TRIPS)]) + "select * from trips"
    q["trips_ordered"] = q["trips_representative"] + " order by id, route_id"
    q["stop_times_filtered"] = with_fx("fx_trips", "fx_stop_times", extra=[
        ("trips", TRIPS), ("stop_times", STOP_TIMES)]) + "select * from stop_times"
    q["trip_stops"] = _matches_query(
        "select trip_id, stop_id, sequence, round(total_dist - dist + along, 2) as dist from matches")
    q["trip_stops_sql"] = q["trip_stops"]
    q["stops_on_segment"] = _matches_query(
        "select trip_id, stop_id, sequence, seg_sequence, round(along, 2) as along from matches")
    q["stops_between_perpendiculars"] = _matches_query(
        f"select trip_id, stop_id, sequence, seg_sequence, "
        f"{between_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')} as between_ends from matches")
    near = with_fx(*_PIPE, extra=[*_PIPE_STAGES[:3], ("near", f"""
select r.trip_id, r.stop_id, r.sequence, s.sequence as seg_sequence, r.lat, r.lon, s.lat1, s.lon1, s.lat2, s.lon2
from (select st.trip_id, st.stop_id, st.sequence, st.shape_id, p.lat, p.lon
      from stop_times st join fx_stops p on st.stop_id = p.id) r
join shapes s on r.shape_id = s.id
where {dist_sql('r.lat', 'r.lon', 's.lat1', 's.lon1')} <= 1000e0""")])
    q["slab_selection"] = near + (f"select trip_id, stop_id, sequence, seg_sequence, "
                                  f"{between_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')} as between_ends from near")
    q["cross_track_signed"] = near + (
        f"select trip_id, stop_id, sequence, seg_sequence, "
        f"round({signed_cross_track_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')}, 2) + 0e0 as cross_track from near")
    q["bearing_forms"] = near + (
        f"select trip_id, stop_id, sequence, seg_sequence, "
        f"round({signed_cross_track_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')}, 2) + 0e0 as cross_track, "
        f"round({signed_along_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')}, 2) + 0e0 as along_track from near")
    nla, nlo = nearest_latlon_sql("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    q["nearest_point_on_circle"] = _matches_query(
        f"select trip_id, stop_id, sequence, seg_sequence, round({nla}, 6) as near_lat, "
        f"round({nlo}, 6) as near_lon from matches")
    q["geo_distance"] = _matches_query(
        f"select trip_id, stop_id, sequence, seg_sequence, "
        f"round({dist_sql('lat', 'lon', 'lat1', 'lon1')}, 3) as to_start, "
        f"round({dist_sql('lat', 'lon', 'lat2', 'lon2')}, 3) as to_end, "
        f"round({haversine_sql('lat', 'lon', 'lat1', 'lon1')}, 3) as haversine_to_start, "
        f"round({cross_track_sql('lat', 'lon', 'lat1', 'lon1', 'lat2', 'lon2')}, 3) as cross_track, "
        f"round({dist_sql('lat1', 'lon1', nla, nlo)}, 2) as along_via_nearest "
        f"from matches")
    pla, plo = planar_projection_sql("lat", "lon", "lat1", "lon1", "lat2", "lon2")
    q["planar_metrics"] = _matches_query(
        f"select trip_id, stop_id, sequence, seg_sequence, "
        f"round({planar_distance_sql('lat', 'lon', 'lat1', 'lon1')}, 3) as planar_to_start, "
        f"round({pla}, 6) as proj_lat, round({plo}, 6) as proj_lon from matches")
    q["route_line_groups"] = with_fx("fx_routes") + f"""
select route_id, regexp_extract(name, '{LINE_GROUP}', 0) as line_group,
       trim(string_split(name, '-')[1]) as dest1
from fx_routes"""
    q["route_names_line_groups"] = f"""
select cast(c_custkey as varchar) as route_id, regexp_extract(case cast(c_custkey % 5 as int) when 0 then c_name
       when 1 then 'corridor BR A' || (c_custkey % 10) || ', B2, ' || c_mktsegment || ' - depot'
       when 2 then 'BRS ' || (c_custkey % 10) || ',' || c_mktsegment
       when 3 then 'BRX 1, ' || c_mktsegment else 'BR 12 ' || c_mktsegment end, '{LINE_GROUP}', 0) as line_group
from customer"""
    q["stops_from_text"] = with_fx("fx_stops") + """
select id, case when bad then 'quarantine' else 'ok' end as status, case when not bad then code end as code,
       case when not bad then name || ', "stop"' end as name, case when not bad then coalesce(info, '') end as info,
       case when not bad then lat end as lat, case when not bad then lon end as lon
from (select *, id::bigint % 50 = 0 as bad from fx_stops) x"""
    q["fares_all"] = with_fx("fx_fares") + "select * from fx_fares"
    q["routes_with_fares"] = with_fx("fx_routes", "fx_fare_rules") + """
select r.route_id as id, r.code, r.name, r.description,
       trim(string_split(r.name, '-')[1]) as dest1, trim(string_split(r.name, '-')[3]) as dest2,
       r.color, f.fare_id
from fx_routes r join fx_fare_rules f on r.route_id = f.route_id"""
    q["fares_clean"] = with_fx("fx_fares") + "select * from fx_fares"
    q["fares_by_id"] = with_fx("fx_fares") + "select * from fx_fares where id = '3'"
    q["stops_clean"] = with_fx("fx_stops") + """
select id, case when length(code) between 1 and 18 then code else '' end as code, name,
       coalesce(info, '') as info, lat, lon
from fx_stops"""
    q["stops_ordered"] = q["stops_clean"] + " order by id"
    q["stop_keys_md5"] = with_fx("fx_stops") + """
select id, md5(concat(cast(lat as varchar), ',', cast(lon as varchar))) as stop_key from fx_stops"""
    q["trips_by_route"] = with_fx("fx_trips", extra=[("trips", TRIPS)]) + \
        "select * from trips where route_id = '7'"
    q["trips_by_id"] = with_fx("fx_trips") + "select * from fx_trips where id = 0"
    q["trips_by_id_and_route"] = with_fx("fx_trips") + \
        "select * from fx_trips where id = 0 and route_id = '899'"
    q["gps_clean"] = with_fx("fx_gps") + f"select {GPS_CLEAN_COLS} from fx_gps"
    q["gps_route_codes"] = with_fx("fx_gps") + f"""
select {line_code_sql('line')} as route_code, count(*) as n from fx_gps group by 1"""
    q["gps_first_only"] = with_fx("fx_gps") + f"""
select {GPS_CLEAN_COLS}
from (select *, row_number() over (order by event_id, datetime, serial_number, line, lat, lon, vel, direction)
                as pos from fx_gps) g
where (pos - 1) % 256 = 0"""
    q["gps_all_feeds"] = with_fx("fx_gps") + f"""
select {GPS_CLEAN_COLS}, case when direction in ('purchase', 'signup') then 'brt' else 'bus' end as feed
from fx_gps"""
    q["gps_stream"] = with_fx("fx_gps") + f"select {GPS_CLEAN_COLS} from fx_gps"
    q["gps_record_text"] = with_fx("fx_gps") + f"""
select serial_number, date_trunc('second', datetime) as datetime,
       concat('H: ', cast(date_trunc('second', datetime) as varchar), '|S:', serial_number,
              '|L:', {line_code_sql('line')}, '|P:(', cast(lat as varchar), ',', cast(lon as varchar),
              ')|V:', cast(vel as varchar), '|D:', direction) as record
from fx_gps"""
    q["gps_on_routes"] = _gps_on_routes()
    q["gps_on_all_routes"] = _gps_on_routes(fixes="""(
select event_id, concat('A', cast(event_id as varchar)) as serial_number, ts as datetime,
       cast((event_id * 31 + user_id) % 1000 as varchar) as route_code,
       -22.9e0 + cast((event_id * 7919) % 10100 as double) / 1e5 as lat,
       -43.2e0 - cast((event_id * 104729) % 10300 as double) / 1e5 as lon from events)""", keep="serial_number, route_code")
    q["gps_stream_resumed"] = q["gps_stream_replayed"] = q["gps_stream"]
    q["gps_on_routes_stream"] = q["gps_on_routes"]
    q["trip_stops_from_text"] = q["trip_stops"]
    q["shape_from_text"] = q["shapes_build"] + " where id = '1'"
    q["gps_stream_polled_again"] = with_fx("fx_gps") + """
select distinct serial_number, date_trunc('second', datetime) as datetime from fx_gps
union all
select distinct serial_number, date_trunc('second', datetime) + interval 30 days as datetime from fx_gps"""
    q["gps_batch_counts"] = """
select 0::bigint as batch, ceil(count(*) / 256)::bigint as documents, 0::bigint as corrupt, count(*) as records,
       0::bigint as invalid from events
union all
select 1, ceil(count(*) / 256)::bigint, ceil(count(*) / 256)::bigint, 0, 0 from events"""
    q["gps_mixed_encodings"] = with_fx("fx_gps") + """
select direction || ' – é' as direction, count(*) as n_rows, min(lat) as min_lat, 1::bigint as n_quarantined
from fx_gps group by direction"""
    q["nearest_vehicles"] = with_fx("fx_stops") + f"""
select id, rank::int as rank, serial_number, round(d, 2) as dist
from (select *, row_number() over (partition by id order by round(d, 3), serial_number) as rank
      from (select s.id, g.serial_number, {dist_sql('s.lat', 's.lon', 'g.lat', 'g.lon')} as d
            from fx_stops s, (select concat('A', cast(event_id as varchar)) as serial_number,
                 -22.9e0 + cast((event_id * 7919) % 10100 as double) / 1e5 as lat,
                 -43.2e0 - cast((event_id * 104729) % 10300 as double) / 1e5 as lon from events) g) x
      where d <= 150e0) y
where rank <= 3"""
    q["nearby_vehicles"] = with_fx("fx_gps") + f"""
select serial_number, date_trunc('second', datetime) as datetime, lat, lon, round(d, 2) as dist
from (select *, {dist_sql('lat', 'lon', '-22.86e0', '-43.23e0')} as d from fx_gps) g
where d <= 200e0"""
    return q
