"""The same results in plain SQL, worked out another way where there is one.

Nearest edges and nodes come from comparing every pair, windows from listing the
starts a ping falls in, stop orders from listing permutations, path costs from a
keyed recursion.  Each query text carries the views it needs.
"""

from __future__ import annotations

from wayfleet import schemas as S
from wayfleet.plans import fixtures

NOW_MS = 1_704_100_000_000
UNNAMED = S.UNNAMED_ROAD
CLASSES = ", ".join(f"'{c}'" for c in S.HIGHWAY_CLASSES)


def up(x: str, places: int) -> str:
    """Round half up on the decimal text."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")


def metres(h: str) -> str:
    return f"(6371000.0e0 * 2 * atan2(sqrt({h}), sqrt(1 - {h})))"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(2.0e0 * 6371.0e0 * asin(least(1.0e0, sqrt({hav(lat1, lon1, lat2, lon2)}))))"


def drawn(*slots: str) -> str:
    """The 52 bits that the slots decide."""
    return f"CAST('0x' || SUBSTR(MD5(CONCAT_WS(':', {', '.join(slots)})), 1, 13) AS BIGINT)"


# Choices of the genetic operators: seed 42, 30 individuals, 15 parents, 2 elites, generation 1.
_CHOICE = lambda n, slot, who: f"({drawn('42', 'vehicle_id', '1', who, str(slot))} % {n})"


def _places(slot: int, who: str) -> str:
    x, y = _CHOICE("n", slot, who), _CHOICE("(n - 1)", slot + 1, who)
    return f"[LEAST({x}, {y} + CASE WHEN {y} >= {x} THEN 1 ELSE 0 END), GREATEST({x}, {y} + CASE WHEN {y} >= {x} THEN 1 ELSE 0 END)]"


def _mutated(who: str) -> str:
    return f"""SELECT vehicle_id, {who}, CASE WHEN hit THEN LIST_TRANSFORM(o, lambda x, k: CASE WHEN k = cuts[1] + 1 THEN o[cuts[2] + 1]
        WHEN k = cuts[2] + 1 THEN o[cuts[1] + 1] ELSE x END) ELSE o END AS o
        FROM (SELECT *, {_places(5, who)} AS cuts, {_CHOICE('1000000', 7, who)} < 150000 AS hit"""


STATIC = "(length_meters / (greatest(max_speed_kmh, 1.0e0) * 1000.0e0 / 3600.0e0))"

PARTS: dict[str, str] = {name: fixtures.view_text(name, "duck") for name in fixtures.VIEWS}
PARTS.update({
    "way_attr": f"""
SELECT way_id, highway, COALESCE(oneway, 'no') AS oneway, COALESCE(name, '{UNNAMED}') AS road_name,
       COALESCE(TRY_CAST(maxspeed AS DOUBLE), 40e0) AS max_speed_kmh FROM f_way_tags""",
    "pairs": """
SELECT way_id, pos, ref AS u, LEAD(ref) OVER (PARTITION BY way_id ORDER BY pos) AS v FROM f_way_nodes""",
    "segs": f"""
SELECT * FROM (
  SELECT p.way_id, p.pos, p.u, p.v, w.oneway, w.road_name, w.max_speed_kmh, a.lat AS u_lat, a.lon AS u_lon,
         b.lat AS v_lat, b.lon AS v_lon, {metres(hav('a.lat', 'a.lon', 'b.lat', 'b.lon'))} AS raw_length_m
  FROM pairs p JOIN way_attr w ON w.way_id = p.way_id AND w.highway IN ({CLASSES})
  JOIN f_nodes a ON a.node_id = p.u JOIN f_nodes b ON b.node_id = p.v) WHERE raw_length_m > 0""",
    "raw_edges": f"""
SELECT way_id * 2097152 + pos * 2 AS edge_seq, 'E_' || u || '_' || v AS edge_id, road_name, max_speed_kmh, u AS start_id,
       u_lat AS start_lat, u_lon AS start_lon, v AS end_id, v_lat AS end_lat, v_lon AS end_lon, {up('raw_length_m', 2)} AS length_meters
FROM segs WHERE oneway <> '-1'
UNION ALL
SELECT way_id * 2097152 + pos * 2 + 1, 'E_' || v || '_' || u, road_name, max_speed_kmh, v, v_lat, v_lon, u, u_lat, u_lon,
       {up('raw_length_m', 2)}
FROM segs WHERE oneway <> 'yes'""",
    "outcomes": """
SELECT v.vehicle_id, CASE WHEN v.current_edge_id = '' THEN 'error' WHEN v.new_route IS NULL OR x.reason IS NOT NULL THEN 'optimized'
         ELSE 'skipped' END AS status, x.reason
FROM vehicles v JOIN (SELECT vehicle_id, CASE WHEN hits_blocked THEN 'blocked' WHEN hits_congested THEN 'congested' WHEN hits_slow THEN 'slow' END AS reason
  FROM conditions) x ON x.vehicle_id = v.vehicle_id""",
    "totals": "SELECT vehicle_id, MAX(total) AS total FROM walk GROUP BY vehicle_id",
    "ordered": """
SELECT b.vehicle_id, STRING_AGG(s.cust_id, ',' ORDER BY POSITION(CAST(s.stop_idx AS VARCHAR) IN b.code)) AS cust_ids
FROM best b JOIN f_stops s ON s.vehicle_id = b.vehicle_id GROUP BY b.vehicle_id""",
    "edges": "SELECT * FROM raw_edges QUALIFY ROW_NUMBER() OVER (PARTITION BY edge_id ORDER BY edge_seq DESC) = 1",
    "mentions": """
SELECT start_id AS node_id, start_lat AS lat, start_lon AS lon, edge_seq * 2 AS mention FROM edges
UNION ALL SELECT end_id, end_lat, end_lon, edge_seq * 2 + 1 FROM edges""",
    "nodes": "SELECT node_id, MIN(mention) AS node_seq, ARG_MAX(lat, mention) AS lat, ARG_MAX(lon, mention) AS lon FROM mentions GROUP BY node_id",
    "clean": "SELECT * FROM f_pings WHERE entity_type IN ('Truck', 'Bot') AND latitude IS NOT NULL AND longitude IS NOT NULL",
    "canon": """
SELECT edge_seq, edge_id,
       CASE WHEN fwd THEN start_lat ELSE end_lat END AS a_lat, CASE WHEN fwd THEN start_lon ELSE end_lon END AS a_lon,
       CASE WHEN fwd THEN end_lat ELSE start_lat END AS b_lat, CASE WHEN fwd THEN end_lon ELSE start_lon END AS b_lon
FROM (SELECT *, start_lat < end_lat OR (start_lat = end_lat AND start_lon <= end_lon) AS fwd FROM edges)""",
    "hits": f"""
SELECT ping_id, edge_id, h FROM (
  SELECT ping_id, edge_id, edge_seq, {hav('latitude', 'longitude', 'f_lat', 'f_lon')} AS h FROM (
    SELECT ping_id, latitude, longitude, edge_id, edge_seq,
           CASE WHEN t <= 0 THEN a_lat WHEN t >= 1 THEN b_lat ELSE a_lat + t * (b_lat - a_lat) END AS f_lat,
           CASE WHEN t <= 0 THEN a_lon WHEN t >= 1 THEN b_lon ELSE a_lon + t * (b_lon - a_lon) END AS f_lon
    FROM (SELECT p.ping_id, p.latitude, p.longitude, c.*,
                 CASE WHEN (b_lat - a_lat) * (b_lat - a_lat) + (b_lon - a_lon) * (b_lon - a_lon) > 0
                      THEN ((latitude - a_lat) * (b_lat - a_lat) + (longitude - a_lon) * (b_lon - a_lon))
                           / ((b_lat - a_lat) * (b_lat - a_lat) + (b_lon - a_lon) * (b_lon - a_lon)) ELSE 0 END AS t
          FROM (SELECT * FROM f_pings WHERE latitude IS NOT NULL AND longitude IS NOT NULL) p CROSS JOIN canon c)))
QUALIFY ROW_NUMBER() OVER (PARTITION BY ping_id ORDER BY h, edge_seq) = 1""",
    "matched": "SELECT c.*, COALESCE(h.edge_id, 'UNKNOWN') AS edge_id, h.h FROM clean c LEFT JOIN hits h ON h.ping_id = c.ping_id",
    "windows": """
SELECT start_ms, start_ms + 10000 AS end_ms, edge_id, ROUND(AVG(speed), 9) AS avg_speed, COUNT(entity_id) AS vehicle_count,
       COUNT(DISTINCT entity_id) AS distinct_vehicles
FROM (SELECT *, UNNEST([timestamp // 3000 * 3000, timestamp // 3000 * 3000 - 3000, timestamp // 3000 * 3000 - 6000,
                        timestamp // 3000 * 3000 - 9000]) AS start_ms FROM matched)
WHERE start_ms + 10000 > timestamp GROUP BY start_ms, edge_id""",
    "dealt_pings": """
SELECT m.edge_id, m.timestamp, LEAST((m.timestamp - low) * 4 // (high - low + 1) + CASE WHEN m.timestamp % 7 = 0 THEN 1 ELSE 0 END, 3) AS batch
FROM matched m, (SELECT MIN(timestamp) AS low, MAX(timestamp) AS high FROM matched)""",
    "batch_marks": """
SELECT batch, MAX(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10000 AS mark
FROM (SELECT batch, MAX(timestamp) AS newest FROM dealt_pings GROUP BY batch)""",
    "states": f"""
SELECT w.edge_id, {up('avg_speed', 2)} AS avg_speed, vehicle_count, {up('COALESCE(e.length_meters, 500e0)', 1)} AS distance,
       {up('COALESCE(e.max_speed_kmh, 40e0)', 1)} AS max_speed,
       {up('COALESCE(e.length_meters, 500e0) / 1000.0e0 / avg_speed * 3600.0e0', 2)} AS estimated_travel_time,
       avg_speed < 5e0 AS is_congested, strftime(make_timestamp(end_ms * 1000), '%Y-%m-%dT%H:%M:%S') AS updated_at,
       end_ms AS last_updated
FROM windows w LEFT JOIN edges e ON e.edge_id = w.edge_id WHERE w.edge_id <> 'UNKNOWN' AND avg_speed > 0""",
    "cur": "SELECT * FROM states QUALIFY ROW_NUMBER() OVER (PARTITION BY edge_id ORDER BY last_updated DESC) = 1",
    "blocked": "SELECT edge_id FROM cur WHERE is_congested",
    "positions": """
SELECT entity_id AS id, latitude AS lat, longitude AS lon, speed FROM f_pings WHERE entity_type = 'Truck'
QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY timestamp DESC, ping_id DESC) = 1""",
    "placed": "SELECT ROW_NUMBER() OVER (ORDER BY edge_seq) - 1 AS p, COUNT(*) OVER () AS n, * FROM edges",
    "trucks": "SELECT DISTINCT vehicle_no, vehicle_id FROM f_stops",
    "seeds": """
SELECT t.vehicle_no, x.k, p.edge_id, p.start_lat, p.start_lon FROM trucks t
CROSS JOIN (SELECT UNNEST(RANGE(6)) AS k) x
JOIN placed p ON x.k < LEAST(6, p.n) AND p.p = ((t.vehicle_no - 1) * 13) % GREATEST(1, p.n - LEAST(6, p.n)) + x.k""",
    "slices": """
SELECT vehicle_no, LIST(edge_id ORDER BY k) AS route, MIN(CASE WHEN k = 0 THEN edge_id END) AS first_edge FROM seeds GROUP BY vehicle_no""",
    "docs": """
SELECT t.vehicle_no, CASE WHEN t.vehicle_no % 10 <> 3 THEN t.vehicle_id END AS vehicle_id, t.vehicle_id AS entity_id,
       CASE WHEN t.vehicle_no % 10 <> 5 THEN 'Truck' END AS entity_type,
       CASE WHEN t.vehicle_no % 10 = 7 THEN '' ELSE first_edge END AS edge_id,
       CASE WHEN t.vehicle_no % 20 = 17 OR t.vehicle_no % 10 = 9 THEN '' ELSE first_edge END AS current_edge_id,
       s.route AS route, CASE WHEN t.vehicle_no % 3 = 0 THEN s.route[1:2] END AS new_route
FROM trucks t JOIN slices s ON s.vehicle_no = t.vehicle_no""",
    "vehicles": """
SELECT vehicle_no, entity_id AS vehicle_id, entity_id, COALESCE(entity_type, 'Truck') AS entity_type,
       COALESCE(NULLIF(edge_id, ''), NULLIF(current_edge_id, ''), '') AS current_edge_id, route, new_route FROM docs""",
    "route_edges": "SELECT DISTINCT vehicle_id, UNNEST(route) AS edge_id FROM vehicles",
    "own_edges": "SELECT * FROM route_edges UNION SELECT vehicle_id, current_edge_id FROM vehicles WHERE current_edge_id <> ''",
    "speeds": """
SELECT v.vehicle_id, COALESCE(ROUND(AVG(c.avg_speed), 9), 30e0) AS speed_kmh FROM vehicles v
LEFT JOIN (SELECT vehicle_id, edge_id FROM own_edges UNION SELECT vehicle_id, b.edge_id FROM vehicles CROSS JOIN blocked b) x
  ON x.vehicle_id = v.vehicle_id
LEFT JOIN cur c ON c.edge_id = x.edge_id AND c.avg_speed > 0 GROUP BY v.vehicle_id""",
    "conditions": """
SELECT v.vehicle_id, COALESCE(BOOL_OR(b.edge_id IS NOT NULL), FALSE) AS hits_blocked,
       COALESCE(BOOL_OR(c.is_congested), FALSE) AS hits_congested,
       COALESCE(BOOL_OR(c.avg_speed > 0 AND c.avg_speed <= 5), FALSE) AS hits_slow,
       COALESCE(SUM(CASE WHEN c.is_congested THEN 1 ELSE 0 END + CASE WHEN c.avg_speed > 0 AND c.avg_speed <= 5 THEN 1 ELSE 0 END), 0) AS marks
FROM vehicles v LEFT JOIN route_edges r ON r.vehicle_id = v.vehicle_id
LEFT JOIN blocked b ON b.edge_id = r.edge_id LEFT JOIN cur c ON c.edge_id = r.edge_id GROUP BY v.vehicle_id""",
    "penalties": "SELECT vehicle_id, CASE WHEN hits_blocked THEN 1e6 ELSE 0e0 END + marks * 1e4 AS penalty FROM conditions",
    "start_costs": """
SELECT v.vehicle_id, CASE WHEN c.estimated_travel_time > 0 THEN c.estimated_travel_time / 3600.0e0 ELSE 0e0 END AS start_cost
FROM vehicles v LEFT JOIN cur c ON c.edge_id = v.current_edge_id""",
    "facts": """
SELECT v.vehicle_id, s.speed_kmh, p.penalty, c.start_cost FROM vehicles v JOIN speeds s ON s.vehicle_id = v.vehicle_id
JOIN penalties p ON p.vehicle_id = v.vehicle_id JOIN start_costs c ON c.vehicle_id = v.vehicle_id""",
    "first": f"""
SELECT vehicle_id, individual, n, LIST(stop_idx ORDER BY {drawn('42', 'vehicle_id', 'individual', 'stop_idx')}) AS o
FROM (SELECT *, COUNT(*) OVER (PARTITION BY vehicle_id) AS n FROM f_stops), RANGE(30) r(individual) GROUP BY vehicle_id, individual, n""",
    "first_hours": """
SELECT p.vehicle_id, p.individual, ROUND(SUM(l.hours), 9) AS about FROM (SELECT vehicle_id, individual, UNNEST(RANGE(1, n)) AS k, o FROM first) p
JOIN legs l ON l.vehicle_id = p.vehicle_id AND l.i = p.o[p.k] AND l.j = p.o[p.k + 1] GROUP BY p.vehicle_id, p.individual""",
    "first_ranks": """
SELECT f.*, h.about, ROW_NUMBER() OVER (PARTITION BY f.vehicle_id ORDER BY h.about, f.individual) - 1 AS rank
FROM first f JOIN first_hours h ON h.vehicle_id = f.vehicle_id AND h.individual = f.individual""",
    "bred": f"""
SELECT vehicle_id, i, n, LIST_CONCAT(rest[1:cuts[1]], kept, rest[cuts[1] + 1:]) AS o
FROM (SELECT *, LIST_FILTER(father, lambda x: NOT LIST_CONTAINS(kept, x)) AS rest
      FROM (SELECT c.vehicle_id, c.i, c.n, c.cuts, b.o AS father, a.o[c.cuts[1] + 1:c.cuts[2]] AS kept
            FROM (SELECT vehicle_id, i, n, {_places(3, 'i')} AS cuts, {_CHOICE('15', 1, 'i')} AS ma, {_CHOICE('15', 2, 'i')} AS pa
                  FROM (SELECT DISTINCT vehicle_id, n FROM first), RANGE(2, 30) r(i)) c
            JOIN first_ranks a ON a.vehicle_id = c.vehicle_id AND a.rank = c.ma JOIN first_ranks b ON b.vehicle_id = c.vehicle_id AND b.rank = c.pa))""",
    "legs": f"""
SELECT a.vehicle_id, a.stop_idx AS i, b.stop_idx AS j,
       {km('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} / f.speed_kmh AS hours
FROM f_stops a JOIN f_stops b ON a.vehicle_id = b.vehicle_id AND a.stop_idx <> b.stop_idx JOIN facts f ON f.vehicle_id = a.vehicle_id""",
    "perms": """
SELECT vehicle_id, CAST(stop_idx AS VARCHAR) AS code, stop_idx AS last, 1 AS len, 0e0 AS hours FROM f_stops
UNION ALL
SELECT p.vehicle_id, p.code || CAST(l.j AS VARCHAR), l.j, p.len + 1, p.hours + l.hours
FROM perms p JOIN legs l ON l.vehicle_id = p.vehicle_id AND l.i = p.last AND POSITION(CAST(l.j AS VARCHAR) IN p.code) = 0""",
    "sizes": "SELECT vehicle_id, COUNT(*) AS n FROM f_stops GROUP BY vehicle_id",
    "best": """
SELECT p.vehicle_id, p.code, p.hours, s.n FROM perms p JOIN sizes s ON s.vehicle_id = p.vehicle_id AND s.n = p.len
QUALIFY ROW_NUMBER() OVER (PARTITION BY p.vehicle_id ORDER BY ROUND(p.hours, 9), p.code) = 1""",
    "costs": f"""
SELECT e.edge_id, e.start_id AS src, e.end_id AS dst,
       CASE WHEN c.estimated_travel_time > 0 THEN c.estimated_travel_time ELSE {STATIC} END AS cost
FROM edges e LEFT JOIN cur c ON c.edge_id = e.edge_id
WHERE e.edge_id NOT IN (SELECT edge_id FROM blocked) AND NOT COALESCE(c.is_congested, FALSE)""",
    "arcs": "SELECT src, dst, MIN(cost) AS cost FROM costs WHERE src <> dst GROUP BY src, dst",
    "starts": "SELECT v.vehicle_id, e.end_id AS node FROM vehicles v JOIN edges e ON e.edge_id = v.current_edge_id",
    "stop_nodes": """
SELECT s.vehicle_id, s.stop_idx, s.cust_id, n.node_id FROM f_stops s CROSS JOIN nodes n
QUALIFY ROW_NUMBER() OVER (PARTITION BY s.cust_id ORDER BY (n.lat - s.latitude) * (n.lat - s.latitude)
  + (n.lon - s.longitude) * (n.lon - s.longitude), n.node_seq) = 1""",
    "sources": "SELECT node AS source FROM starts UNION SELECT node_id FROM stop_nodes",
    "static_arcs": f"SELECT start_id AS src, end_id AS dst, MIN({STATIC}) AS cost FROM edges WHERE start_id <> end_id GROUP BY 1, 2",
    "req_nodes": """
SELECT p.id AS vehicle_id, n.node_id AS node FROM positions p CROSS JOIN nodes n WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY p.id ORDER BY (n.lat - p.lat) * (n.lat - p.lat) + (n.lon - p.lon) * (n.lon - p.lon), n.node_seq) = 1""",
    "latest_updates": """
SELECT * FROM f_route_updates QUALIFY ROW_NUMBER() OVER (PARTITION BY vehicle_id ORDER BY update_seq DESC) = 1""",
    "live_routes": "SELECT vehicle_id, path_csv AS path, time FROM latest_updates WHERE path_csv <> ''",
    "steps": """
SELECT vehicle_id, g - 1 AS pos, route[g] AS edge_id FROM (SELECT vehicle_id, route, UNNEST(RANGE(1, LEN(route) + 1)) AS g FROM vehicles)""",
    "geometry": """
SELECT s.vehicle_id, s.pos, s.edge_id, e.start_lat, e.start_lon, e.end_lat, e.end_lon FROM steps s JOIN edges e ON e.edge_id = s.edge_id""",
    "undirected": "SELECT start_id AS a, end_id AS b FROM edges UNION SELECT end_id, start_id FROM edges",
})

# Keyed recursions: a better cost (or label) replaces the row of its key.
KEYED: dict[str, tuple[str, str]] = {
    "sp": ("sp(source, node, cost) USING KEY (source, node)", """
SELECT source, source, 0e0 FROM sources
UNION
SELECT s.source, a.dst, MIN(s.cost + a.cost) FROM sp s JOIN arcs a ON a.src = s.node
LEFT JOIN recurring.sp k ON k.source = s.source AND k.node = a.dst
WHERE k.cost IS NULL OR s.cost + a.cost < k.cost GROUP BY s.source, a.dst"""),
    "comp": ("comp(node_id, label) USING KEY (node_id)", """
SELECT node_id, node_id FROM nodes
UNION
SELECT u.b, MIN(c.label) FROM comp c JOIN undirected u ON u.a = c.node_id
JOIN recurring.comp k ON k.node_id = u.b WHERE c.label < k.label GROUP BY u.b"""),
    "walk": ("walk(vehicle_id, rank, node, total)", f"""
SELECT vehicle_id, 0, node, 0e0 FROM starts
UNION ALL
SELECT w.vehicle_id, w.rank + 1, CASE WHEN w.node = n.node_id OR s.cost IS NOT NULL THEN n.node_id ELSE w.node END,
       w.total + CASE WHEN w.node = n.node_id THEN 0e0 ELSE COALESCE(s.cost, 0e0) END
FROM walk w JOIN best b ON b.vehicle_id = w.vehicle_id AND w.rank < b.n
JOIN stop_nodes n ON n.vehicle_id = w.vehicle_id AND n.stop_idx = CAST(SUBSTR(b.code, w.rank + 1, 1) AS INT)
LEFT JOIN sp s ON s.source = w.node AND s.node = n.node_id"""),
    "ssp": ("ssp(source, node, cost) USING KEY (source, node)", """
SELECT source, source, 0e0 FROM (SELECT node AS source FROM req_nodes UNION SELECT node_id FROM stop_nodes)
UNION
SELECT s.source, a.dst, MIN(s.cost + a.cost) FROM ssp s JOIN static_arcs a ON a.src = s.node
LEFT JOIN recurring.ssp k ON k.source = s.source AND k.node = a.dst
WHERE k.cost IS NULL OR s.cost + a.cost < k.cost GROUP BY s.source, a.dst"""),
}
KEYED["spp"] = ("spp(source, node, cost, path) USING KEY (source, node)", """
SELECT source, source, 0e0, '' FROM sources
UNION
SELECT s.source, a.dst, MIN(s.cost + a.cost), ARG_MIN(s.path || ',E_' || a.src || '_' || a.dst, s.cost + a.cost)
FROM spp s JOIN arcs a ON a.src = s.node
LEFT JOIN recurring.spp k ON k.source = s.source AND k.node = a.dst
WHERE k.cost IS NULL OR s.cost + a.cost < k.cost GROUP BY s.source, a.dst""")
KEYED["walkp"] = ("walkp(vehicle_id, rank, node, path)", """
SELECT vehicle_id, 0, node, '' FROM starts
UNION ALL
SELECT w.vehicle_id, w.rank + 1, CASE WHEN w.node = n.node_id OR s.cost IS NOT NULL THEN n.node_id ELSE w.node END,
       w.path || CASE WHEN w.node = n.node_id THEN '' ELSE COALESCE(s.path, '') END
FROM walkp w JOIN best b ON b.vehicle_id = w.vehicle_id AND w.rank < b.n
JOIN stop_nodes n ON n.vehicle_id = w.vehicle_id AND n.stop_idx = CAST(SUBSTR(b.code, w.rank + 1, 1) AS INT)
LEFT JOIN spp s ON s.source = w.node AND s.node = n.node_id""")
KEYED["pwalk"] = ("pwalk(vehicle_id, rank, lat, lon, seen)", """
SELECT v.vehicle_id, 0, e.end_lat, e.end_lon, '' FROM vehicles v JOIN edges e ON e.edge_id = v.current_edge_id
UNION ALL
SELECT vehicle_id, rank, lat, lon, seen FROM (
  SELECT w.vehicle_id, w.rank + 1 AS rank, n.latitude AS lat, n.longitude AS lon, w.seen || CAST(n.stop_idx AS VARCHAR) AS seen,
         ROW_NUMBER() OVER (PARTITION BY w.vehicle_id ORDER BY (n.latitude - w.lat) * (n.latitude - w.lat)
           + (n.longitude - w.lon) * (n.longitude - w.lon), n.stop_idx) AS rn
  FROM pwalk w JOIN f_stops n ON n.vehicle_id = w.vehicle_id AND POSITION(CAST(n.stop_idx AS VARCHAR) IN w.seen) = 0) WHERE rn = 1""")
for _start, _name, _labels in (("starts", "gwalk", "sp"), ("req_nodes", "rwalk", "ssp")):
    KEYED[_name] = (f"{_name}(vehicle_id, rank, node, stop_idx, cost, total, seen)", f"""
SELECT vehicle_id, 0, node, -1, 0e0, 0e0, '' FROM {_start}
UNION ALL
SELECT vehicle_id, rank, node, stop_idx, cost, total, seen FROM (
  SELECT w.vehicle_id, w.rank + 1 AS rank, n.node_id AS node, n.stop_idx,
         CASE WHEN w.node = n.node_id THEN 0e0 ELSE s.cost END AS cost,
         w.total + CASE WHEN w.node = n.node_id THEN 0e0 ELSE s.cost END AS total, w.seen || CAST(n.stop_idx AS VARCHAR) AS seen,
         ROW_NUMBER() OVER (PARTITION BY w.vehicle_id ORDER BY CASE WHEN w.node = n.node_id THEN 0e0 ELSE s.cost END, n.stop_idx) AS rn
  FROM {_name} w JOIN stop_nodes n ON n.vehicle_id = w.vehicle_id AND POSITION(CAST(n.stop_idx AS VARCHAR) IN w.seen) = 0
  LEFT JOIN {_labels} s ON s.source = w.node AND s.node = n.node_id
  WHERE w.node = n.node_id OR s.cost IS NOT NULL) WHERE rn = 1""")

HEAVY = {"hits", "matched", "dealt_pings", "windows", "states", "cur", "edges", "best", "facts", "speeds", "blocked", "costs", "arcs",
         "static_arcs", "stop_nodes", "nodes", "req_nodes", "legs", "first", "first_ranks", "bred"}


def _body(name: str) -> str:
    return KEYED[name][1] if name in KEYED else PARTS[name]


def _words(text: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())


def oracle(main: str) -> str:
    """``main`` preceded by every view it needs, in order."""
    known = set(PARTS) | set(KEYED)
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in sorted(_words(_body(name)) & known - {name}):
            visit(other)
        done.append(name)

    for name in sorted(_words(main) & known):
        visit(name)
    ctes = []
    for name in done:
        head = KEYED[name][0] if name in KEYED else name
        if name == "perms":
            head = "perms(vehicle_id, code, last, len, hours)"
        ctes.append(f"{head} AS {'MATERIALIZED ' if name in HEAVY else ''}({_body(name)})")
    return f"WITH RECURSIVE {', '.join(ctes)} {main}" if ctes else main


def _state_columns() -> str:
    return ", ".join(S.EDGE_STATE.names)


MAIN: dict[str, str] = {
    "decoded_pings": """SELECT entity_id, entity_type, latitude, longitude, speed, timestamp FROM clean WHERE ping_id % 53 <> 0""",
    "encoded_pings": "SELECT entity_id AS key, entity_id, entity_type, latitude, longitude, speed, timestamp FROM f_pings",
    "event_time": """SELECT ping_id, timestamp AS event_ms, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%dT%H:%M:%S') AS event_text FROM f_pings""",
    "archive_rows": """SELECT entity_id, entity_type, latitude, longitude, speed, timestamp, edge_id, timestamp AS event_ms,
        strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS event_date FROM matched""",
    "matched_pings": f"SELECT ping_id, edge_id, {up(metres('h'), 3)} AS match_distance_m FROM matched",
    "matched_everything": "SELECT p.ping_id, COALESCE(h.edge_id, 'UNKNOWN') AS edge_id FROM f_pings p LEFT JOIN hits h ON h.ping_id = p.ping_id",
    "latest_positions": "SELECT * FROM positions",
    "conflated_positions": """SELECT entity_id AS id, timestamp // 1000 * 1000 + 1000 AS tick_ms, latitude AS lat, longitude AS lon, speed
        FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, timestamp // 1000 ORDER BY timestamp DESC, latitude DESC NULLS LAST,
              longitude DESC NULLS LAST, speed DESC NULLS LAST) AS k FROM f_pings WHERE entity_type = 'Truck') WHERE k = 1""",
    "way_segments": f"SELECT way_id, pos, u, v, oneway, road_name, max_speed_kmh, {up('raw_length_m', 3)} AS raw_length_m FROM segs",
    "road_edges": "SELECT edge_seq, edge_id, road_name, max_speed_kmh, length_meters, start_id, end_id, start_lat, end_lon FROM edges",
    "clipped_edges": " UNION ALL ".join(
        f"""SELECT '{name}' AS box, edge_id, length_meters FROM edges WHERE start_lat BETWEEN {a} AND {b} AND end_lat BETWEEN {a} AND {b}
        AND start_lon BETWEEN {c} AND {d} AND end_lon BETWEEN {c} AND {d}"""
        for name, (a, b, c, d) in {k: tuple(f"{x!r}e0" for x in v) for k, v in S.DISTRICT_BOXES.items()}.items()),
    "road_nodes": "SELECT node_seq, node_id, lat, lon FROM nodes",
    "graph_tables": """SELECT 'edge' AS kind, edge_id AS id, length_meters, max_speed_kmh FROM edges
        UNION ALL SELECT 'node', node_id, NULL, NULL FROM f_nodes
        WHERE node_id IN (SELECT start_id FROM raw_edges UNION SELECT end_id FROM raw_edges)""",
    "adjacency": "SELECT n.node_id, e.edge_id, e.end_id AS to_node FROM nodes n LEFT JOIN edges e ON e.start_id = n.node_id",
    "edge_ids": "SELECT DISTINCT edge_id FROM raw_edges",
    "edge_endpoints": """SELECT u.edge_id, e.start_id, e.end_id FROM (SELECT DISTINCT path_csv AS edge_id FROM f_route_updates WHERE path_csv <> '') u
        LEFT JOIN edges e ON e.edge_id = u.edge_id""",
    "components": "SELECT node_id, label AS component FROM comp",
    "largest_component": """SELECT edge_id FROM edges WHERE start_id IN (SELECT node_id FROM comp WHERE label =
        (SELECT label FROM comp GROUP BY label ORDER BY COUNT(*) DESC, label LIMIT 1))""",
    "edge_positions": "SELECT edge_id, p AS position FROM placed",
    "nearest_nodes": "SELECT cust_id, node_id FROM stop_nodes",
    "nearest_departures": """SELECT s.cust_id, n.node_id FROM f_stops s CROSS JOIN nodes n WHERE n.node_id IN (SELECT start_id FROM edges)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY s.cust_id ORDER BY (n.lat - s.latitude) * (n.lat - s.latitude)
        + (n.lon - s.longitude) * (n.lon - s.longitude), n.node_seq) = 1""",
    "edge_speed": f"SELECT start_ms, end_ms, edge_id, {up('avg_speed', 4)} AS avg_speed, vehicle_count, distinct_vehicles FROM windows",
    "edge_state": f"SELECT {_state_columns()} FROM states",
    "enriched_windows": f"""SELECT i.edge_id, COALESCE(e.length_meters, 500e0) AS edge_length_m, COALESCE(e.max_speed_kmh, 40e0) AS edge_max_speed,
        COALESCE(e.road_name, 'UNKNOWN') AS road_name
        FROM (SELECT DISTINCT COALESCE(h.edge_id, 'UNKNOWN') AS edge_id FROM f_pings p LEFT JOIN hits h ON h.ping_id = p.ping_id
              WHERE p.entity_type IN ('Truck', 'Bot')) i LEFT JOIN edges e ON e.edge_id = i.edge_id""",
    "latest_edge_state": f"SELECT {_state_columns()} FROM cur",
    "blocked_edges": "SELECT edge_id FROM blocked",
    "live_edge_state": "SELECT edge_id, avg_speed, last_updated FROM cur WHERE (SELECT MAX(timestamp) FROM matched) < last_updated + 120000",
    "live_blocked_edges": "SELECT edge_id FROM cur WHERE is_congested AND (SELECT MAX(timestamp) FROM matched) < last_updated + 120000",
    "state_json": "SELECT 'edge:' || edge_id AS key, avg_speed, vehicle_count, is_congested, updated_at FROM cur",
    "edge_occupancy": f"""SELECT edge_id, vehicles, {up('density', 4)} AS density,
        {up('CASE WHEN density >= 250 THEN 2.5e0 ELSE GREATEST(2.5e0, max_speed_kmh * (1 - density / 250e0)) END', 4)} AS expected_speed,
        {up('250e0 * (length_meters / 1000)', 4)} AS capacity, vehicles >= 250e0 * (length_meters / 1000) AS at_capacity
        FROM (SELECT l.edge_id, COUNT(*) AS vehicles, e.length_meters, e.max_speed_kmh, COUNT(*) / (e.length_meters / 1000) AS density
              FROM (SELECT * FROM matched QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY timestamp DESC, ping_id DESC) = 1) l
              JOIN edges e ON e.edge_id = l.edge_id GROUP BY l.edge_id, e.length_meters, e.max_speed_kmh)""",
    "edge_interpolation": f"""SELECT edge_id, {up('start_lat + (end_lat - start_lat) * ((length_meters * ((edge_seq % 10) / 10.0e0)) / length_meters)', 6)} AS lat,
        {up('start_lon + (end_lon - start_lon) * ((length_meters * ((edge_seq % 10) / 10.0e0)) / length_meters)', 6)} AS lon FROM edges""",
    "seed_routes": f"""SELECT printf('Truck_%03d', s.vehicle_no) AS vehicle_id, 'Truck' AS entity_type, ANY_VALUE(l.first_edge) AS current_edge_id,
        STRING_AGG(s.edge_id, ',' ORDER BY s.k) AS assigned_route,
        STRING_AGG(CASE WHEN s.k BETWEEN 1 AND 3 THEN printf('Cust_T%03d_%d', s.vehicle_no, s.k) END, ',' ORDER BY s.k) AS cust_ids,
        {up('SUM(CASE WHEN s.k BETWEEN 1 AND 3 THEN s.start_lat END)', 5)} AS lat_sum
        FROM seeds s JOIN slices l ON l.vehicle_no = s.vehicle_no GROUP BY s.vehicle_no""",
    "normalized_vehicles": """SELECT v.vehicle_id, v.entity_id, v.entity_type, v.current_edge_id, 0e0 AS distance_on_edge,
        ARRAY_TO_STRING(v.route, ',') AS assigned_route, c.cust_ids
        FROM vehicles v JOIN (SELECT vehicle_id, STRING_AGG(cust_id, ',' ORDER BY stop_idx) AS cust_ids FROM f_stops GROUP BY vehicle_id) c
          ON c.vehicle_id = v.vehicle_id""",
    "invalid_inputs": "SELECT vehicle_id, CASE WHEN current_edge_id = '' THEN 'current_edge_id must not be empty' END AS error FROM vehicles",
    "optimization_inputs": f"""SELECT 'OPT_' || v.vehicle_id || '_{NOW_MS}' AS request_id, v.vehicle_id,
        CASE WHEN v.current_edge_id = '' THEN 'current_edge_id must not be empty' END AS error,
        {up('f.speed_kmh', 4)} AS speed_kmh, {up('f.start_cost', 4)} AS start_cost, f.penalty, {NOW_MS} AS created_at
        FROM vehicles v JOIN facts f ON f.vehicle_id = v.vehicle_id""",
    "traffic_snapshot": """SELECT o.vehicle_id, c.edge_id, c.avg_speed, c.is_congested FROM own_edges o JOIN cur c ON c.edge_id = o.edge_id
        UNION ALL SELECT '*', c.edge_id, c.avg_speed, c.is_congested FROM cur c WHERE c.is_congested""",
    "snapshot_speed": f"SELECT vehicle_id, {up('speed_kmh', 4)} AS speed_kmh FROM speeds",
    "route_penalty": "SELECT vehicle_id, penalty FROM penalties",
    "reroute_candidates": """SELECT vehicle_id, hits_blocked OR hits_congested OR hits_slow AS needs_reroute,
        CASE WHEN hits_blocked THEN 'blocked' WHEN hits_congested THEN 'congested' WHEN hits_slow THEN 'slow' END AS reason FROM conditions""",
    "start_cost": f"SELECT vehicle_id, {up('start_cost', 6)} AS start_cost FROM start_costs",
    "ga_init": "SELECT vehicle_id, individual, ARRAY_TO_STRING(o, ',') AS \"order\" FROM first",
    "ga_selection": f"SELECT vehicle_id, rank, individual, {up('about', 6)} AS hours FROM first_ranks WHERE rank < 15",
    "ga_crossover": "SELECT vehicle_id, i, ARRAY_TO_STRING(o, ',') AS \"order\" FROM bred",
    "ga_mutation": f"SELECT vehicle_id, individual, ARRAY_TO_STRING(o, ',') AS \"order\" FROM ({_mutated('individual')} FROM first))",
    "ga_next_generation": f"""SELECT vehicle_id, rank AS individual, ARRAY_TO_STRING(o, ',') AS \"order\" FROM first_ranks WHERE rank < 2
        UNION ALL SELECT vehicle_id, i, ARRAY_TO_STRING(o, ',') FROM ({_mutated('i')} FROM bred))""",
    "sampled_edges": f"""SELECT * FROM (SELECT 'uniform' AS kind, edge_id FROM edges ORDER BY {drawn('7', 'edge_id')}, edge_id LIMIT 15)
        UNION ALL SELECT * FROM (SELECT 'length', edge_id FROM edges
        ORDER BY -LN(({drawn('7', 'edge_id')} + 0.5e0) / 4503599627370496e0) / GREATEST(length_meters, 1e0), edge_id LIMIT 15)""",
    "stop_pair_costs": f"SELECT vehicle_id, i AS from_idx, j AS to_idx, {up('hours', 6)} AS hours FROM legs",
    "route_fitness": f"""SELECT f.vehicle_id, k.kind, CASE WHEN k.kind = 'short' THEN 1e6 ELSE {up('f.start_cost + COALESCE(t.hours, 0e0) + f.penalty', 4)} END AS fitness
        FROM facts f CROSS JOIN (SELECT UNNEST(['given', 'reverse', 'short']) AS kind) k
        LEFT JOIN (SELECT vehicle_id, SUM(hours) AS hours FROM legs WHERE j = i + 1 GROUP BY vehicle_id) t ON t.vehicle_id = f.vehicle_id""",
    "exact_order": f"""SELECT b.vehicle_id, STRING_AGG(s.cust_id, ',' ORDER BY POSITION(CAST(s.stop_idx AS VARCHAR) IN b.code)) AS cust_ids,
        ANY_VALUE({up('f.start_cost + b.hours + f.penalty', 4)}) AS fitness
        FROM best b JOIN f_stops s ON s.vehicle_id = b.vehicle_id JOIN facts f ON f.vehicle_id = b.vehicle_id GROUP BY b.vehicle_id""",
    "edge_costs": f"SELECT edge_id, src, dst, {up('cost', 4)} AS cost FROM costs",
    "static_edge_costs": f"SELECT edge_id, start_id AS src, end_id AS dst, {up(STATIC, 4)} AS cost FROM edges",
    "shortest_path_cost": f"""SELECT p.source, p.target, p.source = p.target OR s.cost IS NOT NULL AS reachable,
        CASE WHEN p.source = p.target THEN 0e0 ELSE {up('s.cost', 4)} END AS cost
        FROM (SELECT DISTINCT t.node AS source, n.node_id AS target FROM starts t JOIN stop_nodes n ON n.vehicle_id = t.vehicle_id) p
        LEFT JOIN sp s ON s.source = p.source AND s.node = p.target""",
    "build_routes_cost": f"""SELECT v.vehicle_id, CASE WHEN w.total > 0 THEN {up('w.total', 4)} END AS estimated_total_travel_time_s
        FROM vehicles v LEFT JOIN (SELECT vehicle_id, MAX(total) AS total FROM walk GROUP BY vehicle_id) w ON w.vehicle_id = v.vehicle_id""",
    "shortest_path_edges": f"""SELECT p.source, p.target, CASE WHEN p.source = p.target THEN '' ELSE SUBSTR(s.path, 2) END AS path,
        CASE WHEN p.source = p.target THEN 0e0 ELSE {up('s.cost', 4)} END AS cost
        FROM (SELECT DISTINCT t.node AS source, n.node_id AS target FROM starts t JOIN stop_nodes n ON n.vehicle_id = t.vehicle_id) p
        LEFT JOIN spp s ON s.source = p.source AND s.node = p.target""",
    "new_routes": f"""SELECT v.vehicle_id, CASE WHEN LENGTH(w.path) > 0 THEN SUBSTR(w.path, 2) ELSE ARRAY_TO_STRING(v.route, ',') END AS new_assigned_route,
        CASE WHEN t.total > 0 THEN {up('t.total', 4)} END AS estimated_total_travel_time_s
        FROM vehicles v LEFT JOIN totals t ON t.vehicle_id = v.vehicle_id
        LEFT JOIN (SELECT vehicle_id, ARG_MAX(path, rank) AS path FROM walkp GROUP BY vehicle_id) w ON w.vehicle_id = v.vehicle_id""",
    "planar_greedy_order": """SELECT vehicle_id, ARRAY_TO_STRING(STRING_SPLIT(ARG_MAX(seen, rank), ''), ',') AS stop_order FROM pwalk GROUP BY vehicle_id""",
    "optimize_vehicles": f"""SELECT o.status, o.vehicle_id,
        CASE o.status WHEN 'optimized' THEN COALESCE(o.reason, 'forced') WHEN 'skipped' THEN 'No blocked or congested edge detected'
             ELSE 'current_edge_id must not be empty' END AS reason,
        CASE WHEN o.status = 'optimized' THEN {up('f.start_cost + b.hours + f.penalty', 4)} END AS fitness,
        CASE WHEN o.status = 'optimized' AND t.total > 0 THEN {up('t.total', 4)} END AS estimated_total_travel_time_s,
        CASE WHEN o.status = 'optimized' THEN r.cust_ids ELSE '' END AS optimized_customer_order,
        CASE WHEN o.status = 'optimized' THEN 0 END AS generation_count, o.status = 'optimized' AS optimized, {NOW_MS} AS timestamp
        FROM outcomes o JOIN facts f ON f.vehicle_id = o.vehicle_id JOIN best b ON b.vehicle_id = o.vehicle_id
        JOIN ordered r ON r.vehicle_id = o.vehicle_id LEFT JOIN totals t ON t.vehicle_id = o.vehicle_id""",
    "stored_results": f"""SELECT COALESCE(d.vehicle_id, c.vehicle_id) AS vehicle_id, CASE WHEN c.vehicle_id IS NOT NULL THEN 'optimized' END AS route_status,
        CASE WHEN c.vehicle_id IS NOT NULL THEN {NOW_MS} END AS last_optimized_at, {up('c.total', 4)} AS estimated_total_travel_time,
        CASE WHEN c.vehicle_id IS NOT NULL THEN 'exact' END AS algorithm, CASE WHEN c.vehicle_id IS NOT NULL THEN 0 END AS generation_count,
        COALESCE(ARRAY_TO_STRING(c.route, ','), '') AS old_route, COALESCE(c.cust_ids, '') AS customer_order
        FROM (SELECT * FROM docs WHERE vehicle_id IS NOT NULL) d
        FULL JOIN (SELECT o.vehicle_id, v.route, r.cust_ids, CASE WHEN t.total > 0 THEN t.total END AS total FROM outcomes o
                   JOIN vehicles v ON v.vehicle_id = o.vehicle_id JOIN ordered r ON r.vehicle_id = o.vehicle_id
                   LEFT JOIN totals t ON t.vehicle_id = o.vehicle_id WHERE o.status = 'optimized') c ON c.vehicle_id = d.vehicle_id""",
    "greedy_order": f"""SELECT g.vehicle_id, g.stop_idx, g.rank, {up('g.cost', 4)} AS cost FROM gwalk g WHERE g.rank > 0
        UNION ALL
        SELECT s.vehicle_id, s.stop_idx, COALESCE(m.last_rank, 0) + ROW_NUMBER() OVER (PARTITION BY s.vehicle_id ORDER BY s.stop_idx), NULL
        FROM f_stops s LEFT JOIN (SELECT vehicle_id, MAX(rank) AS last_rank FROM gwalk GROUP BY vehicle_id) m ON m.vehicle_id = s.vehicle_id
        WHERE NOT EXISTS (SELECT 1 FROM gwalk g WHERE g.vehicle_id = s.vehicle_id AND g.stop_idx = s.stop_idx)""",
    "request_stops": """SELECT p.id AS vehicle_id, COALESCE(z.n, 0) AS stops,
        CASE WHEN p.lat IS NULL OR p.lon IS NULL THEN 'Missing lat/lon' WHEN z.n IS NULL THEN 'No customers' END AS error
        FROM positions p LEFT JOIN sizes z ON z.vehicle_id = p.id""",
    "route_from_position": """SELECT p.id AS vehicle_id,
        CASE WHEN p.lat IS NULL OR p.lon IS NULL THEN 'Missing lat/lon' WHEN z.n IS NULL THEN 'No customers' END AS error,
        CAST(ROUND(COALESCE(CASE WHEN z.n IS NOT NULL THEN w.total END, 0)) AS BIGINT) AS time,
        COALESCE(CASE WHEN z.n IS NOT NULL THEN w.visited END, '') AS visited
        FROM positions p LEFT JOIN sizes z ON z.vehicle_id = p.id
        LEFT JOIN (SELECT vehicle_id, MAX(total) AS total, STRING_AGG(CASE WHEN rank > 0 THEN CAST(stop_idx AS VARCHAR) END, ',' ORDER BY rank) AS visited
                   FROM rwalk GROUP BY vehicle_id) w ON w.vehicle_id = p.id""",
    "optimize_asked_vehicles": """SELECT CASE WHEN v.vehicle_id IS NULL OR v.current_edge_id = '' THEN 'error'
          WHEN v.new_route IS NULL OR x.bad THEN 'optimized' ELSE 'skipped' END AS status, u.vehicle_id,
        CASE WHEN v.vehicle_id IS NULL THEN 'Vehicle not found' WHEN v.current_edge_id = '' THEN 'current_edge_id must not be empty'
          WHEN x.reason IS NOT NULL THEN x.reason WHEN v.new_route IS NULL THEN 'forced'
          ELSE 'No blocked or congested edge detected' END AS reason
        FROM (SELECT DISTINCT vehicle_id FROM f_route_updates) u
        LEFT JOIN (SELECT v.* FROM vehicles v JOIN docs d ON d.vehicle_id = v.vehicle_id) v ON v.vehicle_id = u.vehicle_id
        LEFT JOIN (SELECT vehicle_id, hits_blocked OR hits_congested OR hits_slow AS bad,
          CASE WHEN hits_blocked THEN 'blocked' WHEN hits_congested THEN 'congested' WHEN hits_slow THEN 'slow' END AS reason
          FROM conditions) x ON x.vehicle_id = v.vehicle_id""",
    "result_summary": """SELECT COUNT(*) AS total, COUNT(*) FILTER (v.current_edge_id <> '' AND (v.new_route IS NULL OR bad)) AS optimized_count,
        COUNT(*) FILTER (v.current_edge_id <> '' AND v.new_route IS NOT NULL AND NOT bad) AS skipped_count,
        COUNT(*) FILTER (v.current_edge_id = '') AS error_count
        FROM vehicles v JOIN (SELECT vehicle_id, hits_blocked OR hits_congested OR hits_slow AS bad FROM conditions) x ON x.vehicle_id = v.vehicle_id""",
    "upserted_vehicles": f"""SELECT COALESCE(d.vehicle_id, u.vehicle_id) AS vehicle_id, d.entity_type, CASE WHEN u.vehicle_id IS NULL THEN 'stale' END AS route_status,
        COALESCE(CASE WHEN u.vehicle_id IS NOT NULL THEN u.path_csv ELSE ARRAY_TO_STRING(d.new_route, ',') END, '') AS new_assigned_route,
        {up('u.time', 4)} AS estimated_total_travel_time
        FROM (SELECT * FROM docs WHERE vehicle_id IS NOT NULL) d FULL JOIN latest_updates u ON u.vehicle_id = d.vehicle_id""",
    "route_snapshot": """SELECT vehicle_id, ARRAY_TO_STRING(route, ',') || ',' AS old_path, COALESCE(ARRAY_TO_STRING(new_route, ','), '') AS new_path,
        CASE WHEN new_route IS NULL THEN ARRAY_TO_STRING(route, ',') || ',' ELSE ARRAY_TO_STRING(new_route, ',') END AS path
        FROM docs WHERE vehicle_id IS NOT NULL""",
    "merged_routes": f"""SELECT vehicle_id, path, {up('time', 4)} AS time,
        CASE WHEN time IS NULL THEN '—' WHEN time / 60 >= 10000 THEN printf('%.1f giờ', {up('time / 60 / 60', 1)})
             ELSE printf('%.1f phút', {up('time / 60', 1)}) END AS eta FROM live_routes""",
    "vehicle_search": "SELECT vehicle_id FROM live_routes WHERE LOWER(vehicle_id) LIKE '%truck\\_00%' ESCAPE '\\'",
    "ordered_vehicles": """SELECT vehicle_id, ROW_NUMBER() OVER (ORDER BY CAST(REGEXP_REPLACE(vehicle_id, '[^0-9]', '', 'g') AS BIGINT), vehicle_id) - 1 AS place, CAST(REGEXP_REPLACE(vehicle_id, '[^0-9]', '', 'g') AS BIGINT) AS number,
        SUBSTR(vehicle_id, 7) AS short_id FROM live_routes""",
    "vehicle_board": f"""SELECT p.id, SUBSTR(p.id, 7) AS short_id, CASE WHEN p.speed > 0 THEN GREATEST(3, CAST({up('p.speed', 0)} AS INT)) ELSE 0 END AS shown_speed,
        r.vehicle_id IS NOT NULL AS has_route, CASE WHEN r.vehicle_id IS NULL THEN 0 ELSE 1 END AS path_size,
        CASE WHEN r.time IS NULL THEN '—' WHEN r.time / 60 >= 10000 THEN printf('%.1f giờ', {up('r.time / 60 / 60', 1)})
             ELSE printf('%.1f phút', {up('r.time / 60', 1)}) END AS eta
        FROM positions p LEFT JOIN live_routes r ON r.vehicle_id = p.id""",
    "board_counts": """SELECT 'vehicles' AS name, COUNT(*) AS n FROM positions UNION ALL SELECT 'routes', COUNT(*) FROM live_routes
        UNION ALL SELECT 'nodes', COUNT(*) FROM nodes UNION ALL SELECT 'edges', COUNT(*) FROM edges""",
    "traffic_feed": "SELECT edge_id, avg_speed FROM cur",
    "heat_points": f"""SELECT c.edge_id, {up('(start_lat + end_lat) / 2', 6)} AS mid_lat, {up('(start_lon + end_lon) / 2', 6)} AS mid_lon,
        {up('GREATEST(0e0, 1 - avg_speed / 30)', 4)} AS intensity FROM cur c JOIN edges e ON e.edge_id = c.edge_id
        WHERE GREATEST(0e0, 1 - avg_speed / 30) > 0.1e0""",
    "edge_speed_class": """SELECT e.edge_id, c.avg_speed, CASE WHEN c.avg_speed IS NULL THEN 'none' WHEN c.avg_speed <= 5 THEN 'slow'
        WHEN c.avg_speed <= 15 THEN 'medium' ELSE 'fast' END AS speed_class FROM edges e LEFT JOIN cur c ON c.edge_id = e.edge_id""",
    "route_geometry": "SELECT vehicle_id, pos, edge_id, start_lat, start_lon, end_lat, end_lon FROM geometry",
    "route_segments": """SELECT vehicle_id, segment_no, STRING_AGG(edge_id, ',' ORDER BY pos) AS edge_ids, COUNT(*) + 1 AS points FROM (
        SELECT *, SUM(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id ORDER BY pos) AS segment_no FROM (
          SELECT *, COALESCE(ABS(LAG(end_lat) OVER w - start_lat) < 0.0001e0 AND ABS(LAG(end_lon) OVER w - start_lon) < 0.0001e0, FALSE) AS joined
          FROM geometry WINDOW w AS (PARTITION BY vehicle_id ORDER BY pos))) GROUP BY vehicle_id, segment_no""",
    "route_progress": """SELECT v.vehicle_id, COALESCE(b.pos, -1) AS progress,
        COALESCE(ARRAY_TO_STRING(v.route[1:COALESCE(b.pos, 0)], ','), '') AS traversed,
        ARRAY_TO_STRING(v.route[COALESCE(b.pos, 0) + 1:], ',') AS upcoming
        FROM vehicles v LEFT JOIN (
          SELECT g.vehicle_id, g.pos FROM geometry g JOIN positions p ON p.id = g.vehicle_id AND p.lat IS NOT NULL AND p.lon IS NOT NULL
          QUALIFY ROW_NUMBER() OVER (PARTITION BY g.vehicle_id ORDER BY
            ((g.start_lat + g.end_lat) / 2 - p.lat) * ((g.start_lat + g.end_lat) / 2 - p.lat)
            + ((g.start_lon + g.end_lon) / 2 - p.lon) * ((g.start_lon + g.end_lon) / 2 - p.lon), g.pos) = 1) b ON b.vehicle_id = v.vehicle_id""",
    "route_bounds": """SELECT vehicle_id, MIN(lat) AS min_lat, MAX(lat) AS max_lat, MIN(lon) AS min_lon, MAX(lon) AS max_lon FROM (
        SELECT vehicle_id, start_lat AS lat, start_lon AS lon FROM geometry UNION ALL SELECT vehicle_id, end_lat, end_lon FROM geometry
        UNION ALL SELECT id, lat, lon FROM positions) WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY vehicle_id""",
    "typed_values": f"""SELECT ping_id, {up('CASE WHEN bad THEN 0e0 ELSE speed END', 4)} AS as_float, CASE WHEN bad THEN -1 ELSE CAST(TRUNC(speed) AS INT) END AS as_int,
        ping_id % 5 IN (0, 1, 3) AS as_bool, ping_id % 5 = 3 AS as_strict_bool,
        CASE WHEN bad OR speed <= 0 THEN 0 ELSE GREATEST(3, CAST({up('speed', 0)} AS INT)) END AS shown
        FROM (SELECT ping_id, speed, ping_id % 4 = 0 AS bad FROM f_pings)""",
    "streamed_edge_state": f"SELECT {_state_columns()} FROM cur",
    "streamed_archive": f"""SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS event_date, edge_id, COUNT(*) AS pings,
        {up('SUM(speed)', 2)} AS speed_sum FROM matched GROUP BY 1, 2""",
    "streamed_route_changes": """SELECT vehicle_id, CASE WHEN path_csv = '' THEN 'old_' || vehicle_id ELSE path_csv END AS path,
        COUNT(*) AS changes FROM f_route_updates GROUP BY 1, 2""",
}
MAIN["stored_osm_edges"] = MAIN["road_edges"]
MAIN["stored_edge_order"] = "SELECT f.format, edge_id, p AS position FROM placed CROSS JOIN (VALUES ('parquet'), ('json')) f(format)"
MAIN["stored_clipped_edges"] = MAIN["clipped_edges"]
MAIN["late_ledger"] = """SELECT edge_id, timestamp // 10000 * 10000 AS start_ms, COUNT(*) - COUNT(*) FILTER (timestamp < mark) AS in_time,
        COUNT(*) FILTER (timestamp < mark) AS late, COALESCE(MAX(mark - timestamp) FILTER (timestamp < mark), 0) AS most_behind_ms
        FROM dealt_pings JOIN batch_marks USING (batch) GROUP BY 1, 2"""
MAIN["versioned_edge_state"] = MAIN["streamed_edge_state"]
MAIN["merged_documents"] = MAIN["upserted_vehicles"]
MAIN["document_changes"] = f"""SELECT CAST(2 AS BIGINT) AS version, u.vehicle_id, CASE WHEN d.vehicle_id IS NULL THEN 'insert' ELSE 'update' END AS kind,
        CASE WHEN d.vehicle_id IS NOT NULL THEN 'stale' END AS old_status, d.new_route IS NOT NULL AS had_route, u.path_csv AS new_route,
        {up('u.time', 4)} AS time
        FROM latest_updates u LEFT JOIN (SELECT * FROM docs WHERE vehicle_id IS NOT NULL) d ON u.vehicle_id = d.vehicle_id"""
_EXPIRED = """(SELECT edge_id, is_congested, last_updated, last_updated + 120000 AS at_ms FROM
        (SELECT edge_id, last_updated, is_congested, LEAD(last_updated) OVER (PARTITION BY edge_id ORDER BY last_updated) AS later FROM states)
        WHERE later >= last_updated + 120000 OR (later IS NULL AND last_updated + 120000 < (SELECT MAX(last_updated) - 10000 FROM states)))"""
MAIN["expiry_events"] = f"""SELECT edge_id, 'expired' AS event, at_ms, last_updated FROM {_EXPIRED}
        UNION ALL SELECT edge_id, 'unblocked', at_ms, last_updated FROM {_EXPIRED} WHERE is_congested"""
MAIN["streamed_match_archive"] = MAIN["streamed_archive"]
MAIN["streamed_traffic_job"] = MAIN["streamed_edge_state"]
MAIN["streamed_snapshot"] = MAIN["traffic_feed"]
MAIN["streamed_conflation"] = MAIN["conflated_positions"]


def all_queries() -> dict[str, str]:
    return {name: oracle(main) for name, main in MAIN.items()}
