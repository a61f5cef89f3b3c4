"""The queries in plain SQL over the given tables, written apart from the package.

Where it can be done the SQL takes another road than the Spark code: neighbours by self-join,
target-driven resampling, point-in-polygon by counting crossings per cell.
"""

from __future__ import annotations

import math
import re

from checks import fixed as speed
from checks import fixtures as fx
from checks.fixed import COVER_WEIGHT, MAGMA, METRES_PER_DEGREE, ORDER_WEIGHT
from paceway.meta import EARTH_RADIUS, LATLNG, MERCATOR, MERCATOR_EDGE, LayerMeta, layout_for_zoom

Z = 7
MERC = layout_for_zoom(Z, MERCATOR)
FINE = fx.GRID.with_(cell_w=1 / 250, cell_h=1 / 250, xmax=-72.0 + 104 / 250, ymin=0.0)
UNIT = fx.GRID.with_(cell_w=1.0, cell_h=1.0)
CTE: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def num(x: float) -> str:
    """A number as a DOUBLE literal."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def i32(x: str) -> str:
    return f"cast(floor({x}) as int)"


def text(x) -> str:
    return "null" if x is None else f"'{x}'"


def case(expr: str, pairs, other: str = "null") -> str:
    return f"case {expr} " + " ".join(f"when {k} then {v}" for k, v in pairs) + f" else {other} end"


def table_case(expr: str, table: dict, other: str = "null") -> str:
    return case(expr, ((text(k), num(v)) for k, v in table.items()), other)


def closure(names: set[str]) -> list[str]:
    """The named views and what they build on, in order of definition."""
    wanted = set(names)
    for name in reversed(list(CTE)):
        if name in wanted:
            wanted |= set(re.findall(r"\w+", CTE[name])) & set(CTE)
    return [n for n in CTE if n in wanted]


def oracle(key: str, body: str) -> None:
    needed = closure(set(re.findall(r"\w+", body)) & set(CTE))
    views = ",\n".join(f"{n} as materialized ({CTE[n]})" for n in needed)
    ORACLE[key] = (f"with {views}\n" if views else "") + body


# ---- inputs -------------------------------------------------------------------------------------
_GX, _GY = "cast(p_partkey % 50 as int) as gx", "cast(floor(p_partkey / 50e0) as int) as gy"
CTE["fx_dem"] = f"""select {_GX}, {_GY},
 case when p_size % 10 = 0 then 0e0 else p_size * 12e0 + (p_partkey % 7) end as value from part"""
CTE["fx_elev"] = "select gx, gy, nullif(value, 0e0) as value from fx_dem"
CTE["fx_nodes"] = """select p_partkey as node_id, round(-72e0 + ((p_partkey % 50) * 0.6e0 + 0.5e0) / 120e0, 7) as lon,
 round(42e0 - (floor(p_partkey / 50e0) + 0.5e0) / 120e0, 7) as lat from part"""
CTE["fx_refs"] = """select l_orderkey as way_id, cast(row_number() over (partition by l_orderkey
 order by l_linenumber, l_partkey, l_extendedprice, l_suppkey) as int) as seq, l_partkey as node_id from lineitem"""
_STEP = "cast(floor(o_orderkey / 10e0) as bigint)"
CTE["fx_tags"] = f"""select o_orderkey as way_id,
 {case(f"{_STEP} % 21", ((i, text(h)) for i, h in enumerate(fx.HIGHWAY)))} as highway,
 case when {_STEP} % 21 in (18, 19) then 'river' end as waterway,
 {case("o_orderkey % 23", ((i, text(m)) for i, m in enumerate(fx.MAXSPEED)))} as maxspeed,
 case when o_orderpriority = '1-URGENT' then 'yes' end as area,
 o_orderpriority in ('1-URGENT', '2-HIGH') as closed from orders"""
CTE["fx_way_nodes"] = """select r.way_id, cast(r.seq + case when t.closed and r.way_id % 7 = 3 then 1 else 0 end as int) as seq, r.node_id
 from fx_refs r join fx_tags t on r.way_id = t.way_id union all
 select r.way_id, cast(max(r.seq) + 1 as int), max(case when r.seq = 1 then r.node_id end)
 from fx_refs r join fx_tags t on r.way_id = t.way_id where t.closed and r.way_id % 7 <> 3 group by r.way_id union all
 select r.way_id, cast(unnest([1, max(r.seq) + 2]) as int), -r.way_id
 from fx_refs r join fx_tags t on r.way_id = t.way_id where t.closed and r.way_id % 7 = 3 group by r.way_id"""
CTE["fx_kinds"] = """select t.way_id, case when n >= 4 and first_ref = last_ref and
 (coalesce(area, '') = 'yes' or highway is null) then 'polygon' else 'line' end as kind
 from fx_tags t left join (select way_id, count(*) as n, arg_min(node_id, seq) as first_ref,
 arg_max(node_id, seq) as last_ref from fx_way_nodes group by way_id) s on t.way_id = s.way_id"""
CTE["fx_placed"] = """select w.way_id as feature_id, k.kind, w.seq, n.lon, n.lat
 from fx_way_nodes w join fx_nodes n on w.node_id = n.node_id join fx_kinds k on w.way_id = k.way_id"""
CTE["fx_edges"] = """select feature_id, kind, seq, x0, y0, x1, y1 from (
 select feature_id, kind, seq, lon as x0, lat as y0,
 lead(lon) over (partition by feature_id order by seq) as x1,
 lead(lat) over (partition by feature_id order by seq) as y1 from fx_placed) e
 where x1 is not null union all
 select feature_id, kind, max(seq), arg_max(lon, seq), arg_max(lat, seq), arg_min(lon, seq), arg_min(lat, seq)
 from fx_placed where kind = 'polygon' group by feature_id, kind having min(seq) > 1 and count(*) > 1"""
CTE["fx_wanted"] = """select e.*, t.highway, t.maxspeed from fx_edges e join fx_tags t on e.feature_id = t.way_id
 where t.highway is not null or t.waterway is not null"""
CTE["fx_cover"] = f"""select {_GX}, {_GY}, {case("p_partkey % 18", enumerate(fx.COVER))} as value from part"""
CTE["fx_flow"] = f"""select o_orderkey as way_id, {case("o_orderkey % 3", ((0, "'336'"), (1, "'460'"), (2, "'558'")))} as ftype,
 {case(f"{_STEP} % 10", [(i, text(i)) for i in range(8)] + [(8, "''"), (9, "'-9'")])} as stream_order
 from orders"""
CTE["fx_flow_ok"] = """select * from fx_flow where ftype in ('336', '460')
 and try_cast(nullif(stream_order, '') as int) >= 0"""
_WEIGHT = case("stream_order", ((text(k), num(v)) for k, v in ORDER_WEIGHT.items()))
CTE["fx_flow_value"] = f"""select * from (select way_id, stream_order, {_WEIGHT} as value from fx_flow_ok) w
 where value is not null"""
CTE["fx_flow_edges"] = """select * from (select w.way_id as feature_id, v.value, n.lon as x0, n.lat as y0,
 lead(n.lon) over (partition by w.way_id order by w.seq) as x1,
 lead(n.lat) over (partition by w.way_id order by w.seq) as y1
 from fx_refs w join fx_flow_value v on w.way_id = v.way_id join fx_nodes n on w.node_id = n.node_id) e
 where x1 is not null"""
CTE["fx_sources"] = """select s_suppkey as pt_id, cast(place % 50 as int) as gx, cast(floor(place / 50e0) as int) as gy,
 round(-72e0 + (place % 50 + 0.5e0) / 120e0, 7) as lon,
 round(42e0 - (floor(place / 50e0) + 0.5e0) / 120e0, 7) as lat
 from (select s_suppkey, s_suppkey * 20 + (s_suppkey * 7) % 20 as place from supplier) s"""
CTE["fx_corner"] = """select 0 as seq, 0 as dx, 0 as dy union all select 1, 6, 0 union all select 2, 8, 3
 union all select 3, 1, 3 union all select 4, 0, 0"""
CTE["fx_ring"] = """select c_custkey as feature_id, k.seq,
 -72e0 + (place % 50 + k.dx + 0.25e0) / 120e0 as x, 42e0 - (floor(place / 50e0) + k.dy + 0.25e0) / 120e0 as y
 from (select c_custkey, cast(floor(c_custkey * 4 / 3e0) as bigint) as place from customer) c cross join fx_corner k"""
CTE["fx_ring_edges"] = """select a.feature_id, a.x as x0, a.y as y0, b.x as x1, b.y as y1
 from fx_ring a join fx_ring b on a.feature_id = b.feature_id and b.seq = a.seq + 1"""
CTE["fx_friction"] = "select gx, gy, case when value = 11 then null else 1e0 + value % 5 end as value from fx_cover"

# ---- speed --------------------------------------------------------------------------------------
_NUMBER = speed.NUMBER


def strip(s: str) -> str:
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def number(s: str) -> str:
    return f"(case when regexp_matches({strip(s)}, '{_NUMBER}') then cast({strip(s)} as double) end)"


def class_of(highway: str, unit: str) -> str:
    table = speed.CLASS_KMH if unit == "kmh" else speed.CLASS_MPH
    return table_case(highway, table, num(table["road"]))


def parts_of(s: str, word: str, unit: str, split: bool = True) -> str:
    factor = num(speed.TEXT_UNITS[unit].get(word, 1.0))
    pieces = f"regexp_split_to_array({s}, '[;|,]')" if split else f"[{s}]"
    piece = f"replace(p, '{word}', '')" if word else "p"
    best = f"list_max(list_transform({pieces}, lambda p: {number(piece)} * {factor}))"
    return f"(case when {best} > 0 then {best} end)"


def velocity(s: str) -> str:
    n, u = (f"regexp_extract({s}, '{speed.VELOCITY}', {g})" for g in (1, 2))
    return f"(case when {n} <> '' then cast({n} as double) * {table_case(u, speed.VELOCITY_KMH)} end)"


def chain(highway: str, maxspeed: str) -> str:
    return f"""(case when {highway} is null or {maxspeed} is null then 35e0 else coalesce({velocity(maxspeed)},
 {table_case(maxspeed, speed.COUNTRY_KMH)}, {table_case(highway, speed.CLASS_KMH)}, 35e0) end)"""


def notebook(unit: str, split: bool = True) -> str:
    """Over a row (highway, s, base) with ``s`` lowered and stripped."""
    def fallback(word):
        return f"coalesce({parts_of('s', word, unit, split)}, base)"

    arms = "".join(f" when contains(s, '{w}') then {fallback(w)}" for w in speed.TEXT_UNITS[unit])
    if unit == "kmh":
        country = table_case("s", speed.COUNTRY_KMH)
        arms += f" when {country} is not null then {country}"
    words = ", ".join(map(text, speed.NO_INFORMATION))
    raw = f"""(case when s = '' then base when {number('s')} is not null then {number('s')}{arms}
 when s in ({words}) then base else {fallback('')} end)"""
    return f"(case when {raw} <= 0 then base else {raw} end)"


_LOWER = "lower(" + strip("coalesce(maxspeed, '')") + ")"
CTE["sp_kmh"] = f"select way_id, highway, maxspeed, {_LOWER} as s, {class_of('highway', 'kmh')} as base from fx_tags"
CTE["sp_mph"] = f"select way_id, highway, maxspeed, {_LOWER} as s, {class_of('highway', 'mph')} as base from fx_tags"
CTE["sp_chain"] = f"select way_id, highway, {chain('highway', 'maxspeed')} as value from fx_tags where highway is not null"
CTE["sp_note"] = f"select way_id, highway, {notebook('kmh')} as value from sp_kmh where highway is not null"
CTE["sp_note_mph"] = f"select way_id, highway, {notebook('mph')} as value from sp_mph where highway is not null"


# ---- grids --------------------------------------------------------------------------------------
def within(m: LayerMeta) -> str:
    return f"gx between 0 and {m.cols - 1} and gy between 0 and {m.rows - 1}"


def line_cells(edges: str, m: LayerMeta, carry: str = "") -> str:
    """Cells on edges, as (feature_id, <carry>, gx, gy)."""
    c = lambda x: i32(f"({x} - {num(m.xmin)}) / {num(m.cell_w)}")
    r = lambda y: i32(f"({num(m.ymax)} - {y}) / {num(m.cell_h)}")
    at = lambda a, b: i32(f"(2e0*i*({b}-{a}) + n) / (2e0*n)") + f" + {a}"
    return f"""select * from (select feature_id, {carry} {at('c0', 'c1')} as gx, {at('r0', 'r1')} as gy from (
 select *, unnest(range(0, n + 1)) as i from (select *, greatest(abs(c1-c0), abs(r1-r0), 1) as n from (
 select feature_id, {carry} {c('x0')} as c0, {r('y0')} as r0, {c('x1')} as c1, {r('y1')} as r1 from ({edges}) e) a) b) d) f
 where {within(m)}"""


def fill_cells(edges: str, m: LayerMeta, carry: str = "") -> str:
    """Cells whose centre has an odd number of crossings to its left."""
    u = lambda x: f"({x} - {num(m.xmin)}) / {num(m.cell_w)}"
    v = lambda y: f"({num(m.ymax)} - {y}) / {num(m.cell_h)}"
    cross = f"""select feature_id, {carry} gy, u0 + (gy + 0.5e0 - v0) * (u1 - u0) / (v1 - v0) as u from (
 select *, unnest(range(greatest(0, cast(ceil(least(v0, v1) - 0.5e0) as int)),
 least({m.rows - 1}, cast(ceil(greatest(v0, v1) - 0.5e0) as int) - 1) + 1)) as gy from (
 select feature_id, {carry} {u('x0')} as u0, {v('y0')} as v0, {u('x1')} as u1, {v('y1')} as v1 from ({edges}) e) a) b"""
    keys = "feature_id, " + carry + "gy"
    return f"""select feature_id, {carry} gx, cast(gy as int) as gy from (
 select {keys}, cast(unnest(range(greatest(0, least(lo, {m.cols})), least(hi, {m.cols}))) as int) as gx, us from (
 select {keys}, cast(ceil(min(u) - 0.5e0) as int) as lo, cast(ceil(max(u) - 0.5e0) as int) as hi, list(u) as us
 from ({cross}) x group by {keys}) g) h
 where len(list_filter(us, lambda c: ceil(c - 0.5e0) <= gx)) % 2 = 1"""


def burnt(m: LayerMeta, edges: str, z: str = "max(value)") -> str:
    """Burnt layer of edges(feature_id, kind, value, ..)."""
    lines = line_cells(f"select * from ({edges}) l where kind = 'line'", m, "value, ")
    fills = fill_cells(f"select * from ({edges}) p where kind = 'polygon'", m, "value, ")
    return f"select gx, gy, {z} as value from (select value, gx, gy from ({lines}) a union all select value, gx, gy from ({fills}) b) c group by gx, gy"


def burnt_lines(m: LayerMeta, edges: str) -> str:
    return f"select gx, gy, max(value) as value from ({line_cells(edges, m, 'value, ')}) a group by gx, gy"


CTE["horn"] = """select -1 as dx, -1 as dy, -1e0 as wx, -1e0 as wy union all select 0, -1, 0e0, -2e0
 union all select 1, -1, 1e0, -1e0 union all select -1, 0, -2e0, 0e0 union all select 1, 0, 2e0, 0e0
 union all select -1, 1, -1e0, 1e0 union all select 0, 1, 0e0, 2e0 union all select 1, 1, 1e0, 1e0"""


def zfactor(gy: str, m: LayerMeta) -> str:
    t = m.tile_size
    lat = f"({num(m.ymax)} - (floor({gy} / {t}e0) * {t} + {num(t / 2)}) * {num(m.cell_h)})"
    return f"(1e0 / ({num(METRES_PER_DEGREE)} * cos(radians({lat}))))"


def sloped(cells: str, m: LayerMeta) -> str:
    return f"""select gx, gy, degrees(atan(sqrt(sx*sx + sy*sy) * {zfactor('gy', m)})) as value from (
 select c.gx, c.gy, sum(k.wx * coalesce(n.value, c.value)) / (8e0 * {num(m.cell_w)}) as sx,
 sum(k.wy * coalesce(n.value, c.value)) / (8e0 * {num(m.cell_h)}) as sy
 from {cells} c cross join horn k left join {cells} n on n.gx = c.gx + k.dx and n.gy = c.gy + k.dy
 where c.value is not null group by c.gx, c.gy) s"""


def walked(cells: str) -> str:
    return f"select gx, gy, 6e0 * exp(-3.5e0 * abs(tan(radians(value)) + 0.05e0)) as value from {cells}"


def ahead_x(x: str) -> str:
    return f"({num(EARTH_RADIUS)} * radians({x}))"


def ahead_y(y: str) -> str:
    return f"({num(EARTH_RADIUS)} * ln(tan({num(math.pi / 4)} + radians({y}) / 2e0)))"


def back_x(x: str) -> str:
    return f"degrees({x} / {num(EARTH_RADIUS)})"


def back_y(y: str) -> str:
    return f"degrees(2e0 * atan(exp({y} / {num(EARTH_RADIUS)})) - {num(math.pi / 2)})"


def targets(src: LayerMeta, dst: LayerMeta, cells: str) -> str:
    """All target cells around the extent of the cells: (tx, ty, sx, sy), source positions of the centres."""
    same = src.crs == dst.crs
    fx_, fy_ = (lambda c: c, lambda c: c) if same else (ahead_x, ahead_y)
    bx_, by_ = (lambda c: c, lambda c: c) if same else (back_x, back_y)
    x = lambda g: f"({num(src.xmin)} + ({g}) * {num(src.cell_w)})"
    y = lambda g: f"({num(src.ymax)} - ({g}) * {num(src.cell_h)})"
    to_c = lambda g: i32(f"({fx_(x(g))} - {num(dst.xmin)}) / {num(dst.cell_w)}")
    to_r = lambda g: i32(f"({num(dst.ymax)} - {fy_(y(g))}) / {num(dst.cell_h)}")
    cx = f"({num(dst.xmin)} + (tx + 0.5e0) * {num(dst.cell_w)})"
    cy = f"({num(dst.ymax)} - (ty + 0.5e0) * {num(dst.cell_h)})"
    return f"""select tx, ty, ({bx_(cx)} - {num(src.xmin)}) / {num(src.cell_w)} as sx,
 ({num(src.ymax)} - {by_(cy)}) / {num(src.cell_h)} as sy from (
 select cast(tx as int) as tx, cast(unnest(range(greatest(0, r0), least({dst.rows}, r1 + 1))) as int) as ty from (
 select unnest(range(greatest(0, c0), least({dst.cols}, c1 + 1))) as tx, r0, r1 from (
 select {to_c('min(gx) - 2')} as c0, {to_c('max(gx) + 3')} as c1, {to_r('min(gy) - 2')} as r0, {to_r('max(gy) + 3')} as r1
 from {cells}) b) c) d"""


def nearest(cells: str, src: LayerMeta, dst: LayerMeta) -> str:
    return f"""select t.tx as gx, t.ty as gy, c.value from ({targets(src, dst, cells)}) t
 join {cells} c on c.gx = {i32('t.sx')} and c.gy = {i32('t.sy')} where c.value is not null"""


def bilinear(cells: str, src: LayerMeta, dst: LayerMeta) -> str:
    w = "((1e0 - abs(t.sx - 0.5e0 - c.gx)) * (1e0 - abs(t.sy - 0.5e0 - c.gy)))"
    return f"""select t.tx as gx, t.ty as gy, sum({w} * c.value) / sum({w}) as value
 from (select *, {i32('sx - 0.5e0')} as x0, {i32('sy - 0.5e0')} as y0 from ({targets(src, dst, cells)}) a
 where sx >= 0 and sx < {src.cols} and sy >= 0 and sy < {src.rows}) t
 cross join (select 0 as dx, 0 as dy union all select 1, 0 union all select 0, 1 union all select 1, 1) k
 join {cells} c on c.gx = t.x0 + k.dx and c.gy = t.y0 + k.dy
 where c.value is not null and 1e0 - abs(t.sx - 0.5e0 - c.gx) > 1e-9 and 1e0 - abs(t.sy - 0.5e0 - c.gy) > 1e-9
 group by t.tx, t.ty"""


def largest(cells: str, src: LayerMeta, dst: LayerMeta) -> str:
    x = f"({num(src.xmin)} + (gx + 0.5e0) * {num(src.cell_w)})"
    y = f"({num(src.ymax)} - (gy + 0.5e0) * {num(src.cell_h)})"
    home = f"""select {i32(f"({ahead_x(x)} - {num(dst.xmin)}) / {num(dst.cell_w)}")} as gx,
 {i32(f"({num(dst.ymax)} - {ahead_y(y)}) / {num(dst.cell_h)}")} as gy, max(value) as value
 from {cells} where value is not null group by 1, 2"""
    return f"""select coalesce(h.gx, n.gx) as gx, coalesce(h.gy, n.gy) as gy, coalesce(h.value, n.value) as value
 from ({home}) h full join ({nearest(cells, src, dst)}) n on h.gx = n.gx and h.gy = n.gy"""


def levels(prefix: str, base: str, zoom: int, method: str = "nearest") -> str:
    """Define the levels of a pyramid as views and return their union."""
    pick = {
        "nearest": "arg_min(value, (gy % 2) * 2 + gx % 2)",
        "bilinear": "avg(value)",
    }[method]
    CTE[f"{prefix}_{zoom}"] = f"select gx, gy, value from {base} where value is not null"
    for z in range(zoom - 1, -1, -1):
        CTE[f"{prefix}_{z}"] = f"""select cast(floor(gx / 2e0) as int) as gx, cast(floor(gy / 2e0) as int) as gy,
 {pick} as value from {prefix}_{z + 1} group by 1, 2"""
    return " union all ".join(f"select {z} as zoom, gx, gy, value from {prefix}_{z}" for z in range(zoom, -1, -1))


def spread(prefix: str, pace: str, start: str, m: LayerMeta, cap: float, rounds: int | None) -> str:
    """Define rounds of cost spreading as views and return the last; without a number of rounds, as many as better a cost."""
    CTE[f"{prefix}_0"] = f"select distinct s.gx, s.gy, 0e0 as cost from {start} s join {pace} f on s.gx = f.gx and s.gy = f.gy where f.value is not null"
    CTE[f"{prefix}_k"] = " union all ".join(
        f"select {dx} as dx, {dy} as dy, {num(math.hypot(dx * m.cell_w, dy * m.cell_h))} as len"
        for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy
    )
    if rounds is None:
        CTE[f"{prefix}_all"] = f"""with recursive spreading(gx, gy, cost) using key (gx, gy) as (select gx, gy, cost from {prefix}_0 union
 select n.gx, n.gy, min(n.cost) from (
 select b.gx, b.gy, o.cost + (a.value + b.value) / 2e0 * k.len as cost from spreading o join {pace} a on o.gx = a.gx and o.gy = a.gy
 cross join {prefix}_k k join {pace} b on b.gx = o.gx + k.dx and b.gy = o.gy + k.dy
 where a.value is not null and b.value is not null) n left join recurring.spreading p on p.gx = n.gx and p.gy = n.gy
 where n.cost <= {num(cap)} and (p.cost is null or n.cost < p.cost) group by n.gx, n.gy) select gx, gy, cost from spreading"""
        return f"{prefix}_all"
    for r in range(1, rounds + 1):
        old = f"{prefix}_{r - 1}"
        CTE[f"{prefix}_{r}"] = f"""select gx, gy, min(cost) as cost from (select gx, gy, cost from {old} union all
 select b.gx, b.gy, o.cost + (a.value + b.value) / 2e0 * k.len from {old} o join {pace} a on o.gx = a.gx and o.gy = a.gy
 cross join {prefix}_k k join {pace} b on b.gx = o.gx + k.dx and b.gy = o.gy + k.dy
 where a.value is not null and b.value is not null) s where cost <= {num(cap)} group by gx, gy"""
    return f"{prefix}_{rounds}"


# ---- layers used by several queries -------------------------------------------------------------
CTE["l_slope"] = sloped("fx_elev", fx.GRID)
CTE["l_walk"] = walked("l_slope")
CTE["l_road_edges"] = "select e.feature_id, e.kind, e.x0, e.y0, e.x1, e.y1, s.value from fx_edges e join sp_chain s on e.feature_id = s.way_id"
CTE["l_roads"] = burnt(fx.GRID, "select * from l_road_edges")
CTE["l_cover"] = f"""select gx, gy, nullif({case('value', ((k, num(v)) for k, v in COVER_WEIGHT.items()))}, 0e0) as value from fx_cover"""
CTE["l_merged"] = """select w.gx, w.gy, case when w.value is not null then greatest(w.value, coalesce(r.value, w.value)) end as value
 from l_walk w left join l_roads r on w.gx = r.gx and w.gy = r.gy"""
CTE["l_base"] = bilinear("l_walk", fx.GRID, MERC)
WALK_LEVELS = levels("wl", "l_base", Z)
WALK_MEANS = levels("wm", "l_base", Z, "bilinear")
CTE["l_flow"] = burnt_lines(fx.GRID, "select * from fx_flow_edges")
_WALKED = ", ".join(map(text, speed.PATH_CLASSES))
CTE["l_paths"] = f"""select gx, gy, 3e0 as value from ({line_cells(f"select e.* from fx_wanted e where e.kind = 'line' and e.highway in ({_WALKED})", fx.GRID)}) a group by gx, gy"""


def adjusted(walk: str, flow: str, cover: str, paths: str) -> str:
    return f"""select w.gx, w.gy, (w.value + coalesce(s.value, 0e0) + c.value) - coalesce(p.value, 0e0) as value
 from {walk} w left join {flow} s on w.gx = s.gx and w.gy = s.gy
 left join {cover} c on w.gx = c.gx and w.gy = c.gy left join {paths} p on w.gx = p.gx and w.gy = p.gy"""


_ROUND = "gx, gy, round(value, 6) as value"

# ---- sources and sinks --------------------------------------------------------------------------
oracle("osm_read", """select node_id as id, 'node' as type, lat, lon, null::varchar as highway, null::varchar as maxspeed, -1 as n_refs from fx_nodes
 union all select t.way_id, 'way', null, null, highway, maxspeed, cast(coalesce(n, 0) as int) from fx_tags t
 left join (select way_id, count(*) as n from fx_way_nodes group by way_id) c on t.way_id = c.way_id
 union all select s_suppkey, 'relation', null, null, null, null, -1 from supplier""")
oracle("osm_patch_visible", """select 'node' as type, count(*) as n, count(*) as n_visible from part
 union all select 'way', count(*), count(*) from orders union all select 'relation', count(*), count(*) from supplier""")
oracle("osm_split", """select 'node' as part, node_id as id, 0 as seq, null::bigint as ref from fx_nodes
 union all select 'way', way_id, 0, null from fx_tags union all select 'ref', way_id, seq, node_id from fx_way_nodes""")
oracle("layer_read", f"select {_ROUND} from fx_elev where value is not null")
_C0, _R0, _C1, _R1 = fx.GRID.tiles_in(fx.BOX)
oracle("layer_bbox", f"""select {_ROUND} from fx_elev where value is not null
 and gx // 16 between {_C0} and {_C1} and gy // 16 between {_R0} and {_R1}""")
oracle("raster_ingest", """select gx, gy, round(value + gy // 16, 6) as value, gx // 16 as tile_col, gy // 16 as tile_row from fx_dem""")
oracle("raster_files_ingest", f"""select gx, gy, round(value, 6) as value, gx // 16 as tile_col, gy // 16 as tile_row from fx_dem
 where gx // 16 between {_C0} and {_C1} and gy // 16 between {_R0} and {_R1}""")
oracle("flowlines_read", "select f.way_id, ftype, stream_order, seq, node_id from fx_flow f join fx_refs r on f.way_id = r.way_id")
oracle("flowlines_files", """select f.way_id, ftype, stream_order, cast(row_number() over (partition by f.way_id order by seq) - 1 as int) as seq,
 round(lon, 7) as lon, round(lat, 7) as lat from fx_flow f join fx_refs r on f.way_id = r.way_id join fx_nodes n on r.node_id = n.node_id""")
oracle("flow_files_layer", f"select {_ROUND} from l_flow where value is not null")
oracle("points_read", "select lon, lat from fx_sources")
_WL = f"select zoom, gx, gy, round(value, 6) as value from ({WALK_LEVELS}) a"
oracle("pyramid_save", _WL)
oracle("levels_write", _WL)


def counted(cells: str, bins: int) -> str:
    return f"""select bin, lo0 + bin * span / {bins} as lo, lo0 + (bin + 1) * span / {bins} as hi, count(*) as n from (
 select least(coalesce({i32(f'(value - lo0) / nullif(span, 0e0) * {bins}')}, 0), {bins - 1}) as bin, lo0, span from {cells} c
 cross join (select min(value) as lo0, max(value) - min(value) as span from {cells}) e where value is not null) b group by bin, lo0, span"""


def breaks(cells: str, n: int, bins: int = 256) -> str:
    return f"""select cast(k as int) as k, lo + (k * total / {num(n)} - (cum - n)) / n * (hi - lo) as break_value from (
 select *, sum(n) over (order by bin) as cum, sum(n) over () as total from ({counted(cells, bins)}) h) c
 join (select unnest(range(1, {n + 1})) as k) q on k * total > (cum - n) * {n} and k * total <= cum * {n}"""


_HIST = "select bin, round(lo, 6) as lo, round(hi, 6) as hi, n from ({}) a"
oracle("histogram_save", _HIST.format(counted("fx_elev", 80)))
_SPREAD_BITS = " + ".join(f"((({{0}} >> {b}) & 1) << {2 * b})" for b in range(20))


def zcode(col: str, row: str) -> str:
    bits = lambda g: _SPREAD_BITS.format(f"cast({g} as bigint)")
    return f"(({bits(col)}) + 2 * ({bits(row)}))"


oracle("layer_save", f"""select cast({zcode('tile_col', 'tile_row')} as bigint) as z2, tile_col, tile_row, n_cells,
 min(tile_col) over () as min_col, min(tile_row) over () as min_row, max(tile_col) over () as max_col, max(tile_row) over () as max_row,
 '{LATLNG}' as crs, 'float64' as cell_type from (select gx // 16 as tile_col, gy // 16 as tile_row, cast(count(*) as int) as n_cells
 from fx_elev where value is not null group by 1, 2) t""")


def styled(levels_sql: str, breaks_sql: str, colors: int, layer: str) -> str:
    """Tiles of 256 cells with classes in pixel order; ``breaks_sql`` is an expression of ``value``."""
    return f"""select 'tiles/{layer}/' || zoom || '/' || tile_col || '/' || tile_row || '.png' as path, zoom, tile_col, tile_row,
 string_agg(cast(px as varchar), ',' order by px) as px, string_agg(cast(cls as varchar), ',' order by px) as class_index from (
 select zoom, gx // 256 as tile_col, gy // 256 as tile_row, (gy % 256) * 256 + gx % 256 as px,
 least({breaks_sql}, {colors - 1}) as cls from ({levels_sql}) l) t group by zoom, tile_col, tile_row"""


_STYLED = styled(WALK_LEVELS, "cast(greatest(0, least(10, ceil((value - 1e0) / 0.5e0))) as int)", 10, "walk")
oracle("styled_tiles", _STYLED)
oracle("styled_tiles_write", _STYLED)
oracle("tile_counts", f"select zoom, count(*) as n from (select distinct zoom, gx // 16, gy // 16 from ({WALK_LEVELS}) l) t group by zoom")

# ---- filters and projections --------------------------------------------------------------------
oracle("roads_and_water", "select way_id from fx_tags where highway is not null or waterway is not null")
oracle("highways", "select way_id, highway from fx_tags where highway is not null")
oracle("roads_paths_split", f"select way_id, case when highway in ({_WALKED}) then 'path' else 'road' end as part from fx_tags where highway is not null")
oracle("path_values", f"select way_id, 3.74e0 as value, 3.74e0 as z from fx_tags where highway in ({_WALKED})")
oracle("presence_class", """select way_id, case when highway is not null then 2e0 else 1e0 end as value, case when highway is not null then 2e0 else 1e0 end as z
 from fx_tags where highway is not null or waterway is not null""")
oracle("flow_filter", "select way_id, ftype from fx_flow where ftype in ('336', '460')")
oracle("flow_valid", "select way_id, stream_order from fx_flow where try_cast(nullif(stream_order, '') as int) >= 0")
oracle("band_select", f"select {_ROUND} from fx_dem")
oracle("first_sources", "select pt_id, gx, gy from fx_sources order by pt_id limit 6")

# ---- speed --------------------------------------------------------------------------------------
oracle("class_speed", f"select way_id, {class_of('highway', 'kmh')} as speed from fx_tags")
oracle("class_speed_mph", f"select way_id, {class_of('highway', 'mph')} as speed from fx_tags")
oracle("country_speed", f"select way_id, {table_case('maxspeed', speed.COUNTRY_KMH)} as speed from fx_tags")
oracle("velocity_parse", f"select way_id, round({velocity('maxspeed')}, 9) as speed from fx_tags")
oracle("speed_chain", f"select way_id, round({chain('highway', 'maxspeed')}, 9) as speed from fx_tags")
oracle("speed_sources", f"""select case when highway is null or maxspeed is null then 'missing_tag' when {velocity('maxspeed')} is not null then 'velocity'
 when {table_case('maxspeed', speed.COUNTRY_KMH)} is not null then 'country' when {table_case('highway', speed.CLASS_KMH)} is not null then 'class'
 else 'road' end as speed_source, count(*) as n from fx_tags group by 1""")
oracle("speed_notebook", f"select way_id, round({notebook('kmh')}, 9) as speed, round({notebook('kmh', False)}, 9) as speed_unsplit from sp_kmh")
oracle("speed_notebook_mph", f"select way_id, round({notebook('mph')}, 9) as speed from sp_mph")
_S = "lower(maxspeed)"
oracle("multi_speed", "select way_id, " + ", ".join(
    f"round({parts_of(_S, w, u)}, 9) as {n}" for n, w, u in (
        ("plain", "", "kmh"), ("mph_kmh", "mph", "kmh"), ("knots_kmh", "knots", "kmh"),
        ("kph_mph", "kph", "mph"), ("knots_mph", "knots", "mph"))) + " from fx_tags")
oracle("is_number", f"select way_id, cast(regexp_matches({strip('maxspeed')}, '{_NUMBER}') as int) as number from fx_tags")
oracle("speed_words", f"select way_id, maxspeed, {class_of('highway', 'kmh')} as speed from fx_tags where maxspeed in ({', '.join(map(text, speed.NO_INFORMATION))})")

# ---- geometry -----------------------------------------------------------------------------------
_EDGE = "feature_id, seq, " + ", ".join(f"round({c}, 7) as {c}" for c in ("x0", "y0", "x1", "y1"))
oracle("way_segments", f"select {_EDGE} from fx_wanted where kind = 'line'")
oracle("way_polygons", f"select {_EDGE} from fx_wanted where kind = 'polygon'")
oracle("fused_features", "select feature_id, kind, count(*) as n_edges from fx_wanted group by 1, 2")
oracle("flow_weights", "select way_id, stream_order, value, value as z from fx_flow_value")
oracle("points_mercator", f"select pt_id, round({ahead_x('lon')}, 4) as x, round({ahead_y('lat')}, 4) as y from fx_sources")

# ---- rasters ------------------------------------------------------------------------------------
oracle("tile_keys", "select gx, gy, gx // 16 as tile_col, gy // 16 as tile_row from fx_dem")
_PER_CELL = "select gx, gy, count(*) as n, cast(sum(feature_id) as bigint) as ids from ({}) a group by gx, gy"
oracle("raster_lines", _PER_CELL.format(line_cells("select * from fx_wanted", fx.GRID)))
oracle("raster_polygons", _PER_CELL.format(fill_cells(
    "select feature_id, x0, y0, x1, y1 from fx_wanted where kind = 'polygon' union all select feature_id + 1000000000, x0, y0, x1, y1 from fx_ring_edges",
    fx.GRID)))
_ZV = "case when highway is not null then 2e0 else 1e0 end"
oracle("burn_zorder", f"""select gx, gy, round(arg_max(z * 100 - feature_id % 90, z * 1000 - feature_id % 90), 6) as value from (
 {line_cells(f"select feature_id, x0, y0, x1, y1, {_ZV} as z from fx_wanted", fx.GRID, "z, ")}) a group by gx, gy""")
CTE["l_note_edges"] = "select e.feature_id, e.kind, e.x0, e.y0, e.x1, e.y1, s.value from fx_edges e join sp_note s on e.feature_id = s.way_id where e.kind = 'line'"
CTE["l_note_roads"] = burnt_lines(fx.GRID, "select * from l_note_edges")
oracle("raster_speed", "select gx, gy, round(cast(cast(value as float) as double), 6) as value from l_note_roads")

# ---- cell types ---------------------------------------------------------------------------------
oracle("with_nodata", f"select {_ROUND} from fx_elev")
_T = "cast(trunc(value - 300.5e0) as bigint)"
oracle("cast_int8", f"""select gx, gy, cast((({_T} + 128) % 256 + 256) % 256 - 128 as int) as wrap,
 cast(least(greatest({_T}, -128), 127) as int) as saturate, cast(case when {_T} between -128 and 127 then {_T} end as int) as "null" from fx_dem""")
_T = "cast(trunc(value / 3) as bigint)"
oracle("convert_type", f"""select gx, gy, cast(nullif({_T}, 0) as int) as i16, cast(nullif(({_T} + 128) % 256 - 128, 0) as int) as i8,
 round(cast(cast(nullif(value, 0e0) / 3 as float) as double), 3) as f32 from fx_dem""")
oracle("float_cells", "select gx, gy, round(cast(cast(nullif(value, 0e0) / 7 as float) as double), 3) as value from fx_dem")

# ---- map algebra --------------------------------------------------------------------------------
CTE["l_tenth"] = "select gx, gy, value / 10 as value from fx_dem"
oracle("tobler", f"select {_ROUND} from ({walked('l_tenth')}) a")
oracle("merge_max", f"select {_ROUND} from l_merged")
oracle("merge_max_dealt", f"select {_ROUND} from l_merged")
CTE["l_two"] = "select e.gx, e.gy, e.value as a, c.value * 600 as b from fx_elev e join l_cover c on e.gx = c.gx and e.gy = c.gy"
oracle("local_max", """select gx, gy, round(case when a is null or b is null then null else greatest(a, b) end, 6) as strict,
 round(case when a is null then b when b is null then a else greatest(a, b) end, 6) as loose,
 round(case when a is not null then greatest(a, coalesce(b, 0e0)) end, 6) as filled from l_two""")
oracle("local_add", "select gx, gy, round(a + b, 6) as value from l_two")
oracle("local_sub", "select gx, gy, round(a - b, 6) as value from l_two")
oracle("adjusted_speed", f"select {_ROUND} from ({adjusted('l_walk', 'l_flow', 'l_cover', 'l_paths')}) a")
oracle("pace", "select gx, gy, round(3.6e0 / nullif(value, 0e0), 9) as value from fx_dem")
oracle("reclassify", f"select {_ROUND} from l_cover")
_MASK = "gx between 10 and 39 and gy >= 1"
oracle("mask_extent", f"select {_ROUND} from fx_dem where {_MASK}")
oracle("mask_polygon", f"""select {_ROUND} from fx_dem d where exists (select 1 from ({fill_cells("select * from fx_ring_edges", fx.GRID)}) p
 where p.gx = d.gx and p.gy = d.gy)""")

# ---- neighbourhood and cost ---------------------------------------------------------------------
_EXTRA = "select gx, gy, value, unnest(range(greatest(0, {g}), least({n}, {h}) + 1)) as {t}"
_TILES = _EXTRA.format(g="cast(floor((gx - 5) / 16e0) as int)", h="cast(floor((gx + 5) / 16e0) as int)", n=fx.GRID.tile_cols - 1, t="tc")
oracle("buffer_tiles", f"""select gx, gy, round(value, 6) as value, cast(tc as int) as tile_col,
 cast(unnest(range(greatest(0, cast(floor((gy - 5) / 16e0) as int)), least({fx.GRID.tile_rows - 1}, cast(floor((gy + 5) / 16e0) as int)) + 1)) as int) as tile_row
 from ({_TILES} from fx_dem) a""")
oracle("slope", f"select {_ROUND} from l_slope")
oracle("zfactor", f"select gx, gy, round({zfactor('gy', fx.GRID)} * 1e6, 6) as zf from fx_dem")
_COST = spread("cd", "fx_friction", "fx_sources", UNIT, fx.COST_CAP, 12)
oracle("cost_distance", f"select gx, gy, round(cost, 6) as value from {_COST}")

# ---- grids --------------------------------------------------------------------------------------
oracle("regrid_nearest", f"select {_ROUND} from ({nearest('fx_elev', fx.GRID, FINE)}) a")
oracle("reproject_bilinear", f"select {_ROUND} from l_base")
oracle("reproject_max", f"select {_ROUND} from ({largest('fx_elev', fx.GRID, MERC)}) a")
oracle("reproject_nearest", f"select {_ROUND} from ({nearest('fx_elev', fx.GRID, MERC)}) a")


def sized(cells: str, m: LayerMeta) -> str:
    x = lambda g: ahead_x(f"({num(m.xmin)} + ({g}) * {num(m.cell_w)})")
    y = lambda g: ahead_y(f"({num(m.ymax)} - ({g}) * {num(m.cell_h)})")
    return f"""select sqrt(power({x('x1 + 1')} - {x('x0')}, 2) + power({y('y0')} - {y('y1 + 1')}, 2))
 / sqrt(power(x1 - x0 + 1, 2) + power(y1 - y0 + 1, 2)) as cell_size
 from (select min(gx) as x0, max(gx) as x1, min(gy) as y0, max(gy) as y1 from {cells}) b"""


_FINEST = 2 * MERCATOR_EDGE / 256
oracle("target_zoom", f"""select round(cell_size, 6) as cell_size, cast(arg_min(z, abs({num(_FINEST)} / power(2, z) - cell_size)) as int) as zoom
 from ({sized('fx_dem', fx.GRID)}) s cross join (select unnest(range(0, 31)) as z) l group by cell_size""")
oracle("pyramid_nearest", _WL)
oracle("pyramid_bilinear", f"select zoom, gx, gy, round(value, 6) as value from ({WALK_MEANS}) a")

# ---- statistics ---------------------------------------------------------------------------------
oracle("histogram", _HIST.format(counted("fx_elev", 80)))
oracle("histogram_256", _HIST.format(counted("fx_elev", 256)))
CTE["l_power"] = """select value, e0 - case when power(2e0, e0) > abs(value) then 1 else 0 end + case when power(2e0, e0 + 1) <= abs(value) then 1 else 0 end as e
 from (select value, case when value <> 0 then floor(log2(abs(value))) end as e0 from (select cast(value as double) as value from fx_elev) a where value is not null) b"""
CTE["l_centroids"] = """select sum(value) / count(*) as centroid, count(*) as n, min(value) as lo, max(value) as hi
 from l_power group by sign(value), e, floor(abs(value) / power(2e0, e) * 128e0)"""
oracle("histogram_centroids", "select round(centroid, 6) as centroid, n, round(lo, 6) as lo, round(hi, 6) as hi from l_centroids")
oracle("histogram_one_pass", """select bin, round(lo0 + bin * span / 80e0, 6) as lo, round(lo0 + (bin + 1) * span / 80e0, 6) as hi, cast(sum(n) as bigint) as n
 from (select least(coalesce(cast(floor((centroid - lo0) / nullif(span, 0e0) * 80e0) as int), 0), 79) as bin, lo0, span, n
 from l_centroids, (select min(lo) as lo0, max(hi) - min(lo) as span from l_centroids) e) a group by bin, lo0, span""")
oracle("quantile_breaks", f"select k, round(break_value, 6) as break_value from ({breaks('fx_elev', 10)}) b")
oracle("rank_breaks", """select cast(k as int) as k, round(value, 6) as break_value
 from (select value, row_number() over (order by value) as place, count(*) over () as n from fx_elev where value is not null) a, range(1, 11) t(k) where place = (k * n + 9) // 10""")
CTE["l_breaks"] = breaks("fx_elev", 10)
oracle("color_classes", f"""select gx, gy, round(value, 6) as value, c as class_index, {case('c', ((i, text(h)) for i, h in enumerate(MAGMA)))} as color
 from (select e.*, cast(least(9, (select count(*) from l_breaks b where b.break_value < e.value)) as int) as c from fx_elev e where value is not null) a""")
oracle("fixed_classes", f"""select gx, gy, round(value, 6) as value,
 cast(case when value < 8 then 0 when value >= 100 then 24 else floor(23e0 * (value - 8) / 92e0) + 1 end as int) as class_index from l_roads""")
oracle("key_bounds", """select min(gx // 16) as min_col, min(gy // 16) as min_row, max(gx // 16) as max_col, max(gy // 16) as max_row
 from fx_elev where value is not null""")
oracle("classify", "select gx, gy, cast(case when value is not null then least(9, greatest(0, ceil(value / 50e0) - 1)) end as int) as class_index from fx_elev")

# ---- placement ----------------------------------------------------------------------------------
oracle("z_order", f"select gx, gy, cast({zcode('gx', 'gy')} as bigint) as z2 from fx_dem")
oracle("z_partition", f"select gx as tile_col, gy as tile_row, cast(({zcode('gx', 'gy')} >> 8) % 5 as int) as part from fx_dem")
oracle("partition_tiles", "select gx // 16 as tile_col, gy // 16 as tile_row, count(*) as n, cast(1 as bigint) as n_parts from fx_dem group by 1, 2")

# ---- jobs ---------------------------------------------------------------------------------------
CTE["j_base"] = bilinear("l_merged", fx.GRID, MERC)
J_LEVELS = levels("jl", "j_base", Z)
J_MEANS = levels("jm", "j_base", Z, "bilinear")
oracle("job_friction_pyramid", f"select zoom, gx, gy, round(value, 6) as value from ({J_LEVELS}) a")
oracle("job_tile_counts", f"select zoom, count(*) as n from (select distinct zoom, gx // 256, gy // 256 from ({J_LEVELS}) l) t group by zoom")
CTE["j_breaks"] = breaks("j_base", 10)
oracle("job_styled_tiles", styled(J_MEANS, "cast((select count(*) from j_breaks b where b.break_value < value) as int)", 10, "friction"))
CTE["j_presence"] = burnt(fx.ROADS, f"select feature_id, kind, x0, y0, x1, y1, {_ZV} as value from fx_wanted")
oracle("job_presence", f"select {_ROUND} from j_presence")

# elevation on the road grid, walking, roads by text, largest per Mercator cell
CTE["t_elev"] = f"select gx, gy, cast(value as double) as value from ({nearest('fx_elev', fx.GRID, fx.ROADS)}) a"
CTE["t_slope"] = sloped("t_elev", fx.ROADS)
CTE["t_walk"] = walked("t_slope")
CTE["t_roads"] = burnt_lines(fx.ROADS, "select * from l_note_edges")
CTE["t_friction"] = """select w.gx, w.gy, greatest(w.value, coalesce(r.value, 0e0)) as value
 from t_walk w left join t_roads r on w.gx = r.gx and w.gy = r.gy"""
CTE["m_elev"] = f"select gx, gy, value from fx_elev where {_MASK}"
CTE["m_slope"] = sloped("m_elev", fx.GRID)
CTE["m_walk"] = walked("m_slope")
CTE["m_cover"] = f"select gx, gy, value from l_cover where {_MASK}"
CTE["m_adjusted"] = adjusted("m_walk", "l_flow", "m_cover", "l_paths")
CTE["m_roads"] = burnt_lines(fx.GRID, f"""select e.feature_id, e.x0, e.y0, e.x1, e.y1, s.value from fx_edges e join sp_note_mph s on e.feature_id = s.way_id
 where e.kind = 'line' and s.highway not in ({_WALKED})""")
CTE["m_friction"] = """select w.gx, w.gy, case when w.value is not null then greatest(w.value, coalesce(r.value, 0e0)) end as value
 from m_adjusted w left join m_roads r on w.gx = r.gx and w.gy = r.gy"""


def travel(key: str, prefix: str, friction: str, src: LayerMeta, zoom: int, k: float, nodata: float, start: str, rounds: int | None, cap: float = fx.JOB_CAP) -> None:
    """A cost job: friction pyramid and cost pyramid in Web Mercator at ``zoom``."""
    dst = layout_for_zoom(zoom, MERCATOR)
    CTE[f"{prefix}_base"] = f"""select gx, gy, nullif(cast(cast(value as float) as double), {num(nodata)}) as value from ({largest(friction, src, dst)}) a"""
    CTE[f"{prefix}_pace"] = f"select gx, gy, {num(k)} / nullif(value, 0e0) as value from {prefix}_base"
    CTE[f"{prefix}_start"] = f"""select {i32(f"({ahead_x('lon')} - {num(dst.xmin)}) / {num(dst.cell_w)}")} as gx,
 {i32(f"({num(dst.ymax)} - {ahead_y('lat')}) / {num(dst.cell_h)}")} as gy from {start}"""
    last = spread(f"{prefix}_c", f"{prefix}_pace", f"{prefix}_start", dst, cap, rounds)
    CTE[f"{prefix}_cost"] = f"select gx, gy, cost as value from {last}"
    surfaces, costs = levels(f"{prefix}_f", f"{prefix}_base", zoom), levels(f"{prefix}_d", f"{prefix}_cost", zoom)
    oracle(key, f"""select 'friction' as layer, zoom, gx, gy, round(value, 4) as value from ({surfaces}) a
 union all select 'cost', zoom, gx, gy, round(value, 4) from ({costs}) b""")


CTE["fx_first"] = "select * from fx_sources order by pt_id limit 6"
# the cheapest step, 130 km/h (or mph) over one cell, takes a bit over JOB_CAP / 60
ROUNDS = 60
travel("job_cost_distance", "ja", "t_friction", fx.ROADS, Z, 3.6, -2147483648.0, "fx_sources", ROUNDS)
travel("job_cost_distance_6", "jb", "t_friction", fx.ROADS, Z, 3.6, -2147483648.0, "fx_first", None, fx.REGION_CAP)
travel("job_adjusted_friction", "jc", "m_friction", fx.GRID, Z, 3.74, 0.0, "fx_sources", ROUNDS)
