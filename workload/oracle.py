"""SQL twins of the queries, for DuckDB on the same tables."""

from __future__ import annotations

STEPS = {
    "base": """
  SELECT CAST(floor(l_orderkey / 10.0) AS BIGINT) AS event_id,
         CAST(l_suppkey % 2 AS BIGINT) AS geo,
         CAST(1 + 3 * (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)
              + l_linenumber % 3 AS BIGINT) AS ch,
         CAST(round(l_extendedprice) AS BIGINT) AS value,
         CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS BIGINT) AS edge
  FROM lineitem""",
    "ev": "SELECT DISTINCT event_id, geo FROM base",
    "flat": """
  SELECT event_id, geo, ch, value, edge FROM base
  UNION ALL SELECT event_id, geo, CAST(0 AS BIGINT), (event_id * 37 + geo * 11) % 1000, CAST(0 AS BIGINT)
            FROM ev WHERE event_id % 17 <> 0
  UNION ALL SELECT event_id, geo, CAST(0 AS BIGINT), (event_id * 37 + geo * 11) % 1000 + 5, CAST(0 AS BIGINT)
            FROM ev WHERE event_id % 23 = 0
  UNION ALL SELECT event_id, geo, CAST(0 AS BIGINT), (event_id * 37 + geo * 11) % 1000 + 9, CAST(1 AS BIGINT)
            FROM ev""",
    "hits": """
  SELECT event_id, CAST(20 AS BIGINT) AS dev, CAST(4 AS BIGINT) AS fp, CAST(50 AS BIGINT) AS det,
         geo, ch, value, edge
  FROM flat
  UNION ALL
  SELECT event_id, CAST(20 + (k = 0)::INT AS BIGINT), CAST(4 + (k = 1)::INT AS BIGINT),
         CAST(50 + (k = 2)::INT AS BIGINT), geo, CAST(c AS BIGINT), CAST(7 AS BIGINT), CAST(0 AS BIGINT)
  FROM ev CROSS JOIN (VALUES (0), (1), (2)) AS m(k) CROSS JOIN (VALUES (0), (4)) AS n(c)""",
    "chmap": """
  SELECT concat('p', CAST(g.geo AS VARCHAR),
                CASE WHEN c.ch <= 3 THEN 'a' WHEN c.ch <= 6 THEN 'x' ELSE 'y' END) AS cat,
         CAST((c.ch - 1) % 3 AS BIGINT) AS id, CAST(20 AS BIGINT) AS dev, CAST(4 AS BIGINT) AS fp,
         CAST(50 AS BIGINT) AS det, CAST(g.geo AS BIGINT) AS geo, CAST(c.ch AS BIGINT) AS ch
  FROM (VALUES (0),(1)) AS g(geo)
  CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(9)) AS c(ch)
  WHERE NOT (g.geo = 1 AND c.ch = 9)""",
    "mapped": """
  SELECT h.event_id, m.cat, h.value, m.id, h.edge, h.dev, h.fp, h.det, h.geo
  FROM hits h JOIN chmap m
    ON h.dev = m.dev AND h.fp = m.fp AND h.det = m.det AND h.geo = m.geo AND h.ch = m.ch""",
    "tref": """
  SELECT event_id, value, dev, fp, det, geo FROM hits
  WHERE dev = 20 AND fp = 4 AND det = 50 AND geo IN (0, 1) AND ch = 0 AND edge = 0""",
    "subtracted": """
  SELECT m.event_id, m.cat, m.id, m.value - t.value AS value, m.edge
  FROM mapped m LEFT JOIN tref t
    ON m.event_id = t.event_id AND m.dev = t.dev AND m.fp = t.fp AND m.det = t.det AND m.geo = t.geo""",
    "valid": "SELECT * FROM subtracted WHERE value > -100000 AND value < 100000",
    "flipped": """
  SELECT event_id, cat, id, value, CASE WHEN cat LIKE '%a' THEN edge ELSE 1 - edge END AS edge
  FROM valid""",
    "pairs": """
  SELECT l.event_id, l.cat, l.id, t.value - l.value AS charge, l.value AS timing
  FROM (SELECT DISTINCT event_id, cat, id, value FROM flipped WHERE edge = 0) l
  ASOF JOIN (SELECT event_id, cat, id, value FROM flipped WHERE edge = 1) t
    ON l.event_id = t.event_id AND l.cat = t.cat AND l.id = t.id AND l.value < t.value""",
    "pulses": """
  SELECT event_id, cat, id, 0.09765627::DOUBLE * (charge + 0.5::DOUBLE) AS charge,
         0.09765627::DOUBLE * (timing + 0.5::DOUBLE) AS timing
  FROM pairs""",
    # Pairs without the edge flip, in the other time unit.
    "plain_pairs": """
  SELECT l.event_id, l.cat, l.id, t.value - l.value AS charge, l.value AS timing
  FROM (SELECT DISTINCT event_id, cat, id, value FROM valid WHERE edge = 0) l
  ASOF JOIN (SELECT event_id, cat, id, value FROM valid WHERE edge = 1) t
    ON l.event_id = t.event_id AND l.cat = t.cat AND l.id = t.id AND l.value < t.value""",
    "plain_pulses": """
  SELECT event_id, cat, id, 0.0244140625::DOUBLE * (charge + 0.5::DOUBLE) AS charge,
         0.0244140625::DOUBLE * (timing + 0.5::DOUBLE) AS timing
  FROM plain_pairs""",
    "ranked": """
  SELECT event_id, cat, id, charge,
         row_number() OVER (PARTITION BY event_id, cat ORDER BY charge DESC, id, timing) AS r
  FROM pulses""",
    "top2": """
  SELECT event_id, cat, max(CASE WHEN r = 1 THEN charge END) AS c0,
         max(CASE WHEN r = 2 THEN charge END) AS c1, max(CASE WHEN r = 1 THEN id END) AS id0,
         max(CASE WHEN r = 2 THEN id END) AS id1
  FROM ranked WHERE r <= 2 GROUP BY event_id, cat""",
    # The curve is a ramp to (0.4, 1); asymmetries are never negative.
    "shared": """
  SELECT *, CASE WHEN c1 IS NULL THEN NULL
                 WHEN (c0 - c1) / (c0 + c1) >= 0.4::DOUBLE THEN 1.0::DOUBLE
                 ELSE (c0 - c1) / (c0 + c1) / 0.4::DOUBLE END AS conv
  FROM top2""",
    "positions": """
  SELECT event_id, cat, conv,
         -((id0 - 1.0::DOUBLE + (1 - conv) * CASE WHEN id0 < id1 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END)
           * 2.55::DOUBLE) AS pos
  FROM shared""",
    "lists": """
  SELECT event_id, cat,
         string_agg(CAST(id AS VARCHAR), ',' ORDER BY timing, id, charge) AS ids,
         string_agg(CAST(CAST(round(timing * 1000000) AS BIGINT) AS VARCHAR), ','
                    ORDER BY timing, id, charge) AS timings,
         string_agg(CAST(CAST(round(charge * 1000000) AS BIGINT) AS VARCHAR), ','
                    ORDER BY timing, id, charge) AS charges
  FROM pulses GROUP BY event_id, cat""",
    "plain_lists": """
  SELECT event_id, cat,
         string_agg(CAST(id AS VARCHAR), ',' ORDER BY timing, id, charge) AS ids,
         string_agg(CAST(CAST(round(timing * 1000000) AS BIGINT) AS VARCHAR), ','
                    ORDER BY timing, id, charge) AS timings,
         string_agg(CAST(CAST(round(charge * 1000000) AS BIGINT) AS VARCHAR), ','
                    ORDER BY timing, id, charge) AS charges
  FROM plain_pulses GROUP BY event_id, cat""",
    "events_seen": "SELECT DISTINCT event_id FROM hits",
}

NEEDS = {
    "base": [],
    "ev": ["base"],
    "flat": ["base", "ev"],
    "hits": ["flat", "ev"],
    "chmap": [],
    "mapped": ["hits", "chmap"],
    "tref": ["hits"],
    "subtracted": ["mapped", "tref"],
    "valid": ["subtracted"],
    "flipped": ["valid"],
    "pairs": ["flipped"],
    "pulses": ["pairs"],
    "plain_pairs": ["valid"],
    "plain_pulses": ["plain_pairs"],
    "ranked": ["pulses"],
    "top2": ["ranked"],
    "shared": ["top2"],
    "positions": ["shared"],
    "lists": ["pulses"],
    "plain_lists": ["plain_pulses"],
    "events_seen": ["hits"],
}


def query(body: str, *steps: str) -> str:
    """`body` after the named steps and all they need."""
    wanted: set[str] = set()
    todo = list(steps)
    while todo:
        step = todo.pop()
        if step not in wanted:
            wanted.add(step)
            todo += NEEDS[step]
    parts = [f"{name} AS ({text})" for name, text in STEPS.items() if name in wanted]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def r6(expression: str) -> str:
    """Six decimals, and no negative zero."""
    return f"round({expression}, 6) + 0.0::DOUBLE"


def pairs_in_window(
    source: str, low: str, high: str, left: str, right: str, compat: bool = False
) -> str:
    """Left/right pulses of one strip inside a time window, with their features."""
    mean = "l.{0} + r.{0} / 2" if compat else "(l.{0} + r.{0}) / 2"
    return f"""SELECT l.event_id, l.id, l.timing - r.timing AS tdiff, {mean.format('timing')} AS tavg,
         l.charge - r.charge AS qdiff, {mean.format('charge')} AS qavg,
         ln(l.charge / r.charge) AS qlog, sqrt(l.charge * r.charge) AS qsqsum
  FROM {source} l JOIN {source} r ON l.event_id = r.event_id AND l.id = r.id
  WHERE l.cat = '{left}' AND r.cat = '{right}' AND l.timing - r.timing BETWEEN {low} AND {high}"""


FEATURES = ["tdiff", "tavg", "qdiff", "qavg", "qlog", "qsqsum"]


def micro_list(expression: str, order: str) -> str:
    return (
        f"string_agg(CAST(CAST(round({expression} * 1000000) AS BIGINT) AS VARCHAR), ',' "
        f"ORDER BY {order})"
    )


def edge_list(low: float, high: float, bins: int) -> str:
    """Edges of equal bins as a list; the last is exact."""
    step = (high - low) / bins
    return (
        f"list_append([i * {step!r}::DOUBLE + {low!r}::DOUBLE FOR i IN range(0, {bins})], "
        f"{high!r}::DOUBLE)"
    )


def bin_of(value: str, low: float, high: float, bins: int, closed: bool = False) -> str:
    """Bin number by counting the edges at or below the value."""
    edges = edge_list(low, high, bins)
    number = f"len([e FOR e IN {edges} IF e <= {value}])"
    if closed:
        return (
            f"CASE WHEN {value} > {high!r}::DOUBLE THEN {bins + 1} "
            f"ELSE least({number}, {bins}) END"
        )
    return number


def edge_at(index: str, low: float, high: float, bins: int) -> str:
    step = (high - low) / bins
    return (
        f"CASE WHEN {index} >= {bins} THEN {high!r}::DOUBLE "
        f"ELSE ({index}) * {step!r}::DOUBLE + {low!r}::DOUBLE END"
    )


def hist1d(source: str, value: str, low: float, high: float, bins: int, closed: bool, outer: bool,
           *steps: str) -> str:
    first, last = (0, bins + 1) if outer else (1, bins)
    lo, hi = edge_at("b.bin - 1", low, high, bins), edge_at("b.bin", low, high, bins)
    return query(
        f"""SELECT b.bin, CASE WHEN b.bin >= 1 THEN {lo} END AS lo,
       CASE WHEN b.bin <= {bins} THEN {hi} END AS hi,
       CASE WHEN b.bin BETWEEN 1 AND {bins} THEN {r6(f'0.5::DOUBLE * ({lo} + {hi})')} END AS center,
       count(v.bin) AS n
FROM (SELECT range AS bin FROM range({first}, {last + 1})) b
LEFT JOIN (SELECT CAST({bin_of(value, low, high, bins, closed)} AS BIGINT) AS bin
           FROM {source} WHERE {value} IS NOT NULL) v ON v.bin = b.bin
GROUP BY b.bin""",
        *steps,
    )


def hist2d(source: str, x: str, y: str, span: tuple, bins: tuple, closed: bool, *steps: str) -> str:
    (lx, hx), (ly, hy) = span
    cx = f"0.5::DOUBLE * ({edge_at('bin_x - 1', lx, hx, bins[0])} + {edge_at('bin_x', lx, hx, bins[0])})"
    cy = f"0.5::DOUBLE * ({edge_at('bin_y - 1', ly, hy, bins[1])} + {edge_at('bin_y', ly, hy, bins[1])})"
    return query(
        f"""SELECT bin_x, bin_y, {r6(cx)} AS x, {r6(cy)} AS y, count(*) AS n
FROM (SELECT CAST({bin_of(x, lx, hx, bins[0], closed)} AS BIGINT) AS bin_x,
             CAST({bin_of(y, ly, hy, bins[1], closed)} AS BIGINT) AS bin_y
      FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) v
WHERE bin_x BETWEEN 1 AND {bins[0]} AND bin_y BETWEEN 1 AND {bins[1]}
GROUP BY bin_x, bin_y""",
        *steps,
    )


def strip_full(more: str = "") -> str:
    """All columns of both detectors for every event, after the columns `more`."""
    columns, joins = [], []
    for d in ("p0", "p1"):
        columns += [f"{d}a.timings AS {d}a_timing", f"{d}a.charges AS {d}a_charge"]
        joins.append(f"LEFT JOIN lists {d}a ON {d}a.event_id = e.event_id AND {d}a.cat = '{d}a'")
        for p in (f"{d}x", f"{d}y"):
            columns += [f"{p}.ids AS {p}_id", f"{p}.timings AS {p}_timing", f"{p}.charges AS {p}_charge",
                        f"{r6(f's{p}.pos')} AS {p}_pos"]
            joins += [f"LEFT JOIN lists {p} ON {p}.event_id = e.event_id AND {p}.cat = '{p}'",
                      f"LEFT JOIN positions s{p} ON s{p}.event_id = e.event_id AND s{p}.cat = '{p}'"]
    return query(
        f"SELECT e.event_id, {more}{', '.join(columns)} FROM events_seen e " + " ".join(joins),
        "lists",
        "positions",
        "events_seen",
    )


STRIP_FULL = strip_full()
# What the stream adds: run number and arrival time, in seconds.
STREAM_FULL = strip_full("e.event_id % 7 AS runnumber, 1700000000 + e.event_id % 5 AS stream_uts, ")


def strip_short(require: str) -> str:
    detector = """(SELECT x.event_id, x.pos AS x_pos, y.pos AS y_pos, a.timings, a.charges
      FROM positions x
      LEFT JOIN positions y ON y.event_id = x.event_id AND y.cat = '{0}y'
      LEFT JOIN lists a ON a.event_id = x.event_id AND a.cat = '{0}a'
      WHERE x.cat = '{0}x' AND x.pos IS NOT NULL)"""
    return query(
        f"""SELECT e.event_id, {r6('d0.x_pos')} AS p0x_pos, {r6('d0.y_pos')} AS p0y_pos,
       d0.timings AS p0a_timing, d0.charges AS p0a_charge, {r6('d1.x_pos')} AS p1x_pos,
       {r6('d1.y_pos')} AS p1y_pos, d1.timings AS p1a_timing, d1.charges AS p1a_charge
FROM events_seen e
{require} JOIN {detector.format('p0')} d0 ON d0.event_id = e.event_id
LEFT JOIN {detector.format('p1')} d1 ON d1.event_id = e.event_id""",
        "lists",
        "positions",
        "events_seen",
    )


def two_sided_rows(source: str, low: str, high: str, compat: bool, *steps: str) -> str:
    order = ", ".join(FEATURES)
    columns = ", ".join(f"{micro_list(f, order)} AS {f}" for f in FEATURES)
    found = pairs_in_window(source, low, high, "p0x", "p0y", compat)
    return query(f"SELECT event_id, id, {columns} FROM ({found}) f GROUP BY event_id, id", *steps)


def two_sided_event(full: bool, require: bool) -> str:
    order = ", ".join(FEATURES)
    features = FEATURES if full else ["tdiff", "tavg", "qsqsum"]
    columns = ", ".join(f"{micro_list(f, order)} AS {f}" for f in features)
    found = pairs_in_window("plain_pulses", "-500", "500", "p0x", "p0y")
    strips = f"(SELECT event_id, id, {columns} FROM ({found}) f GROUP BY event_id, id)"
    join = "JOIN" if require else "LEFT JOIN"
    chosen = ["a.timings AS pad_timing", "a.charges AS pad_charge"]
    sides = ""
    if full:
        for side, name in (("x", "left"), ("y", "right")):
            chosen += [f"{side}.ids AS {name}_id", f"{side}.timings AS {name}_timing",
                       f"{side}.charges AS {name}_charge"]
            sides += (f"LEFT JOIN plain_lists {side} ON {side}.event_id = e.event_id "
                      f"AND {side}.cat = 'p0{side}'\n")
    chosen += ["s.id AS strip_id", *[f"s.{f} AS strip_{f}" for f in features]]
    return query(
        f"""SELECT e.event_id, {', '.join(chosen)}
FROM events_seen e
{join} (SELECT * FROM plain_lists WHERE cat = 'p0a') a ON a.event_id = e.event_id
{sides}{join} {strips} s ON s.event_id = e.event_id""",
        "plain_lists",
        "plain_pulses",
        "events_seen",
    )


def _wire(by_id: bool, chunk: int | None = None) -> str:
    """All planes of an event, or with `chunk` so many pulses of each plane to a row."""
    part = "0" if chunk is None else f"(row_number() OVER (PARTITION BY event_id, cat ORDER BY timing, id, charge) - 1) // {chunk}"
    shown = "" if chunk is None else "coalesce(part, 0) AS part, "
    # The chamber takes all values: there is no window before pairing.
    reference = (
        "LEFT JOIN (SELECT * FROM tref WHERE geo = 0) t ON m.event_id = t.event_id"
        if by_id
        else "LEFT JOIN tref t ON m.event_id = t.event_id AND m.dev = t.dev AND m.fp = t.fp "
        "AND m.det = t.det AND m.geo = t.geo"
    )
    planes = ["p0a", "p0x", "p0y", "p1a", "p1x", "p1y"]
    columns = ", ".join(
        f"max(CASE WHEN cat = '{p}' THEN {q} END) AS {p}_{c}"
        for p in planes
        for q, c in (("ids", "id"), ("timings", "timing"), ("charges", "charge"))
    )
    return query(
        f"""SELECT e.event_id, {shown}{columns}
FROM events_seen e LEFT JOIN (
  SELECT event_id, cat, part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY timing, id, charge) AS ids,
         {micro_list('timing', 'timing, id, charge')} AS timings,
         {micro_list('charge', 'timing, id, charge')} AS charges
  FROM (SELECT *, {part} AS part FROM (SELECT l.event_id, l.cat, l.id,
               0.0244140625::DOUBLE * (t.value - l.value + 0.5::DOUBLE) AS charge,
               0.0244140625::DOUBLE * (l.value + 0.5::DOUBLE) AS timing
        FROM (SELECT DISTINCT event_id, cat, id, value FROM s WHERE edge = 0) l
        ASOF JOIN (SELECT event_id, cat, id, value FROM s WHERE edge = 1) t
          ON l.event_id = t.event_id AND l.cat = t.cat AND l.id = t.id AND l.value < t.value) q) p
  GROUP BY event_id, cat, part) w ON w.event_id = e.event_id
GROUP BY e.event_id, part""",
        "mapped",
        "tref",
        "events_seen",
    ).replace(
        " SELECT e.event_id",
        f", s AS (SELECT m.event_id, m.cat, m.id, m.value - t.value AS value, m.edge "
        f"FROM mapped m {reference} WHERE t.value IS NOT NULL) SELECT e.event_id",
        1,
    )


TRIGGER_HITS = """(SELECT event_id, id, 0.0244140625::DOUBLE * (value + 0.5::DOUBLE) AS timing
      FROM valid WHERE cat LIKE 'p_a')"""

SALES_SPAN = (0.0, 105000.0)

# Equal rows once, with their number.
COUNTED = "SELECT event_id, cat, id, value, edge, count(*) AS n FROM {} GROUP BY 1, 2, 3, 4, 5"


def oracles() -> dict[str, str]:
    edges = ((0.0, 5000.0), (-500.0, 9500.0))
    sales = ((1.0, 51.0), (0.0, 105000.0))
    pulse = "(SELECT charge, timing FROM pulses)"
    plane = "(SELECT charge, timing FROM pulses WHERE cat = 'p0x')"
    stats_bin = bin_of("charge", 0.0, 500.0, 49)
    zone = "CASE WHEN {0} = 0 THEN 0 WHEN {0} = {1} THEN 2 ELSE 1 END"
    zone_x = zone.format(f"({bin_of('charge', 0.0, 500.0, 19)})", 20)
    zone_y = zone.format(f"({bin_of('timing', 0.0, 5000.0, 29)})", 30)
    decoded = """SELECT event_id, user_id AS runnumber, CAST(round(value * 1000) AS BIGINT) AS ts, CAST(20 AS BIGINT) AS dev,
       CAST(4 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS mod, CAST(50 AS BIGINT) AS det,
       user_id % 2 AS geo, user_id % 10 AS ch, CAST(round(value * 100) AS BIGINT) AS value,
       event_id % 2 AS edge"""
    curve_points = """SELECT p_brand AS tab, floor(p_retailprice / 2) / 613.0::DOUBLE AS y,
       min(p_retailprice) AS x FROM part GROUP BY 1, 2"""
    trigger_chunks = query(
        f"""SELECT e.event_id, coalesce(part, 0) AS part, trig_id, trig_timing, f.trig
FROM events_seen e LEFT JOIN (
  SELECT event_id, rk // 2 AS part, string_agg(CAST(id AS VARCHAR), ',' ORDER BY timing, id) AS trig_id,
         {micro_list('timing', 'timing, id')} AS trig_timing
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY timing, id) - 1 AS rk FROM {TRIGGER_HITS})
  GROUP BY event_id, rk // 2) c ON c.event_id = e.event_id
LEFT JOIN (SELECT event_id, arg_min(id, timing * 4096 + id) AS trig FROM {TRIGGER_HITS} GROUP BY event_id) f
  ON f.event_id = e.event_id""",
        "valid",
        "events_seen",
    )
    return {
        "q_explode_hits": query("SELECT * FROM hits", "hits"),
        "q_explode_hits_keep": query(
            "SELECT event_id, ch AS runnumber, value AS ts, dev, fp, CAST(0 AS BIGINT) AS mod, det, "
            "geo, ch, value, edge FROM hits",
            "hits",
        ),
        "q_read_map_prefix": """SELECT concat(lower(p_type), '-', p_brand) AS cat, p_partkey AS id,
       CAST(p_size AS BIGINT) AS dev, p_partkey % 64 AS fp, p_partkey % 31 AS det,
       p_partkey % 16 AS geo, p_partkey % 128 AS ch
FROM part WHERE starts_with(p_type, 'S') OR starts_with(p_type, 'PROMO')""",
        "q_read_map_planes": """SELECT concat('w', CAST(p_partkey % 128 // 16 AS VARCHAR)) AS cat,
       p_partkey % 128 AS id, CAST(p_size AS BIGINT) AS dev, p_partkey % 64 AS fp, p_partkey % 31 AS det,
       p_partkey % 16 AS geo, p_partkey AS ch
FROM part""",
        "q_read_curves": f"SELECT tab AS \"table\", x, y FROM ({curve_points}) c",
        "q_map_channels": query("SELECT event_id, cat, value, id FROM mapped", "mapped"),
        "q_time_reference": query("SELECT * FROM tref", "tref"),
        "q_subtract_reference": query(COUNTED.format("subtracted"), "subtracted"),
        "q_subtract_reference_salted": query(COUNTED.format("subtracted"), "subtracted"),
        "q_subtract_first_reference": query(
            COUNTED.format(
                """(SELECT m.event_id, m.cat, m.id, m.value - t.value AS value, m.edge
FROM mapped m LEFT JOIN (SELECT event_id, dev, fp, det, geo, min(value) AS value FROM tref
                         GROUP BY event_id, dev, fp, det, geo) t
  ON m.event_id = t.event_id AND m.dev = t.dev AND m.fp = t.fp AND m.det = t.det AND m.geo = t.geo) s"""
            ),
            "mapped",
            "tref",
        ),
        "q_subtract_by_id": query(
            """SELECT m.event_id, m.id, m.value - t.value AS value, m.edge, count(*) AS n
FROM mapped m LEFT JOIN (SELECT event_id, value FROM tref WHERE geo = 1) t USING (event_id)
GROUP BY 1, 2, 3, 4""",
            "mapped",
            "tref",
        ),
        "q_validate_flip": query(COUNTED.format("flipped"), "flipped"),
        "q_pair_edges": query("SELECT * FROM pairs", "pairs"),
        "q_pair_edges_cells": query("SELECT * FROM pairs", "pairs"),
        "q_category_totals": query(
            "SELECT cat, count(*) AS n, round(sum(charge), 4) AS total_charge FROM pulses GROUP BY cat",
            "pulses",
        ),
        "q_to_float_mid": query("SELECT * FROM pulses", "pulses"),
        "q_to_float_bounds": query(
            "SELECT count(*) AS n, count(*) AS hash_inside, count(*) AS rand_inside FROM pairs", "pairs"
        ),
        "q_linear_calib": """SELECT l_orderkey, l_linenumber, l_suppkey AS id,
       round(p0 + p1 * l_extendedprice, 6) AS charge
FROM lineitem LEFT JOIN (SELECT s_suppkey, s_acctbal / 1000 AS p0, 1 + s_nationkey / 100.0::DOUBLE AS p1
                         FROM supplier WHERE s_acctbal > 0) s ON s_suppkey = l_suppkey""",
        "q_linear_calib_array": """SELECT l_orderkey, l_linenumber, l_suppkey AS id,
       CAST(i AS INTEGER) AS pos,
       round(p0 + p1 * CASE i WHEN 0 THEN l_extendedprice WHEN 1 THEN l_quantity ELSE l_tax END, 6)
         AS charge
FROM lineitem CROSS JOIN (VALUES (0), (1), (2)) AS k(i)
LEFT JOIN (SELECT s_suppkey, s_acctbal / 1000 AS p0, 1 + s_nationkey / 100.0::DOUBLE AS p1
      FROM supplier WHERE s_acctbal > 0) s ON s_suppkey = l_suppkey""",
        "q_interpolate": query(
            f"SELECT event_id, cat, {r6('(c0 - c1) / (c0 + c1)')} AS c0c1, {r6('conv')} AS conv FROM shared",
            "shared",
        ),
        "q_interpolate_curves": f"""WITH p AS ({curve_points}),
seg AS (SELECT tab, x AS x0, y AS y0, lead(x) OVER (PARTITION BY tab ORDER BY x) AS x1,
               lead(y) OVER (PARTITION BY tab ORDER BY x) AS y1 FROM p),
lim AS (SELECT tab, min(x) AS low, max(x) AS high, arg_min(y, x) AS ylow, arg_max(y, x) AS yhigh
        FROM p GROUP BY tab),
v AS (SELECT l_orderkey, l_linenumber, l_partkey, concat('Brand#', 1 + l_partkey % 26) AS tab,
             l_extendedprice / 50 + 10 AS x FROM lineitem)
SELECT v.l_orderkey, v.l_linenumber, v.l_partkey, round(v.x, 6) AS x,
       {r6('''CASE WHEN v.x <= low THEN ylow WHEN v.x >= high THEN yhigh
                   ELSE y0 + (y1 - y0) / (x1 - x0) * (v.x - x0) END''')} AS y
FROM v LEFT JOIN lim ON lim.tab = v.tab
ASOF LEFT JOIN seg s ON s.tab = v.tab AND s.x0 <= v.x""",
        "q_top2": query(
            f"SELECT event_id, cat, {r6('c0')} AS c0, {r6('c1')} AS c1, id0, id1 FROM top2", "top2"
        ),
        "q_strip_position": query(
            f"SELECT event_id, {r6('pos')} AS pos, {r6('conv')} AS c0c1_conv FROM positions "
            "WHERE cat = 'p0x'",
            "positions",
        ),
        "q_distinct_events": query("SELECT * FROM events_seen", "events_seen"),
        "q_collect_planes": query(
            """SELECT event_id, max(CASE WHEN cat = 'p0a' THEN timings END) AS a_timing,
       max(CASE WHEN cat = 'p0a' THEN charges END) AS a_charge,
       max(CASE WHEN cat = 'p1x' THEN ids END) AS x_id,
       max(CASE WHEN cat = 'p1x' THEN timings END) AS x_timing
FROM lists WHERE cat IN ('p0a', 'p1x') GROUP BY event_id""",
            "lists",
        ),
        "q_assemble": query(
            f"""SELECT e.event_id, {r6('x.c0')} AS x_c0, {r6('y.c0')} AS y_c0
FROM events_seen e JOIN top2 x ON x.event_id = e.event_id AND x.cat = 'p0x'
LEFT JOIN top2 y ON y.event_id = e.event_id AND y.cat = 'p0y'""",
            "top2",
            "events_seen",
        ),
        "q_strip_full": STRIP_FULL,
        "q_strip_full_spread": STRIP_FULL,
        "q_strip_batch": STRIP_FULL,
        "q_strip_local": STRIP_FULL,
        "q_strip_local_short": strip_short("INNER"),
        "q_strip_short": strip_short("LEFT"),
        "q_strip_require": strip_short("INNER"),
        "q_two_sided": two_sided_rows("pulses", "-2000", "2000", False, "pulses"),
        "q_two_sided_compat": two_sided_rows("pulses", "-2000", "2000", True, "pulses"),
        "q_two_sided_full": two_sided_event(True, False),
        "q_two_sided_short": two_sided_event(False, False),
        "q_two_sided_require": two_sided_event(False, True),
        "q_two_sided_spread": two_sided_event(True, False),
        "q_two_sided_local": two_sided_event(True, False),
        "q_wire": _wire(False),
        "q_wire_local": _wire(False),
        "q_wire_spread": _wire(False),
        "q_wire_by_id": _wire(True),
        "q_wire_chunks": _wire(False, 2),
        "q_wire_chunks_spread": _wire(False, 2),
        "q_trigger": query(
            f"""SELECT e.event_id, arg_min(t.id, t.timing * 4096 + t.id) AS trig
FROM events_seen e LEFT JOIN {TRIGGER_HITS} t ON t.event_id = e.event_id GROUP BY e.event_id""",
            "valid",
            "events_seen",
        ),
        "q_trigger_full": query(
            f"""SELECT e.event_id, string_agg(CAST(t.id AS VARCHAR), ',' ORDER BY t.timing, t.id) AS trig_id,
       {micro_list('t.timing', 't.timing, t.id')} AS trig_timing,
       arg_min(t.id, t.timing * 4096 + t.id) AS trig
FROM events_seen e LEFT JOIN {TRIGGER_HITS} t ON t.event_id = e.event_id GROUP BY e.event_id""",
            "valid",
            "events_seen",
        ),
        "q_trigger_chunks": trigger_chunks,
        "q_trigger_chunks_spread": trigger_chunks,
        "q_histograms": f"""
SELECT 'price' AS hist, bin AS bin_x, NULL::BIGINT AS bin_y, center AS x, NULL::DOUBLE AS y, n
FROM ({hist1d("lineitem", "l_extendedprice", 0.0, 105000.0, 100, False, True)})
UNION ALL SELECT 'tax', bin, NULL, center, NULL, n FROM ({hist1d("lineitem", "l_tax", 0.0, 0.08, 9, True, False)})
UNION ALL SELECT 'both', bin_x, bin_y, x, y, n
FROM ({hist2d("lineitem", "l_quantity", "l_extendedprice", sales, (50, 42), False)})""",
        "q_histograms_array": f"""
SELECT 'charge' AS hist, bin AS bin_x, NULL::BIGINT AS bin_y, center AS x, NULL::DOUBLE AS y, n
FROM ({hist1d(plane, "charge", 0.0, 5000.0, 49, False, True, "pulses")})
UNION ALL SELECT 'timing', bin, NULL, center, NULL, n FROM ({hist1d(plane, "timing", 0.0, 9000.0, 60, True, False, "pulses")})
UNION ALL SELECT 'both', bin_x, bin_y, x, y, n
FROM ({hist2d(plane, "charge", "timing", edges, (39, 59), False, "pulses")})""",
        "q_hist1d": hist1d(pulse, "charge", 0.0, 5000.0, 49, False, True, "pulses"),
        "q_hist1d_sales": hist1d("lineitem", "l_extendedprice", *SALES_SPAN, 100, False, True),
        "q_hist1d_numpy": hist1d(pulse, "charge", 0.0, 5000.0, 50, True, False, "pulses"),
        "q_hist1d_array": hist1d(plane, "charge", 0.0, 5000.0, 49, False, False, "pulses"),
        "q_hist1d_array_numpy": hist1d(plane, "timing", 0.0, 9000.0, 60, True, False, "pulses"),
        "q_hist1d_stats": query(
            f"""SELECT count(*) AS entries, count(*) FILTER (bin = 0) AS underflow,
       count(*) FILTER (bin BETWEEN 1 AND 49) AS inside, count(*) FILTER (bin = 50) AS overflow
FROM (SELECT {stats_bin} AS bin FROM pulses) b""",
            "pulses",
        ),
        "q_hist2d": hist2d(pulse, "charge", "timing", edges, (39, 59), False, "pulses"),
        "q_hist2d_sales": hist2d(
            "lineitem", "l_quantity", "l_extendedprice", sales, (50, 42), False
        ),
        "q_hist2d_numpy": hist2d(pulse, "charge", "timing", edges, (40, 60), True, "pulses"),
        "q_hist2d_array": hist2d(plane, "charge", "timing", edges, (39, 59), False, "pulses"),
        "q_hist2d_array_numpy": hist2d(plane, "charge", "timing", edges, (40, 60), True, "pulses"),
        "q_hist2d_dense": query(
            f"""SELECT x.range AS bin_x, y.range AS bin_y, count(v.bin_x) AS n
FROM range(1, 20) x CROSS JOIN range(1, 30) y
LEFT JOIN (SELECT {bin_of('charge', 0.0, 5000.0, 19)} AS bin_x,
                  {bin_of('timing', -500.0, 9500.0, 29)} AS bin_y FROM pulses) v
  ON v.bin_x = x.range AND v.bin_y = y.range
GROUP BY x.range, y.range""",
            "pulses",
        ),
        "q_hist2d_stats": query(
            f"""SELECT CAST(x.range AS INTEGER) AS zone_x, CAST(y.range AS INTEGER) AS zone_y,
       count(v.zx) AS n
FROM range(0, 3) x CROSS JOIN range(0, 3) y
LEFT JOIN (SELECT {zone_x} AS zx, {zone_y} AS zy FROM pulses) v
  ON v.zx = x.range AND v.zy = y.range
GROUP BY x.range, y.range""",
            "pulses",
        ),
        "q_zip_arrays": query(
            f"SELECT {r6('charge')} AS charge, {r6('timing')} AS timing FROM pulses WHERE cat = 'p0x'",
            "pulses",
        ),
        "q_offset_summary": """SELECT event_type AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
       max(event_id // 4) + 1 AS end_offset,
       (SELECT max(event_id // 4) + 1 FROM events WHERE event_type = 'click') AS latest_offset
FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
        "q_capture": f"""{decoded} FROM (SELECT * FROM events
WHERE event_id % 4 = 0 AND event_id // 4 >= 20 AND event_type <> 'error' ORDER BY event_id LIMIT 100) e""",
        "q_decode_first": f"{decoded} FROM events WHERE event_type <> 'error'",
        "q_decode_all": query("SELECT * FROM hits", "hits"),
        "q_kafka_rows": query(
            "SELECT CAST(event_id AS VARCHAR) AS key, event_id, cat, id, charge, timing FROM pairs",
            "pairs",
        ),
        "q_stream_strip": STREAM_FULL,
        "q_stream_dedup": STREAM_FULL,
        "q_stream_local": STREAM_FULL,
        "q_stream_local_dedup": STREAM_FULL,
        "q_decode_batches": query(
            "SELECT event_id, dev, fp, det, geo, ch, value, edge, event_id % 7 AS runnumber FROM hits", "hits"
        ),
        "q_to_float_hash": query(
            """SELECT event_id, cat, id, charge, timing, CAST(floor(charge) AS BIGINT) AS channel FROM pairs""",
            "pairs",
        ),
    }
