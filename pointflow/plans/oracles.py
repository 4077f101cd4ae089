"""The same results as ANSI SQL over the same tables, for another engine to compute.

The texts share nothing with the library but the query parameters. Rounds of an
iteration are unrolled, one set of common table expressions per round.
"""

from __future__ import annotations

from pointflow.plans import bindings as b

SEED = 42
K = len(b.CENTERS)


def _num(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


POINTS = """points AS (
    SELECT l_quantity AS x, l_discount * 100 AS y, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp,
           l_linestatus, l_suppkey, l_returnflag
    FROM lineitem)"""


def _center_row(name: str, centers) -> str:
    cells = ", ".join(f"{_num(x)} AS x{i}, {_num(y)} AS y{i}" for i, (x, y) in enumerate(centers))
    return f"{name} AS (SELECT {cells})"


def _assign(name: str, centers: str, k: int = K) -> str:
    """Distances to a one-row table of centers; the lowest index wins ties."""
    d = ", ".join(
        f"(p.x - c.x{i}) * (p.x - c.x{i}) + (p.y - c.y{i}) * (p.y - c.y{i}) AS d{i}" for i in range(k)
    )
    low = "least(" + ", ".join(f"d{i}" for i in range(k)) + ")"
    case = " ".join(f"WHEN d{i} = dist2 THEN {i}" for i in range(k))
    return f"""{name} AS (
    SELECT *, CASE {case} END AS k
    FROM (SELECT *, {low} AS dist2 FROM (SELECT p.*, {d} FROM points p, {centers} c)))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ASSIGNED = (POINTS, _center_row("c0", b.CENTERS), _assign("near", "c0"))


def _pivot(name: str, source: str, previous: str) -> str:
    """K rows of centers as one row; a cluster that is missing keeps its center."""
    cells = ", ".join(
        f"coalesce((SELECT x FROM {source} WHERE k = {i}), {previous}.x{i}) AS x{i}, "
        f"coalesce((SELECT y FROM {source} WHERE k = {i}), {previous}.y{i}) AS y{i}"
        for i in range(K)
    )
    return f"{name} AS (SELECT {cells} FROM {previous})"


def _unpivot(centers: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS k, round(x{i}, 6) AS x, round(y{i}, 6) AS y FROM {centers}" for i in range(K)
    )


def _lloyd(rounds: int, tag: str = "l") -> list[str]:
    ctes = []
    for r in range(rounds):
        old = "c0" if r == 0 else f"{tag}c{r}"
        ctes += [
            _assign(f"{tag}a{r}", old),
            f"{tag}m{r} AS (SELECT k, avg(x) AS x, avg(y) AS y FROM {tag}a{r} GROUP BY k)",
            _pivot(f"{tag}c{r + 1}", f"{tag}m{r}", old),
        ]
    return ctes


def _lloyd_rows(segment: str, shift: str, rounds: int) -> str:
    """Rounds of a model per segment, centers being rows."""
    start = ", ".join(f"({i}, {_num(x)}, {_num(y)})" for i, (x, y) in enumerate(b.CENTERS))
    ctes = [
        f"p AS MATERIALIZED (SELECT row_number() OVER () AS id, {segment} AS segment, l_quantity AS x, "
        "l_discount * 100 AS y FROM lineitem)",
        f"c0 AS MATERIALIZED (SELECT segment, k, x + {shift} AS x, y FROM (SELECT DISTINCT segment FROM p), "
        f"(VALUES {start}) AS v(k, x, y))",
    ]
    for r in range(rounds):
        ctes += [
            f"a{r} AS MATERIALIZED (SELECT any_value(p.segment) AS segment, any_value(p.x) AS x, any_value(p.y) AS y, "
            "min({'d': (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y), 'k': c.k}).k AS k "
            f"FROM p JOIN c{r} c ON c.segment = p.segment GROUP BY p.id)",
            f"m{r} AS MATERIALIZED (SELECT segment, k, avg(x) AS x, avg(y) AS y FROM a{r} GROUP BY ALL)",
            f"c{r + 1} AS MATERIALIZED (SELECT c.segment, c.k, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y "
            f"FROM c{r} c LEFT JOIN m{r} m ON m.segment = c.segment AND m.k = c.k)",
        ]
    return _with(*ctes)


def _group_means(name: str, near: str, by: str = "") -> str:
    """Sizes and means per cluster and group, side by side; `by` is a leading column list."""
    cells = ", ".join(
        f"count(*) FILTER (WHERE grp = {g}) AS n_{s}, "
        f"avg(x) FILTER (WHERE grp = {g}) AS {s}_x, avg(y) FILTER (WHERE grp = {g}) AS {s}_y"
        for g, s in ((0, "a"), (1, "b"))
    )
    return f"{name} AS (SELECT {by} k, {cells} FROM {near} GROUP BY {by} k)"


def _stats(name: str, means: str, near: str, by: str = "") -> list[str]:
    """Shares, filled means, gap and scatter with all points counted."""
    on = "m.k = p.k" + (" AND m.segment = p.segment" if by else "")
    over = "OVER (PARTITION BY segment)" if by else "OVER ()"
    join_fixed = "USING (segment)" if by else "ON true"
    return [
        f"""{name}_fixed AS (
    SELECT {by.replace('segment', 'p.segment')}
           coalesce(sum((p.x - m.a_x) * (p.x - m.a_x) + (p.y - m.a_y) * (p.y - m.a_y)) FILTER (WHERE grp = 0)
                    / nullif(count(*) FILTER (WHERE grp = 0), 0), 0) AS fixed_a,
           coalesce(sum((p.x - m.b_x) * (p.x - m.b_x) + (p.y - m.b_y) * (p.y - m.b_y)) FILTER (WHERE grp = 1)
                    / nullif(count(*) FILTER (WHERE grp = 1), 0), 0) AS fixed_b
    FROM {near} p JOIN {means} m ON {on} {"GROUP BY p.segment" if by else ""})""",
        f"""{name} AS (
    SELECT *, sqrt((a_x - b_x) * (a_x - b_x) + (a_y - b_y) * (a_y - b_y)) AS ell
    FROM (SELECT {by} k, n_a, n_b, fixed_a, fixed_b,
                 coalesce(n_a / nullif(sum(n_a) {over}, 0), 0) AS alpha,
                 coalesce(n_b / nullif(sum(n_b) {over}, 0), 0) AS beta,
                 coalesce(a_x, b_x) AS a_x, coalesce(a_y, b_y) AS a_y, coalesce(b_x, a_x) AS b_x, coalesce(b_y, a_y) AS b_y
          FROM {means} JOIN {name}_fixed {join_fixed}))""",
    ]


def _search(name: str, stats: str, by: str = "") -> list[str]:
    """Ten halving steps on gamma over one row of lists per model; x belongs to the last gamma but one move."""
    heavy = "(g * a[i] + (1 - g) * b[i])"
    x = (
        "list_transform(range(1, len(a) + 1), lambda i: "
        f"CASE WHEN {heavy} = 0 THEN 0 ELSE (1 - g) * b[i] * l[i] / {heavy} END)"
    )
    cost_a = "fixed_a + list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * x[i] * x[i]))"
    cost_b = "fixed_b + list_sum(list_transform(range(1, len(a) + 1), lambda i: b[i] * (l[i] - x[i]) * (l[i] - x[i])))"
    columns = (("k", "ks"), ("alpha", "a"), ("beta", "b"), ("ell", "l"))
    lists = ", ".join(f"list({c} ORDER BY k) AS {s}" for c, s in columns)
    ctes = [
        f"{name}_1 AS (SELECT {by} any_value(fixed_a) AS fixed_a, any_value(fixed_b) AS fixed_b, {lists}, "
        f"CAST(0.5 AS DOUBLE) AS g FROM {stats} {'GROUP BY segment' if by else ''})"
    ]
    for t in range(1, 10):
        power = _num(0.5 ** (t + 1))
        ctes.append(f"""{name}_{t + 1} AS (
    SELECT {by} fixed_a, fixed_b, ks, a, b, l,
           CASE WHEN abs(cost_a - cost_b) <= 1e-12 * greatest(cost_a, cost_b) THEN g
                WHEN cost_a > cost_b THEN g + {power} ELSE g - {power} END AS g
    FROM (SELECT *, {cost_a} AS cost_a, {cost_b} AS cost_b FROM (SELECT *, {x} AS x FROM {name}_{t})))""")
    ctes.append(
        f"{name} AS (SELECT {by} unnest(ks) AS k, unnest(x) AS x FROM (SELECT *, {x} AS x FROM {name}_10))"
    )
    return ctes


def _blend(name: str, stats: str, search: str, by: str = "") -> str:
    cells = ", ".join(
        f"CASE WHEN ell = 0 THEN a_{d} ELSE (ell - f.x) / ell * a_{d} + f.x / ell * b_{d} END AS {d}" for d in "xy"
    )
    using = "(segment, k)" if by else "(k)"
    return f"{name} AS (SELECT {by} k, {cells} FROM {stats} JOIN {search} f USING {using})"


def _fair_lloyd(rounds: int, population: bool, tag: str = "f") -> list[str]:
    ctes = []
    for r in range(rounds):
        old = "c0" if r == 0 else f"{tag}c{r}"
        near, means, new = f"{tag}a{r}", f"{tag}m{r}", f"{tag}n{r}"
        ctes += [_assign(near, old), _group_means(means, near)]
        if population:
            ctes += _stats(f"{tag}s{r}", means, near)
            ctes += _search(f"{tag}x{r}", f"{tag}s{r}")
            ctes.append(_blend(new, f"{tag}s{r}", f"{tag}x{r}"))
        else:
            # one mean per group and cluster: the midpoint, or the only one there is
            ctes.append(
                f"{new} AS (SELECT k, (coalesce(a_x, b_x) + coalesce(b_x, a_x)) / 2 AS x, "
                f"(coalesce(a_y, b_y) + coalesce(b_y, a_y)) / 2 AS y FROM {means})"
            )
        ctes.append(_pivot(f"{tag}c{r + 1}", new, old))
    return ctes


_TOTALS = """count(*) AS n, count(*) FILTER (WHERE grp = 0) AS n_a, count(*) FILTER (WHERE grp = 1) AS n_b,
       avg(dist2) AS delta, avg(dist2) FILTER (WHERE grp = 0) AS phi_a, avg(dist2) FILTER (WHERE grp = 1) AS phi_b"""
_OBJECTIVES = """round(delta, 6) AS delta, round(phi_a, 6) AS phi_a, round(phi_b, 6) AS phi_b,
       CASE WHEN phi_a IS NOT NULL AND phi_b IS NOT NULL THEN round(greatest(phi_a, phi_b), 6) END AS phi"""


def _report(segment: bool) -> str:
    seg = "l_linestatus AS segment, " if segment else ""
    head = "segment, " if segment else ""
    group = "GROUP BY l_linestatus" if segment else ""
    centers = ", ".join(f"({i}, {_num(x)}, {_num(y)})" for i, (x, y) in enumerate(b.CENTERS))
    match = "c.k = p.k" + (" AND t.segment = p.segment" if segment else "")
    return _with(
        *ASSIGNED,
        f"totals AS (SELECT {seg}{_TOTALS} FROM near {group})",
        f"""per AS (SELECT {seg}k, count(*) FILTER (WHERE grp = 0) AS n_a_k, count(*) FILTER (WHERE grp = 1) AS n_b_k
           FROM near GROUP BY ALL)""",
        f"centers(k, x, y) AS (VALUES {centers})",
    ) + f"""SELECT {'t.segment, ' if segment else ''}c.k, c.x, c.y, coalesce(n_a_k, 0) AS n_a_k, coalesce(n_b_k, 0) AS n_b_k,
       n, n_a, n_b, {_OBJECTIVES}
FROM totals t JOIN centers c ON true LEFT JOIN per p ON {match}"""


_SEGMENT = (
    POINTS,
    _center_row("c0", b.CENTERS),
    _assign("near0", "c0"),
    "near AS (SELECT *, l_suppkey AS segment FROM near0)",
    _group_means("means", "near", "segment,"),
    *_stats("stats", "means", "near", "segment,"),
)
_SEGMENT_SEARCH = (*_SEGMENT, *_search("found", "stats", "segment,"))
_ONE = (*ASSIGNED, _group_means("means", "near"), *_stats("stats", "means", "near"))

LINES = "concat_ws(',', CAST(l_quantity AS VARCHAR), CAST(l_discount AS VARCHAR), l_returnflag)"

WIDE = f"""centers AS (
    SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS k, c
    FROM (SELECT label, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS c FROM embeddings GROUP BY label)),
pairs AS (
    SELECT vec_id, label, k, e,
           list_sum(list_transform(range(1, {b.WIDE_DIMS + 1}), lambda j: (e[j] - c[j]) * (e[j] - c[j]))) AS dist2
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), centers),
near AS (
    SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist2, k) = 1)"""

DOC_LINES = """lines AS (
    SELECT doc_id, unnest(string_split("text", chr(10))) AS "value",
           CAST(generate_subscripts(string_split("text", chr(10)), 1) - 1 AS INTEGER) AS line
    FROM documents),
tokens AS (
    SELECT doc_id, line, CASE WHEN "value" = '' THEN [''] WHEN rtrim("value") = '' THEN []
                              ELSE string_split(rtrim("value"), ' ') END AS t
    FROM lines),
words AS (SELECT doc_id, line, unnest(t) AS word FROM tokens)"""
WORD_COUNT = _with(DOC_LINES) + "SELECT word, count(*) AS cnt FROM words GROUP BY word"

DAY = f"CAST(floor(epoch_us(ts) / {b.DAY_SECONDS * 1_000_000}) AS BIGINT)"
DAYS = f"items AS (SELECT {DAY} AS batch, user_id AS item FROM events)"
SIZES = """sizes AS (SELECT batch, count(*) AS n FROM items GROUP BY batch),
running AS (
    SELECT batch, n, CAST(coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                          AS BIGINT) AS n_before
    FROM sizes)"""
SUMMARY = "SELECT count(*) AS processed, count(DISTINCT item) AS n_distinct, max(item) AS largest"


LIVE = f"live AS (SELECT count(*) AS n, greatest(1, ceil(count(*) / {b.LIVE_SLICES}::DOUBLE))::BIGINT AS step FROM events)"


MANY = """o AS (
    SELECT o_orderkey, o_totalprice / 1000 AS x, o_custkey / 10 AS y, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS grp FROM orders),
c AS (SELECT p_partkey AS k, p_retailprice / 4 - 200 AS cx, p_size * 3.0::DOUBLE AS cy FROM part),
near AS (
    SELECT o_orderkey, any_value(grp) AS grp, min({'d': (x - cx) * (x - cx) + (y - cy) * (y - cy), 'k': k}) AS m
    FROM o, c GROUP BY o_orderkey)"""


def _unit(stream: str, ident: str, start: int) -> str:
    digest = f"md5('{SEED}:{stream}:' || CAST({ident} AS VARCHAR))"
    return f"((CAST('0x' || substr({digest}, {start}, 12) AS BIGINT) + CAST(0.5 AS DOUBLE)) / {_num(2.0**48)})"


BLOB_LAYOUT = f"""total AS (SELECT count(*) AS n, count(*) // {b.BLOBS} AS small, count(*) % {b.BLOBS} AS longer FROM orders),
ids AS (SELECT unnest(range(n)) AS id, small, longer, longer * (small + 1) AS edge FROM total),
placed AS (
    SELECT id, CASE WHEN id < edge THEN small + 1 ELSE small END AS size,
           CASE WHEN id < edge THEN id // (small + 1) ELSE longer + (id - edge) // small END AS cluster,
           CASE WHEN id < edge THEN id % (small + 1) ELSE (id - edge) % small END AS place
    FROM ids),
layout AS (
    SELECT id, cluster, place < floor(size * CAST(0.8 AS DOUBLE)) AS major,
           CASE WHEN (cluster % 2 = 0) = (place < floor(size * CAST(0.8 AS DOUBLE))) THEN 'A' ELSE 'B' END AS label
    FROM placed)"""
GEN_BLOBS = _with(
    BLOB_LAYOUT,
    f"""draws AS (
    SELECT *, {_unit("center", "cluster", 1)} AS cu, {_unit("center", "cluster", 13)} AS cv,
           {_unit("point", "id", 1)} AS u, {_unit("point", "id", 13)} AS v, CASE WHEN major THEN 0 ELSE 5 END AS shift
    FROM layout)""",
) + """SELECT id, cluster, label,
       round(cu * 100 + shift + sqrt(-2 * ln(u)) * cos(2 * pi() * v) * 3, 3) AS x,
       round(cv * 100 + shift + sqrt(-2 * ln(u)) * sin(2 * pi() * v) * 3, 3) AS y
FROM draws"""

_XY = "round(x, 6) AS x, round(y, 6) AS y"

# the seven places of the far points, in order
FAR_CENTERS = """SELECT CAST(row_number() OVER (ORDER BY l_linenumber) - 1 AS INTEGER) AS k,
       l_linenumber * 1000.0::DOUBLE AS x, l_linenumber * l_linenumber * 100.0::DOUBLE AS y
FROM (SELECT DISTINCT l_linenumber FROM lineitem)"""

ORACLES: dict[str, str] = {
    "scan_lines": f'SELECT {LINES} AS "value" FROM lineitem',
    "parse_points": """SELECT l_quantity AS x, l_discount AS y, l_tax AS z, l_returnflag AS label,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp FROM lineitem""",
    "parse_points_2d": """SELECT l_quantity AS x, l_discount AS y,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp FROM lineitem""",
    "split_groups": """WITH lines AS (SELECT replace(l_returnflag, 'N', 'B') AS v, l_quantity AS x, l_discount AS y FROM lineitem),
parts AS (SELECT 'U' AS part, x, y FROM lines UNION ALL SELECT 'A', x, y FROM lines WHERE v LIKE '%A'
          UNION ALL SELECT 'B', x, y FROM lines WHERE v LIKE '%B')
SELECT part, count(*) AS n, round(sum(x), 4) AS sum_x, round(sum(y), 4) AS sum_y FROM parts GROUP BY part""",
    "repartition_load": f"""SELECT count(*) AS n_rows, CAST(sum(length({LINES})) AS BIGINT) AS n_chars,
       CAST(8 AS BIGINT) AS n_parts FROM lineitem""",
    "gen_blobs": GEN_BLOBS,
    "gen_blob_sizes": _with(BLOB_LAYOUT) + "SELECT cluster, label, count(*) AS n FROM layout GROUP BY cluster, label",
    "points_csv_roundtrip": """SELECT round(l_quantity, 3) AS x, round(l_discount * 100, 3) AS y, l_returnflag AS label,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp FROM lineitem""",
    "sample_head": "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 10",
    "encode_group": """SELECT l_returnflag AS label, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp, count(*) AS n
FROM lineitem GROUP BY l_returnflag""",
    "filter_suffix": f"""SELECT {LINES} AS "value" FROM lineitem WHERE l_returnflag LIKE '%A'""",
    "group_counts": """SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag LIKE '%A') AS n_a_suffix,
       count(*) FILTER (WHERE l_returnflag NOT LIKE '%A') AS n_b_suffix,
       count(*) FILTER (WHERE l_returnflag = 'A') AS n_a_label FROM lineitem""",
    "assign_nearest": _with(*ASSIGNED) + f"SELECT {_XY}, grp, k, round(dist2, 6) AS dist2 FROM near",
    "assign_nearest_wide": f"WITH {WIDE}\nSELECT vec_id, k, round(dist2, 6) AS dist2 FROM near",
    "nearest_index": _with(*ASSIGNED) + f"SELECT {_XY}, k FROM near",
    "nearest_dist2": _with(*ASSIGNED) + f"SELECT {_XY}, round(dist2, 6) AS dist2 FROM near",
    "standard_objective": _with(*ASSIGNED) + "SELECT round(avg(dist2), 6) AS delta FROM near",
    "fair_objective": _with(*ASSIGNED, f"t AS (SELECT {_TOTALS} FROM near)")
    + f"SELECT phi_a, phi_b, phi FROM (SELECT {_OBJECTIVES} FROM t)",
    "cluster_group_counts": _with(*ASSIGNED)
    + f"""SELECT c.k, count(*) FILTER (WHERE grp = 0) AS n_a, count(*) FILTER (WHERE grp = 1) AS n_b
FROM (SELECT CAST(unnest(range({K + 1})) AS INTEGER) AS k) c LEFT JOIN near ON near.k = c.k GROUP BY c.k""",
    "cluster_report": _report(False),
    "cluster_report_by_segment": _report(True),
    "cluster_group_sums": _with(*ASSIGNED)
    + """SELECT k, grp, count(*) AS n, round(sum(x), 4) AS sum_x, round(sum(y), 4) AS sum_y, round(sum(dist2), 4) AS ss
FROM near GROUP BY k, grp""",
    "cluster_group_means": _with(*ASSIGNED)
    + "SELECT k, grp, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM near GROUP BY k, grp",
    "cluster_group_means_wide": f"""WITH {WIDE},
cells AS (
    SELECT k, CASE WHEN label < 5 THEN 0 ELSE 1 END AS grp, CAST(unnest(range({b.WIDE_DIMS})) AS INTEGER) AS j, unnest(e) AS v FROM near)
SELECT k, grp, j, count(*) AS n, round(avg(v), 6) AS mean FROM cells GROUP BY k, grp, j""",
    "mean_vector": _with(POINTS)
    + """SELECT l_linestatus AS segment, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y
FROM points GROUP BY l_linestatus""",
    "cluster_shares": _with(*_ONE) + "SELECT k, round(alpha, 6) AS alpha, round(beta, 6) AS beta FROM stats",
    "group_mean_gap": _with(*_ONE) + "SELECT k, round(ell, 6) AS ell FROM stats",
    "group_scatter": _with(*_ONE)
    + "SELECT round(fixed_a, 6) AS delta_a, round(fixed_b, 6) AS delta_b FROM stats_fixed",
    "group_scatter_offset": _with(POINTS)
    + f"""SELECT segment, strategy, round(delta_a, 6) AS delta_a, round(delta_b, 6) AS delta_b
FROM (SELECT l_linestatus AS segment, coalesce(var_pop(x + {_num(b.OFFSET)}) FILTER (WHERE grp = 0) + var_pop(y + {_num(b.OFFSET)}) FILTER (WHERE grp = 0), 0) AS delta_a,
             coalesce(var_pop(x + {_num(b.OFFSET)}) FILTER (WHERE grp = 1) + var_pop(y + {_num(b.OFFSET)}) FILTER (WHERE grp = 1), 0) AS delta_b
      FROM points GROUP BY l_linestatus), (SELECT unnest(['unrolled', 'arrow']) AS strategy)""",
    "lloyd_rounds": _with(POINTS, _center_row("c0", b.CENTERS), *_lloyd(b.LLOYD_ROUNDS))
    + _unpivot(f"lc{b.LLOYD_ROUNDS}"),
    "lloyd_bounded": _lloyd_rows("0", "0", b.BOUNDED_ROUNDS)
    + f"SELECT k, round(x, 6) AS x, round(y, 6) AS y FROM c{b.BOUNDED_ROUNDS}",
    "lloyd_by_segment": _lloyd_rows("l_suppkey", "(segment % 7) / 4.0::DOUBLE", b.LLOYD_ROUNDS)
    + f"SELECT segment, k, round(x, 6) AS x, round(y, 6) AS y FROM c{b.LLOYD_ROUNDS}",
    "fair_stats": _with(*_SEGMENT)
    + """SELECT segment, k, n_a, n_b, round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(ell, 6) AS ell,
       round(a_x, 6) AS a_x, round(a_y, 6) AS a_y, round(b_x, 6) AS b_x, round(b_y, 6) AS b_y FROM stats""",
    "fair_line_search": _with(*_SEGMENT_SEARCH) + "SELECT segment, k, round(x, 6) AS x FROM found",
    "fair_centroids": _with(*_SEGMENT_SEARCH, _blend("chosen", "stats", "found", "segment,"))
    + f"SELECT segment, k, {_XY} FROM chosen",
    "fair_lloyd": _with(POINTS, _center_row("c0", b.CENTERS), *_fair_lloyd(b.FAIR_ROUNDS, False))
    + _unpivot(f"fc{b.FAIR_ROUNDS}"),
    "fair_lloyd_population": _with(POINTS, _center_row("c0", b.CENTERS), *_fair_lloyd(b.FAIR_ROUNDS, True))
    + _unpivot(f"fc{b.FAIR_ROUNDS}"),
    "fair_report": _with(
        POINTS,
        _center_row("c0", b.CENTERS),
        *_lloyd(b.FAIR_ROUNDS),
        *_fair_lloyd(b.FAIR_ROUNDS, False),
        _assign("near_s", f"lc{b.FAIR_ROUNDS}"),
        _assign("near_f", f"fc{b.FAIR_ROUNDS}"),
        f"t AS (SELECT 'standard' AS model, {_TOTALS} FROM near_s UNION ALL SELECT 'fair', {_TOTALS} FROM near_f)",
    )
    + f"SELECT model, n, n_a, n_b, {_OBJECTIVES} FROM t",
    "sqdist": """WITH d AS (
    SELECT l_orderkey, (l_quantity - l_linenumber) * (l_quantity - l_linenumber)
           + (l_discount * 100 - l_tax * 100) * (l_discount * 100 - l_tax * 100) AS d2 FROM lineitem)
SELECT l_orderkey, round(d2, 6) AS d2, round(sqrt(d2), 6) AS d FROM d""",
    "vector_add_scale": """WITH p AS (SELECT l_orderkey, l_quantity AS x, l_discount * 100 AS y, l_tax * 10 AS t FROM lineitem)
SELECT l_orderkey, round(x + 1.5, 6) AS total_x, round(y - 2, 6) AS total_y, round(x * t, 6) AS scaled_x,
       round(y * t, 6) AS scaled_y, round((2 - t) / 2 * x + t / 2 * 1.5, 6) AS blended_x,
       round((2 - t) / 2 * y - t / 2 * 2, 6) AS blended_y, round(x, 6) AS same_x, round(y, 6) AS same_y FROM p""",
    "tokenize": _with(DOC_LINES)
    + "SELECT doc_id, line, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, '|') AS joined FROM tokens",
    "word_count": WORD_COUNT,
    "word_count_salted": WORD_COUNT,
    "word_count_salted_groupby": WORD_COUNT,
    "word_count_salted_hot": WORD_COUNT,
    "word_count_by_partition": WORD_COUNT,
    "doc_word_count": _with(DOC_LINES)
    + "SELECT doc_id, line, word, count(*) AS cnt FROM words GROUP BY doc_id, line, word",
    "distinct_words": _with(DOC_LINES) + "SELECT count(DISTINCT word) AS n_words FROM words",
    "avg_word_length": _with(DOC_LINES)
    + "SELECT round(avg(length(word)), 6) AS avg_length FROM (SELECT DISTINCT word FROM words)",
    "wordcount_summary": _with(DOC_LINES)
    + """SELECT (SELECT count(*) FROM lines) AS n_docs, (SELECT count(*) FROM words) AS n_tokens,
       count(*) AS n_words, round(avg(length(word)), 6) AS avg_length FROM (SELECT DISTINCT word FROM words)""",
    "word_length": _with(DOC_LINES)
    + """SELECT word, CAST(length(word) AS INTEGER) AS points,
       CAST(length(word) + length(regexp_replace(word, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS INTEGER) AS units
FROM (SELECT DISTINCT word FROM words)""",
    "parse_items": """SELECT event_id, CAST(v AS BIGINT) AS item
FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN ' ' ELSE '' END || CAST(user_id AS VARCHAR) AS v FROM events)
WHERE regexp_full_match(v, '[+-]?[0-9]+')""",
    "batch_distinct": _with(DAYS) + "SELECT DISTINCT batch, item FROM items",
    "batch_sizes": _with(DAYS, SIZES) + "SELECT batch, n, n_before FROM running",
    "distinct_union": "SELECT user_id AS item FROM events UNION SELECT o_custkey FROM orders",
    "largest_item": "SELECT user_id AS item FROM events ORDER BY user_id DESC LIMIT 1",
    "stream_summary": _with(DAYS) + f"{SUMMARY} FROM items",
    "stream_threshold_replay": _with(DAYS, SIZES)
    + f"{SUMMARY} FROM items WHERE batch IN (SELECT batch FROM running WHERE n_before < {b.THRESHOLD})",
    "stream_threshold_batches": _with(DAYS, SIZES)
    + f"{SUMMARY} FROM items WHERE batch IN (SELECT batch FROM running WHERE n_before < {b.THRESHOLD})",
    "stream_distinct": "SELECT DISTINCT user_id AS item FROM events",
    "stream_batches": _with(DAYS) + f"{SUMMARY} FROM items",
    "gen_blobs_shuffled": GEN_BLOBS,
    "points_csv_odd_labels": """SELECT round(l_quantity, 3) AS x, round(l_discount * 100, 3) AS y,
       CASE l_returnflag WHEN 'A' THEN ' A' WHEN 'N' THEN 'q"N ' ELSE l_returnflag END AS label, 1 AS grp FROM lineitem""",
    "assign_nearest_nullable": f"""WITH p AS (SELECT l_quantity AS x, l_discount * 100 AS y,
       CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS grp FROM lineitem WHERE l_orderkey % 10 <> 0 AND l_discount IS NOT NULL),
d AS (SELECT grp, [{", ".join(f"(x - {x}) * (x - {x}) + (y - {y}) * (y - {y})" for x, y in b.CENTERS)}] AS d FROM p)
SELECT CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS k, grp, count(*) AS n, round(sum(list_min(d)), 4) AS ss
FROM d GROUP BY 1, 2""",
    "kmeans_fit_far": FAR_CENTERS,
    "kmeans_init_far": FAR_CENTERS,
    "fair_lloyd_auto_far": FAR_CENTERS,
    "kmeans_fit_facts": """SELECT 12 AS k, CAST(count(DISTINCT l_linenumber) AS INTEGER) AS k_effective, count(*) AS n, 0.0::DOUBLE AS delta
FROM lineitem""",
    "assign_many_centers": f"WITH {MANY}\nSELECT o_orderkey, m.k AS k, round(m.d, 6) AS dist2 FROM near",
    "report_many_centers": f"""WITH {MANY},
near2 AS (SELECT m.k AS k, m.d AS dist2, grp FROM near),
t AS (SELECT {_TOTALS} FROM near2),
per AS (SELECT k, count(*) FILTER (WHERE grp = 0) AS n_a_k, count(*) FILTER (WHERE grp = 1) AS n_b_k FROM near2 GROUP BY k)
SELECT c.k, round(cx, 6) AS x, round(cy, 6) AS y, coalesce(n_a_k, 0) AS n_a_k, coalesce(n_b_k, 0) AS n_b_k,
       n, n_a, n_b, {_OBJECTIVES}
FROM c LEFT JOIN per ON per.k = c.k JOIN t ON true""",
    "stream_threshold_live": f"""WITH {LIVE}
SELECT least(n, ceil(taken / step::DOUBLE) * step)::BIGINT AS processed, ceil(taken / step::DOUBLE)::BIGINT AS n_batches
FROM (SELECT *, greatest(1, ceil(n / {b.LIVE_SHARE}::DOUBLE))::BIGINT AS taken FROM live)""",
    "stream_empty_batches": f"""WITH {LIVE},
slices AS (SELECT event_id // step AS batch_id, count(*) AS n FROM events, live GROUP BY ALL)
SELECT batch_id, n, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS seen,
       (SELECT count(*) FROM slices WHERE batch_id % 2 = 1) AS n_empty
FROM slices WHERE batch_id % 2 = 0""",
    "stream_batches_replayed": f"""WITH {LIVE}
SELECT count(*) AS processed, count(DISTINCT user_id) AS n_distinct, max(user_id) AS largest,
       ceil(any_value(n) / any_value(step)::DOUBLE)::BIGINT AS n_batches, 2 AS n_faults,
       ceil(any_value(n) / any_value(step)::DOUBLE)::BIGINT + 2 AS n_delivered
FROM events, live""",
    "stream_running_distinct": f"""WITH {LIVE},
firsts AS (SELECT min(event_id) // any_value(step) AS batch FROM events, live GROUP BY user_id)
SELECT batch, count(*) AS n_new, CAST(sum(count(*)) OVER (ORDER BY batch) AS BIGINT) AS n_distinct FROM firsts GROUP BY batch""",
}
