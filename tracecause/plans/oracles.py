"""The registered queries in SQL, for checking on another engine.

Written from the definitions, not from the plans: single-parent mechanisms by covariance over variance,
the two-parent one by Cramer's rule, Shapley values by summing over all coalitions, draws from md5.
"""

from __future__ import annotations

from hashlib import md5
from math import exp, factorial
from statistics import NormalDist

# Abramowitz & Stegun 26.2.17.
TAIL_P = 0.2316419
TAIL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

SPLIT = "DATE '1998-04-15'"

FACTS = """facts AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(n_lines AS DOUBLE) AS n_lines, qty, gross,
  disc, gross - disc AS net FROM (SELECT o_orderkey, o_orderdate, coalesce(n_lines, 0) AS n_lines, coalesce(qty, 0) AS qty,
  coalesce(gross, 0) AS gross, coalesce(disc, 0) AS disc FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
  sum(l_extendedprice) AS gross, sum(l_extendedprice * l_discount) AS disc FROM lineitem GROUP BY l_orderkey)
  ON o_orderkey = l_orderkey))"""
DAYS = FACTS + """, days AS (SELECT d, CASE WHEN month(d) IN (11, 12) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS peak,
  CAST(n_orders AS DOUBLE) AS n_orders, n_lines, qty, gross, disc, gross - disc AS net FROM (SELECT d,
  count(*) AS n_orders, sum(n_lines) AS n_lines, sum(qty) AS qty, sum(gross) AS gross, sum(disc) AS disc
  FROM facts GROUP BY d))"""
EDGES = """e AS (SELECT 'region:' || n_regionkey AS parent, 'nation:' || n_nationkey AS child FROM nation
  UNION SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
  UNION SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey FROM supplier
  UNION SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders
  UNION SELECT 'supplier:' || l_suppkey, 'order:' || l_orderkey FROM lineitem)"""

DAY_CHAIN = ["peak", "n_orders", "n_lines", "gross", "disc"]
ORDER_CHAIN = ["n_lines", "gross", "disc"]
DAY_ALL = ["peak", "n_orders", "n_lines", "qty", "gross", "disc", "net"]
ORDER_ALL = ["n_lines", "qty", "gross", "disc", "net"]


def normal_edges(bins: int) -> list[float]:
    return [round(NormalDist().inv_cdf(i / bins), 12) for i in range(1, bins)]


def tidy(x: str, zero: str = "1e-6", digits: int = 7) -> str:
    return f"CASE WHEN abs({x}) < {zero} THEN 0.0 ELSE CAST(printf('%.{digits - 1}e', {x}) AS DOUBLE) END"


def cols(names, zero: str = "1e-6", digits: int = 7, prefix: str = "") -> str:
    return ", ".join(f"{tidy(prefix + n, zero, digits)} AS {n}" for n in names)


def u(row: str, label: str, replicate: str = "'0'", seed: int = 0) -> str:
    text = f"CAST({row} AS VARCHAR) || ':{label}:' || {replicate} || ':{seed}'"
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496::DOUBLE)"


def pick(pool: str, uniform: str) -> str:
    return f"{pool}[CAST(floor({uniform} * len({pool})) AS BIGINT) + 1]"


def long(source: str, keys: str, nodes, zero: str = "1e-6", digits: int = 7, prefix: str = "", value: str = "score",
         label: str = "node") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys + ', ' if keys else ''}'{n}' AS {label}, {tidy(prefix + n, zero, digits)} AS {value} FROM {source}"
        for n in nodes)


def fits(source: str, chain, group: str = "", weight: str = "1.0::DOUBLE", name: str = "f", qty: bool = True) -> str:
    """One row of parameters per group: a_/b_ per chain node and qty, a_net/bd/bg for net, m_/v_ moments."""
    pairs = list(zip(chain, chain[1:])) + ([("n_lines", "qty")] if qty else [])
    use = list(dict.fromkeys(chain + (["qty"] if qty else []) + ["net"]))
    products = sorted({tuple(sorted(p)) for p in pairs} | {(n, n) for n in use}
                      | {tuple(sorted(p)) for p in (("disc", "gross"), ("disc", "net"), ("gross", "net"))})
    by = f"GROUP BY {group}" if group else ""
    lead = f"{group}, " if group else ""
    centre = ", ".join(f"avg({n}) AS c_{n}" for n in use)
    moved = ", ".join(f"{n} - c_{n} AS {n}" for n in use)
    sums = ", ".join([f"sum(w * {n}) / sum(w) AS s_{n}" for n in use]
                     + [f"sum(w * {a} * {b}) / sum(w) AS s_{a}_{b}" for a, b in products])

    def cov(a, b):
        a, b = sorted((a, b))
        return f"(s_{a}_{b} - s_{a} * s_{b})"

    means = ", ".join(f"c_{n} + s_{n} AS m_{n}" for n in use)
    slopes = ", ".join(f"{cov(x, y)} / {cov(x, x)} AS b_{y}" for x, y in pairs)
    det = f"({cov('disc', 'disc')} * {cov('gross', 'gross')} - power({cov('disc', 'gross')}, 2))"
    bd = f"({cov('net', 'disc')} * {cov('gross', 'gross')} - {cov('net', 'gross')} * {cov('disc', 'gross')}) / {det}"
    bg = f"({cov('net', 'gross')} * {cov('disc', 'disc')} - {cov('net', 'disc')} * {cov('disc', 'gross')}) / {det}"
    variances = ", ".join(f"{cov(n, n)} AS v_{n}" for n in use)
    levels = ", ".join(f"m_{y} - b_{y} * m_{x} AS a_{y}" for x, y in pairs)
    return (f"{name}_c AS (SELECT {centre} FROM {source}), "
            f"{name}_s AS (SELECT {lead}sum(w) AS n_w, {sums} FROM (SELECT {lead}{weight} AS w, {moved} "
            f"FROM {source}, {name}_c) {by}), "
            f"{name}_m AS (SELECT {lead}n_w, {means}, {slopes}, {bd} AS bd, {bg} AS bg, {variances} FROM {name}_s, {name}_c), "
            f"{name} AS (SELECT *, {levels}, m_net - bd * m_disc - bg * m_gross AS a_net FROM {name}_m)")


def residual(node: str, chain) -> str:
    if node == "qty":
        return "(qty - a_qty - b_qty * n_lines)"
    i = chain.index(node)
    return node if i == 0 else f"({node} - a_{node} - b_{node} * {chain[i - 1]})"


def effects(chain, source: str = "f", name: str = "w") -> str:
    """Total effects on net and the constant."""
    steps = [f"{name}_0 AS (SELECT *, bd AS w_disc, bg + bd * b_disc AS w_gross FROM {source})"]
    last = "gross"
    for i, n in enumerate(reversed(chain[:-2])):
        steps.append(f"{name}_{i + 1} AS (SELECT *, w_{last} * b_{last} AS w_{n} FROM {name}_{i})")
        last = n
    const = " + ".join(["a_net"] + [f"w_{n} * a_{n}" for n in chain[1:]])
    steps.append(f"{name} AS (SELECT *, {const} AS const FROM {name}_{len(chain) - 2})")
    return ", ".join(steps)


def pools(source: str, key: str, chain, extra=(), params: str = "f", name: str = "pool", group: str = "",
          raw: bool = False) -> str:
    """Noise lists of all rows in the order of their hash."""
    nodes = list(chain) + list(extra)
    part = f"PARTITION BY {group} " if group else ""
    text = f"CAST({key} AS VARCHAR)"
    join = f"JOIN {params} USING ({group})" if group else f", {params}"
    lists = ", ".join(f"list({n if raw else residual(n, chain)} ORDER BY pos) AS p_{n}" for n in nodes)
    lead = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return (f"{name}_r AS (SELECT *, row_number() OVER ({part}ORDER BY md5({text} || ':pool:0'), {text}) AS pos "
            f"FROM {source}), {name} AS (SELECT {lead}{lists} FROM {name}_r {join} {tail})")


def permuted(source: str, label: str, replicate: int = 0, seed: int = 0) -> str:
    """``(j, x)``: positions of ``source`` and their images under a keyed permutation."""
    prime, rounds = (1 << 31) - 1, 4
    sql = f"SELECT j, j AS x, n, a, n // a AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*))) AS BIGINT) AS a FROM {source}), (SELECT pos - 1 AS j FROM {source})"
    for half in range(2):
        sql = f"SELECT *, (x - {half} * (n - a * b)) % a AS l, (x - {half} * (n - a * b)) // a AS r FROM ({sql})"
        for i in range(rounds):
            digest = md5(f"{label}:{replicate}:{seed}:{half}:{i}".encode()).hexdigest()
            c, m1, m2 = (int(digest[8 * k:8 * k + 8], 16) % (prime - 1) + 1 for k in range(3))
            part, other, size = ("r", "l", "b") if i % 2 else ("l", "r", "a")
            sql = (f"SELECT * REPLACE (({part} + xor(t, t >> 15) * {m2} % {prime}) % {size} AS {part}) FROM "
                   f"(SELECT *, ({other} + {c}) * {m1} % {prime} AS t FROM ({sql}))").replace("SELECT * REPLACE", "SELECT * EXCLUDE (t) REPLACE")
        inside = f"x >= {half} * (n - a * b) AND x < {half} * (n - a * b) + a * b"
        sql = f"SELECT j, n, a, b, CASE WHEN {inside} THEN r * a + l + {half} * (n - a * b) ELSE x END AS x FROM ({sql})"
    return sql


def shapley(values: str, nodes, keys: str = "", value: str = "v", name: str = "phi") -> str:
    """Columns per node from rows (keys, s, value)."""
    k = len(nodes)
    weight = "CASE bit_count(s{0}) " + " ".join(
        f"WHEN {i} THEN {factorial(i) * factorial(k - i - 1)}::DOUBLE / {factorial(k)}" for i in range(k)) + " END"
    parts = []
    for j, n in enumerate(nodes):
        bit = 1 << j
        parts.append(f"sum(CASE WHEN s & {bit} > 0 THEN ({weight.format(f' - {bit}')}) * {value} "
                     f"ELSE -({weight.format('')}) * {value} END) AS {n}")
    lead, by = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"{name} AS (SELECT {lead}{', '.join(parts)} FROM {values} {by})"


def attribution(source: str, key: str, chain, draws: int, replicates: int | None = None) -> str:
    """CTEs up to ``phi`` for anomaly attribution of all rows of ``source``, per replicate if asked for."""
    nodes = chain + ["net"]
    rep = "CAST(r.replicate AS VARCHAR)" if replicates else "'0'"
    ref = "'ref' || CAST(r.replicate AS VARCHAR)" if replicates else "'ref0'"
    lead = "replicate, " if replicates else ""
    by = "replicate" if replicates else ""
    join = (lambda a: f"{a} JOIN w USING (replicate) JOIN pool USING (replicate)") if replicates else (
        lambda a: f"{a}, w, pool")
    base = (f"(SELECT * FROM range({draws}) AS x(i), range({replicates}) AS y(replicate)) AS r" if replicates
            else f"range({draws}) AS r(i)")
    out = []
    for name, label in (("nd", rep), ("rf", ref)):
        drawn = ", ".join(f"w_{n} * {pick('p_' + n, u('i', n, label))} AS {n}" for n in chain)
        out.append(f"{name} AS (SELECT {lead}i, const, {drawn}, 0.0::DOUBLE AS net FROM {join(base)})")
    total = " + ".join(["const"] + nodes)
    g = f"GROUP BY {by}" if by else ""
    out.append(f"ref AS (SELECT {lead}list(y ORDER BY y) AS ys, 1e-9 * stddev_samp(y) AS tie FROM "
               f"(SELECT {lead}{total} AS y FROM rf) {g})")
    own = ", ".join(f"w_{n} * {residual(n, chain)} AS {n}" for n in chain)
    rows = (f"{source} JOIN (SELECT * FROM w) AS w ON true" if replicates else f"{source}, w")
    out.append(f"obs AS (SELECT {lead}{key}, {source}.net AS y, const, {own}, 0.0::DOUBLE AS net FROM {rows})")
    link = "JOIN ref USING (replicate)" if replicates else ", ref"
    out.append(f"tails AS (SELECT obs.*, tie, ys, least(len(list_filter(ys, lambda v: v >= y - tie)), "
               f"len(list_filter(ys, lambda v: v <= y + tie))) AS t FROM obs {link})")
    out.append(f"ends AS (SELECT *, ys[least(t + 1, {draws})] - tie AS lo, ys[greatest({draws} - t, 1)] + tie AS hi "
               f"FROM tails)")
    size = 2 ** len(nodes)
    kept = " + ".join(["const"] + [f"CASE WHEN s & {1 << j} > 0 THEN 0.0 ELSE {n} END" for j, n in enumerate(nodes)])
    rand = " + ".join(f"CASE WHEN s & {1 << j} > 0 THEN {n} ELSE 0.0 END" for j, n in enumerate(nodes))
    out.append(f"cs AS (SELECT {lead}{key}, s, t, lo - ({kept}) AS lo, hi - ({kept}) AS hi FROM ends, "
               f"range(1, {size}) AS c(s))")
    out.append(f"rs AS (SELECT {lead}s, {rand} AS x FROM nd, range(1, {size}) AS c(s))")
    on = "s, replicate" if replicates else "s"
    out.append(f"hits AS (SELECT {lead}{key}, s, t, count(*) FILTER (WHERE t >= {draws} OR x < lo OR x > hi) AS h "
               f"FROM cs JOIN rs USING ({on}) GROUP BY ALL)")
    out.append(f"vals AS (SELECT {lead}{key}, s, -ln(greatest(h / {draws}::DOUBLE, 1.0 / {draws + 1}::DOUBLE)) AS v "
               f"FROM hits)")
    out.append(shapley("vals", nodes, f"{lead}{key}"))
    return ", ".join(out)


def mixes(chain, old: str, new: str, noise) -> str:
    """Nested SELECTs that evaluate nodes under coalition s; ``noise(node, side)`` gives SQL."""
    nodes = chain + ["net"]
    sql = "base"
    for j, n in enumerate(nodes):
        sides = []
        for side in (old, new):
            if j == 0:
                sides.append(noise(n, side))
            elif n == "net":
                sides.append(f"{side}.a_net + {side}.bd * disc + {side}.bg * gross")
            else:
                sides.append(f"{side}.a_{n} + {side}.b_{n} * {chain[j - 1]} + {noise(n, side)}")
        sql = (f"(SELECT *, CASE WHEN s & {1 << j} > 0 THEN {sides[1]} ELSE {sides[0]} END AS {n} FROM {sql} AS q{j})")
    return sql.replace(f"{old}.", f"{old}_").replace(f"{new}.", f"{new}_")


def side_params(chain, names=("fo", "fn")) -> str:
    """Select list that prefixes the parameters of both sides."""
    fields = [f"m_{chain[0]}"] + [f"{x}_{n}" for n in chain[1:] for x in "ab"] + ["a_net", "bd", "bg"]
    return ", ".join(f"{s}.{f} AS {s}_{f}" for s in names for f in fields)


def change_mean(source: str, chain, qty: bool = True) -> str:
    nodes = chain + ["net"]
    mixed = mixes(chain, "fo", "fn", lambda n, s: f"{s}.m_{n}" if n == chain[0] else "0.0")
    return (f"old AS (SELECT * FROM {source} WHERE d <= {SPLIT}), new AS (SELECT * FROM {source} WHERE d > {SPLIT}), "
            + fits("old", chain, name="fo", qty=qty) + ", " + fits("new", chain, name="fn", qty=qty)
            + f", base AS (SELECT s, {side_params(chain)} FROM fo, fn, range({2 ** len(nodes)}) AS c(s)), "
            + f"vals AS (SELECT s, net AS v FROM {mixed}), " + shapley("vals", nodes))


def change_drawn(source: str, key: str, chain, draws: int, aggregate: str = "", replicates: int = 1) -> str:
    """CTEs up to ``mixed`` (replicate, s, i, net): drawn targets under every mix."""
    nodes = chain + ["net"]
    e = ", ".join(f"{pick(f'p{s[-1]}.p_{n}', u('i', n, 'CAST(replicate AS VARCHAR)'))} AS {s}_e_{n}"
                  for n in chain for s in ("fo", "fn"))
    mixed = mixes(chain, "fo", "fn", lambda n, s: f"{s}.e_{n}")
    return (f"old AS (SELECT * FROM {source} WHERE d <= {SPLIT}), new AS (SELECT * FROM {source} WHERE d > {SPLIT}), "
            + fits("old", chain, name="fo") + ", " + fits("new", chain, name="fn") + ", "
            + pools("old", key, chain, params="fo", name="po") + ", " + pools("new", key, chain, params="fn", name="pn")
            + f", noise AS (SELECT replicate, i, {e}, {side_params(chain)} FROM fo, fn, po, pn, range({draws}) AS a(i), "
            + f"range({replicates}) AS b(replicate)), "
            + f"base AS (SELECT * FROM noise, range({2 ** len(nodes)}) AS c(s)), "
            + f"mixed AS (SELECT replicate, s, i, net FROM {mixed})")


def bin_of(x: str, mean: str, sd: str, bins: int = 16) -> str:
    return "(" + " + ".join(f"CAST({x} >= {mean} + {sd} * {e!r} AS INTEGER)" for e in normal_edges(bins)) + ")"


def kl(counts_a: str, counts_b: str, bins: int = 16) -> str:
    """KL over two lists of bin counts."""
    return (f"list_sum(list_transform(range({bins}), lambda i: ({counts_a}[i + 1] + 0.5) / (list_sum({counts_a}) + {bins / 2}) "
            f"* ln((({counts_a}[i + 1] + 0.5) / (list_sum({counts_a}) + {bins / 2})) / "
            f"(({counts_b}[i + 1] + 0.5) / (list_sum({counts_b}) + {bins / 2})))))")


def counts(x: str, bins: int = 16) -> str:
    return "[" + ", ".join(f"count(*) FILTER (WHERE {x} = {i})::DOUBLE" for i in range(bins)) + "]"


def interval(source: str, mode: str, keys: str = "", zero: str = "1e-3", digits: int = 5) -> str:
    lead = f"{keys}, " if keys else ""
    q = {"median": 0.5, "lo": 0.025, "hi": 0.975}
    parts = ", ".join(f"{tidy(f'quantile_cont(score, {p})', zero, digits)} AS {n}" for n, p in q.items())
    return (f"SELECT {lead}node, {parts}, '{mode}' AS mode, CAST(count(*) AS INTEGER) AS resamples FROM {source} "
            f"GROUP BY {lead}node")


def poisson_case(uniform: str) -> str:
    below, steps = 0.0, ""
    for k in range(13):
        below += exp(-1) / factorial(k)
        steps += f" WHEN {uniform} < {below!r}::DOUBLE THEN {k}"
    return f"CASE{steps} ELSE 13 END"


def weighted(source: str, key: str, replicates: int, mode: str) -> str:
    """CTE ``boot``: rows with weights per replicate."""
    r = "CAST(replicate AS VARCHAR)"
    weight = (poisson_case(u(key, "boot", r)) if mode != "subsample"
              else f"CASE WHEN {u(key, 'sample', r)} < 0.6 THEN 1 ELSE 0 END")
    return (f"boot AS (SELECT * FROM (SELECT *, {weight} AS weight FROM {source}, range({replicates}) AS z(replicate)))")


def change_boot(source: str, key: str, chain, replicates: int, mode: str) -> str:
    nodes = chain + ["net"]
    mixed = mixes(chain, "fo", "fn", lambda n, s: f"{s}.m_{n}" if n == chain[0] else "0.0")
    return (weighted(source, key, replicates, mode)
            + f", old AS (SELECT * FROM boot WHERE d <= {SPLIT}), new AS (SELECT * FROM boot WHERE d > {SPLIT}), "
            + fits("old", chain, "replicate", "weight", "fo") + ", " + fits("new", chain, "replicate", "weight", "fn")
            + f", base AS (SELECT replicate, s, {side_params(chain)} FROM fo JOIN fn USING (replicate), "
            + f"range({2 ** len(nodes)}) AS c(s)), vals AS (SELECT replicate, s, net AS v FROM {mixed}), "
            + shapley("vals", nodes, "replicate")
            + ", scores AS (" + " UNION ALL ".join(f"SELECT replicate, '{n}' AS node, {n} AS score FROM phi"
                                                   for n in nodes) + ")")


def left_over(node: str, chain, side: str = "") -> str:
    """Weighted variance of a chain node that its parent leaves over."""
    i = chain.index(node)
    return f"{side}v_{node}" if i == 0 else f"({side}v_{node} - power({side}b_{node}, 2) * {side}v_{chain[i - 1]})"


def f_score(a: str, da: str, b: str, db: str) -> str:
    """The normal score of an F statistic (a / da) / (b / db)."""
    root = f"power(({a} / {da}) / ({b} / {db}), 1.0 / 3.0)"
    return f"((1 - 2 / (9 * {db})) * {root} - (1 - 2 / (9 * {da}))) / sqrt(2 / (9 * {db}) * power({root}, 2) + 2 / (9 * {da}))"


def change_boot_tested(source: str, key: str, chain, replicates: int) -> str:
    """As ``change_boot``, with mechanisms that pass the change test of their replicate taken from the old side."""
    nodes, tests, kept = chain + ["net"], [], []
    for i, n in enumerate(chain):
        d1 = 1 if i == 0 else 2
        rss = {s: f"({s}.n_w * {left_over(n, chain, s + '.')})" for s in ("fo", "fn", "fb")}
        rest = f"({rss['fo']} + {rss['fn']})"
        free = {s: f"greatest({s}.n_w - {d1}::DOUBLE, 1.0)" for s in ("fo", "fn")}
        chow = f_score(f"greatest({rss['fb']} - {rest}, 1e-300)", f"{d1}::DOUBLE", rest, f"(fb.n_w - {2 * d1}::DOUBLE)")
        up, down = (f_score(rss[a], free[a], rss[b], free[b]) for a, b in (("fn", "fo"), ("fo", "fn")))
        tests.append(f"{chow} AS z_{n}, {up} AS up_{n}, {down} AS down_{n}")
        same = " AND ".join(f"{k} * ({normal_tail(f'{x}_{n}')}) > 0.025" for k, x in ((1, "z"), (2, "up"), (2, "down")))
        for field in ([f"m_{n}"] if i == 0 else [f"a_{n}", f"b_{n}"]):
            kept.append(f"CASE WHEN {same} THEN fo.{field} ELSE fn.{field} END AS {field}")
    mixed = mixes(chain, "fo", "ft", lambda n, s: f"{s}.m_{n}" if n == chain[0] else "0.0")
    both = "fo JOIN fn USING (replicate) JOIN fb USING (replicate)"
    return (weighted(source, key, replicates, "resample")
            + f", old AS (SELECT * FROM boot WHERE d <= {SPLIT}), new AS (SELECT * FROM boot WHERE d > {SPLIT}), "
            + ", ".join(fits(t, chain, "replicate", "weight", f) for t, f in (("old", "fo"), ("new", "fn"), ("boot", "fb")))
            + f", test AS (SELECT replicate, {', '.join(tests)} FROM {both}), "
            + f"ft AS (SELECT replicate, {', '.join(kept)}, fo.a_net, fo.bd, fo.bg FROM fo JOIN fn USING (replicate) JOIN test USING (replicate)), "
            + f"base AS (SELECT replicate, s, {side_params(chain, ('fo', 'ft'))} FROM fo JOIN ft USING (replicate), "
            + f"range({2 ** len(nodes)}) AS c(s)), vals AS (SELECT replicate, s, net AS v FROM {mixed}), "
            + shapley("vals", nodes, "replicate")
            + ", scores AS (" + " UNION ALL ".join(f"SELECT replicate, '{n}' AS node, {n} AS score FROM phi" for n in nodes) + ")")


def boot_pools(key: str, chain, extra=()) -> str:
    """Per replicate: noise lists of the pool rows, each repeated by its weight."""
    nodes = list(chain) + list(extra)
    text = f"CAST({key} AS VARCHAR)"
    lists = ", ".join(f"list({residual(n, chain)} ORDER BY pos, copy) AS p_{n}" for n in nodes)
    return (f"pool_r AS (SELECT *, row_number() OVER (PARTITION BY replicate ORDER BY md5({text} || ':pool:0'), {text}) "
            f"AS pos FROM boot), pool AS (SELECT replicate, {lists} FROM (SELECT *, unnest(range(weight)) AS copy "
            f"FROM pool_r) JOIN f USING (replicate) GROUP BY replicate)")


def normal_tail(z: str) -> str:
    t = f"(1.0::DOUBLE / (1.0 + {TAIL_P} * abs({z})))"
    poly = "0.0"
    for b in reversed(TAIL_B):
        poly = f"(({poly} + {b}) * {t})"
    upper = f"({poly} * exp(-0.5 * {z} * {z}) / sqrt(2.0 * pi()))"
    return f"CASE WHEN {z} >= 0 THEN {upper} ELSE 1.0 - {upper} END"


def fit_rows(chain, zero: str, digits: int) -> str:
    parts = []
    for x, y in list(zip(chain, chain[1:])) + [("n_lines", "qty")]:
        parts.append(f"SELECT '{y}' AS node, '{x}' AS term, {tidy('b_' + y, zero, digits)} AS value FROM f")
        parts.append(f"SELECT '{y}', '', {tidy('a_' + y, zero, digits)} FROM f")
    for term, field in (("disc", "bd"), ("gross", "bg"), ("", "a_net")):
        parts.append(f"SELECT 'net', '{term}', {tidy(field, zero, digits)} FROM f")
    return " UNION ALL ".join(parts)


def build(draws: int = 400, replicates: int = 20) -> dict[str, str]:
    q: dict[str, str] = {}
    q["daily_frame"] = f"""WITH {DAYS} SELECT d, CAST(peak AS INTEGER) AS peak, CAST(n_orders AS BIGINT) AS n_orders,
        CAST(n_lines AS BIGINT) AS n_lines, round(qty, 2) AS qty, round(gross, 2) AS gross, round(disc, 4) AS disc,
        round(net, 4) AS net FROM days"""
    q["order_frame"] = f"""WITH {FACTS} SELECT o_orderkey, d, CAST(n_lines AS BIGINT) AS n_lines, round(qty, 2) AS qty,
        round(gross, 2) AS gross, round(disc, 4) AS disc, round(net, 4) AS net FROM facts"""
    q["sanitized_columns"] = q["csv_roundtrip"] = """SELECT c_custkey AS "Cust_Key", c_mktsegment AS "Market_Segment",
        c_acctbal AS "Account_Balance", c_nationkey AS "Nation_Key" FROM customer"""
    q["snapshot_as_of"] = """SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS latest_version FROM orders
        WHERE o_orderstatus = 'F'"""
    first = " UNION ALL ".join(
        [f"SELECT 'peak' AS node, 'empirical' AS kind, '' AS parents, 0.0 AS first_coef, n_w FROM f"]
        + [f"SELECT '{y}', 'linear', '{x}', b_{y}, n_w FROM f" for x, y in
           list(zip(DAY_CHAIN, DAY_CHAIN[1:])) + [("n_lines", "qty")]]
        + ["SELECT 'net', 'linear', 'disc,gross', bd, n_w FROM f"])
    q["model_latest_alias"] = f"""WITH {DAYS}, {fits('days', DAY_CHAIN)} SELECT node, kind, 2 AS latest,
        4 AS alias_versions, parents, {tidy('first_coef')} AS first_coef, CAST(n_w AS BIGINT) AS n_rows FROM ({first})"""
    q["payload_roundtrip"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    q["period_filter"] = f"""WITH {FACTS} SELECT o_orderkey, d, round(gross, 2) AS gross, 'w1' AS week FROM facts
        WHERE d <= {SPLIT}"""
    q["event_overlay"] = f"""WITH {DAYS}, b AS (SELECT min(net) AS low, max(net) AS high, count(*) AS n_rows FROM days)
        SELECT d, round(net, 4) AS net, round(low, 4) AS low, round(high, 4) AS high, n_rows FROM days, b WHERE peak = 1"""
    q["net_series"] = f"WITH {DAYS} SELECT d, round(net, 4) AS net FROM days ORDER BY d"
    aligned = ", ".join(f"{tidy(f'((b.{c} / nullif(a.{c}, 0) - 1) * 100)', digits=11)} AS {c}_growth_pct, "
                        f"{tidy(f'((1 - b.{c} / nullif(a.{c}, 0)) * 100)', digits=11)} AS {c}_drop_pct" for c in ("n_lines", "net"))
    q["period_aligned_change"] = f"""WITH {DAYS} SELECT month(a.d)::INTEGER AS month, day(a.d)::INTEGER AS day, {aligned}
        FROM days a JOIN days b ON month(a.d) = month(b.d) AND day(a.d) = day(b.d)
        WHERE year(a.d) = 1996 AND year(b.d) = 1997"""
    q["parents_of"] = f"WITH {EDGES} SELECT child, parent, count(*) OVER (PARTITION BY child) AS n_parents FROM e"
    q["roots_of"] = f"WITH {EDGES} SELECT DISTINCT parent AS node FROM e WHERE parent NOT IN (SELECT child FROM e)"
    q["node_list"] = f"WITH {EDGES} SELECT parent AS node FROM e UNION SELECT child FROM e"
    q["invert_edges"] = f"WITH {EDGES} SELECT child AS parent, parent AS child FROM e"
    q["upstream"] = f"""WITH RECURSIVE {EDGES}, up AS (SELECT 'order:' || o_orderkey AS node, 0 AS hops FROM orders
        WHERE o_orderpriority = '1-URGENT' UNION SELECT e.parent, up.hops + 1 FROM up JOIN e ON e.child = up.node)
        SELECT node, CAST(min(hops) AS INTEGER) AS hops FROM up WHERE hops > 0 GROUP BY node"""
    q["topo_level"] = f"""WITH RECURSIVE {EDGES}, lv AS (SELECT DISTINCT parent AS node, 0 AS level FROM e
        WHERE parent NOT IN (SELECT child FROM e) UNION SELECT e.child, lv.level + 1 FROM lv JOIN e ON e.parent = lv.node)
        SELECT node, CAST(max(level) AS INTEGER) AS level FROM lv GROUP BY node"""
    means = ", ".join(f"avg({n}) AS {n}" for n in DAY_ALL)
    q["group_means"] = f"""WITH {DAYS} SELECT week, {cols(DAY_ALL)} FROM (SELECT CASE WHEN d <= {SPLIT} THEN 'w1'
        ELSE 'w2' END AS week, {means} FROM days GROUP BY 1)"""
    agg = ", ".join(f"avg({n}) AS {n}" for n in ORDER_ALL)
    q["column_means"] = f"WITH {FACTS}, m AS (SELECT {agg} FROM facts) " + long("m", "", ORDER_ALL, value="mean")
    q["target_spread"] = f"""WITH {FACTS} SELECT {cols(['sd', 'low', 'high', 'mean'])}, n_rows FROM (SELECT
        stddev_samp(net) AS sd, min(net) AS low, max(net) AS high, avg(net) AS mean, count(*) AS n_rows FROM facts)"""
    q["histograms"] = " UNION ALL ".join(f"""SELECT '{c}' AS node, CAST(bin AS INTEGER) AS bin,
        {tidy('(lo + bin * (hi - lo) / 16)', digits=12)} AS low,
        {tidy('(lo + (bin + 1) * (hi - lo) / 16)', digits=12)} AS high, n FROM (
        SELECT lo, hi, least(floor(({c} - lo) / ((hi - lo) / 16)), 15) AS bin, count(*) AS n FROM lineitem,
        (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 1, 2, 3)"""
                                         for c in ("l_quantity", "l_extendedprice"))
    names = sorted(ORDER_ALL)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    q["pairwise_corr"] = f"WITH {FACTS} " + " UNION ALL ".join(
        f"SELECT '{a}' AS left_node, '{b}' AS right_node, {tidy(f'corr({a}, {b})')} AS corr FROM facts" for a, b in pairs)
    names = sorted(["n_lines", "qty", "gross"])
    bounds = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in names)

    def slot(c):
        return f"CAST(least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 8)), 7) AS INTEGER)"
    q["pairwise_counts"] = f"WITH {FACTS}, b AS (SELECT {bounds} FROM facts) " + " UNION ALL ".join(
        f"SELECT '{x}' AS left_node, '{y}' AS right_node, {slot(x)} AS left_bin, {slot(y)} AS right_bin, count(*) AS n "
        f"FROM facts, b GROUP BY ALL" for i, x in enumerate(names) for y in names[i + 1:])
    q["percent_change"] = f"WITH {DAYS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS node, {tidy('o')} AS mean_old, {tidy('n')} AS mean_new, {tidy('((n / o - 1) * 100)')} AS growth_pct, "
        f"{tidy('((1 - n / o) * 100)')} AS drop_pct FROM (SELECT avg({c}) FILTER (WHERE d <= {SPLIT}) AS o, "
        f"avg({c}) FILTER (WHERE d > {SPLIT}) AS n FROM days)" for c in DAY_ALL)
    q["mean_difference"] = f"WITH {FACTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS node, {tidy(f'(avg({c}) FILTER (WHERE d > {SPLIT}) - avg({c}) FILTER (WHERE d <= {SPLIT}))')} "
        f"AS difference FROM facts" for c in ORDER_ALL)
    day_w = f"{DAYS}, {fits('days', DAY_CHAIN)}, {effects(DAY_CHAIN)}"
    order_w = f"{FACTS}, {fits('facts', ORDER_CHAIN)}, {effects(ORDER_CHAIN)}"

    def influence(source, chain):
        return (", i AS (SELECT " + ", ".join(
            f"power(any_value(w_{n}), 2) * var_samp({residual(n, chain)}) AS {n}" for n in chain)
            + f", 0.0::DOUBLE AS net FROM {source}, w)")
    total = " + ".join(f"abs({n})" for n in DAY_CHAIN)
    q["percent_share"] = f"WITH {day_w}{influence('days', DAY_CHAIN)} " + " UNION ALL ".join(
        f"SELECT '{n}' AS node, {tidy(n)} AS score, {tidy(f'(abs({n}) / ({total}) * 100)')} AS percent FROM i"
        for n in DAY_CHAIN + ["net"])
    q["head_rows"] = f"""WITH {FACTS} SELECT o_orderkey, CAST(n_lines AS BIGINT) AS n_lines, round(gross, 2) AS gross
        FROM facts ORDER BY n_lines DESC, o_orderkey LIMIT 5"""
    q["first_day"] = f"""WITH {DAYS} SELECT d, {tidy('(net - (SELECT avg(net) FROM days))')} AS from_mean FROM days
        ORDER BY d LIMIT 1"""
    q["edge_list"] = """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS parent, CAST(l_partkey AS VARCHAR) AS child
        FROM lineitem"""
    q["stack_periods"] = f"""WITH {FACTS} SELECT o_orderkey, d, CAST(n_lines AS BIGINT) AS n_lines,
        CASE WHEN d <= {SPLIT} THEN 'w1' ELSE 'w2' END AS week FROM facts"""
    q["round_half_even"] = """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half,
        greatest(l_discount, l_tax) AS larger FROM lineitem"""
    q["hash_sample"] = f"""SELECT event_id, event_type, value FROM events
        WHERE {u('event_id', 'sample', "'1'", 10)} < 0.6"""
    q["hash_sample_exact"] = f"""SELECT event_id, event_type FROM events ORDER BY {u('event_id', 'sample', "'2'", 10)},
        event_id LIMIT (SELECT CAST(round(count(*) * 0.6) AS BIGINT) FROM events)"""
    q["poisson_weights"] = f"""SELECT event_type, CAST(replicate AS INTEGER) AS replicate, CAST(sum(w) AS BIGINT) AS n,
        {tidy('sum(w * value)', digits=12)} AS total, CAST(max(w) AS INTEGER) AS top FROM (SELECT *,
        {poisson_case(u('event_id', 'boot', 'CAST(replicate AS VARCHAR)', 10))} AS w
        FROM events, range(4) AS r(replicate)) GROUP BY 1, 2"""
    q["fit_linear"] = f"WITH {FACTS}, {fits('facts', ORDER_CHAIN)} " + fit_rows(ORDER_CHAIN, "1e-4", 7)
    q["fit_linear_daily"] = f"WITH {DAYS}, {fits('days', DAY_CHAIN)} " + fit_rows(DAY_CHAIN, "1e-4", 6)
    q["fit_halfnormal"] = f"""WITH {FACTS} SELECT 'n_lines' AS node, {tidy('min(lo)')} AS loc,
        {tidy('sqrt(avg(power(n_lines - lo, 2)))')} AS scale FROM facts, (SELECT min(n_lines) AS lo FROM facts)"""
    nodes = ["n_lines", "qty", "gross", "disc"]
    res = ", ".join(f"{residual(n, ORDER_CHAIN)} AS r_{n}" for n in nodes)
    q["empirical_noise"] = f"""WITH {FACTS}, {fits('facts', ORDER_CHAIN)} SELECT o_orderkey,
        {', '.join(f"{tidy('r_' + n, '1e-4', 6)} AS {n}" for n in nodes)}, 0.0::DOUBLE AS net FROM (SELECT o_orderkey, {res} FROM facts, f)"""
    q["noise_pool"] = f"WITH {DAYS}, {fits('days', DAY_CHAIN)}, {pools('days', 'd', DAY_CHAIN, ['qty'])} " + " UNION ALL ".join(
        f"SELECT '{n}' AS node, i AS pos, {tidy('v', '1e-4', 6)} AS noise FROM (SELECT unnest(p_{n}) AS v, "
        f"unnest(range(len(p_{n}))) AS i FROM pool)" for n in DAY_CHAIN + ["qty"]) + (
        " UNION ALL SELECT 'net', unnest(range(len(p_peak))), 0.0::DOUBLE FROM pool")
    fold = f"CAST(floor({u('d', 'fold')} * 5) AS INTEGER)"
    single = list(zip(DAY_CHAIN, DAY_CHAIN[1:])) + [("n_lines", "qty")]
    cv = cross_validated("k", single, ("peak",))
    q["auto_assign"] = f"WITH {DAYS}, k AS (SELECT *, {fold} AS fold FROM days), cv AS ({cv}) {assignment_rows('peak')}"
    order_fold = f"CAST(floor({u('o_orderkey', 'fold')} * 5) AS INTEGER)"
    order_pairs = list(zip(ORDER_CHAIN, ORDER_CHAIN[1:])) + [("n_lines", "qty")]
    q["auto_assign_products"] = (f"WITH {FACTS}, k AS (SELECT *, {order_fold} AS fold FROM facts), cv AS ("
                                 f"{cross_validated('k', order_pairs)}) {assignment_rows('n_lines')}")
    metric = []
    for n in nodes:
        r = residual(n, ORDER_CHAIN)
        if n != "n_lines":
            metric.append(f"SELECT '{n}' AS node, 'mse' AS metric, avg(power({r}, 2)) AS value FROM facts, f")
            metric.append(f"SELECT '{n}', 'r2', 1 - avg(power({r}, 2)) / var_pop({n}) FROM facts, f")
        metric.append(f"SELECT '{n}' AS node, 'crps' AS metric, sum((2 * i - n - 1) * r) / (any_value(n) * any_value(n)) "
                      f"/ any_value(sd) AS value FROM (SELECT r, row_number() OVER (ORDER BY r) AS i, count(*) OVER ()::DOUBLE AS n, "
                      f"stddev_samp(x) OVER () AS sd FROM (SELECT {r} AS r, {n} AS x FROM facts, f))")
    metric.append("SELECT 'net' AS node, 'mse' AS metric, 0.0::DOUBLE AS value UNION ALL SELECT 'net', 'r2', 1.0::DOUBLE "
                  "UNION ALL SELECT 'net', 'crps', 0.0::DOUBLE")
    q["mechanism_metrics"] = (f"WITH {FACTS}, {fits('facts', ORDER_CHAIN)} SELECT node, metric, "
                              f"{tidy('value', digits=6)} AS value FROM (" + " UNION ALL ".join(metric) + ")")
    bins = []
    for x, y in single:
        r = residual(y, DAY_CHAIN)
        bins.append(f"SELECT '{y}' AS node, '{x}' AS parent, {bin_of('e', '0.0', 'sd_e', 6)} AS r, {bin_of('x', 'm_x', 'sd_x', 6)} "
                    f"AS x FROM (SELECT {r} AS e, {x} AS x, stddev_samp({r}) OVER () AS sd_e, avg({x}) OVER () AS m_x, "
                    f"stddev_samp({x}) OVER () AS sd_x FROM days, f)")
    z = "((power(g / dof, 1.0 / 3.0) - (1 - 2.0 / (9.0 * dof))) / sqrt(2.0 / (9.0 * dof)))"
    tests = f"""b AS ({' UNION ALL '.join(bins)}),
        o AS (SELECT node, parent, r, x, count(*)::DOUBLE AS o FROM b GROUP BY ALL),
        s AS (SELECT *, sum(o) OVER (PARTITION BY node, parent) AS n, sum(o) OVER (PARTITION BY node, parent, r) AS nr,
        sum(o) OVER (PARTITION BY node, parent, x) AS nx FROM o), g AS (SELECT node, parent, n,
        2 * sum(o * ln(o * n / (nr * nx))) AS g, (count(DISTINCT r) - 1) * (count(DISTINCT x) - 1) AS dof FROM s GROUP BY ALL),
        z AS (SELECT *, {z} AS z FROM g)"""
    q["noise_independence"] = f"""WITH {DAYS}, {fits('days', DAY_CHAIN)}, {tests}
        SELECT node, parent, CAST(n AS BIGINT) AS n, {tidy('g', digits=6)} AS g, dof,
        least(({normal_tail('z')}) * 7, 1.0) < 0.05 AS rejected FROM z
        UNION ALL SELECT 'net', unnest(['disc', 'gross']), (SELECT count(*) FROM days), 0.0::DOUBLE, 0, false"""

    def divergence(a, b, nodes, zero="1e-6", digits=6):
        out = []
        for n in nodes:
            m = f"(SELECT avg({n}) AS m, stddev_samp({n}) AS sd FROM {a})"
            both = [f"(SELECT {counts(bin_of('y', 'm', 'sd'))} AS c{i} FROM (SELECT {n} AS y, m, sd FROM {t}, {m}))"
                    for i, t in enumerate((a, b))]
            out.append(f"SELECT '{n}' AS node, {tidy(kl('c0', 'c1'), zero, digits)} AS kl FROM {both[0]}, {both[1]}")
        return " UNION ALL ".join(out)
    q["period_divergence"] = f"""WITH {DAYS}, a AS (SELECT * FROM days WHERE d <= {SPLIT}),
        b AS (SELECT * FROM days WHERE d > {SPLIT}) """ + divergence("a", "b", DAY_ALL)

    def forward(chain, row, replicate="'0'", qty=True, shift={}):
        """Nested SELECT drawing all nodes for rows of ``draw``."""
        sql = "draw, f, pool"
        for i, n in enumerate(chain):
            noise = pick("p_" + n, u(row, n, replicate))
            value = noise if i == 0 else f"a_{n} + b_{n} * {chain[i - 1]} + {noise}"
            sql = f"(SELECT *, {shift.get(n, '{}').format(value)} AS {n} FROM {sql})"
        extra = f", a_qty + b_qty * n_lines + {pick('p_qty', u(row, 'qty', replicate))} AS qty" if qty else ""
        return f"(SELECT *, a_net + bd * disc + bg * gross AS net{extra} FROM {sql})"
    base = f"{DAYS}, {fits('days', DAY_CHAIN)}, {pools('days', 'd', DAY_CHAIN, ['qty'])}"
    rep = "'check'"
    q["fit_divergence"] = (f"WITH {base}, draw AS (SELECT i AS id FROM range(5000) AS r(i)), "
                           f"gen AS (SELECT * FROM {forward(DAY_CHAIN, 'id', rep)}) "
                           + divergence("days", "gen", DAY_ALL))
    report = []
    for n in DAY_CHAIN + ["qty"]:
        r = residual(n, DAY_CHAIN)
        if n != "peak":
            report.append(f"SELECT 'performance' AS section, '{n}' AS node, 'mse' AS metric, avg(power({r}, 2)) AS value "
                          f"FROM days, f")
            report.append(f"SELECT 'performance' AS section, '{n}' AS node, 'r2' AS metric, 1 - avg(power({r}, 2)) / var_pop({n}) FROM days, f")
        report.append(f"SELECT 'performance' AS section, '{n}' AS node, 'crps' AS metric, sum((2 * i - n - 1) * r) / "
                      f"(any_value(n) * any_value(n)) / any_value(sd) AS value FROM (SELECT r, row_number() OVER (ORDER BY r) AS i, count(*) OVER ()::DOUBLE AS n, "
                      f"stddev_samp(x) OVER () AS sd FROM (SELECT {r} AS r, {n} AS x FROM days, f))")
    report.append("SELECT 'performance' AS section, 'net', unnest(['mse', 'r2', 'crps']), unnest([0.0::DOUBLE, 1.0, 0.0])")
    report.append("SELECT 'baseline' AS section, node, 'cv_mse:mean', mean FROM cv UNION ALL "
                  "SELECT 'baseline', node, 'cv_mse:linear', linear FROM cv UNION ALL SELECT 'baseline', node, 'cv_mse:poly', poly FROM cv")
    report.append(f"SELECT 'invertibility', node, 'p:' || parent, least(({normal_tail('z')}) * 7, 1.0) FROM z UNION ALL "
                  "SELECT 'invertibility', 'net', unnest(['p:disc', 'p:gross']), 1.0::DOUBLE")
    report = [f"SELECT section, node, metric, {tidy('value', '1e-5', 5)} AS value FROM ({' UNION ALL '.join(report)})"]
    report.append(f"SELECT 'divergence' AS section, node, 'kl' AS metric, kl AS value FROM "
                  f"({divergence('days', 'gen', DAY_ALL, '1e-5', 5)})")
    q["evaluate_model"] = (
        f"WITH {base}, draw AS (SELECT i AS id FROM range(10000) AS r(i)), gen AS (SELECT * FROM {forward(DAY_CHAIN, 'id', rep)}), "
        f"k AS (SELECT *, {fold} AS fold FROM days), cv AS ({cv}), {tests} " + " UNION ALL ".join(report))
    q["draw_samples"] = (f"WITH {base}, draw AS (SELECT i AS id FROM (SELECT unnest(range((SELECT count(*) FROM days))) AS i)) "
                         f"SELECT id, {cols(DAY_ALL, '1e-4', 6)} FROM {forward(DAY_CHAIN, 'id')}")
    q["dag_local_tests"] = dag_tests()
    q["dag_covariance_tests"] = dag_covariance()
    q["dag_permutations"] = dag_permuted() + """ SELECT CASE WHEN replicate < 0 THEN 'given' ELSE 'permuted' END AS graph, replicate,
        CAST(n_claims AS INTEGER) AS n_claims, CAST(n_violations AS INTEGER) AS n_violations, n_violations / n_claims AS violation_share,
        same_claims FROM v JOIN same USING (replicate)"""
    q["dag_falsify"] = dag_permuted() + """, o AS (SELECT * FROM v WHERE replicate < 0), s AS (SELECT avg((v.n_violations <= o.n_violations)::INTEGER) AS p,
        avg(same_claims::INTEGER) AS same, count(*) AS n FROM v JOIN same USING (replicate), o WHERE v.replicate >= 0)
        SELECT CAST(n_claims AS INTEGER) AS n_claims, CAST(n_violations AS INTEGER) AS n_violations, CAST(n AS INTEGER) AS n_permutations,
        p AS p_value, same AS same_claims_share, same <= 0.05 AS informative, same <= 0.05 AND p > 0.05 AS rejected FROM s, o"""
    q["arrow_strength"] = f"""WITH {order_w} SELECT 'disc' AS parent, 'net' AS child,
        {tidy('(power(any_value(bd), 2) * var_samp(disc))')} AS strength FROM facts, w UNION ALL SELECT 'gross', 'net',
        {tidy('(power(any_value(bg), 2) * var_samp(gross))')} FROM facts, w"""
    cut = []
    for p, b in (("disc", "bd"), ("gross", "bg")):
        moved = f"net + {b} * ({pick('p_' + p, u('d', p + '->net'))} - {p})"
        both = [f"(SELECT {counts(bin_of('y', 'm', 'sd'))} AS c{i} FROM (SELECT {y} AS y, m, sd FROM days, f, pool, "
                f"(SELECT avg(net) AS m, stddev_samp(net) AS sd FROM days)))" for i, y in enumerate(("net", moved))]
        cut.append(f"SELECT '{p}' AS parent, 'net' AS child, {tidy(kl('c0', 'c1'), digits=6)} AS strength "
                   f"FROM {both[0]}, {both[1]}")
    q["arrow_strength_kl"] = (f"WITH {DAYS}, {fits('days', DAY_CHAIN)}, "
                              f"{pools('days', 'd', ['disc', 'gross'], raw=True)} " + " UNION ALL ".join(cut))
    q["intrinsic_influence"] = f"WITH {order_w}{influence('facts', ORDER_CHAIN)} " + long("i", "", ORDER_CHAIN + ["net"],
                                                                                          digits=6)
    nodes = DAY_CHAIN + ["net"]
    # Of a linear target the control is all there is, and the estimate is the closed form.
    q["intrinsic_sampled"] = f"WITH {day_w}{influence('days', DAY_CHAIN)} " + long("i", "", nodes, "1e-3", 5)
    day_pool = f"{day_w}, {pools('days', 'd', DAY_CHAIN)}"
    day_attr = f"{day_pool}, {attribution('days', 'd', DAY_CHAIN, draws)}"
    g = f"-ln(least(2 * greatest(t / {draws}::DOUBLE, 1.0 / {draws + 1}::DOUBLE), 1.0))"
    q["anomaly_score"] = f"WITH {day_attr} SELECT d, {tidy(g)} AS score FROM ends"
    q["z_score"] = f"""WITH {FACTS} SELECT o_orderkey, {tidy('(abs(net - m) / sd)')} AS score FROM facts,
        (SELECT avg(net) AS m, stddev_samp(net) AS sd FROM facts)"""
    q["attribute_anomalies"] = q["batch_scores"] = f"WITH {day_attr} " + long("phi", "d", nodes)
    q["stream_scores"] = f"WITH {day_attr}, l AS ({long('phi', 'd', nodes)}) SELECT *, true AS answered FROM l"
    q["root_cause_topk"] = f"""WITH {day_attr}, l AS ({long('phi', 'd', nodes)}) SELECT * FROM (SELECT d, node, score,
        CAST(row_number() OVER (PARTITION BY d ORDER BY score DESC, node) AS INTEGER) AS rank FROM l) WHERE rank <= 2"""
    q["attribute_orders"] = (f"WITH {order_w}, {pools('facts', 'o_orderkey', ORDER_CHAIN)}, "
                             f"{attribution('facts', 'o_orderkey', ORDER_CHAIN, 200)} "
                             + long("phi", "o_orderkey", ORDER_CHAIN + ["net"]))
    q["attribute_products"] = q["attribute_orders"]
    chain = ORDER_CHAIN + ["net"]
    q["distribution_change_products"] = (
        f"WITH {FACTS}, {change_drawn('facts', 'o_orderkey', ORDER_CHAIN, 2000)}, "
        f"vals AS (SELECT s, avg(net) AS v FROM mixed GROUP BY s), {shapley('vals', chain)} " + long("phi", "", chain, "1e-3", 6))
    q["distribution_change"] = f"WITH {DAYS}, {change_mean('days', DAY_CHAIN)} " + long("phi", "", nodes, "1e-3", 6)
    q["distribution_change_orders"] = (f"WITH {FACTS}, {change_mean('facts', ORDER_CHAIN)} "
                                       + long("phi", "", ORDER_CHAIN + ["net"], "1e-3", 6))
    q["distribution_change_tested"] = change_tested(ORDER_CHAIN)
    q["distribution_change_tested_shape"] = change_tested(ORDER_CHAIN, True)
    drawn = f"{DAYS}, {change_drawn('days', 'd', DAY_CHAIN, 2000)}"
    q["distribution_change_variance"] = (f"WITH {drawn}, vals AS (SELECT s, var_samp(net) AS v FROM mixed GROUP BY s), "
                                         f"{shapley('vals', nodes)} " + long("phi", "", nodes, "10.0", 5))
    q["distribution_change_python"] = (f"WITH {drawn}, vals AS (SELECT s, avg(net) AS v FROM mixed GROUP BY s), "
                                       f"{shapley('vals', nodes)} " + long("phi", "", nodes, "1e-3", 6))
    b = bin_of("net", "m", "sd")
    q["distribution_change_kl"] = (
        f"WITH {drawn}, o AS (SELECT avg(net) AS m, stddev_samp(net) AS sd FROM mixed WHERE s = 0), "
        f"h AS (SELECT s, {counts(b)} AS c1 FROM mixed, o GROUP BY s), h0 AS (SELECT c1 AS c0 FROM h WHERE s = 0), "
        f"vals AS (SELECT s, {kl('c1', 'c0')} AS v FROM h, h0), {shapley('vals', nodes)} "
        + long("phi", "", nodes, "1e-6", 5))
    q["bootstrap_refit"] = f"WITH {DAYS}, {change_boot('days', 'd', DAY_CHAIN, replicates, 'refit')} " + interval(
        "scores", "refit")
    q["bootstrap_resample"] = (f"WITH {FACTS}, {change_boot('facts', 'o_orderkey', ORDER_CHAIN, 10, 'resample')} "
                               + interval("scores", "resample"))
    q["subsample_interval"] = f"WITH {DAYS}, {change_boot('days', 'd', DAY_CHAIN, 10, 'subsample')} " + interval(
        "scores", "subsample")
    many = f"{DAYS}, {change_drawn('days', 'd', DAY_CHAIN, 2000, replicates=5)}"
    stacked = " UNION ALL ".join(f"SELECT replicate, '{n}' AS node, {n} AS score FROM phi" for n in nodes)
    q["rerun_interval"] = (f"WITH {many}, vals AS (SELECT replicate, s, avg(net) AS v FROM mixed GROUP BY replicate, s), "
                           f"{shapley('vals', nodes, 'replicate')}, scores AS ({stacked}) " + interval("scores", "rerun"))
    q["change_interval_python"] = q["rerun_interval"]
    q["change_interval_tested"] = (f"WITH {FACTS}, {change_boot_tested('facts', 'o_orderkey', ORDER_CHAIN, 10)} "
                                   + interval("scores", "resample"))
    scale = "n_w / (n_w - 1)"
    own = [f"SELECT replicate, '{n}' AS node, power(w_{n}, 2) * {left_over(n, DAY_CHAIN)} * {scale} AS score FROM w" for n in DAY_CHAIN]
    own.append("SELECT replicate, 'net', 0.0::DOUBLE FROM w")
    q["influence_interval"] = (f"WITH {DAYS}, {weighted('days', 'd', replicates, 'refit')}, {fits('boot', DAY_CHAIN, 'replicate', 'weight')}, "
                               f"{effects(DAY_CHAIN)}, scores AS ({' UNION ALL '.join(own)}) " + interval("scores", "refit"))
    arrows = " UNION ALL ".join(f"SELECT replicate, '{p}' AS parent, 'net' AS node, power({b}, 2) * v_{p} * {scale} AS score FROM f"
                                for p, b in (("disc", "bd"), ("gross", "bg")))
    q["arrow_interval"] = (f"WITH {FACTS}, {weighted('facts', 'o_orderkey', 10, 'refit')}, {fits('boot', ORDER_CHAIN, 'replicate', 'weight')}, "
                           f"scores AS ({arrows}) SELECT parent, node AS child, median, lo, hi, mode, resamples FROM ("
                           + interval("scores", "refit", "parent") + ")")
    boot = (f"{DAYS}, {weighted('days', 'd', 10, 'refit')}, {fits('boot', DAY_CHAIN, 'replicate', 'weight')}, "
            f"{effects(DAY_CHAIN)}, {boot_pools('d', DAY_CHAIN, ['qty'])}")
    stacked = " UNION ALL ".join(f"SELECT replicate, d, '{n}' AS node, {n} AS score FROM phi" for n in nodes)
    q["anomaly_interval"] = (f"WITH {boot}, {attribution('days', 'd', DAY_CHAIN, 200, 10)}, scores AS ({stacked}) "
                             + interval("scores", "refit", "d", "1e-5", 6))
    shift = {"n_lines": "({} - 1)", "disc": "(({}) * 2)"}
    q["interventional_draws"] = (f"WITH {base}, draw AS (SELECT unnest(range((SELECT count(*) FROM days))) AS id) SELECT id, "
                                 + cols(["n_orders", "n_lines", "gross", "disc", "net"], "1e-4", 6)
                                 + f" FROM {forward(DAY_CHAIN, 'id', shift=shift)}")
    row = {n: f"p_{n}[j_{n} + 1]" for n in ("n_lines", "gross", "disc", "qty")}
    given = "(SELECT pool_r.* EXCLUDE (pos), " + ", ".join(f"j_{n}" for n in row) + " FROM pool_r" + "".join(
        f" JOIN (SELECT j AS j_{n}, x AS i_{n} FROM ({permuted('pool_r', n + '__draw')})) ON i_{n} = pos - 1" for n in row) + ")"

    def shifted(noise, source):
        s = f"(SELECT *, a_n_lines + b_n_lines * n_orders + {noise['n_lines']} - 1 AS x_n_lines FROM {source})"
        s = f"(SELECT *, a_gross + b_gross * x_n_lines + {noise['gross']} AS x_gross FROM {s})"
        s = f"(SELECT *, (a_disc + b_disc * x_gross + {noise['disc']}) * 2 AS x_disc FROM {s})"
        return (f"(SELECT *, a_qty + b_qty * x_n_lines + {noise['qty']} AS x_qty, "
                f"a_net + bd * x_disc + bg * x_gross AS x_net FROM {s})")
    after = shifted(row, f"{given}, f, pool")
    moved = ["n_lines", "gross", "disc", "net"]
    q["intervene"] = (f"WITH {base} SELECT d, {tidy('n_orders', '1e-4', 9)} AS n_orders, "
                      + ", ".join(f"{tidy('x_' + n, '1e-4', 9)} AS {n}" for n in moved) + f" FROM {after}")
    ahead = {n: f"x_{n}" if n in moved + ["qty"] else n for n in DAY_ALL}
    avgs = ", ".join(f"avg({n}) AS b_{n}, avg({ahead[n]}) AS a_{n}" for n in DAY_ALL)
    q["before_after"] = f"WITH {base}, ab AS (SELECT {avgs} FROM {after}) " + " UNION ALL ".join(
        f"SELECT '{n}' AS node, {tidy('b_' + n, '1e-4', 6)} AS mean_before, {tidy('a_' + n, '1e-4', 6)} AS mean_after, "
        f"{tidy(f'(a_{n} - b_{n})', '1e-4', 6)} AS difference FROM ab" for n in DAY_ALL)
    q["intervene_counterfactual"] = f"""WITH {order_w}, x AS (SELECT o_orderkey, n_lines + 1 AS n_lines, qty + b_qty AS qty,
        gross + b_gross AS gross, disc + b_disc * b_gross AS disc, net + (bg + bd * b_disc) * b_gross AS net FROM facts, w)
        SELECT o_orderkey, {cols(ORDER_ALL, '1e-4', 6)} FROM x"""
    many = {n: pick("p_" + n, u("d", n, "CAST(replicate AS VARCHAR)")) for n in row}
    avgs = ", ".join(f"avg({ahead[n]}) AS {n}" for n in DAY_ALL)
    stacked = " UNION ALL ".join(f"SELECT replicate, '{n}' AS node, {n} AS score FROM mm" for n in DAY_ALL)
    source = "(SELECT * FROM days, range(10) AS z(replicate)) JOIN f USING (replicate) JOIN pool USING (replicate)"
    q["intervention_interval"] = (f"WITH {boot}, mm AS (SELECT replicate, {avgs} FROM {shifted(many, source)} GROUP BY replicate), "
                                  f"scores AS ({stacked}) " + interval("scores", "refit"))
    return q


def cross_validated(source: str, pairs, binary=()) -> str:
    """Held-out squared error per node of its mean, of a line and of a parabola in its parent; ``net`` is an exact sum.

    A parent in ``binary`` has two values, and a parabola in it is a line.
    """
    out = []
    for x, y in pairs:
        scaled = f"(SELECT *, ({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER () AS z FROM {source})"
        sums = (f"avg({y}) AS my, regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a, avg(z) AS mu, avg(z * z) AS mv, "
                f"covar_pop(z, z) AS uu, covar_pop(z, z * z) AS uv, covar_pop(z * z, z * z) AS vv, covar_pop(z, {y}) AS uy, covar_pop(z * z, {y}) AS vy")
        fitted = (f"SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS p1, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS p2 FROM "
                  f"(SELECT h AS fold, {sums} FROM {scaled}, range(5) AS r(h) WHERE fold <> h GROUP BY h)")
        line = f"avg(power({y} - a - b * {x}, 2))"
        curve = line if x in binary else f"avg(power({y} - my - p1 * (z - mu) - p2 * (z * z - mv), 2))"
        out.append(f"SELECT '{y}' AS node, avg(power({y} - my, 2)) AS mean, {line} AS linear, {curve} AS poly FROM {scaled} JOIN ({fitted}) USING (fold)")
    out.append(f"SELECT 'net', avg(power(net - my, 2)), 0.0::DOUBLE, 0.0::DOUBLE FROM {source} JOIN (SELECT h AS fold, avg(net) AS my "
               f"FROM {source}, range(5) AS r(h) WHERE fold <> h GROUP BY h) USING (fold)")
    return " UNION ALL ".join(out)


def assignment_rows(root: str) -> str:
    better = "poly < linear * 0.95"
    return (f"SELECT node, 'mean' AS candidate, {tidy('mean', digits=6)} AS cv_mse, false AS chosen FROM cv "
            f"UNION ALL SELECT node, 'linear', {tidy('linear', digits=6)}, NOT ({better}) FROM cv "
            f"UNION ALL SELECT node, 'poly', {tidy('poly', digits=6)}, {better} FROM cv UNION ALL SELECT '{root}', 'empirical', NULL, true")


def change_tested(chain, shape: bool = False) -> str:
    """Mean change with mechanisms that pass the change tests taken from the old side; ``shape`` adds the distance of noises."""
    parts, kept = [], []
    for i, n in enumerate(chain):
        d1 = 1 if i == 0 else 2
        rss = {s: f"(SELECT sum(power({residual(n, chain) if i else f'{n} - m_{n}'}, 2)) FROM {t}, {s})"
               for s, t in (("fo", "old"), ("fn", "new"), ("fb", "facts"))}
        parts.append(f"SELECT '{n}' AS node, {d1}::DOUBLE AS d1, {rss['fo']} + {rss['fn']} AS rest, {rss['fb']} AS pooled, "
                     f"{rss['fo']} AS r0, {rss['fn']} AS r1, (SELECT count(*) FROM old) - {d1}::DOUBLE AS k0, "
                     f"(SELECT count(*) FROM new) - {d1}::DOUBLE AS k1, "
                     f"(SELECT count(*) FROM facts) - {2 * d1}::DOUBLE AS d2")
    root = "power(((pooled - rest) / d1) / (rest / d2), 1.0 / 3.0)"
    z = f"((1 - 2 / (9 * d2)) * {root} - (1 - 2 / (9 * d1))) / sqrt(2 / (9 * d2) * power({root}, 2) + 2 / (9 * d1))"
    up, down = f_score("r1", "k1", "r0", "k0"), f_score("r0", "k0", "r1", "k1")
    level = "(0.05 / 3)" if shape else "0.025"
    for i, n in enumerate(chain):
        same = (f"(SELECT ({normal_tail('z')}) > {level} AND 2 * ({normal_tail('up')}) > {level} AND 2 * ({normal_tail('down')}) > {level} "
                f"FROM chow WHERE node = '{n}')")
        if shape:
            noise = residual(n, chain)
            distance = (f"SELECT max(abs(ca / na - cb / nb)) AS d, any_value(na) AS na, any_value(nb) AS nb FROM (SELECT sum(a) OVER (ORDER BY v) AS ca, "
                        f"sum(b) OVER (ORDER BY v) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM (SELECT v, sum(1.0 - side) AS a, sum(side) AS b "
                        f"FROM (SELECT 0.0 AS side, {noise} AS v FROM old, fo UNION ALL SELECT 1.0, {noise} FROM new, fn) GROUP BY v))")
            tail = ("2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2 * power(k * x, 2))))")
            same += (f" AND (SELECT {tail} > {level} FROM (SELECT (e + 0.12 + 0.11 / e) * d AS x FROM (SELECT d, sqrt(na * nb / (na + nb)) AS e "
                     f"FROM ({distance}))))")
        for field in ([f"m_{n}"] if i == 0 else [f"a_{n}", f"b_{n}"]):
            kept.append(f"CASE WHEN {same} THEN fo.{field} ELSE fn.{field} END AS {field}")
    nodes = chain + ["net"]
    mixed = mixes(chain, "fo", "ft", lambda n, s: f"{s}.m_{n}" if n == chain[0] else "0.0")
    return (f"WITH {FACTS}, old AS (SELECT * FROM facts WHERE d <= {SPLIT}), new AS (SELECT * FROM facts WHERE d > {SPLIT}), "
            + ", ".join(fits(t, chain, name=f) for t, f in (("old", "fo"), ("new", "fn"), ("facts", "fb")))
            + f", chow AS (SELECT *, {z} AS z, {up} AS up, {down} AS down FROM ({' UNION ALL '.join(parts)})), "
            + f"ft AS (SELECT {', '.join(kept)}, fo.a_net, fo.bd, fo.bg FROM fo, fn), "
            + f"base AS (SELECT s, {side_params(chain, ('fo', 'ft'))} FROM fo, ft, range({2 ** len(nodes)}) AS c(s)), "
            + f"vals AS (SELECT s, net AS v FROM {mixed}), {shapley('vals', nodes)} " + long("phi", "", nodes, "1e-3", 6))


#: What the daily graph implies, written out: a node, its parents, and what it should not depend on given these.
DAY_CLAIMS = (("disc", ("gross",), ("n_lines", "n_orders", "peak", "qty")),
              ("gross", ("n_lines",), ("n_orders", "peak", "qty")),
              ("n_lines", ("n_orders",), ("peak",)),
              ("net", ("disc", "gross"), ("n_lines", "n_orders", "peak", "qty")),
              ("qty", ("n_lines",), ("disc", "gross", "n_orders", "net", "peak")))


def dag_tests() -> str:
    parts = []
    for x, given, others in DAY_CLAIMS:
        for z in others:
            if x == "net":  # an exact sum of its parents: nothing is left to correlate
                r = "0.0::DOUBLE"
            else:
                g = given[0]
                r = (f"(corr({x}, {z}) - corr({x}, {g}) * corr({z}, {g})) / "
                     f"sqrt((1 - power(corr({x}, {g}), 2)) * (1 - power(corr({z}, {g}), 2)))")
            parts.append(f"SELECT '{x}' AS node, '{z}' AS other, '{','.join(given)}' AS given, {len(given)} AS k, {r} AS r, "
                         f"count(*) AS n FROM days")
    return (f"WITH {DAYS}, c AS ({' UNION ALL '.join(parts)}) SELECT node, other, given, {tidy('r', '1e-7', 5)} AS partial_corr, "
            f"0.5 * ln((1 + abs(r)) / (1 - abs(r))) * sqrt(n - k - 3) > 1.959963984540054 AS violated FROM c")


ORDER_EDGES = (("n_lines", "qty"), ("n_lines", "gross"), ("gross", "disc"), ("gross", "net"), ("disc", "net"))


def claims_of(edges) -> list[tuple[str, str, list[str]]]:
    """What a graph implies: a node and each other that is neither its parent nor below it, given its parents."""
    names = sorted({n for e in edges for n in e})
    parents = {n: sorted(p for p, c in edges if c == n) for n in names}
    below = {n: set() for n in names}
    for _ in names:
        for p, c in edges:
            below[p] |= {c} | below[c]
    return [(x, z, parents[x]) for x in names for z in names if z != x and z not in parents[x] and z not in below[x]]


def permuted_edges(edges, replicate: int):
    names = sorted({n for e in edges for n in e})
    draw = {i: int(md5(f"{i}:permute:{replicate}:0".encode()).hexdigest()[:13], 16) for i in range(len(names))}
    moved = {n: names[j] for n, j in zip(names, sorted(draw, key=lambda i: (draw[i], i)))}
    return tuple((moved[p], moved[c]) for p, c in edges)


def dag_permuted(count: int = 20) -> str:
    """CTEs up to ``v`` (replicate, n_claims, n_violations): claims of the order graph (-1) and of its permutations, with at most two parents."""
    names = sorted({n for e in ORDER_EDGES for n in e})
    graphs = {r: ORDER_EDGES if r < 0 else permuted_edges(ORDER_EDGES, r) for r in range(-1, count)}
    own = {(frozenset((x, z)), frozenset(g)) for x, z, g in claims_of(ORDER_EDGES)}
    rows, same = [], []
    for r, edges in graphs.items():
        found = claims_of(edges)
        for x, z, g in found:
            given = [f"'{n}'" for n in g] + ["NULL"] * (2 - len(g))
            rows.append(f"({r}, '{x}', '{z}', {given[0]}, {given[1]}, {len(g)})")
        same.append(f"({r}, {str({(frozenset((x, z)), frozenset(g)) for x, z, g in found} == own).lower()})")
    matrix = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {'1.0::DOUBLE' if a == b else f'corr({a}, {b})'} AS r, count(*) AS n FROM facts"
                                for a in names for b in names)
    pairs = {"xz": "x z", "xg": "x g", "xh": "x h", "zg": "z g", "zh": "z h", "gh": "g h"}
    joins = " ".join(f"LEFT JOIN m AS {k} ON {k}.a = c.{v[0]} AND {k}.b = c.{v[2]}" for k, v in pairs.items())
    picked = ", ".join(f"coalesce({k}.r, 0) AS {k}" for k in pairs)
    det = "(1 - gh * gh)"  # without a second parent all its correlations are zero

    def left(a, b, whole):
        return f"({whole} - ({a}g * {b}g + {a}h * {b}h - gh * ({a}g * {b}h + {a}h * {b}g)) / {det})"
    vx, vz, cov = left("x", "x", "1"), left("z", "z", "1"), left("x", "z", "xz")
    r = f"CASE WHEN {vx} < 1e-9 OR {vz} < 1e-9 THEN 0.0 ELSE greatest(least({cov} / sqrt(greatest({vx} * {vz}, 1e-300)), 1 - 1e-15), -1 + 1e-15) END"
    return (f"WITH {FACTS}, m AS ({matrix}), c(replicate, x, z, g, h, k) AS (VALUES {', '.join(rows)}), "
            f"same(replicate, same_claims) AS (VALUES {', '.join(same)}), "
            f"j AS (SELECT c.replicate, c.k, xz.n AS n, {picked} FROM c {joins}), t AS (SELECT replicate, k, n, {r} AS r FROM j), "
            f"v AS (SELECT replicate, count(*) AS n_claims, count(*) FILTER (0.5 * ln((1 + abs(r)) / (1 - abs(r))) * sqrt(n - k - 3) > "
            f"1.959963984540054) AS n_violations FROM t GROUP BY replicate)")


def dag_covariance() -> str:
    """Products of held-out residuals, five folds, straight lines."""
    fold = f"CAST(floor({u('d', 'fold')} * 5) AS INTEGER)"
    parts = []
    for x, given, others in DAY_CLAIMS:
        for z in others:
            head = f"SELECT '{x}' AS node, '{z}' AS other, '{','.join(given)}' AS given"
            if x == "net":
                parts.append(f"{head}, 0.0::DOUBLE AS t")
                continue
            g = given[0]
            lines = ", ".join(f"regr_slope({y}, {g}) AS b{i}, regr_intercept({y}, {g}) AS a{i}" for i, y in enumerate((x, z)))
            parts.append(f"{head}, count(*) * power(avg(p), 2) / (avg(p * p) - power(avg(p), 2)) AS t FROM (SELECT ({x} - a0 - b0 * {g}) * "
                         f"({z} - a1 - b1 * {g}) AS p FROM k JOIN (SELECT h AS fold, {lines} FROM k, range(5) AS r(h) WHERE fold <> h "
                         f"GROUP BY h) USING (fold))")
    z = "((power(greatest(t, 1e-300), 1.0 / 3.0) - (1 - 2.0 / 9.0)) / sqrt(2.0 / 9.0))"
    return (f"WITH {DAYS}, k AS (SELECT *, {fold} AS fold FROM days), c AS ({' UNION ALL '.join(parts)}) SELECT node, other, given, "
            f"{tidy('t', '1e-7', 5)} AS statistic, t > 0 AND ({normal_tail(z)}) < 0.05 AS violated FROM c")
