"""Sequential models of the landing loop, used as brute-force references on small logs."""

from collections import defaultdict


def varint_len(n):
    z, size = (n << 1) ^ (n >> 63), 1
    while z > 0x7F:
        z, size = z >> 7, size + 1
    return size


def trunc_div(a, b):
    return -(-a // b) if a < 0 else a // b


def audit(rows, start=0, sink=False):
    """rows: (offset, watermark) in arrival order -> (expected, status, next)."""
    e, out = start, []
    for o, h in rows:
        if o == e:
            status, after = "ok", o + 1
        elif o > e:
            status, after = "gap", o + 1
        elif e < h:
            status, after = "early", e
        elif e > h:
            status, after = "beyond_hw", (h if sink else e)
        else:
            status, after = "at_hw", e
        out.append((e, status, after))
        e = after
    return out


def blocks(lines, cap, max_lines=None):
    """lines of one file: (ts_ms, arrival_ms, body) -> [(second, create, number, [(ms, body)])]."""
    out, used = [], 0
    for ts, arrival, body in lines:
        second = trunc_div(ts, 1000)
        ms = ts - second * 1000
        full = cap - used < 20 + len(body) or (max_lines and out and len(out[-1][3]) >= max_lines)
        if not out or out[-1][0] != second or full:
            out.append((second, arrival, len(out), []))
            used = 0
        out[-1][3].append((ms, body))
        used += varint_len(ms) + varint_len(len(body)) + len(body)
    return out


def by_key(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def shuffles_of(df, column, broadcast):
    """Shuffles that move ``column`` in the plan made before any stage has run; ``broadcast``: bytes of a table that may be broadcast."""
    conf, wanted = df.sparkSession.conf, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": str(broadcast)}
    before = {key: conf.get(key) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        nodes = [df.select("*")._jdf.queryExecution().executedPlan()]
    finally:
        for key, value in before.items():
            conf.set(key, value)
    for node in nodes:
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    moves = [node for node in nodes if node.nodeName() == "Exchange"]
    return sum(any(n.output().apply(k).name() == column for k in range(n.output().size())) for n in moves)
