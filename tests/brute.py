"""Plain re-statements of the stated definitions, for comparison on small tables."""

import math
from collections import defaultdict
from statistics import median


def _rows(df):
    return df.to_dict("records")


def counted(history, projects, expectations):
    """project -> (cadence, [(t, rec_id, plan, actual)] in order of weeks)."""
    kinds = {r["kind"] for r in _rows(expectations) if r["needs_pct"] is True or r["needs_pct"] == 1}
    cadence = {r["project_id"]: r["cadence"] for r in _rows(projects) if r["kind"] in kinds}
    best = {}
    for r in _rows(history):
        if r["project_id"] not in cadence:
            continue
        key = r["project_id"], int(r["year"]) * 52 + int(r["week"]) - 1
        rank = (r["recorded_at"], r["rec_id"])
        if key not in best or rank > best[key][0]:
            best[key] = rank, r
    out = defaultdict(list)
    for (p, t), (_, r) in sorted(best.items()):
        out[p].append((t, r["rec_id"], r["plan"], r["actual"]))
    return {p: (cadence[p], rows) for p, rows in out.items()}


def absent(v):
    return v is None or v != v


def missing(rows):
    """The (rec_id, field) that are missing, of one project's rows."""
    weeks = defaultdict(set)
    for t, _, *vs in rows:
        for v in vs:
            if not absent(v) and not 0 <= v <= 100:
                weeks[v].add(t)
    stand_in = {v for v, ts in weeks.items() if len(ts) >= 2}
    return {(i, f) for _, i, *vs in rows for f, v in zip(("plan", "actual"), vs, strict=True) if absent(v) or v in stand_in}


def p1(history, projects, expectations):
    return set().union(*(missing(rows) for _, rows in counted(history, projects, expectations).values()), set())


def p2(history, projects, expectations, cadences):
    steps = {r["cadence"]: int(r["step_weeks"]) for r in _rows(cadences)}
    out = set()
    for p, (cadence, rows) in counted(history, projects, expectations).items():
        step, gone = steps.get(cadence if cadence is not None and cadence == cadence else "weekly", 1), missing(rows)
        first = rows[0][0]
        full = {(t - first) // step for t, i, *_ in rows if not {(i, "plan"), (i, "actual")} <= gone}
        for k in range((rows[-1][0] - first) // step + 1):
            if k not in full:
                t = first + k * step
                out.add((p, t // 52, t % 52 + 1))
    return out


def p4(history, projects, expectations):
    out = set()
    for _, rows in counted(history, projects, expectations).values():
        gone = missing(rows)
        for k, f in ((2, "plan"), (3, "actual")):
            seq = [(r[1], r[k]) for r in rows if (r[1], f) not in gone]
            out |= {(i, f) for i, v in seq if not 0 <= v <= 100}
            a = 0
            while a < len(seq):
                b = a
                while b + 1 < len(seq) and seq[b + 1][1] == seq[a][1]:
                    b += 1
                if b - a + 1 >= 4 and 0 < seq[a][1] < 100:
                    out |= {(i, f) for i, _ in seq[a + 1 : b + 1]}
                a = b + 1
            inner = [v for _, v in seq if 0 < v < 100]
            if len(inner) < 8:
                continue
            bound = max(3.0, 8 * median(abs(y - x) for x, y in zip(inner, inner[1:])))
            own = [(i, v) for i, v in seq if 0 <= v <= 100]
            for n in (1, 2):
                for a in range(1, len(own) - n):
                    mid, ends = [v for _, v in own[a : a + n]], (own[a - 1][1], own[a + n][1])
                    up, down = min(mid) - max(ends), min(ends) - max(mid)
                    if round(max(up, down) - bound, 7) >= 0 and not math.isnan(up):
                        out |= {(i, f) for i, _ in own[a : a + n]}
    return out


def p5(history):
    """(load_id, column) -> sigmas of nulls, impossible, level, spread and mix, of the loads that are judged."""
    loads = {}
    for r in _rows(history):
        for c in ("n_disc", "n_scopes", "n_concerns", "n_activities"):
            v = r[c]
            loads.setdefault((r["feed"], c), {}).setdefault(r["load_id"], []).append(None if v is None or v != v else int(v))
    facts = {}
    for (feed, c), own in loads.items():
        for load, vs in own.items():
            good = [v for v in vs if v is not None and 0 <= v <= 20]
            if len(vs) < 150:
                continue
            mean = sum(good) / len(good)
            sd = max(0.1, math.sqrt(max(0.0, sum(v * v for v in good) / len(good) - mean * mean)))
            bad = len([v for v in vs if v is not None and not 0 <= v <= 20])
            facts[load, c] = feed, len(vs), len(good), [vs.count(None) / len(vs), bad / len(vs), mean, math.log(sd)], [good.count(k) for k in range(21)]
    out = set()
    for _ in range(2):
        off = {}
        for (load, c), (feed, n, ok, m, hist) in facts.items():
            others = [k for k in facts if k[1] == c and k[0] != load and facts[k][0] == feed]
            calm = [k for k in others if k not in out]
            others = calm if len(calm) >= 2 else others
            usual = [median(facts[k][3][q] for k in others) for q in range(4)]
            sd = max(0.1, median(math.exp(facts[k][3][3]) for k in others))
            u = [sum(facts[k][4][v] for k in others) for v in range(21)]
            u = [x / sum(u) for x in u]
            p = [max(usual[q], 1 / n) for q in (0, 1)]
            d = [m[0] - usual[0], m[1] - usual[1], (m[2] - usual[2]) / sd, m[3] - usual[3], sum(abs(x / ok - y) for x, y in zip(hist, u, strict=True)) / 2]
            s = [p[0] * (1 - p[0]) / n, p[1] * (1 - p[1]) / n, 1 / ok, 0.5 / ok, (sum(math.sqrt(y * (1 - y) * 2 / math.pi / ok) for y in u) / 2) ** 2]
            off[load, c] = d, s
        z = {k: [0.0] * 5 for k in off}
        for c in {k[1] for k in off}:
            for q in range(5):
                pairs = [(off[k][0][q] ** 2, off[k][1][q]) for k in off if k[1] == c and k not in out]
                cut = median(s for _, s in pairs)
                small, large = [x for x in pairs if x[1] > cut], [x for x in pairs if x[1] <= cut]
                (ds, ss), (dl, sl) = ((median(x[0] for x in h), median(x[1] for x in h)) if h else (0.0, 0.0) for h in (small, large))
                inflation = max(1.0, (ds - dl) / (ss - sl) / 0.4549) if small and ss > sl * 1.0001 else 1.0
                between = max(0.0, dl / 0.4549 - inflation * sl)
                for k in off:
                    if k[1] == c:
                        z[k][q] = abs(off[k][0][q]) / math.sqrt(between + inflation * off[k][1][q])
        out = {k for k, v in z.items() if max(v) > 5.5}
    return z
