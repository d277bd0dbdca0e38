"""Plain loops over small inputs, to compare the Spark operators with."""

from collections import defaultdict


def substring_distance(pattern, text):
    best = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row = [i]
        for j, t in enumerate(text, 1):
            row.append(min(row[j - 1] + 1, best[j] + 1, best[j - 1] + (p != t)))
        best = row
    return min(best)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(nxt[j - 1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def threshold(length, distance):
    return int(length * distance) if distance < 1 else int(distance)


def edges(cell, distance, metric=substring_distance):
    """Directed (src, dst) of different UMIs of one cell."""
    return {(a, b) for a in cell for b in cell if a != b and threshold(len(a), distance) > 0
            and metric(a, b) <= threshold(len(a), distance)}


def recall(wt, mut, limit):
    if wt + mut == 0 or max(wt, mut) / (wt + mut) <= limit:
        return "AMB"
    return "WT" if wt > mut else "MUT"


def collapse(cell, links, limit):
    """``cell``: {umi: (wt, mut, amb, call)} -> survivors in the same form."""
    left = dict(cell)
    while True:
        degree = {u: sum((u, v) in links for v in left) for u in left}
        top = max(degree.values(), default=0)
        if top == 0:
            return left
        keeper = min(u for u in left if degree[u] == top)
        reached, todo = {keeper}, [keeper]
        while todo:
            u = todo.pop()
            for v in left:
                if (u, v) in links and v not in reached:
                    reached.add(v)
                    todo.append(v)
        wt, mut, amb = (sum(left[u][i] for u in reached) for i in range(3))
        for u in reached - {keeper}:
            del left[u]
        left[keeper] = (wt, mut, amb, recall(wt, mut, limit))


def cells_of(rows):
    out = defaultdict(dict)
    for r in rows:
        out[r["bc"]][r["umi"]] = (r["n_wt"], r["n_mut"], r["n_amb"], r["call"])
    return out


def rescue(bc, scores, whitelist, priors, cutoff=0.99, cap=33):
    """Outcome for one read: (status, replacement). ``whitelist``: barcodes in order."""
    near = [w for w in whitelist if len(w) == len(bc) and sum(a != b for a, b in zip(w, bc)) == 1]
    if not near:
        return "No_Hamm_1", None
    total = sum(priors.get(w, 0) for w in near)
    weights = []
    for w in near:
        at = next(i for i in range(len(bc)) if bc[i] != w[i])
        q = min(cap, scores[at]) if priors.get(w, 0) else 0
        weights.append((priors.get(w, 0) / total if total else 0) * 10 ** (-q / 10))
    post = [x / sum(weights) if sum(weights) else 0 for x in weights]
    best = [w for w, p in zip(near, post) if p == max(post)]
    if total == 0 and len(best) > 1:
        return "NO_in_SAVED", None
    if max(post) < cutoff or (len(best) == 2 and abs(max(post) - 0.5) < 1e-12):
        return "Not_Sig", None
    return "RESCUED", best[0]
