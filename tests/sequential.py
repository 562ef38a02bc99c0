"""One-point-at-a-time statements of the clustering rules, for property tests on small inputs only."""

from collections import deque


def cluster(n, dist, eps, min_points, noise="singleton", start_id=1, start_noise=0):
    """Visits points in order; returns (ids, next id, points met as noise)."""
    near = [[j for j in range(n) if dist(i, j) < eps] for i in range(n)]
    ids, next_id, met = [0] * n, start_id, []
    for p in range(n):
        if ids[p]:
            continue
        if len(near[p]) < min_points:
            met.append(p)
            continue
        for q in near[p]:
            ids[q] = next_id
        todo = deque(near[p])
        while todo:
            c = todo.popleft()
            if len(near[c]) < min_points:
                continue
            for q in near[c]:
                if not ids[q]:
                    ids[q] = next_id
                    todo.append(q)
        next_id += 1
    for p in met:
        if ids[p]:
            continue
        if noise == "shared":
            ids[p] = next_id
            continue
        best = min(((dist(p, q), q) for q in range(n) if q != p), default=None)
        if best is not None and best[0] < eps and ids[best[1]]:
            ids[p] = ids[best[1]]
        else:
            ids[p], next_id = next_id, next_id + 1
    return ids, next_id + (noise == "shared"), start_noise + len(met)


def assign(batch, history, dist, eps):
    """``history`` holds (key, id); returns (ids, first new id, next id)."""
    seen, start = list(history), max((i for _, i in history), default=0) + 1
    next_id, out = start, []
    for key in batch:
        hits = [(dist(key, k), at) for at, (k, _) in enumerate(seen) if dist(key, k) < eps]
        if hits:
            out.append(seen[min(hits)[1]][1])
        else:
            out.append(next_id)
            next_id += 1
        seen.append((key, out[-1]))
    return out, start, next_id


def hash_distance(a, b):
    x = bin(a ^ b)[2:]
    return x.count("1") / len(x)
