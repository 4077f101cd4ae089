"""Plain-Python twins of the clustering operators, written from their definitions."""

import math


def d2(p, q):
    return sum((a - b) ** 2 for a, b in zip(p, q))


def nearest(p, centers):
    best = min(range(len(centers)), key=lambda i: (d2(p, centers[i]), i))
    return best, d2(p, centers[best])


def mean(points):
    return [sum(c) / len(points) for c in zip(*points)]


def lloyd(points, centers, rounds):
    centers = [list(c) for c in centers]
    for _ in range(rounds):
        sets = {}
        for p, _g in points:
            sets.setdefault(nearest(p, centers)[0], []).append(p)
        for k, members in sets.items():
            centers[k] = mean(members)
    return centers


def search(fixed_a, fixed_b, alpha, beta, ell):
    gamma, x = 0.5, []
    for step in range(10):
        x = []
        for a, b, length in zip(alpha, beta, ell):
            heavy = gamma * a + (1 - gamma) * b
            x.append((1 - gamma) * b * length / heavy if heavy else 0.0)
        cost_a = fixed_a + sum(a * v * v for a, v in zip(alpha, x))
        cost_b = fixed_b + sum(b * (length - v) ** 2 for b, length, v in zip(beta, ell, x))
        if abs(cost_a - cost_b) <= 1e-12 * max(cost_a, cost_b):
            break
        gamma += (1 if cost_a > cost_b else -1) * 0.25 * 0.5**step
    return x


def fair_round(points, centers, population):
    sets = {}
    for p, g in points:
        sets.setdefault((nearest(p, centers)[0], g), []).append(p)
    used = sorted({k for k, _ in sets})
    means = {key: mean(members) for key, members in sets.items()}
    alpha, beta = [], []
    for shares, g in ((alpha, 0), (beta, 1)):
        weight = [float(len(sets.get((k, g), [])) if population else (k, g) in sets) for k in used]
        shares += [w / sum(weight) if sum(weight) else 0.0 for w in weight]
    fixed = []
    for g in (0, 1):
        members = [(p, means[k, g]) for k in used for p in sets.get((k, g), [])]
        fixed.append(sum(d2(p, m) for p, m in members) / len(members) if population and members else 0.0)
    pairs = [(means.get((k, 0)) or means[k, 1], means.get((k, 1)) or means[k, 0]) for k in used]
    ell = [math.sqrt(d2(a, b)) for a, b in pairs]
    x = search(*fixed, alpha, beta, ell)
    out = [list(c) for c in centers]
    for k, (a, b), length, v in zip(used, pairs, ell, x):
        out[k] = [(length - v) / length * s + v / length * t for s, t in zip(a, b)] if length else list(a)
    return out


def fair_lloyd(points, centers, rounds, population):
    for _ in range(rounds):
        centers = fair_round(points, centers, population)
    return centers


def tokens(line):
    """Split at spaces; trailing empty parts go, unless the line itself is empty."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts
