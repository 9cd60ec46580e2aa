"""Plain-Python twins of the positional operators, for small inputs."""

from __future__ import annotations

import math
from collections import defaultdict


def vector(ra, dec):
    a, d = math.radians(ra), math.radians(dec)
    return math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)


def separation(p, q):
    return 2 * math.degrees(math.asin(min(1.0, math.dist(vector(*p), vector(*q)) / 2)))


def all_pairs(left, right, radius):
    """Keys of all pairs; inputs are lists of (key, ra, dec)."""
    return {(a[0], b[0]) for a in left for b in right if separation(a[1:], b[1:]) <= radius}


def walk(sources, radius):
    """(field, aid, sid) of the walk in time order; sources are dicts."""
    out = set()
    fields = defaultdict(list)
    for s in sources:
        fields[s["field"]].append(s)
    for field, rows in fields.items():
        batches = defaultdict(list)
        for s in rows:
            batches[(s["mjdobs"], s["expid"], s["sca"])].append(s)
        objects = {}  # aid: [ra, dec, n]
        for key in sorted(batches):
            matches, fresh = defaultdict(list), []
            for s in batches[key]:
                hits = [a for a, o in objects.items() if separation((s["ra"], s["dec"]), (o[0], o[1])) <= radius]
                for a in hits:
                    matches[a].append(s)
                    out.add((field, a, s["sid"]))
                if not hits:
                    fresh.append(s)
            for a, found in matches.items():
                ra, dec, n = objects[a]
                dra = sum((s["ra"] - ra + 540) % 360 - 180 for s in found)
                ddec = sum(s["dec"] - dec for s in found)
                k = n + len(found)
                objects[a] = [(ra + dra / k) % 360, dec + ddec / k, k]
            for s in fresh:
                objects[s["sid"]] = [s["ra"], s["dec"], 1]
                out.add((field, s["sid"], s["sid"]))
    return out


def groups(points, link):
    """Friends-of-friends groups as a set of frozensets of keys."""
    parent = {p[0]: p[0] for p in points}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(points):
        for b in points[:i]:
            if separation(a[1:], b[1:]) <= link:
                parent[root(a[0])] = root(b[0])
    found = defaultdict(set)
    for p in points:
        found[root(p[0])].add(p[0])
    return {frozenset(v) for v in found.values()}
