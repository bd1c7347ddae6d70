"""Small in-memory answers to check the Spark operators against."""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction


def drawn_edges(paths):
    found = set()
    for path in paths:
        for a, b in zip(path, path[1:]):
            if a != b:
                found.add((min(a, b), max(a, b)))
    return found


def line_of(a, b):
    """The supporting line of an edge, exactly: slope and offset."""
    (ax, ay), (bx, by) = ((Fraction(repr(x)), Fraction(repr(y))) for x, y in (a, b))
    if ax == bx:
        return None, ax
    slope = (by - ay) / (bx - ax)
    return slope, ay - slope * ax


def edges_of(paths):
    """The edges of the union: on each line, neighbouring points that some edge covers."""
    lines = defaultdict(set)
    for a, b in drawn_edges(paths):
        lines[line_of(a, b)].add((a, b))
    out = set()
    for edges in lines.values():
        points = sorted({p for e in edges for p in e})
        far, at = None, sorted(edges)
        for p, q in zip(points, points[1:]):
            while at and at[0][0] <= p:
                far = max(at.pop(0)[1], far or p)
            if far and far > p:
                out.add((p, q))
    return out


def settled(line, ring):
    if ring:
        body = line[:-1]
        at = body.index(min(body))
        line = body[at:] + body[:at] + [min(body)]
    if line[-1] < line[0] or (line[-1] == line[0] and line[-2] < line[1]):
        line = line[::-1]
    return tuple(line)


def chains_of(paths):
    """Maximal chains of one group's lines as {(ring, line)}."""
    edges = edges_of(paths)
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    left, out = set(edges), set()

    def walk(u, v):
        line = [u, v]
        left.discard((min(u, v), max(u, v)))
        while len(near[v]) == 2 and line[0] != v:
            u, v = v, next(iter(near[v] - {u}))
            left.discard((min(u, v), max(u, v)))
            line.append(v)
        return line

    for u in [n for n in near if len(near[n]) != 2]:
        for v in near[u]:
            if (min(u, v), max(u, v)) in left:
                out.add((False, settled(walk(u, v), False)))
    while left:
        u, v = next(iter(left))
        out.add((True, settled(walk(u, v), True)))
    return out


def length(line):
    return sum(((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5 for a, b in zip(line, line[1:]))
