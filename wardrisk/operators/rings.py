"""The one step in Python: putting the ways of a boundary in order.

Each choice depends on the ways used so far, which no column expression can say.  The
module is sent to the executors with the job, so they need no copy of this package.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINKS = "relation_id long, way_no long, ring long, part long, side long, flipped boolean, closed boolean"


def link_ways(ways, tolerance: float = 1e-7):
    """Order the ways of one relation into rings, from their end points alone.

    ``ways`` lists ``(way_no, start, end)`` in order.  A ring starts with the first free
    way.  It grows by the first free way that fits: at the ring's end (as it is or turned
    round) or else at its start.  Returns ``(way_no, ring, part, side, flipped, closed)``
    rows; ``side`` tells whether the way joined after (1) or before (-1) the first one.
    """
    def cell(p):
        return round(p[0] / tolerance), round(p[1] / tolerance)

    def near(p, q):
        return abs(p[0] - q[0]) < tolerance and abs(p[1] - q[1]) < tolerance

    grid: dict = {}
    for i, (_, a, b) in enumerate(ways):
        for c in {cell(a), cell(b)}:
            grid.setdefault(c, []).append(i)
    free = [True] * len(ways)

    def touching(p):
        x, y = cell(p)
        for c in ((x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)):
            for i in grid.get(c, ()):
                if free[i] and (near(p, ways[i][1]) or near(p, ways[i][2])):
                    yield i

    rows, ring = [], 0
    for first in range(len(ways)):
        if not free[first]:
            continue
        free[first] = False
        after, before = [(first, 0, False)], []
        _, head, tail = ways[first]
        while not near(head, tail):
            i = min(min(touching(tail), default=len(ways)), min(touching(head), default=len(ways)))
            if i == len(ways):
                break
            _, a, b = ways[i]
            free[i] = False
            if near(tail, a):
                after.append((i, 1, False))
                tail = b
            elif near(tail, b):
                after.append((i, 1, True))
                tail = a
            elif near(head, b):
                before.append((i, -1, False))
                head = a
            else:
                before.append((i, -1, True))
                head = b
        closed = near(head, tail)
        rows += [(ways[i][0], ring, part, side, flipped, closed)
                 for part, (i, side, flipped) in enumerate(before[::-1] + after)]
        ring += 1
    return rows


def link_partition(batches, tolerance: float):
    """Link the relations of one sorted partition, which arrive one after the other."""
    def flush(relation, ways):
        return [(relation, *row) for row in link_ways(ways, tolerance)]

    columns = ["relation_id", "way_no", "ring", "part", "side", "flipped", "closed"]
    relation, ways, rows = None, [], []
    for pdf in batches:
        for r, w, x0, y0, x1, y1 in zip(*(pdf[c].tolist() for c in ("relation_id", "way_no", "x0", "y0", "x1", "y1"))):
            if r != relation:
                rows += flush(relation, ways)
                relation, ways = r, []
            ways.append((w, (x0, y0), (x1, y1)))
        if rows:
            yield pd.DataFrame(rows, columns=columns)
            rows = []
    rows += flush(relation, ways)
    if rows:
        yield pd.DataFrame(rows, columns=columns)
