"""Labels of least total cost by a minimum cut."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence


def min_cut(keep_cost: Sequence[float], drop_cost: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """For each node, whether it is kept in the cheapest labelling (a tie is dropped).

    Keeping node i costs ``keep_cost[i]``, dropping it ``drop_cost[i]``, and each
    edge ``(i, j, w)`` costs w if its ends differ.  The source holds kept nodes:
    its arc to i has the capacity ``drop_cost[i]``, the arc from i to the sink
    ``keep_cost[i]``, and edges carry flow both ways.  A node whose own costs
    outweigh all its edges has its label in every cheapest labelling; such nodes
    are settled first and lend their edges to their neighbours' costs.
    """
    n = len(keep_cost)
    keep, drop = list(map(float, keep_cost)), list(map(float, drop_cost))
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if i != j and w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    weight = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(drop[i] - keep[i]) <= weight[i] + 1e-12:
            continue
        label[i] = drop[i] > keep[i]
        for j, w in near[i].items():
            if label[j] is None:
                if label[i]:
                    drop[j] += w
                else:
                    keep[j] += w
                weight[j] -= w
                todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        arcs = [(number[i], number[j], w) for i in rest for j, w in near[i].items() if i < j and j in number]
        for i, kept in zip(rest, _max_flow(len(rest), [keep[i] for i in rest], [drop[i] for i in rest], arcs)):
            label[i] = kept
    return [bool(x) for x in label]


def _max_flow(n: int, keep: list[float], drop: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side after a maximum flow (blocking flows on level graphs)."""
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        arc(source, i, drop[i], 0.0)
        arc(i, sink, keep[i], 0.0)
    for i, j, w in edges:
        arc(i, j, w, w)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                v = to[path[cut] ^ 1]
                del path[cut:]
            elif nxt[v] < len(out[v]):
                e = out[v][nxt[v]]
                if room[e] > tiny and level[to[e]] == level[v] + 1:
                    path.append(e)
                    v = to[e]
                else:
                    nxt[v] += 1
            elif v == source:
                break
            else:
                v = to[path.pop() ^ 1]
                nxt[v] += 1
