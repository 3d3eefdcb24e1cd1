"""Graph questions about numbered edges within one task: components, levels and meeting times (numpy only).

``graph.py`` asks them once a graph, or a part of it, is small enough; memory is a small multiple of the edges given.
Nothing here imports the package: the functions travel to the executors by value.
"""

import numpy as np

ROUNDS = 60
NARROW = 16


def dense(*ends):
    """(numbers in ascending order, one array of places in them per array given)."""
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    return nodes, np.split(at, np.cumsum([len(x) for x in ends])[:-1])


def starts(n, keys):
    return np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=n))))


def trimmed(n, x, y):
    """Edges left when ends that are no start, or no end, of another edge have gone, a large share at a time."""
    while True:
        out, in_ = np.zeros(n, bool), np.zeros(n, bool)
        out[x] = True
        in_[y] = True
        keep = in_[x] & out[y]
        more = len(x) - np.count_nonzero(keep)
        x, y = x[keep], y[keep]
        if more <= 0.02 * (len(x) + more):
            return x, y


def least_reaching(n, x, y):
    """The smallest node that reaches each node along x -> y, or None when that takes too many rounds."""
    order = np.argsort(y, kind="stable")
    x, y = x[order], y[order]
    first = np.flatnonzero(np.concatenate(([True], y[1:] != y[:-1])))
    ends, c = y[first], np.arange(n)
    for _ in range(ROUNDS):
        new = c.copy()
        new[ends] = np.minimum(c[ends], np.minimum.reduceat(c[x], first))
        new = np.minimum(new, new[new])  # what reaches my colour reaches me
        if np.array_equal(new, c):
            return c
        c = new
    return None


def walked(n, x, y, label):
    """Tarjan's walk over the edges x -> y, for what colours take too long for: one label per component."""
    order = np.argsort(x, kind="stable")
    to, at = y[order], starts(n, x).tolist()
    index, low, on, stack, count = [0] * n, [0] * n, bytearray(n), [], 0
    for root in np.unique(x).tolist():
        if index[root]:
            continue
        work = [(root, iter(to[at[root]:at[root + 1]].tolist()))]
        count += 1
        index[root] = low[root] = count
        stack.append(root)
        on[root] = 1
        while work:
            v, rest = work[-1]
            for w in rest:
                if not index[w]:
                    count += 1
                    index[w] = low[w] = count
                    stack.append(w)
                    on[w] = 1
                    work.append((w, iter(to[at[w]:at[w + 1]].tolist())))
                    break
                if on[w] and index[w] < low[v]:
                    low[v] = index[w]
            else:
                work.pop()
                if work and low[v] < low[work[-1][0]]:
                    low[work[-1][0]] = low[v]
                if low[v] == index[v]:
                    while True:
                        w = stack.pop()
                        on[w] = 0
                        label[w] = v
                        if w == v:
                            break


def components(n, x, y):
    """For each of the nodes 0 .. n - 1, a node that stands for its strongly connected component. The colours of
    ``graph._components``, with nodes of many edges first; what they do not settle in a few turns is walked."""
    label = np.arange(n)
    x, y = trimmed(n, *(a[x != y] for a in (x, y)))
    if not len(x):
        return label
    # nodes of many edges get the smallest numbers: they reach, and are reached from, the most
    weight = np.bincount(x, minlength=n).astype("f8") * np.bincount(y, minlength=n)
    named = np.argsort(-weight, kind="stable")
    number = np.empty(n, "i8")
    number[named] = np.arange(n)
    x, y, found = number[x], number[y], np.arange(n)
    for _ in range(6):
        c = least_reaching(n, x, y)
        if c is None:
            break
        keep = c[x] == c[y]
        x, y = x[keep], y[keep]
        if not len(x):
            break
        b = least_reaching(n, y, x)
        if b is None:
            break
        done = b == c
        found[x], found[y] = np.where(done[x], c[x], found[x]), np.where(done[y], c[y], found[y])
        keep = ~done[x] & ~done[y] & (b[x] == b[y])
        x, y = trimmed(n, x[keep], y[keep])
        if not len(x):
            break
    if len(x):
        walked(n, x, y, found)
    label[named] = named[found]
    return label


def least_of(label):
    """The smallest node of each component in place of the one that stands for it."""
    low = np.full(len(label), len(label))
    order = np.arange(len(label) - 1, -1, -1)
    low[label[order]] = order  # the smallest node is written last
    return low[label]


def levels(n, child, parent):
    """Longest path of each node to one without parents; -1 on and behind cycles."""
    open_, at = np.bincount(child, minlength=n), starts(n, parent)
    kids = child[np.argsort(parent, kind="stable")]
    level, front, deep = np.full(n, -1), np.flatnonzero(open_ == 0), 0
    while len(front):
        level[front] = deep
        deep += 1
        if len(front) <= NARROW:
            freed = []
            for v in front.tolist():
                for k in kids[at[v]:at[v + 1]].tolist():
                    open_[k] -= 1
                    if not open_[k]:
                        freed.append(k)
            front = np.array(freed, "i8")
            continue
        many = at[front + 1] - at[front]
        before = np.cumsum(many) - many
        k, times = np.unique(kids[np.repeat(at[front] - before, many) + np.arange(many.sum())], return_counts=True)
        open_[k] -= times
        front = k[open_[k] == 0]
    return level


def meeting(lo, x, y, t):
    """Which edges appear (time ``t``) at the very time their ends come into one component. Edges of one part share ``lo``,
    the time before it; parts have no node in common. An edge with t <= lo is there all the time, and all
    ends meet before the next part begins. Halving as in ``graph.break_cycles``, for all parts at once."""
    times = np.unique(t[t > lo])
    hit = np.zeros(len(x), bool)
    if not len(times):
        return hit
    t = np.where(t > lo, np.searchsorted(times, t) + 1, 0)
    lo = np.searchsorted(times, lo, side="right")
    last = np.zeros(len(times) + 1, "i8")
    np.maximum.at(last, lo, t)
    hi, edge = last[lo], np.arange(len(x))
    nodes, (x, y) = dense(x, y)
    nodes, (x, y) = dense(lo * len(nodes) + x, lo * len(nodes) + y)
    n = len(nodes)
    while True:
        hit[edge[(t == hi) & (hi - lo == 1)]] = True
        fresh = np.zeros(len(times) + 1, bool)
        fresh[lo[t > lo]] = True  # the other parts have nothing to find
        keep = fresh[lo] & (hi - lo > 1)
        x, y, t, lo, hi, edge = (a[keep] for a in (x, y, t, lo, hi, edge))
        if not len(x):
            return hit
        mid = (lo + hi) // 2
        early = t <= mid
        label = components(n, x[early], y[early])
        met = early & (label[x] == label[y])
        # those that have met go on among the same nodes, the others between the components at the cut
        lo, hi = np.where(met, lo, mid), np.where(met, mid, hi)
        x, y = np.where(met, x, n + label[x]), np.where(met, y, n + label[y])
        used = np.zeros(2 * n, bool)
        used[x] = used[y] = True
        number = np.cumsum(used) - 1
        x, y, n = number[x], number[y], int(number[-1]) + 1
