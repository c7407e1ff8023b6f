"""The word-mover distance of two bags: the least cost of moving the weights of one to the words of the other."""

import numpy as np

#: Weights below this are rounding.
DUST = 1e-12


def _nearest(cost, u, v, flow, a, b):
    """Distances of rows and columns from the rows with weight left, parents, and the first column that takes some."""
    rows, columns = np.where(a > DUST, 0.0, np.inf), np.full(len(b), np.inf)
    from_row, from_column = np.full(len(b), -1), np.full(len(a), -1)
    open_rows, open_columns = np.ones(len(a), bool), np.ones(len(b), bool)
    while True:
        i = np.where(open_rows, rows, np.inf).argmin()
        j = np.where(open_columns, columns, np.inf).argmin()
        row, column = rows[i] if open_rows[i] else np.inf, columns[j] if open_columns[j] else np.inf
        if row <= column:
            open_rows[i] = False
            there = np.maximum(row, row + cost[i] - u[i] - v)
            better = open_columns & (there < columns)
            columns[better], from_row[better] = there[better], i
        elif b[j] > DUST:
            return rows, columns, from_row, from_column, j
        else:
            # back along a flow, which costs nothing at these potentials
            open_columns[j] = False
            better = open_rows & (flow[:, j] > DUST) & (column < rows)
            rows[better], from_column[better] = column, j


def plan(a, b, cost):
    """The flow of least cost from weights ``a`` to weights ``b`` of the same sum, by successive shortest paths."""
    a, b = np.array(a, float), np.array(b, float)
    flow, u, v = np.zeros(cost.shape), np.zeros(len(a)), cost.min(axis=0)
    while (a > DUST).any() and (b > DUST).any():
        rows, columns, from_row, from_column, last = _nearest(cost, u, v, flow, a, b)
        length = columns[last]
        u += length - np.minimum(rows, length)
        v -= length - np.minimum(columns, length)
        path, j = [], last
        while True:
            i = from_row[j]
            path.append((i, j, 1))
            if from_column[i] < 0:
                break
            j = from_column[i]
            path.append((i, j, -1))
        amount = min([a[i], b[last]] + [flow[r, c] for r, c, sign in path if sign < 0])
        for r, c, sign in path:
            flow[r, c] += sign * amount
        a[i] -= amount
        b[last] -= amount
    return flow


def mover_distance(weights_a, vectors_a, weights_b, vectors_b):
    """Word-mover distance of two bags given as weights that add up to one and a vector for each word."""
    a, b = np.stack(vectors_a).astype(float), np.stack(vectors_b).astype(float)
    cost = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return float((plan(weights_a, weights_b, cost) * cost).sum())
