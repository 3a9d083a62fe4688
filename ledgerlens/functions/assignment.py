"""Best one-to-one assignment of a few names to others."""

from __future__ import annotations

#: Scores are compared to this many digits, so that rounding decides no tie.
DIGITS = 9


def assign(scores: list[list[float]], threshold: float) -> list[int | None]:
    """Of each row the column that it is matched with, or None.

    The matching has the greatest sum of scores, counting only pairs that reach ``threshold`` (the Hungarian method on whole
    numbers). Of equally good ones it is the first when each row in turn prefers the least column, and any column to none.
    """
    n_rows, n_cols = len(scores), len(scores[0]) if scores else 0
    # a column of its own for each row stands for no match; a preference never outweighs the last digit of a score
    places = n_cols + n_rows
    base = places + 1
    unit = base ** n_rows
    none = base ** (n_rows + 1) * 10 ** DIGITS  # dearer than any match
    cost = []
    for i, row in enumerate(scores):
        rank = base ** (n_rows - 1 - i)
        costs = [-round(s * 10 ** DIGITS) * unit + j * rank if s >= threshold else none for j, s in enumerate(row)]
        cost.append(costs + [n_cols * rank if k == i else none for k in range(n_rows)])
    return [j if j < n_cols else None for j in _least_cost(cost)]


def _least_cost(cost: list[list[int]]) -> list[int]:
    """Columns of the rows in the matching of least total cost; no more rows than columns. Rows are added one at a time
    along the cheapest alternating path under row and column prices."""
    n, m = len(cost), len(cost[0]) if cost else 0
    row_price, col_price = [0] * n, [0] * m
    row_of: list[int | None] = [None] * m
    for start in range(n):
        gap: list[int | None] = [None] * m
        came: list[int | None] = [None] * m
        done = [False] * m
        row, last = start, None
        while row is not None:
            for j in range(m):
                if not done[j]:
                    g = cost[row][j] - row_price[row] - col_price[j]
                    if last is not None:
                        g += gap[last]
                    if gap[j] is None or g < gap[j]:
                        gap[j], came[j] = g, last
            last = min((j for j in range(m) if not done[j]), key=lambda j: gap[j])
            done[last] = True
            row = row_of[last]
        # prices: columns reached before the end, and the rows matched to them, move by how much nearer they were
        far = gap[last]
        row_price[start] += far
        for j in range(m):
            if done[j] and j != last:
                row_price[row_of[j]] += far - gap[j]
                col_price[j] -= far - gap[j]
        while last is not None:
            before = came[last]
            row_of[last] = start if before is None else row_of[before]
            last = before
    out = [0] * n
    for j, r in enumerate(row_of):
        if r is not None:
            out[r] = j
    return out
