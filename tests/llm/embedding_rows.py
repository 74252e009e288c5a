"""Rows of an embeddings table for the edge cases."""

import random


def vectors():
    """(vec_id, label, embedding): nulls, odd values and lengths, ties, repeated rows, a hot label and a hot vector."""
    rng = random.Random(5)
    rows = [(i, 0 if i % 3 else rng.randrange(10), [rng.gauss(0, 0.3) for _ in range(16)]) for i in range(420)]
    rows = [(i, x, [round(v * 8) / 8 for v in e]) for i, x, e in rows]  # ties
    rows += [(500 + i, 0, rows[7][2]) for i in range(40)] + [(700 + i, 3, rows[7][2]) for i in range(40)]
    rows += [rows[200], rows[211], (None, 4, rows[0][2]), (800, None, rows[0][2]), (900, 1, None), (1000, 1, [0.1, None] * 8),
             (1001, 1, [float("nan")] * 16), (1002, 1, [float("inf")] * 16), (1100, 2, []), (1101, 2, [0.25] * 3), (1102, 0, [40000.0] * 16)]
    return rows
