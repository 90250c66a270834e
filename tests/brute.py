"""Plain Python versions to compare with; small fixtures only."""

import hashlib

import numpy as np


def bucket(image):
    return int(hashlib.md5(image.encode()).hexdigest()[:8], 16) % 100


def side_of(task, label):
    """Label of a row inside a task, or None when the row is not part of it."""
    if task["kind"] == "1vsAll":
        return label if label == task["class1"] else "All"
    return label if label in (task["class1"], task["class2"]) else None


def label_order(rows, task, cut):
    counts = {}
    for label, _, image in rows:
        side = side_of(task, label)
        if side is not None and bucket(image) < cut:
            counts[side] = counts.get(side, 0) + 1
    return sorted(counts, key=lambda side: (-counts[side], side))


def descend(rows, task, cut, limit, step=1.0, reg=0.01, tolerance=0.001):
    """Weights after ``limit`` iterations of one task, and the iterations run."""
    order = label_order(rows, task, cut)
    chosen = [(side_of(task, l), x) for l, x, image in rows if side_of(task, l) is not None and bucket(image) < cut]
    x = np.array([v for _, v in chosen])
    s = np.array([2.0 * order.index(side) - 1 for side, _ in chosen])
    w = np.zeros(x.shape[1])
    for i in range(1, limit + 1):
        eta = step / np.sqrt(i)
        active = s * (x @ w) < 1
        moved = w * (1 - eta * reg) + eta / len(x) * (s[active, None] * x[active]).sum(axis=0)
        change = np.linalg.norm(moved - w)
        w = moved
        if i > 1 and change < tolerance * max(np.linalg.norm(w), 1.0):
            return w, i
    return w, limit
