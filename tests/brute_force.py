"""Decision tree by recursion over plain Python rows: the rules, with no shortcuts."""

from __future__ import annotations

import math
from collections import Counter


def impurity(labels, criterion):
    n = len(labels)
    if n == 0:
        return 0.0
    shares = [c / n for c in Counter(labels).values()]
    if criterion == "gini":
        return 1 - sum(p * p for p in shares)
    return -sum(p * math.log2(p) for p in shares)


def kinds(rows, features, limit=15):
    result = {}
    for f in features:
        seen = {r[f] for r in rows}
        text = any(isinstance(v, str) for v in seen)
        result[f] = "categorical" if text or len(seen) <= limit else "continuous"
    return result


def says_yes(value, question_value, kind):
    if value is None:
        return False
    return value <= question_value if kind == "continuous" else value == question_value


def leaf(rows, label):
    counts = Counter(r[label] for r in rows)
    return str(min(counts, key=lambda v: (-counts[v], v)))


def grow(rows, features, label, max_depth=5, min_samples=2, criterion="entropy", depth=0, types=None):
    types = types or kinds(rows, features)
    at_end = max_depth is not None and depth == max_depth
    if len({r[label] for r in rows}) == 1 or len(rows) < min_samples or at_end:
        return leaf(rows, label)
    best = None
    for position, f in enumerate(features):
        for value in sorted({r[f] for r in rows if r[f] is not None}):
            yes = [r[label] for r in rows if says_yes(r[f], value, types[f])]
            no = [r[label] for r in rows if not says_yes(r[f], value, types[f])]
            weighted = (
                len(yes) * impurity(yes, criterion) + len(no) * impurity(no, criterion)
            ) / len(rows)
            rank = (-round(weighted, 10) + 0.0, position, value)
            if best is None or rank[0] > best[0][0] or (
                rank[0] == best[0][0] and rank[1:] >= best[0][1:]
            ):
                best = (rank, f, value)
    if best is None:
        return leaf(rows, label)
    _, f, value = best
    yes = [r for r in rows if says_yes(r[f], value, types[f])]
    no = [r for r in rows if not says_yes(r[f], value, types[f])]
    if not yes or not no:
        return leaf(rows, label)
    shown = float(value) if not isinstance(value, str) else value
    question = f"{f} {'<=' if types[f] == 'continuous' else '='} {shown}"
    answers = [
        grow(side, features, label, max_depth, min_samples, criterion, depth + 1, types)
        for side in (yes, no)
    ]
    return answers[0] if answers[0] == answers[1] else {question: answers}


def score(row, tree, types):
    while isinstance(tree, dict):
        question, answers = next(iter(tree.items()))
        f, op, value = question.split(" ", 2)
        held = row[f]
        if op == "<=":
            yes = held is not None and held <= float(value)
        elif isinstance(held, str):
            yes = held == value
        else:
            yes = held is not None and held == float(value)
        tree = answers[0] if yes else answers[1]
    return tree
