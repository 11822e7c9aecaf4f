"""The semantics by definition, over small lists of record rows: nothing is carried from step to step."""

from __future__ import annotations

from fractions import Fraction
from functools import lru_cache

MINUTE = 60_000_000
CLUSTER, ID, BATCH, TS, _, METRICS, FILE, ENTRY = range(8)


def window(checked, records, at):
    """(holds, records, records with the metric, aggregate): every record is looked at."""
    inside = sorted((r for r in records if 0 <= at - r[TS] < checked.window_minutes * MINUTE), key=lambda r: (r[TS], r[BATCH], r[ID]))
    values = [r[METRICS][checked.metric] for r in inside if checked.metric in r[METRICS]]
    if len(values) < checked.min_batches:
        return False, len(inside), len(values), None
    value = {
        "avg": lambda: float(sum(map(Fraction, values)) / len(values)),
        "max": lambda: max(values),
        "min": lambda: min(values),
        "last": lambda: values[-1],
    }[checked.aggregation]()
    return (value > checked.threshold) if checked.operator == "gt" else (value < checked.threshold), len(inside), len(values), value


def first_copies(records):
    best = {}
    for r in sorted(records, key=lambda r: (r[FILE], r[ENTRY])):
        best.setdefault((r[CLUSTER], r[ID], r[BATCH]), r)
    return sorted(best.values(), key=lambda r: (r[TS], r[BATCH], r[ID]))


def outcomes(times_and_rules, rules, workers, last=None):
    """Per matched point ``(workers, time of the last decision, outcome)``.

    Asked for any point, the last decision before it is searched for among all points before it.
    """
    points = list(times_and_rules)

    @lru_cache(None)
    def before(i):
        made = [j for j in range(i) if outcome(j) == "decision"] if i else []
        return (rules[points[made[-1]][1]].target_workers, points[made[-1]][0]) if made else (workers, last)

    @lru_cache(None)
    def outcome(i):
        at, r = points[i]
        now, since = before(i)
        passed = since is None or at - since >= rules[r].cooldown_minutes * MINUTE
        return "blocked_idempotence" if rules[r].target_workers == now else "decision" if passed else "blocked_cooldown"

    return [(*before(i), outcome(i)) for i in range(len(points))]


def walk(records, rules, workers):
    """Per matched record of one cluster: batch, rule, state before, outcome."""
    ordered = first_copies(records)
    matched = [(r, next((k for k, x in enumerate(rules) if window(x, ordered, r[TS])[0]), None)) for r in ordered]
    matched = [(r, k) for r, k in matched if k is not None]
    found = outcomes([(r[TS], k) for r, k in matched], rules, workers)
    return [(r[BATCH], rules[k].name, *state) for (r, k), state in zip(matched, found)]
