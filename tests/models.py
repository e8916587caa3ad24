"""Plain per-reading models of the detector rules, to test against."""

from dataclasses import dataclass
from itertools import groupby

@dataclass
class Limits:
    orange_min: float = 350.0
    orange_max: float = 430.0
    red_min: float = 430.0


def ema_values(values, alpha, times=None, gap=None):
    out, last, when = [], None, None
    for i, value in enumerate(values):
        restart = last is None or (gap is not None and times[i] - when > gap)
        last = value if restart else alpha * value + (1.0 - alpha) * last
        when = times[i] if times is not None else None
        out.append(last)
    return out


def cusum_values(values, allowance, times=None, gap=None):
    """Sums in millionths."""
    out, total, when = [], 0, None
    for i, value in enumerate(values):
        if when is not None and gap is not None and times[i] - when > gap:
            total = 0
        total = max(0, total + round((value - allowance) * 1e6))
        when = times[i] if times is not None else None
        out.append(total)
    return out


def fuzzy(rows, max_time, delta, limits=None, gap=None):
    """Alerts (microseconds, value, metric, name, category) for time-ordered rows.

    Fixed limits judge each row alone. For the time limits the rows are cut into runs
    of one band; inside a run a wait begins with its first row, and again with the row
    after each one that waited long enough.
    """
    limits = limits or Limits()
    # From the highest band down: its floor, its end, its fixed alert, its alert in time.
    bands = [
        (limits.red_min, None, "red", None),
        (limits.red_min - delta, limits.red_min, "orange", "red"),
        (limits.orange_min, None, "orange", None),
        (limits.orange_min - delta, limits.orange_min, None, "orange"),
    ]

    def band_of(x):
        return next((i for i, (floor, *_) in enumerate(bands) if x >= floor), len(bands))

    alerts = [
        (when, x, x, "hard_threshold", bands[band_of(x)][2])
        for when, x in rows
        if band_of(x) < len(bands) and bands[band_of(x)][2]
    ]
    pauses = [0]
    for (before, _), (when, _) in zip(rows[:-1], rows[1:], strict=True):
        pauses.append(pauses[-1] + (gap is not None and when - before > gap))
    placed = zip(rows, pauses, strict=True)
    for (band, _), run in groupby(placed, key=lambda row: (band_of(row[0][1]), row[1])):
        if band == len(bands) or bands[band][3] is None:
            continue
        floor, end, _, category = bands[band]
        # The line from the full wait at the floor to none at the limit.
        slope = (0 - max_time) / (end - floor)
        intercept = max_time - slope * floor
        run = [row for row, _ in run]
        begin = 0
        while begin < len(run):
            since = run[begin][0]
            waited = [(i, (when - since) / 1e6, when, x) for i, (when, x) in enumerate(run) if i >= begin]
            hit = next((w for w in waited if w[1] >= slope * w[3] + intercept), None)
            if hit is None:
                break
            begin = hit[0] + 1
            alerts.append((hit[2], hit[3], hit[1], f"fuzzy_zone_{category}_duration", category))
    return alerts
