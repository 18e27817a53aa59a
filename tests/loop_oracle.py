"""Slow scoring oracle for tests: each (machine, metric) sequence as a numpy
array, with all its look-back windows cut out at once."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from shopfloor import schema as S


def _signals(values: np.ndarray, window: int, cfg) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """(rows that raise it, score of each row, flag) for every signal of one sequence."""
    n = len(values)
    past = np.array([np.pad(values[max(0, i - window):i], (window - min(i, window), 0), constant_values=np.nan)
                     for i in range(n)]).reshape(n, window)
    known = (~np.isnan(past)).sum(1)
    enough = known >= S.ZSCORE_MIN_VALUES
    z = np.zeros(n)
    if enough.any():
        mean, std = np.nanmean(past[enough], 1), np.nanstd(past[enough], 1)
        z[enough] = np.abs(values[enough] - mean) / np.where(std < S.ZERO_STD, 1.0, std)
    low = values < (-np.inf if cfg.min_value is None else cfg.min_value)
    high = values > (np.inf if cfg.max_value is None else cfg.max_value)
    limit = cfg.zscore_threshold
    spike = z > limit * S.SPIKE_FACTOR
    last = cfg.flatline_window
    flat = np.zeros(n, bool)
    if last <= window and n >= last:
        seen = np.lib.stride_tricks.sliding_window_view(values, last)
        flat[last - 1:] = np.ptp(seen, axis=1) < cfg.flatline_tolerance
    return [
        (low | high, np.where(low, S.OUT_OF_RANGE_LOW_SCORE, S.OUT_OF_RANGE_HIGH_SCORE), "OUT_OF_RANGE"),
        (spike, np.minimum(1.0, z / (limit * S.SPIKE_SCALE)), "SPIKE"),
        ((z > limit) & ~spike, np.minimum(S.DRIFT_CAP, z / (limit * S.DRIFT_SCALE)), "DRIFT"),
        (flat, np.full(n, S.FLATLINE_SCORE), "FLATLINE"),
    ]


def score_rows(rows, window=S.DEFAULT_WINDOW, configs=None):
    """rows: iterable of (machine_id, seq, {metric: value}) in any order.
    Returns {(machine_id, seq): (score, sorted_flags)}."""
    found = {(machine, seq): (0.0, set()) for machine, seq, _ in rows}
    sequences = defaultdict(list)
    for machine, seq, metrics in rows:
        for name, value in (metrics or {}).items():
            if value is not None:
                sequences[machine, name].append((seq, float(value)))
    for (machine, name), points in sequences.items():
        order, values = zip(*sorted(points), strict=True)
        cfg = (configs or S.DEFAULT_METRIC_CONFIGS).get(name, S.DEFAULT_METRIC_CONFIG)
        for raised, scores, flag in _signals(np.array(values), window, cfg):
            for i in np.flatnonzero(raised):
                score, flags = found[machine, order[i]]
                found[machine, order[i]] = (max(score, float(scores[i])), flags | {flag})
    return {k: (round(score, 4), sorted(flags)) for k, (score, flags) in found.items()}
