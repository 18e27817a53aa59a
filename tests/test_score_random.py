"""Randomized scoring check: both Spark plans == the plain loop, over random
windows, configs, sparse metrics, constant runs and metric-less readings."""

import random

import pytest

from shopfloor import schema as S
from shopfloor.operators import score as sc
from tests.loop_oracle import score_rows

NAMES = ["temperature", "vibration", "custom", "rpm"]


def random_case(seed):
    rnd = random.Random(seed)
    window = rnd.choice([5, 9, 10, 12, 30, 60])
    cfgs = {}
    for name in rnd.sample(NAMES, 2):
        lo = rnd.choice([None, 0.0, 10.0])
        hi = rnd.choice([None, 50.0, 200.0])
        cfgs[name] = S.MetricConfig(min_value=lo, max_value=hi,
                                    zscore_threshold=rnd.choice([1.0, 2.0, 3.0]),
                                    flatline_tolerance=rnd.choice([1e-4, 0.5, 2.0]),
                                    flatline_window=rnd.choice([3, 10, 15]))
    rows = []
    for seq in range(rnd.randint(150, 400)):
        machine = f"M{rnd.randint(0, 3)}"
        metrics = {}
        for name in NAMES:
            r = rnd.random()
            if r < 0.35:
                metrics[name] = 25.0                       # constant runs -> flatline / zero std
            elif r < 0.7:
                metrics[name] = round(rnd.gauss(30, 15), 2)
            elif r < 0.75:
                metrics[name] = None                       # present but null
        rows.append((machine, seq * 3 + rnd.randint(0, 2), metrics))
    return window, cfgs, rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_cases(spark, seed):
    window, cfgs, rows = random_case(seed)
    want = score_rows(rows, window=window, configs=cfgs)
    df = spark.createDataFrame(rows, "machine_id string, seq long, metrics map<string,double>")
    for plan in (dict(), dict(segment_rows=50), dict(segment_rows=max(window, 15) + 3)):
        got = {(r.machine_id, r.seq): (r.anomaly_score, list(r.anomaly_flags))
               for r in sc.score(df, window=window, configs=cfgs, **plan).collect()}
        assert got.keys() == want.keys()
        bad = [k for k in want if abs(got[k][0] - want[k][0]) > 1e-9 or got[k][1] != want[k][1]]
        assert not bad, (plan, window, [(k, got[k], want[k]) for k in bad[:3]])
