"""The fit of the appliance signature against one that is written out state by state."""

import math
import random

import numpy as np
import pytest

from meterline.operators import signature
from meterline.operators.signature import Signature


def plain_fit(xs, c):
    """Expectation maximisation over logarithms, for one window; the log-likelihood of the result."""
    k = range(len(c.means))
    total = lambda logs: (lambda m: m + math.log(sum(math.exp(v - m) for v in logs)))(max(logs))
    variances, old = list(c.variances), None

    def pass_over():
        b = [[-0.5 * (math.log(2 * math.pi * variances[i]) + (x - c.means[i]) ** 2 / variances[i]) for i in k] for x in xs]
        ahead = [[math.log(1 / len(c.means)) + b[0][i] for i in k]]
        for row in b[1:]:
            ahead.append([row[i] + total([ahead[-1][j] + math.log(c.moves[j][i]) for j in k]) for i in k])
        return b, ahead, total(ahead[-1])

    for _ in range(c.steps):
        b, ahead, now = pass_over()
        back = [[0.0] * len(c.means)]
        for row in reversed(b[1:]):
            back.insert(0, [total([math.log(c.moves[i][j]) + row[j] + back[0][j] for j in k]) for i in k])
        weight = [[math.exp(f[i] + g[i] - now) for i in k] for f, g in zip(ahead, back, strict=True)]
        variances = [(c.prior + sum(w[i] * (x - c.means[i]) ** 2 for w, x in zip(weight, xs, strict=True))) / max(sum(w[i] for w in weight), c.least) for i in k]
        if old is not None and now - old < c.tolerance:
            break
        old = now
    return variances, pass_over()[2]


def loads(r, kind, n):
    """kWh of n hours."""
    if kind == "heater":
        return [0.02 + r.random() * 0.03 + r.choices([0, 0.6, 1.8], [60, 20, 20])[0] for _ in range(n)]
    if kind == "flat":
        return [0.5] * n
    return [abs(r.gauss(3, 4)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["heater", "flat", "house"])
def test_fit_is_the_plain_one(kind):
    r = random.Random(kind)
    c = Signature()
    windows = [[max(1.0 if b < a else b - a, 0) * 1 for a, b in zip(y, y[1:], strict=False)] for y in ([1000 * v for v in loads(r, kind, c.window)] for _ in range(6))]
    x = np.array(windows)
    got = signature.fit_variances(x, c)
    ll = signature.log_likelihood(x, got, c)
    for row, variances, value in zip(windows, got, ll, strict=True):
        want, score = plain_fit(row, c)
        assert variances.tolist() == pytest.approx(want, rel=1e-5)
        assert value == pytest.approx(score, rel=1e-7)


def test_planted_heater_is_found(spark):
    r = random.Random(7)
    rows = [(f"{kind}{k}", i, v) for kind in ("heater", "house", "flat") for k in range(5) for i, v in enumerate(loads(r, kind, 72 * 4 + 9))]
    rows += [("short", i, 1.0) for i in range(30)] + [("dirty", i, None if i % 3 else float("nan")) for i in range(80)]
    df = spark.createDataFrame(rows, "channel string, at int, kwh double").repartition(3)
    got = {x["channel"]: x for x in signature.signature_score(df, ["channel"], "at", "kwh").collect()}
    assert {k for k, x in got.items() if x["is_heater"]} == {f"heater{k}" for k in range(5)}
    assert got["heater0"]["windows"] == 4 and 300 < got["heater0"]["avg_score"] < 400
    assert (got["short"]["windows"], got["short"]["avg_score"]) == (0, 0) and got["dirty"]["windows"] == 0
    assert signature.signature_score(df.limit(0), ["channel"], "at", "kwh").collect() == []
    places = spark.createDataFrame([("heater0", 1), ("house0", 1), ("house1", 2)], "channel string, location int")
    by = {x["location"]: x["is_heater"] for x in signature.heaters_by_location(signature.signature_score(df, ["channel"], "at", "kwh"), places, "channel", ["location"]).collect()}
    assert by == {1: 1, 2: 0}


def test_windows_are_cut_as_described(spark):
    c = Signature(window=4)
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 0.1, 0.05, 0.3, 0.3, 1.0, 0.2, 0.4, 0.9])], "k string, at int, v double")
    got = {r["window"]: [round(x, 6) for x in r["xs"]] for r in signature.difference_windows(df, ["k"], "at", "v", c).collect()}
    assert got == {0: [100.0, 1.0, 250.0], 1: [700.0, 1.0, 200.0]}
