"""Random batches against a plain model of the rules."""

import datetime as dt
import random

import pytest
from frames import rows

from loomhouse.operators import checks
from loomhouse.operators import vault as vault_operators
from loomhouse.operators.scd2 import Dimension, scd2_apply, scd2_init
from loomhouse.operators.vault import load_satellite

SPEC = Dimension("sk", "k", ("a", "b"))
OPEN = dt.date(9999, 12, 31)


def random_snapshot(rng):
    """Some keys, some NULLs, now and then a key twice."""
    keys = rng.sample(range(60), rng.randint(20, 50))
    found = [(f"k{n}", rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for n in keys]
    return found + [(k, rng.choice(["x", "z"]), 3) for k, _, _ in found[:3]]


def chosen(snapshot):
    """Greatest attributes per key, NULL least."""
    best = {}
    for k, a, b in snapshot:
        rank = ((a is not None, a or ""), (b is not None, b or 0))
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (a, b))
    return {k: v for k, (_, v) in best.items()}


def model(snapshots):
    """Versions as [sk, key, attributes, from, to]."""
    versions, last = [], 0
    for day, snapshot in snapshots:
        state = chosen(snapshot)
        current = {v[1]: v for v in versions if v[4] == OPEN}
        opened = []
        for k in sorted(state):
            if k not in current:
                opened.append((1, k))
            elif current[k][2] != state[k]:
                if current[k][3] == day:
                    current[k][2] = state[k]
                else:
                    current[k][4] = day - dt.timedelta(days=1)
                    opened.append((0, k))
        for _, k in sorted(opened):
            last += 1
            versions.append([last, k, state[k], day, OPEN])
    return versions


@pytest.mark.parametrize("seed", range(3))
def test_refreshes(spark, seed):
    rng = random.Random(seed)
    days = [dt.date(2024, 1, d) for d in (1, 5, 5, 9)]
    snapshots = [(d, random_snapshot(rng)) for d in days]
    dim = None
    for day, snapshot in snapshots:
        src = spark.createDataFrame(snapshot, "k string, a string, b int")
        dim = scd2_init(src, SPEC, day) if dim is None else scd2_apply(src, dim, SPEC, day)
    expected = [(sk, k, *attrs, low, high, high == OPEN)
                for sk, k, attrs, low, high in model(snapshots)]
    assert rows(dim) == sorted(expected, key=lambda r: tuple(
        (v is not None, str(v)) for v in r))
    assert checks.chain_breaks(dim, "k", "sk").count() == 0
    assert checks.several_current(dim, "k").count() == 0


@pytest.mark.parametrize("compare", ["any", "latest"])
@pytest.mark.parametrize("small", [0, 10**9])
def test_satellites(spark, monkeypatch, compare, small):
    """Both ways of looking up stored rows: keys broadcast, or shuffled join."""
    monkeypatch.setattr(vault_operators, "SMALL_BATCH_BYTES", small)
    rng = random.Random(7)
    stored, expected = None, []
    for n in range(3):
        batch = {k: rng.choice("xyz") for k in rng.sample(range(40), 25)}
        load_ts = f"2026-01-0{n + 1} 00:00:00"
        stg = spark.createDataFrame(list(batch.items()), "id int, v string")
        new = load_satellite(stg, "hk", ["id"], {"v": "v"}, load_ts, stored, compare=compare)
        stored = new if stored is None else stored.unionByName(new)
        for k, v in batch.items():
            known = [e for e in expected if e[0] == k]
            if compare == "latest":
                known = known[-1:]
            if (k, v) not in [(e[0], e[1]) for e in known]:
                expected.append((k, v, load_ts))
    ids = spark.range(40).selectExpr("cast(id as int) id", "md5(cast(id as string)) hk")
    got = stored.join(ids, "hk").selectExpr("id", "v", "cast(load_dts as string) t")
    assert rows(got) == sorted(expected, key=lambda r: tuple((True, str(v)) for v in r))
