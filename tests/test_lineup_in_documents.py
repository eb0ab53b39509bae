"""Elevens out of whole documents equal those of joined tables."""

import random

from creaseline.operators import lineup, silver
from tests.test_tables_that_grow import SWAPPED, as_bronze, ball, document


def drawn(rng):
    """A document of two or three innings in which few or many replacements of all kinds fall, some without a team or a name."""
    squads = {"T1": [f"A{k}" for k in range(rng.randint(0, 5))], "T2": [f"B{k}" for k in range(rng.randint(1, 5))]}
    who = lambda p: f"{p}{rng.randrange(7)}"

    def swaps():
        if rng.random() < 0.6:
            return None
        one = lambda: {k: v for k, v in {"team": rng.choice(["T1", "T2", "T3", None]), "in": rng.choice([who("A"), who("B"), None]), "out": rng.choice([who("A"), who("B"), None]), "reason": "injury"}.items() if v}
        return {"match": [one() for _ in range(rng.randint(1, 3))], "role": [{"in": who("B"), "out": who("B"), "role": "bowler"}]}

    over = lambda o: {"over": o, "deliveries": [ball(who("A"), who("B"), **({"replacements": s} if (s := swaps()) else {})) for _ in range(rng.randint(0, 3))]}
    innings = [{"team": rng.choice(["T1", "T2", "T3"]), **({"overs": [over(o) for o in range(rng.randint(0, 4))]} if rng.random() < 0.9 else {})} for _ in range(rng.randint(1, 3))]
    return document(players=squads, innings=innings)


def test_elevens_in_documents_equal_joined_ones(spark):
    rng = random.Random(11)
    plain = document(players={"T1": ["A"]}, innings=[{"team": "T1", "overs": [{"over": 0, "deliveries": [ball("A", "X")]}]}])
    docs = {"m": SWAPPED, "plain": plain} | {str(k): drawn(rng) for k in range(60)}
    bronze = as_bronze(spark, docs).localCheckpoint()
    parsed = silver.parse(bronze).cache()
    versions = lineup.elevens(lineup.stints(silver.players(parsed), silver.replacements(parsed)))
    want = lineup.active(lineup.sides(silver.deliveries(parsed), silver.innings(parsed), silver.matches(parsed)), versions)
    for got in (lineup.active_in_documents(silver.parse_lineup(bronze)), lineup.active_in_documents(parsed)):
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = lineup.active_in_documents(silver.parse_lineup(bronze))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("from_json") == 1
    assert len({r.batting_version for r in want.collect()}) > 3
    parsed.unpersist()
