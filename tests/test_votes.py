"""The counted vote equals the full one after any loads and reloads."""

import random

from touchline.operators import identity
from touchline.plans import votes
from touchline.sinks.store import Store


def test_counts_follow_loads_and_reloads(spark, tmp_path):
    rng, state, store = random.Random(6), {}, Store(spark, str(tmp_path / "raw"), 2000)
    schema = "combo_id string, provider string, anchor_id bigint, prov_id bigint"
    for step in range(8):
        matches = rng.sample([f"m{i}" for i in range(12)], rng.randint(1, 5))
        pairs = [(m, rng.choice(["rd", "xg"]), rng.randint(1, 4), rng.choice([7, 8, 9, None])) for m in matches if rng.random() < 0.8 for _ in range(rng.randint(1, 5))]
        state.update({m: [p[1:] for p in pairs if p[0] == m] for m in matches})
        votes.count_matches(store, spark.createDataFrame([(m,) for m in matches], "combo_id string"), spark.createDataFrame(pairs, schema))
        if step == 4:
            store.compact(votes.COUNTS)
            store.compact(votes.PAIRS)
    full = spark.createDataFrame([p for found in state.values() for p in found], "provider string, anchor_id bigint, prov_id bigint")
    for provider in ("rd", "xg"):
        counted = store.read(votes.COUNTS).filter(f"provider = '{provider}' and votes > 0")
        expected = identity.vote(full.filter(f"provider = '{provider}'"))
        assert sorted(map(tuple, identity.winners(counted).collect())) == sorted(map(tuple, expected.collect()))
    assert store.read(votes.COUNTS).filter("votes < 0").count() == 0
