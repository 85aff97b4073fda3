"""SURVEY §5 (4): any split of the startups into micro-batches, with any batch replayed,
gives the same DAU table as the batch computation."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulse.operators import dedup, ingest
from pulse.streaming import jobs, sinks

BASE = 1_705_276_800_000
HOUR = 3_600_000

recs = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 60 * HOUR)),
                min_size=1, max_size=40, unique=True)


def parsed(spark, rows):
    lines = [(json.dumps({"type": "startup", "mid": m, "ts": BASE + t}),) for m, t in rows]
    return ingest.parse_startup(spark.createDataFrame(lines, "value string"))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=recs, cuts=st.lists(st.integers(1, 39), max_size=3, unique=True),
       replay=st.integers(0, 3))
def test_split_and_replay_invariance(spark, scratch, rows, cuts, replay):
    rows = sorted(rows, key=lambda r: r[1])  # arrival in time order
    cuts = sorted(c for c in cuts if c < len(rows))
    parts = [rows[i:j] for i, j in zip([0, *cuts], [*cuts, len(rows)])]
    table = scratch("prop")
    for bid, part in enumerate(parts):
        jobs.dau_batch(parsed(spark, part), bid, table)
    r = min(replay, len(parts) - 1)
    jobs.dau_batch(parsed(spark, parts[r]), r, table)
    got = sorted((x.mid, x.logDate, x.ts) for x in sinks.read_result(spark, table).collect())
    want = sorted((x.mid, x.logDate, x.ts)
                  for x in dedup.first_per_key(parsed(spark, rows), ["mid", "logDate"], ["ts"]).collect())
    assert got == want
