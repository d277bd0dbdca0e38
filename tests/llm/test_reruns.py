"""Results that may not depend on how rows are spread over tasks."""

import random

from cellamp.llm import shards


def test_shards_of_one_key_follow_from_the_rows(spark):
    rng = random.Random(2)
    rows = [(None if k % 2 else 5, rng.choice(["copy " * 9, "x" * rng.randrange(1, 90), None, "y" * 400]), k % 3) for k in range(900)]

    def dealt(frame):
        return sorted(map(tuple, shards.assign_shards(frame, limit=300).collect()), key=repr)

    frame = spark.createDataFrame(rows, "doc_id bigint, text string, extra int")
    first = dealt(frame.coalesce(1))
    assert len(first) == len(rows) and len({r[-1] for r in first}) > 50
    assert dealt(frame.repartition(7, "text")) == first
    assert dealt(spark.createDataFrame(rows[::-1], frame.schema).repartition(3)) == first
    sizes = {}
    for *_, n_bytes, shard in first:
        sizes.setdefault(shard, []).append(n_bytes)
    assert all(sum(s) <= 300 or len(s) == 1 for s in sizes.values())
