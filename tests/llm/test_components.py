"""Connected components: rounds of few links have few tasks, whatever the shuffle's partitions."""

from learner_scoring.llm import components


def test_rounds_go_by_the_links_not_by_the_shuffle(spark, monkeypatch):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    rows = [(i, i + 1) for i in range(100, 140)] + [(i, 500) for i in range(300, 340)] + [(7, 7), (9, 8), (8, 9)]
    want = {i: 100 for i in range(100, 141)} | {i: 300 for i in (*range(300, 340), 500)} | {8: 8, 9: 8}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame(rows, "a long, b long")
        out = components.connected(links)
        assert dict(map(tuple, out.collect())) == want
        assert out.rdd.getNumPartitions() <= components.LEAST_TASKS
        monkeypatch.setattr(components, "BROADCAST_ROWS", 5)  # many roots: joined by shuffle
        assert dict(map(tuple, components.connected(links).collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
