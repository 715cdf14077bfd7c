"""Few links are held in few partitions, whatever the number of shuffle partitions."""

from __future__ import annotations

from rowtide.llm import components


def test_few_links_take_one_partition(spark, monkeypatch):
    seen, was = [], components.settle

    def settled(df):
        out = was(df)
        seen.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(components, "settle", settled)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(30) if i != 14], "a long, b long")
        nodes = spark.createDataFrame([(i, i) for i in range(32)], "node long, label long")
        found = {r["node"]: r["label"] for r in components.components(links, nodes).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == {i: 0 if i < 15 else 15 if i < 31 else 31 for i in range(32)}
    assert len(seen) > 2 and set(seen[1:]) == {1}
