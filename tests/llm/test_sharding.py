from collections import Counter

from pyspark.sql import functions as F

from ratecraft.llm.sharding import Shard, descend, op6_sharding, regular_tree, shard_rows

SF = "/root/testdata/sf0.001"


def test_query_keeps_the_key_law(spark):
    rows = op6_sharding(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    import zlib
    assert len(rows) == len(docs)
    slots = {}
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
        assert 0 <= r["shard"] < 40 and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_growth_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    before = {r["doc_id"]: r["shard"] for r in descend(ids, "doc_id", regular_tree(7)).collect()}
    for n in (8, 9):
        after = {r["doc_id"]: r["shard"] for r in descend(ids, "doc_id", regular_tree(n)).collect()}
        moved = [k for k in before if before[k] != after[k]]
        assert moved and all(after[k] == n - 1 for k in moved)
        before = after


def test_weights_rule_the_shares_and_movement_stays_in_changed_subtrees(spark):
    tree = [Shard(0, 0, 0, 1), Shard(0, 0, 1, 3), Shard(1, 1, 2, 2), Shard(1, 2, 3, 2), Shard(1, 2, 4, 0)]
    ids = spark.range(8000).withColumnRenamed("id", "doc_id")
    got = {r["doc_id"]: r for r in descend(ids, "doc_id", tree).collect()}
    share = Counter(r["shard"] for r in got.values())
    for leaf in tree:
        assert abs(share[leaf.shard] / 8000 - leaf.weight / 8) < 0.02
    for r in got.values():
        leaf = next(x for x in tree if x.shard == r["shard"])
        assert (r["region"], r["rack"]) == (leaf.region, leaf.rack)
    heavier = tree[:3] + [Shard(1, 2, 3, 4)]
    after = {r["doc_id"]: r["shard"] for r in descend(ids, "doc_id", heavier).collect()}
    assert {after[k] for k in got if after[k] != got[k]["shard"]} == {3}


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, ""), (2, "x" * 100000)], "doc_id long, shard string")
    out = shard_rows(rows, "doc_id", regular_tree(4))
    got = out.collect()
    assert len(got) == 5 and out.columns == ["doc_id", "region", "rack", "shard", "slot", "grown_shard"]
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert shard_rows(rows.where(F.lit(False)), "doc_id", regular_tree(4)).count() == 0


def test_plan_is_native(spark):
    plan = op6_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
