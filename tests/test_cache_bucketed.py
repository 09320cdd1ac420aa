"""The vector cache and the bucketed target."""

from pyspark.sql import functions as F

from shelfsync.operators.cache import CachedEmbedder, VectorCache
from shelfsync.operators.embed import hashing_embedder
from shelfsync.operators.merge import merge_products
from shelfsync.schema import UPDATE_COLUMNS
from shelfsync.sources.bucketed import BucketedTable


def rows(spark, texts, status="new"):
    return spark.createDataFrame([(str(i), t, status) for i, t in enumerate(texts)], "id string, embed_text string, status string")


def test_a_text_is_embedded_once(spark, tmp_path):
    called = spark.sparkContext.accumulator(0)
    plain = hashing_embedder(8)

    def fn(texts):
        called.add(len(texts))
        if any("bad" in t for t in texts):
            raise RuntimeError("no answer")
        return plain(texts)

    def run(texts, model="m"):
        cache = VectorCache(spark, str(tmp_path / "cache"), model)
        out = CachedEmbedder(fn, cache, batch_size=1).apply(rows(spark, texts)).collect()
        return {r.embed_text: (r.cached, r.embedding and list(r.embedding), r.embed_error) for r in out}, len(out)

    first, n = run(["a", "b", "a", "bad"])
    assert n == 4 and called.value == 3
    assert first["a"][:2] == (False, [float(x) for x in plain(["a"])[0]]) and first["bad"][1] is None and "no answer" in first["bad"][2]
    second, n = run(["a", "b", "c", "bad"])                 # the failed text is asked for again, the known ones are not
    assert called.value == 5 and (second["a"][0], second["c"][0], second["bad"][0]) == (True, False, False)
    assert second["a"][1] == first["a"][1]
    run(["a"], model="other")                               # another model has vectors of its own
    assert called.value == 6
    other = CachedEmbedder(fn, VectorCache(spark, str(tmp_path / "cache"), "m")).apply(rows(spark, ["zz"], "changed")).first()
    assert other.embedding is None and other.cached is None and called.value == 6
    cache = VectorCache(spark, str(tmp_path / "cache"), "m")
    cache.add(cache.read())                                 # two runs that embedded the same texts at once
    assert cache.read().count() == 3


def products(spark, n, price):
    base = spark.range(n).select(F.lit("w").alias("workspace_id"), F.col("id").cast("string").alias("id"))
    typed = {"price": F.lit(price), "promotion_price": F.lit(None).cast("double"), "stock": F.lit(1),
             "need_prescription": F.lit(False), "promotion_start": F.lit(None).cast("timestamp_ntz"),
             "promotion_end": F.lit(None).cast("timestamp_ntz")}
    return base.select("*", *[typed.get(c, F.lit("x")).alias(c) for c in UPDATE_COLUMNS],
                       F.array(F.lit(1.0).cast("float")).alias("embedding"))


def test_bucketed_merge_shuffles_only_the_changes(spark, tmp_path):
    table = BucketedTable.create(products(spark, 500, 1.0), str(tmp_path), 4)
    changes = products(spark, 600, 2.0).filter(F.col("id").cast("int") % 3 == 0).withColumn(
        "action", F.when(F.col("id").cast("int") % 2 == 0, "upsert").otherwise("update"))
    changes.write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.merged(changes)._jdf.queryExecution().executedPlan().toString()
        after = table.merge(changes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1, plan
    scan = plan.index("FileScan")
    assert plan.rindex("Exchange") > scan and "Bucketed: true" in plan      # the one exchange is the changes' own
    expect = merge_products(table.read(), changes)
    cols = expect.columns
    assert sorted(map(str, after.read().select(*cols).collect())) == sorted(map(str, expect.collect()))
    again = after.merged(changes)._jdf.queryExecution().executedPlan().toString()
    assert again.count("Exchange") == 1                                      # the merged version is bucketed too
    for t in (table, after):
        t.drop()
