"""Title lookup through a client, embedding batches, exact cents."""

import datetime as dt

from pyspark.sql import functions as F

from shelfsync.config import ColumnMapping
from shelfsync.operators import embed, enrich
from shelfsync.operators.normalize import normalize
from shelfsync.sources.scan import keyed_source


def test_fetch_pages_client_errors_become_null(spark):
    codes = spark.createDataFrame([("1",), ("2",), ("2",), ("3",), (None,)], "code string")

    def fetch(code):
        if code == "3":
            raise TimeoutError("slow site")
        return f"URL: x\nTitle: EAN 123 - Product {code} - Go-UPC\n"

    pages = enrich.fetch_pages(codes, fetch, concurrency=2)
    assert pages.rdd.getNumPartitions() == 2
    titles = {r.code: r.title for r in enrich.title_table(pages).collect()}
    assert titles == {"1": "Product 1", "2": "Product 2"}


def test_enrich_only_new_rows(spark):
    rows = spark.createDataFrame([("1", "new", "a", "A"), ("2", "changed", "b", "B"), ("3", "new", "z", "Z")],
                                 "id string, status string, code string, display_name string")
    titles = spark.createDataFrame([("a", "Title A"), ("b", "Title B")], "code string, title string")
    got = {r.id: (r.display_name, r.title) for r in enrich.enrich_titles(rows, titles).collect()}
    assert got == {"1": ("Title A", "Title A"), "2": ("B", None), "3": ("Z", None)}


def test_embed_batches_and_short_replies(spark):
    rows = spark.createDataFrame([(str(i), "new", f"text {i % 4}", "") for i in range(20)] +
                                 [("99", "changed", "text 1", "")],
                                 "id string, status string, display_name string, description string")
    sizes = []

    def short(texts):
        sizes.append(len(texts))
        return [[1.0, 0.0]] * (len(texts) - 1)   # one vector short per call

    out = embed.with_action(embed.embed_with_function(rows, short, batch_size=3))
    got = {r.id: (r.action, r.embedding is None) for r in out.collect()}
    assert got["99"] == ("update", True)
    assert sum(a == "upsert" for a, _ in got.values()) + sum(a == "drop" for a, _ in got.values()) == 20
    # four distinct texts: the last text of each call has no vector
    assert {a for a, _ in got.values()} == {"upsert", "drop", "update"}


def test_exact_cents_option(spark):
    m = ColumnMapping(id="id", description="d", code="c", price="p")
    df = keyed_source(spark.createDataFrame([(1, "x", "c", 19.99)], "id int, d string, c string, p double"), m, "w")
    assert normalize(df, dt.datetime(2024, 1, 1)).first().price == 1998.9999999999998
    assert normalize(df, dt.datetime(2024, 1, 1), exact_cents=True).first().price == 1999.0


def test_hashing_embedder_is_deterministic_and_normalised():
    import numpy as np

    f = embed.hashing_embedder(32)
    a, b = f(["red widget", ""]), f(["red widget", ""])
    assert np.allclose(a, b) and abs(np.linalg.norm(a[0]) - 1) < 1e-6 and not a[1].any()


def test_batched_vectors_equal_brute_force(spark):
    """The mapInPandas path gives, per row, exactly what the embedder gives
    when called on that row's text alone."""
    import numpy as np

    from shelfsync.operators import detect
    from shelfsync.plans import fixtures as fx
    from shelfsync.plans.sync import FunctionEmbedder, outcome
    from conftest import SF001

    keyed = keyed_source(fx.part_source(spark, SF001), fx.PART_MAPPING, fx.WS_PART)
    cls = detect.classify(keyed, fx.prior_state(keyed), "quick", fx.AS_OF)
    proc = normalize(detect.to_process(cls), fx.AS_OF)
    f = embed.hashing_embedder(64)
    out = outcome(proc, None, FunctionEmbedder(f, 7)).filter(F.col("status") == "new")
    rows = out.select("embed_text", "embedding").collect()
    assert rows
    for r in rows:
        assert np.allclose(np.asarray(r.embedding, dtype=np.float32), f([r.embed_text])[0])
