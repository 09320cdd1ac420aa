"""Text sources: a CSV copy of a table normalises like the typed table."""

from pyspark.sql import functions as F

from shelfsync.operators.normalize import normalize
from shelfsync.plans import fixtures as fx
from shelfsync.sources.scan import MappingError, keyed_source, read_table, validate_mapping

from conftest import SF001

COLS = ["id", "description", "display_name", "code", "manufactory", "price", "promotion_price", "stock"]


def test_csv_copy_normalises_like_parquet(spark, tmp_path):
    src = fx.part_source(spark, SF001)
    path = str(tmp_path / "part_csv")
    src.write.option("header", True).csv(path)
    text = read_table(spark, path, "csv", header=True)          # every column arrives as text
    assert all(t == "string" for _, t in text.dtypes)
    typed = normalize(keyed_source(src, fx.PART_MAPPING, fx.WS_PART), fx.AS_OF)
    loose = normalize(keyed_source(text, fx.PART_MAPPING, fx.WS_PART), fx.AS_OF)
    a = {r.id: r for r in typed.select(*COLS).collect()}
    b = {r.id: r for r in loose.select(*COLS).collect()}
    assert a.keys() == b.keys()
    # the barcode 0 is a falsy number in the typed table but the text '0' in CSV
    assert a["0"].code == "" and b["0"].code == "0"
    assert all(tuple(a[k]) == tuple(b[k]) for k in a if k != "0")
    # '1' as text is not === 1, so no text row needs a prescription
    assert loose.filter(F.col("need_prescription")).count() == 0
    assert typed.filter(F.col("need_prescription")).count() > 0


def test_mapping_validation_fails_before_any_job(spark):
    from shelfsync.config import ColumnMapping

    part = fx.table(spark, SF001, "part")
    validate_mapping(part, ColumnMapping(id="p_partkey", description="p_name", code="p_type", price="p_retailprice"))
    try:
        validate_mapping(part, ColumnMapping(id="p_partkey", description="p_name", code="nope", price="p_retailprice"))
    except MappingError as e:
        assert "nope" in str(e)
    else:
        raise AssertionError("missing column accepted")
