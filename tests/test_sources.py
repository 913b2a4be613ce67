import pytest
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.session import shared_dir, small_side, written
from cohortix.sources import sinks
from cohortix.sources.tables import load_canonical, load_checked, narrowed, read_table, typed

NAMES = {S.ID: "msisdn", S.USAGE: "gb", S.REVENUE: "arpu", S.DOU: "days", S.PACK: "pack", S.TENURE: "age", S.CHURN: "left"}


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("gb,msisdn,arpu,days,pack,age,left,extra\n"
                    "1.5,M1,-2.0,30,1,120,0,x\nNaN,M2,,3,0,999999999999,1,y\nbad,M3,4,5,1,7,0,z\n")
    return str(path)


def test_csv_is_renamed_and_typed(spark, csv_path):
    rows = {r[S.ID]: r for r in load_canonical(spark, csv_path, "csv", NAMES).collect()}
    assert rows["M1"][S.USAGE] == 1.5 and rows["M1"][S.REVENUE] == -2.0
    assert rows["M2"][S.USAGE] is None and rows["M2"][S.REVENUE] is None and rows["M2"][S.TENURE] is None
    assert rows["M3"][S.USAGE] is None and rows["M3"][S.TENURE] == 7


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("gb,msisdn,arpu,days,pack,age,left,extra\n"
                    "1.5,M1,-2.0,30,1,120,0,x\n"          # fits
                    "NaN,M2,,3,0,99,1,y\n"                # missing values fit
                    "bad,M3,4,5,1,7,0,z\n"                # no number
                    "1,M4,4\n"                            # cut
                    "1,M5,4,5,1,7,0,z,more\n"             # a field too many
                    "1,M6,4,5,1,999999999999,0,z\n"       # beyond the type
                    '1,"M7,quoted",4,5,1,7,0,"z"\n')
    found = load_checked(spark, str(path), NAMES)
    assert {r[S.ID]: r[S.USAGE] for r in found.rows.collect()} == {"M1": 1.5, "M2": None, "M7,quoted": 1.0}
    lines = [r["record"].split(",")[1] for r in found.quarantined.collect()]
    assert sorted(lines) == ["M3", "M4", "M5", "M6"] and (found.loaded, found.malformed) == (3, 4)
    assert found.quarantined.first()["source_file"].endswith("in.csv")
    assert found.rows.columns == list(S.CANONICAL)
    with pytest.raises(KeyError, match="average_revenue"):
        load_checked(spark, str(path), {**NAMES, S.REVENUE: "nowhere"})


def test_checked_files_with_other_headers_fail(spark, tmp_path):
    for name, head in (("a", "gb,msisdn"), ("b", "msisdn,gb")):
        (tmp_path / f"{name}.csv").write_text(f"{head},arpu,days,pack,age,left\n1,2,3,4,1,6,0\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_checked(spark, str(tmp_path), NAMES)


def test_empty_checked_folder_and_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(NAMES.values()) + "\n\n")
    found = load_checked(spark, str(tmp_path), NAMES)
    assert found.rows.count() == found.quarantined.count() == found.loaded == found.malformed == 0


def test_missing_columns_are_named(spark, csv_path):
    with pytest.raises(KeyError, match="average_revenue"):
        load_canonical(spark, csv_path, "csv", {**NAMES, S.REVENUE: "nowhere"})


def test_unknown_format(spark, csv_path):
    with pytest.raises(ValueError):
        read_table(spark, csv_path, "xml")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats_round_trip(spark, raw, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writer = raw.write.option("header", True) if fmt == "csv" else raw.write
    writer.format(fmt).save(path)
    back = typed(read_table(spark, path, fmt))
    assert back.count() == raw.count()
    assert back.agg(F.round(F.sum(S.REVENUE), 2)).first() == raw.agg(F.round(F.sum(S.REVENUE), 2)).first()


def test_storage_types(raw):
    types = dict(narrowed(raw).dtypes)
    assert (types[S.USAGE], types[S.PACK], types[S.CHURN], types[S.TENURE]) == ("float", "tinyint", "tinyint", "int")


def test_projection_reaches_the_scan(spark, raw):
    table = written(raw, "narrow")
    plan = table.where("aon >= 90").select(S.ID, S.TENURE)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:bigint,aon:int>" in plan and "GreaterThanOrEqual(aon,90)" in plan


def test_large_side_is_not_marked_for_broadcast(spark):
    big, small = small_side(spark.range(50), 20), small_side(spark.range(5), 20)
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert not hint(big) and hint(small) and big.count() == 50


class FakeSession:
    """Just the settings the folder choice looks at."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_shared_folder_follows_the_session():
    assert shared_dir(FakeSession(spark_checkpoint_dir="s3://bucket/x/", spark_master="yarn")) == "s3://bucket/x"
    assert shared_dir(FakeSession(spark_master="local[4]"))
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession(spark_master="yarn"))


def test_documents_round_trip(spark, tmp_path):
    sinks.write_document(spark, {"a": {"b": [1, 2.5, None]}}, str(tmp_path / "doc"))
    assert sinks.read_document(spark, str(tmp_path / "doc")) == {"a": {"b": [1, 2.5, None]}}
