"""How registered queries lay out, read and write their inputs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerleaf import plans
from ledgerleaf.plans import adapters, durable, landed
from ledgerleaf.session import new_path

SF = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Documents as a folder of files, as larger tables come."""
    place = tmp_path_factory.mktemp("parts")
    spark.read.parquet(str(SF / "documents.parquet")).repartition(3).write.parquet(str(place / "documents.parquet"))
    return str(place)


def test_files_share_few_folders_and_the_cores(spark, tmp_path):
    rows = spark.range(40).select("id", F.lit("n").alias("name")).coalesce(1)
    landed._write_files(rows, str(tmp_path / "out"))
    found = list((tmp_path / "out").rglob("*.csv"))
    assert len(found) == 40 and {f.read_text() for f in found} == {f"id,name\n{i},n\n" for i in range(40)}
    assert len({f.parent for f in found}) <= landed._FOLDERS < 40
    assert len({f.name.split("-")[1] for f in found}) > 1  # tasks


def test_streams_read_tables_of_several_files(spark, parts):
    one, several = (plans.load().QUERIES["landing_stream"](spark, d).collect() for d in (str(SF), parts))
    assert sorted(several) == sorted(one) and one


def test_chain_batches_are_many_files(spark, parts, monkeypatch):
    """No file, and so no task, holds a batch's whole share of the input."""
    places = {}

    def named(spark, label):
        return places.setdefault(label, new_path(spark, label)) if label == "landed" else new_path(spark, label)

    monkeypatch.setattr(durable, "new_path", named)
    tables = adapters.Tables(spark, parts)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a partition for each file
    try:
        run = durable._chain(tables)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    landed_files = spark.read.parquet(places["landed"]).select(F.input_file_name().alias("f")).distinct().count()
    assert landed_files == 3 * durable.BATCHES
    assert run.runs.changes().select("batch_id").distinct().count() == durable.BATCHES
