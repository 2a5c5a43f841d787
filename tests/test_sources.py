"""Readers, writers and the staging folder."""

from types import SimpleNamespace

import pytest

from ledgerline import schema as S
from ledgerline.sources import staging, tables


class _Reader:
    def jdbc(self, **options):
        self.options = options
        return self


def test_jdbc_reads_in_ranges():
    reader = _Reader()
    session = SimpleNamespace(read=reader)
    tables.scan_jdbc(
        session, "jdbc:x", "credit", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4
    )
    assert reader.options["column"] == "id" and reader.options["numPartitions"] == 4
    assert reader.options["properties"]["fetchsize"] == "10000"
    tables.scan_jdbc(session, "jdbc:x", "credit")
    assert set(reader.options) == {"url", "table", "properties"}
    with pytest.raises(ValueError, match="lower_bound"):
        tables.scan_jdbc(session, "jdbc:x", "credit", partition_column="id")


def test_table_overwrite_and_read_back(spark):
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):
        tables.write_table_overwrite(tables.frame_from_rows(spark, rows, "id int, s string"), "default.saved_rows")
    assert sorted(tuple(r) for r in tables.scan_table(spark, "default.saved_rows").collect()) == [(2, "b"), (3, "c")]
    spark.sql("DROP TABLE default.saved_rows")


def test_clean_table_round_trip(spark, clean):
    tables.write_table_overwrite(clean, "default.crs_transformed")
    back = tables.scan_table(spark)
    assert back.columns == clean.columns and back.count() == clean.count()
    spark.sql("DROP TABLE default.crs_transformed")


def test_parquet_round_trip(spark, tmp_path):
    tables.write_parquet(spark.range(5).toDF("id"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_stage_uses_the_named_folder(spark):
    folder = staging.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(3).toDF("id"), "t")
    assert all(f.startswith(("file:" + folder, folder, "file://" + folder)) for f in staged.inputFiles())


def test_cluster_without_folder_is_refused():
    context = SimpleNamespace(
        master="yarn", applicationId="a", getConf=lambda: SimpleNamespace(get=lambda name: None)
    )
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: None), sparkContext=context)
    with pytest.raises(ValueError, match="checkpoint"):
        staging.shared_folder(session)


def test_schema_counts():
    assert len(S.RAW_COLUMNS) == len(set(S.RAW_COLUMNS)) == 78
    assert len(S.CONTRACT_CANONICAL) == 25
    assert len(S.CONTRACT_V1) == 29
    assert len(S.CONTRACT_THREE_CLASS) == 34
    assert len(S.FEATURES_THREE_CLASS) == 28
