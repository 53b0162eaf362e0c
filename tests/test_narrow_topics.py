"""Topics are written from rows that are moved before they are mapped and encoded."""

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.plans import stream_queries as Q
from sensorweave.plans.proxy import telemetry
from sensorweave.sinks import topic


def test_rows_are_dealt_narrow(spark, tmp_path, monkeypatch):
    seen, deal = [], DataFrame.repartition

    def dealt(self, *args):
        seen.append(set(self.columns))
        return deal(self, *args)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.repartition", dealt)
    Q.write_topic(spark, SMALL, f"{tmp_path}/topic")
    assert len(seen) == Q.APPENDS and not any({"force_x", "log_message"} & s for s in seen)
    assert spark.read.parquet(f"{tmp_path}/topic").count() == telemetry(spark, SMALL).count()


def test_records_are_numbered_before_they_are_encoded(spark, tmp_path, monkeypatch):
    seen, number = [], topic.numbered

    def numbered(df, *args):
        seen.append(df.schema)
        return number(df, *args)
    monkeypatch.setattr(topic, "numbered", numbered)
    Q.write_partitioned_topic(spark, SMALL, f"{tmp_path}/topic")
    assert len(seen) == 2 and not any(f.dataType.typeName() == "binary" for s in seen for f in s.fields)
    held = spark.read.parquet(f"{tmp_path}/topic")
    assert set(held.columns) == {"key", "value", "partition", "offset"}
    tops = held.groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("top"), F.countDistinct("offset").alias("d")).collect()
    assert len(tops) == Q.PARTITIONS and all(r["n"] == r["top"] + 1 == r["d"] for r in tops)
