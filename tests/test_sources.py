import json
import os

from usagelake.sources.reports import (
    console_sink, kafka_options, print_batch, range_scan, read_report_lines, reports_decode,
)

from test_decode import GOOD


def test_kafka_options():
    o = kafka_options("h1:9092,h2:9092", ["t1", "t2"])
    assert o == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "t1,t2",
                 "startingOffsets": "latest"}
    assert kafka_options("h", "t", failOnDataLoss="false")["failOnDataLoss"] == "false"


def test_range_scan(spark):
    df = range_scan(spark, 1000, num_partitions=4)
    assert df.count() == 1000 and df.agg({"id": "min"}).first()[0] == 1
    assert df.agg({"id": "max"}).first()[0] == 1000


def test_print_batch(spark, capsys):
    print_batch(spark.createDataFrame([("xyz",)], "v string"), 5)
    out = capsys.readouterr().out
    assert "|v  |" in out and "|xyz|" in out


def test_console_sink_builds(spark, scratch):
    os.makedirs(os.path.join(scratch, "in"))
    lines = read_report_lines(spark, os.path.join(scratch, "in"), stream=True)
    w = console_sink(lines, 3)
    assert w is not None  # not started: building the writer is enough here


def test_read_lines_batch_with_provenance(spark, scratch):
    p = os.path.join(scratch, "lines")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w") as f:
        f.write(json.dumps(GOOD) + "\n" + "not json\n")
    lines = read_report_lines(spark, p)
    assert lines.count() == 2
    assert all(r["source_file"].endswith("a.txt") for r in lines.collect())
    assert reports_decode(lines).count() == 1
