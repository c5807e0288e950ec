import datetime as dt

import pytest

from editscope import schemas, session
from editscope.operators.history import data_status
from editscope.sources import feed, history
from editscope.streaming import pipeline, sinks


WAR = (
    "start_time timestamp, end_time timestamp, title string, total_edits bigint, unique_users bigint, "
    "combatants string, latest_comment string, latest_revision bigint, reverts_count bigint, batch_id bigint"
)
T = dt.datetime(2026, 5, 28, 18, 10)
ODD = ["NA", "null", "None", "", 'He said "no", twice', "back\\slash", "zażółć ☃", "semi;colon, comma", " pad "]


def rows(spark):
    data = [(T, T + dt.timedelta(minutes=5), t, 2, 2, "a, b", t, None if i % 2 else 2498846264, 1, i)
            for i, t in enumerate(ODD)]
    data.append((T, T, "null comment", 2, 1, "a", None, 1, 1, 99))
    return spark.createDataFrame(data, WAR)


def test_csv_files_round_trip(spark, tmp_path):
    rows(spark).repartition(3).write.options(header=True, **history.CSV_WRITE).csv(str(tmp_path / "a"))
    got = history.read_history(spark, str(tmp_path / "a"), schemas.EDIT_WARS, "start_time", "end_time")
    assert sorted(map(str, got.collect())) == sorted(map(str, rows(spark).collect()))


def test_files_of_the_default_writer_read_with_a_backslash(spark, tmp_path):
    odd = rows(spark).filter("""title not in ('', ' pad ', 'back\\\\slash')""")
    odd.write.option("header", True).csv(str(tmp_path / "a"))
    got = history.read_history(
        spark, str(tmp_path / "a"), schemas.EDIT_WARS, "start_time", "end_time", escape="\\"
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, odd.collect()))
    assert odd.count() == 7


def test_damaged_rows_are_dropped(spark, tmp_path):
    header = ",".join(c.split("`")[1] for c in schemas.EDIT_WARS.split(", "))
    good = "2026-05-28T18:10:00.000+02:00,2026-05-28T18:15:00.000+02:00,X,2,2,a,c,5,1,0"
    shifted = "Q116,2026-05-28T18:15:00.000+02:00,X,2,2,a,c,5,1,0"
    half = "2026-05-28T18:10:00.000+02:00,later,Y,2,2,a,c,5,1,0"
    (tmp_path / "edit_wars_1.csv").write_text("\n".join([header, good, shifted, half]) + "\n")
    (tmp_path / "edit_wars_2.csv").write_text(header + "\n")
    both = history.read_history(spark, str(tmp_path), schemas.EDIT_WARS, "start_time", "end_time")
    assert [(r.title, r.start_time) for r in both.collect()] == [("X", dt.datetime(2026, 5, 28, 16, 10))]
    start_only = history.read_history(spark, str(tmp_path), schemas.EDIT_WARS)
    assert sorted(r.title for r in start_only.collect()) == ["X", "Y"]


def test_a_history_that_has_not_begun_is_empty(spark, tmp_path):
    none = history.read_history(spark, f"{tmp_path}/nothing", schemas.EDIT_WARS, "start_time", "end_time")
    assert none.count() == 0
    assert data_status({"wars": none, "more": rows(spark)}).filter("has_data").collect()[0].table_name == "more"


def test_one_missing_path_leaves_the_others(spark, tmp_path):
    rows(spark).write.options(header=True, **history.CSV_WRITE).csv(str(tmp_path / "a"))
    paths = [f"{tmp_path}/missing", f"{tmp_path}/a", f"{tmp_path}/later"]
    got = history.read_history(spark, paths, schemas.EDIT_WARS, "start_time", "end_time")
    assert got.count() == len(ODD) + 1


def test_unreadable_files_are_an_error_unless_skipped(spark, tmp_path):
    rows(spark).write.options(header=True, **history.CSV_WRITE).csv(str(tmp_path / "a"))
    (tmp_path / "a" / "broken.csv.gz").write_bytes(b"no gzip")
    with pytest.raises(Exception, match="(?i)gzip|corrupt|read"):
        history.read_history(spark, f"{tmp_path}/a", schemas.EDIT_WARS, "start_time").collect()
    got = history.read_history(spark, f"{tmp_path}/a", schemas.EDIT_WARS, "start_time", skip_corrupt=True)
    assert got.count() == len(ODD) + 1


BREAKS = ["x\ny", "x\\ny", "\r\n", "\\\n", "c:\\new\\\\run\n\\", "plain", "", "tail\\"]


def test_line_breaks_round_trip_through_a_sink(spark, tmp_path):
    data = [(T, T, f"t{i}", 2, 2, "a, b", text, 7, 1, 0) for i, text in enumerate(BREAKS)]
    frame = spark.createDataFrame(data, WAR)
    sinks.partition_sink(f"{tmp_path}/w", "r", "csv")(frame.drop("batch_id"), 3)
    got = history.read_history(spark, f"{tmp_path}/w", schemas.EDIT_WARS, "start_time", "end_time").collect()
    assert sorted((r.title, r.latest_comment, r.latest_revision, r.reverts_count, r.batch_id) for r in got) == sorted(
        (f"t{i}", text, 7, 1, 3) for i, text in enumerate(BREAKS))


def test_kafka_options():
    class Reader:
        def __init__(self):
            self.options = {}

        def format(self, name):
            self.name = name
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            return self

    class Spark:
        readStream = Reader()

    source = feed.stream_kafka(Spark(), "host:9092")
    assert source.name == "kafka"
    assert source.options["subscribe"] == "wiki-edits"
    assert source.options["startingOffsets"] == "latest"
    assert source.options["maxOffsetsPerTrigger"] == feed.MAX_OFFSETS_PER_TRIGGER


def test_kafka_sink_options():
    class Writer(dict):
        def format(self, name):
            return self.option("format", name)

        def option(self, key, value):
            self[key] = value
            return self

        def start(self):
            return self

    class Messages:
        writeStream = Writer()

    sink = pipeline.publish_kafka(Messages(), "host:9092", "/cp")
    assert sink == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "wiki-edits", "checkpointLocation": "/cp",
    }


def test_text_source(spark, tmp_path):
    (tmp_path / "f.txt").write_text("data: 1\n\nevent: x\n")
    assert feed.read_text(spark, str(tmp_path)).count() == 3
    assert feed.stream_text(spark, str(tmp_path)).isStreaming


def test_checkpoint_location_follows_the_database(spark):
    location = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    assert session.get_checkpoint_location(spark) == location + "/tmp/checkpoint/"


def test_shared_dir_comes_from_the_session():
    class Spark:
        def __init__(self, **conf):
            self.conf = conf

    cluster = Spark(**{"spark.checkpoint.dir": "/cluster"})
    assert session.shared_dir(cluster, "/mine") == "/cluster"
    assert session.shared_dir(Spark(), "/mine") == "/mine"
    with pytest.raises(ValueError):
        session.shared_dir(Spark())
