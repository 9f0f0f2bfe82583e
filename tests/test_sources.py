import pytest

from riverbed.sources import kafka, socket
from riverbed.sources.memory import rows
from riverbed.sinks.outputs import split_tagged


def test_socket_options():
    assert socket.socket_options("h", "9000") == {"host": "h", "port": "9000"}
    with pytest.raises(ValueError):
        socket.socket_options("h", "nine")


def test_kafka_options():
    o = kafka.kafka_options("t", "b:9092", group_id="g")
    assert o == {"subscribe": "t", "kafka.bootstrap.servers": "b:9092",
                 "startingOffsets": "latest", "kafka.group.id": "g"}


def test_tagged_split(spark):
    df = rows(spark, [(1, "pass"), (2, "alert")], "id int, tag string")
    pick = split_tagged(df)
    assert [r.id for r in pick("alert").collect()] == [2]


def test_map_with_setup_runs_once_per_task(spark):
    from riverbed.operators.maps import map_with_setup
    df = rows(spark, [(i,) for i in range(10)], "x long").coalesce(1)

    def setup():
        import uuid
        return uuid.uuid4().hex

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = map_with_setup(df, setup, lambda tag, b: b.assign(tag=tag), "x long, tag string").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.x for r in out) == list(range(10)) and len({r.tag for r in out}) == 1


def test_write_text(spark):
    from riverbed.session import shared_path
    from riverbed.sinks.outputs import write_text
    df = rows(spark, [(1, "a"), (2, None)], "id int, s string")
    path = shared_path(spark, "text-sink")
    write_text(df, path)
    write_text(df, path)  # overwrite, not append
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1,a", "2,null"]


def test_text_source_reads_what_the_sink_wrote(spark):
    from riverbed.session import shared_path
    from riverbed.sinks.outputs import write_text
    from riverbed.sources.text import read_text
    path = shared_path(spark, "text-source")
    write_text(rows(spark, [(1, "a"), (2, "b")], "id int, s string"), path)
    assert sorted(r[0] for r in read_text(spark, path).collect()) == ["1,a", "2,b"]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace
    from riverbed.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_text_stream_takes_each_line_once_over_a_restart(spark):
    from riverbed.session import shared_path
    from riverbed.sources.text import stream_text
    from riverbed.streaming.runner import run_counting
    path = shared_path(spark, "text-stream")
    lines = [f"line {i}" for i in range(40)] + ["", "a\rb"]
    rows(spark, [(x,) for x in lines], "value string").coalesce(1) \
        .write.option("maxRecordsPerFile", 10).text(path)
    source = stream_text(spark, path, bytes_per_trigger=100, line_sep="\n")
    run = "text-" + path.rsplit("/", 1)[-1]
    part, _ = run_counting(source, "text-lines", run=run, batches=2)
    assert 0 < part.count() < len(lines)
    out, _ = run_counting(source, "text-lines", run=run)
    assert sorted(r.value for r in out.collect()) == sorted(lines)
    with pytest.raises(ValueError):
        stream_text(spark, path, files_per_trigger=1, bytes_per_trigger=1)


def test_text_word_count_in_many_small_files(spark, monkeypatch):
    from oracle_compare import compare
    from riverbed.plans import stream_catalog
    monkeypatch.setattr(stream_catalog, "TEXT_LINES", 100)
    monkeypatch.setattr(stream_catalog, "TEXT_BYTES", 100_000)
    got = compare(spark, "/root/testdata/sf0.001", ["stream_text_word_count"], verbose=False)
    assert got["stream_text_word_count"]["status"] == "ok", got


def test_mapped_patterns_of_null_and_empty_texts(spark, tmp_path):
    from riverbed.plans.catalog import mapped_patterns
    rows(spark, [(1, None), (2, ""), (3, "Ab, cd 12 Éa"), (3, "Ab, cd 12 Éa")],
         "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, mapped_patterns(spark, str(tmp_path)).collect())) == [
        (1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 1, 1), (3, 1, 1, 1)]
