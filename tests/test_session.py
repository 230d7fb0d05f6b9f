from basketry.session import BASE_CONF, fresh_dir, shared_dir


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert BASE_CONF["spark.ui.enabled"] == "false"


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    assert configured and shared_dir(spark) == configured.rstrip("/")
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_scale_conf_sizes_partitions_to_the_input():
    from basketry.session import scale_conf

    conf = scale_conf(100 * (1 << 40), 8000)  # 100 TB on 1000 executors x 8 cores
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(conf["spark.sql.shuffle.partitions"]) == 24000
    assert 4000 <= int(scale_conf(100 * (1 << 40), 4000)["spark.sql.shuffle.partitions"]) <= 30000
    assert int(scale_conf(100 * (1 << 40), 8000, shuffle_bytes=50 * (1 << 40))["spark.sql.shuffle.partitions"]) == 204800
    small = scale_conf(5 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_a_cluster_without_a_shared_folder_is_refused():
    import types

    import pytest

    conf = types.SimpleNamespace(get=lambda key: None)
    sc = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(types.SimpleNamespace(sparkContext=sc))


def test_stream_ignores_the_input_size(monkeypatch):
    from basketry import __main__ as cli

    seen = {}

    class Stop(Exception):
        pass

    def build(master, **settings):
        seen.update(settings)
        raise Stop

    monkeypatch.setattr(cli, "build_session", build)
    for command, sized in ((["stream", "--base-dir", "x", "--text-dir", "y", "--state-partitions", "96"], False), (["audit", "--base-dir", "x"], True)):
        try:
            cli.main(["--input-bytes", str(1 << 40), "--cores", "100", *command])
        except Stop:
            pass
        assert bool(seen["extra_conf"]) == sized and seen["state_partitions"] == (None if sized else 96)


def test_kafka_options_of_the_command_line():
    import pytest

    from basketry.__main__ import _parser, kafka_options

    base = ["stream", "--base-dir", "x", "--kafka", "h:9092", "--topic", "t"]
    args = _parser().parse_args([*base, "--max-offsets-per-trigger", "1000", "--min-partitions", "12", "--kafka-option", "kafka.security.protocol=SSL"])
    assert kafka_options(args) == {"maxOffsetsPerTrigger": "1000", "minPartitions": "12", "kafka.security.protocol": "SSL"}
    assert kafka_options(_parser().parse_args(base)) == {} and _parser().parse_args(base).starting_offsets == "earliest"
    with pytest.raises(SystemExit):
        kafka_options(_parser().parse_args([*base, "--kafka-option", "novalue"]))
