import os
from types import SimpleNamespace

import pytest

from starweir.__main__ import main
from starweir.jobs import at_once
from starweir.sources import read_table, write_table
from starweir.staging import scratch_path, scratch_root, stage, temporary


def session(master, **settings):
    """What scratch_root asks of a session."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_the_named_folder_is_used(spark):
    named = {"spark.checkpoint.dir": "hdfs://shared/scratch/"}
    assert scratch_root(session("spark://somewhere:7077", **named)) == "hdfs://shared/scratch"
    assert scratch_path(spark, "x").startswith(f"{scratch_root(spark)}/starweir/x-")
    assert stage(spark.range(3), "y").count() == 3


def test_only_a_local_session_may_do_without(spark):
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        scratch_root(session("spark://somewhere:7077"))
    assert os.path.isdir(scratch_root(session("local[2]")))


def test_temporary_tables_go_with_their_block(spark):
    outside = scratch_path(spark, "outside")
    with temporary(spark):
        inside = scratch_path(spark, "inside")
        assert os.path.isdir(inside)
    assert not os.path.exists(inside) and os.path.isdir(outside)


def test_jobs_at_once_keep_their_order_and_raise():
    assert at_once([lambda i=i: i * i for i in range(10)], limit=3) == [i * i for i in range(10)]
    with pytest.raises(ZeroDivisionError):
        at_once([lambda: 1, lambda: 1 // 0])


def test_single_steps_from_the_command_line(spark, tmp_path, capsys):
    raw = spark.createDataFrame([("A-1", "DE"), ("B-2", "")], "cid string, cntry string")
    write_table(raw, str(tmp_path / "raw" / "customer_locations"))
    main(["cleanse", "--root", str(tmp_path), "--tables", "customer_locations"])
    assert "{'customer_locations': 2}" in capsys.readouterr().out
    cleansed = read_table(spark, str(tmp_path / "cleansed" / "customer_locations"))
    assert sorted(tuple(r) for r in cleansed.collect()) == [("A1", "Germany"), ("B2", "n/a")]
    with pytest.raises(FileNotFoundError):
        main(["cleanse", "--root", str(tmp_path), "--tables", "customers"])
