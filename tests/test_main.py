from datetime import date

import pytest

from marquee.__main__ import STAGES, arguments, batch
from marquee.plans.daily import raw_paths
from test_daily import D1, write_raw


def test_arguments():
    args = arguments(["--root", "/data", "--date", "2024-01-31", "--stage", "land", "--input", "title_crew=/raw/*.gz"])
    assert (args.root, args.date, args.stage) == ("/data", date(2024, 1, 31), "land")
    prepared = batch(None, args)
    assert prepared.inputs == raw_paths("/data") | {"title_crew": "/raw/*.gz"}
    assert prepared.publish is None
    with pytest.raises(ValueError, match="nothing"):
        batch(None, arguments(["--root", "/data", "--input", "nothing=/x"]))


def test_serving_store(tmp_path):
    secret = tmp_path / "password"
    secret.write_text("p\n")
    args = arguments(["--root", "/d", "--jdbc-url", "jdbc:x", "--jdbc-user", "u", "--jdbc-password-file", str(secret)])
    target = batch(None, args).publish.__self__
    assert (target.url, target.user, target.password) == ("jdbc:x", "u", "p")


def test_stages_run_one_by_one(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root)
    for stage in ("check-inputs", "land", "cleanse", "aggregate", "publish-run-log"):
        STAGES[stage](batch(spark, arguments(["--root", root, "--date", D1.isoformat()])))
    assert spark.read.parquet(f"{root}/aggregated_zone/actors_actress_kpis").count() == 3
