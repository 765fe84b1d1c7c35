import json

import pytest

from checks import fixture
from tidemark import __main__ as jobs
from tidemark.plans.layout import Lake
from tidemark.sources.tables import overwrite_table


@pytest.fixture
def run(spark, tmp_path, monkeypatch, capsys):
    lake = Lake(str(tmp_path / "lake"))
    bronze = fixture.bronze(spark, "/root/testdata/sf0.001")
    lake.store_bronze(bronze)

    class Kept:
        """The test session, which a job must not stop."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def stop(self):
            pass

    monkeypatch.setattr(jobs, "open_session", lambda app: Kept())

    def job(name, *more):
        monkeypatch.setattr("sys.argv", ["tidemark", name, "--base", lake.base + "/", *more])
        jobs.main()
        return capsys.readouterr().out

    return job


def test_steps_one_after_the_other(run):
    assert json.loads(run("silver")) == {"silver": 949}
    assert json.loads(run("gold")) == {
        "top_hashtags": 18, "user_engagement": 30, "hourly_trends": 120,
    }
    assert json.loads(run("mart"))["mart_trending_topics"] >= 10
    assert all(row["passed"] for row in json.loads(run("check")))
    report = run("report")
    assert "total_mentions" in report and "total_engagement_score" in report


def test_whole_batch(run):
    report = json.loads(run("batch"))
    assert report["written"]["silver"] == 949
    assert report["sent"] == {}


def test_ingest_passes_its_options(run, monkeypatch):
    given = {}
    monkeypatch.setattr(jobs, "read_event_stream", lambda spark, options: given.update(options))
    monkeypatch.setattr(jobs, "run_ingest", lambda stream, lake, **more: given.update(more))
    run(
        "ingest", "--servers", "h:9092", "--topic", "t", "--rate", "500", "--interval", "1 minute",
        "--state-partitions", "64", "--source-option", "kafka.security.protocol=SASL_SSL",
        "--source-option", "kafka.sasl.jaas.config=a=b",
    )
    assert given == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500",
        "kafka.security.protocol": "SASL_SSL", "kafka.sasl.jaas.config": "a=b",
        "interval": "1 minute", "state_partitions": 64,
    }


@pytest.mark.parametrize("more", [[], ["--servers", "h:1"], ["--servers", "h:1", "--topic", "t", "--source-option", "x"]])
def test_ingest_without_a_source_is_refused(run, more):
    with pytest.raises(SystemExit):
        run("ingest", *more)


def test_sending_needs_a_store(run):
    with pytest.raises(SystemExit, match="--jdbc-url"):
        run("send")
