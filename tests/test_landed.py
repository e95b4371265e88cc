"""How the feeds of the registered streams land."""

import os

import pytest

from urbanloom.session import session_settings
from workbench import queries_sources
from workbench.feeds import Feeds

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_a_delivery_of_the_fact_is_many_files(spark, monkeypatch):
    """One task wrote each delivery before, and one file was a batch."""
    feeds, folders = Feeds(spark, FOLDER), []
    read = queries_sources.jobs.read_landed
    monkeypatch.setattr(queries_sources.jobs, "read_landed", lambda s, folder, *rest, **more: folders.append(folder) or read(s, folder, *rest, **more))
    fact, held = queries_sources.slim_fact, []
    monkeypatch.setattr(queries_sources, "slim_fact", lambda f: fact(f).repartition(4))
    with session_settings(spark, {"spark.sql.files.maxPartitionBytes": "4k"}):
        queries_sources.as_landed(feeds, lambda stream: held.append(spark.read.parquet(folders[-1])))
    assert len(held) == queries_sources.LANDED_FILES and len(set(folders)) == 1
    assert len(spark.read.parquet(folders[0]).inputFiles()) > queries_sources.LANDED_FILES
    assert spark.read.parquet(folders[0]).count() == fact(feeds).count()


def test_trips_are_dealt_before_they_multiply(spark):
    """The file of the events is one task, however many cores there are."""
    assert "RepartitionByExpression" in Feeds(spark, FOLDER).trips._jdf.queryExecution().optimizedPlan().toString()
