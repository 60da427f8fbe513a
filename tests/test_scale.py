"""What keeps tasks in bounds: matches dealt by number of events, tables derived once."""

from touchline.operators.common import LEAST_ROWS, MOST_ROWS, by_match
from touchline.operators.sequences import possessions
from touchline.plans import catalog
from touchline.sources.adapter import Tables

SF = "/root/testdata/sf0.001"


def test_tasks_get_a_bounded_number_of_events(spark):
    feed, cores = spark.sql("select 'M' combo_id"), spark.sparkContext.defaultParallelism
    assert [by_match(feed, n).rdd.getNumPartitions() for n in (0, 1, LEAST_ROWS, 400 * MOST_ROWS)] == [1, 1, 1, 400]
    assert by_match(feed, 100 * LEAST_ROWS).rdd.getNumPartitions() == max(min(cores, 100), 5)


def test_possessions_ask_for_their_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr("touchline.operators.common.MOST_ROWS", 100)
    plan = possessions(Tables(spark, SF).feed)._jdf.queryExecution().executedPlan().toString()
    assert ", 10), REPARTITION_BY_NUM" in plan


def test_paths_of_the_documents_are_derived_once(spark):
    t = Tables(spark, SF)
    files = catalog._listed(t).inputFiles()
    assert files and all("/paths-" in f for f in files) and catalog._listed(t, "path is null").inputFiles() == files
    assert catalog.QUERIES["l01_held_matches"](t).count() > 0


def test_squads_are_written_by_several_tasks(spark):
    tables = Tables(spark, "/root/testdata/sf0.01")
    assert len(tables["squad"].inputFiles()) == min(2, spark.sparkContext.defaultParallelism)
