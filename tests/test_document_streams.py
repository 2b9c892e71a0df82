"""What a stream of document files costs: jobs and tasks of a batch, and documents written by many tasks."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from caremart import schemas
from caremart.plans import posing
from caremart.sources import delimited
from caremart.streaming import ingest

THRESHOLD = "spark.sql.sources.parallelPartitionDiscovery.threshold"
PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def last_stage(spark):
    context = spark.sparkContext
    context.setJobGroup("last stage", "")
    spark.range(1).write.format("noop").mode("overwrite").save()
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    return max(s for j in tracker.getJobIdsForGroup("last stage") for s in tracker.getJobInfo(j).stageIds)


def tasks_of_stages(spark, work):
    """Tasks of each stage that ran in ``work``."""
    tracker, first = spark.sparkContext.statusTracker(), last_stage(spark)
    work()
    infos = [tracker.getStageInfo(s) for s in range(first + 1, last_stage(spark))]
    return [info.numTasks for info in infos if info and info.numCompletedTasks]


@pytest.fixture
def files(tmp_path):
    source = tmp_path / "docs"
    source.mkdir()
    for i in range(60):
        (source / f"p{i}_d{i}_x.xml").write_text(f"<a>{i}</a>")
    return source


def land(spark, source, work, **options):
    assert ingest.ingest_documents(
        spark, str(source), f"{work}/bronze", f"{work}/checkpoint", timeout=120, **options)
    return spark.read.parquet(f"{work}/bronze")


def test_listing_does_not_start_a_task_for_each_file(spark, files, tmp_path):
    spark.conf.set(THRESHOLD, 8)
    try:
        tasks = tasks_of_stages(spark, lambda: land(spark, files, tmp_path / "out"))
    finally:
        spark.conf.unset(THRESHOLD)
    assert max(tasks) < 30
    assert spark.conf.get(PARALLELISM) == "10000"


def test_a_batch_reads_and_writes_in_one_job(spark, files, tmp_path):
    tasks = tasks_of_stages(spark, lambda: land(spark, files, tmp_path / "out", max_files=20))
    # Three batches of two stages; the rest is the look at what landed.
    assert len(tasks) <= 3 * 2 + 2
    landed = spark.read.parquet(f"{tmp_path}/out/bronze")
    assert sorted(r["count"] for r in landed.groupBy(ingest.BATCH_ID).count().collect()) == [20, 20, 20]
    assert sorted(r.xml_string for r in landed.collect()) == sorted(f"<a>{i}</a>" for i in range(60))
    assert landed.filter("created_at < file_modification_time or created_at is null").count() == 0


def test_names_with_glob_characters_land_once(spark, files, tmp_path):
    (files / "q_d[1].xml").write_text("<b/>")
    (files / "q_d{2}.xml").write_text("<c/>")
    landed = land(spark, files, tmp_path / "out")
    assert landed.count() == 62 and landed.select("file_path").distinct().count() == 62


@pytest.fixture
def turns(tmp_path):
    """Conversations in one piece; a turn occurs twice, one has no text."""
    texts = ["a <b>\nc & d", "é", None, "", "twice", "twice"]
    pq.write_table(pa.table({
        "conv_id": pa.array([1, 2, 3, 4, 5, 5], pa.int64()), "turn": pa.array([0, 1, 0, 1, 0, 0], pa.int64()),
        "role": ["user", "assistant", "user", "user", "user", "user"], "text": texts,
    }), tmp_path / "conversations.parquet")
    return str(tmp_path)


def test_document_files_are_written_by_all_cores(spark, turns):
    assert posing.documents(spark, turns).rdd.getNumPartitions() == 1
    spread = posing.documents(spark, turns, spread=True)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(map(str, spread.collect())) == sorted(map(str, posing.documents(spark, turns).collect()))


def test_document_files_are_compared_by_digest(spark, turns):
    found = entry.bronze_document_files(spark, turns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joined = plan[: plan.index("sha2(")]
    assert "xml_string" not in joined
    rows = found.collect()
    # The turn that is there twice is one file, which both rows of it wrote.
    assert sorted(r.document_id for r in rows) == ["1-0", "2-1", "4-1", "5-0", "5-0"]
    assert all(r.size_as_written and r.text_as_written and r.path_ends_in_name for r in rows)


def test_clean_lines_build_no_json(spark, tmp_path):
    """JSON of what is rescued stands behind a condition; what a line holds of odd cells is the same as ever."""
    (tmp_path / "a.csv").write_text('a,b,x\n1,2,\n3,4,"say ""hi"""\n5\n')
    rows = delimited.read_csv_rescued(
        spark, delimited.list_files(spark, str(tmp_path)), schemas.ddl("a string, b string"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan[: plan.index("to_json")]
    assert sorted((r.a, r.b, r[delimited.RESCUED]) for r in rows.collect()) == [
        ("1", "2", None), ("3", "4", '{"x":"say \\"hi\\""}'), ("5", None, '{"_corrupt_record":"5"}')]
