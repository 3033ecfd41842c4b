"""How often the dearest jobs read their input."""

from opinari.plans.registry import QUERIES, load_all

SF_SMALL = "/root/testdata/sf0.001"


def scans(df, name):
    return df._jdf.queryExecution().executedPlan().toString().count(f"{name}.parquet]")


def test_quality_report_reads_the_input_once_more(spark):
    load_all()
    assert scans(QUERIES["quality_report"](spark, SF_SMALL), "documents") == 1


def test_clean_job_runs_its_chain_once(spark):
    load_all()
    assert scans(QUERIES["clean_job"](spark, SF_SMALL), "documents") == 0
