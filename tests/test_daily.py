"""The whole job on small tables: the proofs the reference made by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog import shapes
from catalog.queries import daily_sources
from martwright.plans.daily import rebuild, run_daily
from martwright.plans.suite import GateError
from martwright.schemas import MARTS
from martwright.session import cluster_settings, object_store_settings
from martwright.sources.landing import land
from martwright.sources.publish import export_audit, jdbc_column_types, jdbc_options, publish, serving_table
from martwright.sources.store import Store

DAYS = ["2024-02-01", "2024-02-02", "2024-02-03"]
RUNS = [datetime(2024, 2, d, 2) for d in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def clean(spark, small):
    return daily_sources(spark, small)[1]


def rows(df):
    return sorted(map(str, df.collect()))


def without_stamps(df):
    return df.drop("dbt_run_started_at", "etl_loaded_at")


def test_first_run_publishes_all_marts(spark, clean, tmp_path):
    run = run_daily(spark, str(tmp_path), DAYS[0], RUNS[0], clean, loaded_at=datetime(2024, 2, 1, 2, 5), audit_copy=True)
    assert run.checks_passed == 50
    for name, schema in MARTS.items():
        assert run.marts[name].schema.names == schema.names
        assert [f.dataType for f in run.marts[name].schema] == [f.dataType for f in schema]
        stamps = run.marts[name].select("dbt_run_started_at", "etl_loaded_at").distinct().collect()
        assert [tuple(r) for r in stamps] == [(RUNS[0], datetime(2024, 2, 1, 2, 5))]
        assert spark.read.parquet(f"{tmp_path}/audit/{name}/{DAYS[0]}").count() == run.marts[name].count()
    for fact, source in (("fct_contributions", "contributions"), ("fct_claims", "claims")):
        assert run.marts[fact].count() == clean[source].count()
        assert run.marts[fact].filter("policy_sk is null").count() == 0
    Store(spark, str(tmp_path)).create_views()
    found = spark.sql("SELECT count(*) FROM fct_claims JOIN stg_claims USING (claim_id) WHERE etl_loaded_at IS NOT NULL")
    assert found.first()[0] == clean["claims"].count()


def test_a_change_opens_a_version_and_old_facts_keep_theirs(spark, clean, tmp_path):
    first = run_daily(spark, str(tmp_path), DAYS[0], RUNS[0], clean)
    policies = clean["policies"]
    changed = policies.agg(F.min("policy_id")).first()[0]
    other = F.when(F.col("status") == "Lapsed", "Active").otherwise("Lapsed")
    second = run_daily(
        spark,
        str(tmp_path),
        DAYS[1],
        RUNS[1],
        clean | {"policies": policies.withColumn("status", F.when(F.col("policy_id") == changed, other).otherwise(F.col("status")))},
    )
    assert second.marts["dim_policies"].count() == first.marts["dim_policies"].count() + 1
    versions = second.marts["dim_policies"].filter(F.col("policy_id") == changed).orderBy("valid_from").collect()
    assert [v.is_current for v in versions] == [False, True]
    assert versions[0].valid_to == versions[1].valid_from == RUNS[1]
    facts = second.marts["fct_contributions"].filter(F.col("policy_id") == changed).select("policy_sk").distinct()
    assert [r[0] for r in facts.collect()] == [versions[0].policy_sk]
    before = rows(without_stamps(first.marts["dim_policies"].filter(F.col("policy_id") != changed)))
    assert rows(without_stamps(second.marts["dim_policies"].filter(F.col("policy_id") != changed))) == before


def test_running_the_same_day_again_changes_nothing(spark, clean, tmp_path):
    first = run_daily(spark, str(tmp_path), DAYS[0], RUNS[0], clean)
    before = {name: rows(without_stamps(df)) for name, df in first.marts.items()}
    again = run_daily(spark, str(tmp_path), DAYS[0], RUNS[1], clean)
    assert {name: rows(without_stamps(df)) for name, df in again.marts.items()} == before
    with pytest.raises(ValueError, match="isn't later"):
        run_daily(spark, str(tmp_path), DAYS[0], RUNS[1], clean)


def test_a_failed_check_blocks_everything(spark, clean, tmp_path):
    root = str(tmp_path)
    run_daily(spark, root, DAYS[0], RUNS[0], clean)
    store = Store(spark, root)
    before = {name: rows(df) for name, df in store.published().items()}
    bad_claims = clean["claims"].withColumn(
        "fund_type", F.when(F.col("status") == "Pending", "INVALID_FUND").otherwise(F.col("fund_type"))
    )
    bad_policies = clean["policies"].withColumn("status", F.lit("Lapsed"))
    with pytest.raises(GateError) as error:
        run_daily(spark, root, DAYS[1], RUNS[1], clean | {"claims": bad_claims, "policies": bad_policies})
    assert error.value.failed == {"accepted_values_stg_claims_fund_type": 1}
    assert {name: rows(df) for name, df in store.published().items()} == before
    kept = spark.read.parquet(f"{root}/quarantine/run={store.run_id(RUNS[1])}/accepted_values_stg_claims_fund_type")
    assert kept.first().value_field == "INVALID_FUND"
    # The bad extract left no trace in history: the corrected day continues from the first run.
    third = run_daily(spark, root, DAYS[1], RUNS[2], clean)
    assert rows(without_stamps(third.marts["dim_policies"])) == rows(
        without_stamps(store.mart(store.run_id(RUNS[0]), "dim_policies"))
    )


def test_a_future_day_stays_the_latest(spark, clean, tmp_path):
    root = str(tmp_path)
    run_daily(spark, root, "2024-03-01", RUNS[0], clean)
    one = clean["claims"].limit(1)
    with pytest.warns(UserWarning, match="claims: extract of 2024-03-01 stays the latest"):
        run = run_daily(spark, root, DAYS[0], RUNS[1], clean | {"claims": one})
    assert run.marts["fct_claims"].count() == clean["claims"].count()


def test_extracts_that_were_dropped_in_place_are_taken(spark, clean, tmp_path):
    for name, df in clean.items():
        land(df, f"{tmp_path}/raw", name, DAYS[0])
    assert run_daily(spark, str(tmp_path), DAYS[0], RUNS[0]).checks_passed == 50


def test_rebuild_from_raw_zone_and_log_gives_the_same_marts(spark, small, clean, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="no run was published"):
        rebuild(spark, root)
    later = clean["policies"].withColumn("status", F.when(F.col("has_pif"), "Matured").otherwise(F.col("status")))
    before = clean | {"participants": shapes.participants(spark, small, second=False)}
    first = run_daily(spark, root, DAYS[0], RUNS[0], before)
    with pytest.raises(GateError):  # a run that doesn't count; its day is landed again below
        run_daily(spark, root, DAYS[1], RUNS[1], clean | {"claims": clean["claims"].withColumn("fund_type", F.lit("X"))})
    run = run_daily(spark, root, DAYS[1], RUNS[2], clean | {"policies": later})
    published = {name: rows(df) for name, df in run.marts.items()}
    rebuilt = rebuild(spark, root)
    for name in MARTS:
        assert rows(without_stamps(rebuilt[name])) == rows(without_stamps(run.marts[name]))
    assert rebuilt["dim_policies"].count() > first.marts["dim_policies"].count()
    land(later.withColumn("status", F.lit("Lapsed")), f"{root}/raw", "policies", DAYS[1])
    with pytest.raises(ValueError, match="policies: the extracts of these runs"):
        rebuild(spark, root)
    assert {name: rows(df) for name, df in Store(spark, root).published().items()} == published


def test_publishing_twice_and_exporting_twice(spark, tmp_path):
    for n in (3, 2):
        publish(spark.range(n), f"{tmp_path}/t")
        export_audit(spark.range(n), str(tmp_path), "a", DAYS[0])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    assert spark.read.parquet(f"{tmp_path}/a/{DAYS[0]}").count() == 2


def test_serving_table_options():
    options = jdbc_options("dim_participants", "jdbc:any:db", connections=4)
    assert options["dbtable"] == "marts.dim_participants" and options["batchsize"] == "1000"
    assert options["numPartitions"] == "4" and options["truncate"] == "true"
    assert jdbc_column_types("dim_participants") == (
        "participant_sk VARCHAR(64), participant_id VARCHAR(20), full_name VARCHAR(200), ic_number VARCHAR(20), "
        "state VARCHAR(50), gender VARCHAR(1)"
    )


def test_serving_tables_take_names_of_any_script():
    assert serving_table("dim_participants") == (
        "CREATE TABLE marts.dim_participants (participant_sk VARCHAR(64) PRIMARY KEY, participant_id VARCHAR(20), "
        "full_name NVARCHAR(200), ic_number VARCHAR(20), state NVARCHAR(50), date_of_birth DATE, gender VARCHAR(1), "
        "join_date DATE, valid_from DATETIME2, valid_to DATETIME2, is_current BIT, dbt_run_started_at DATETIME2, "
        "etl_loaded_at DATETIME2)"
    )
    assert "commission_rate DECIMAL(5,2)" in serving_table("fct_agency_commissions", "s") and "term_years INT" in serving_table("dim_policies")


def test_settings_follow_the_size_of_the_shuffle():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert cluster_settings(10)[name] == "200"
    assert cluster_settings(2 * 1024**4)[name] == "8192"
    assert cluster_settings(100 * 1024**4)[name] == str(100 * 4096)
    assert object_store_settings("http://store", "k", "s")["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_removing_old_runs_keeps_what_later_runs_and_a_rebuild_need(spark, clean, tmp_path):
    """Three runs; the parts of the facts that the second and third didn't touch are where the first wrote them."""
    root = str(tmp_path / "a")
    policies = clean["policies"]
    statuses = ["Lapsed", "Active", "Matured", "Active"]
    days = [clean | {"policies": policies.withColumn("status", F.lit(s))} for s in statuses]
    for day, at, sources in list(zip(DAYS, RUNS, days))[:3]:
        run_daily(spark, root, day, at, sources)
    store = Store(spark, root)
    store.write_staging("r19990101000000000000", "claims", store.staging(store.run_id(RUNS[0]), "claims"))  # of a run that failed
    published = {name: rows(df) for name, df in store.published().items()}
    rebuilt = {name: rows(df) for name, df in rebuild(spark, root).items()}
    gone = store.remove_runs(RUNS[2])
    old = [store.run_id(r) for r in RUNS[:2]]
    assert f"staging/run={old[0]}" in gone and "staging/run=r19990101000000000000" in gone
    assert f"marts/run={old[1]}/dim_policies" in gone and not any("kept_as=closed" in g for g in gone)
    assert not any(g.startswith(f"marts/run={old[0]}/fct_agency") for g in gone)  # still in use
    assert {name: rows(df) for name, df in store.published().items()} == published
    assert {name: rows(df) for name, df in rebuild(spark, root).items()} == rebuilt
    again = run_daily(spark, root, "2024-02-04", RUNS[3], days[3])
    assert again.marts["dim_policies"].count() == 4 * policies.count()
    full = rebuild(spark, root)
    for name in MARTS:
        assert rows(without_stamps(again.marts[name])) == rows(without_stamps(full[name]))
    assert store.remove_runs(RUNS[2]) == [] or all("rebuild" not in g for g in store.remove_runs(RUNS[2]))
