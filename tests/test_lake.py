from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import DAY, NOON, NOWHERE, PATAGONIA, RIOHACHA, plan_of
from pyspark.sql import functions as F

from heliovane import __main__ as cli
from heliovane.operators.gold import build_gold
from heliovane.plans import jobs
from heliovane.schemas import GOLD, GOLD_TABLE, SILVER
from heliovane.sources.lake import (
    read_gold,
    read_silver,
    register_table,
    repair_table,
    write_partitioned,
)
from heliovane.sources.published import publish_view
from heliovane.sources.scratch import scratch_dir

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def rows(silver):
    return silver(
        (NOON, PATAGONIA, 1.0, 10.0, 1000, 2.0),
        (NOON, PATAGONIA, 1.0, 10.0, 1000, 2.0),
        (NOON + 40 * DAY, RIOHACHA, 2.0, 30.0, 1010, 3.0),
        (None, NOWHERE, None, None, None, None),
    )


def files(path) -> list[Path]:
    return sorted(Path(path).rglob("*.parquet"))


def test_round_trip_keeps_rows_types_and_layout(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    assert write_partitioned(rows, path) == 4
    back = read_silver(spark, path)
    assert back.schema == SILVER
    assert back.exceptAll(rows.select(*SILVER.names)).count() == 0
    partitions = {str(f.parent.relative_to(path)) for f in files(path)}
    assert partitions == {
        "region=Patagonia/year=2024/month=1",
        "region=Riohacha/year=2024/month=2",
        "region=No Region/year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__",
    }
    assert all(f.name.endswith(".snappy.parquet") for f in files(path))


def test_static_overwrite_replaces_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(rows, path)
    assert write_partitioned(rows.where("region = 'Riohacha'"), path) == 1
    assert [r.region for r in read_silver(spark, path).collect()] == ["Riohacha"]


def test_dynamic_overwrite_leaves_other_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(rows, path)
    one = rows.where("region = 'Patagonia'").limit(1)
    assert write_partitioned(one, path, "dynamic") == 1
    regions = [r.region for r in read_silver(spark, path).orderBy("region").collect()]
    assert regions == ["No Region", "Patagonia", "Riohacha"]


def test_hot_partition_is_written_by_many_tasks_and_quiet_ones_by_one(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    wide = spark.range(0, 120_000, numPartitions=8).select(
        F.col("id").alias("dt"),
        F.rand(1).alias("a"),
        F.rand(2).alias("b"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 40)).alias(
            "region"
        ),
        F.lit(2024).alias("year"),
        F.lit(1).alias("month"),
    )
    path = str(tmp_path / "t")
    assert write_partitioned(wide, path) == 120_000
    assert len(files(f"{path}/region=hot")) >= 3
    assert len(files(f"{path}/region=r1")) <= 2


def test_gold_of_chosen_months_only(spark, rows, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitioned(rows, silver)
    assert jobs.run_gold(spark, silver, gold) == 4
    january = [f for f in files(gold) if "month=1" in str(f)]
    others = [f for f in files(gold) if "month=1" not in str(f)]
    assert jobs.run_gold(spark, silver, gold, months=[(2024, 1)]) == 3
    kept = {f for f in others if "month=2" in str(f)}
    assert kept and kept < set(files(gold)) and not set(january) & set(files(gold))
    assert read_gold(spark, gold).exceptAll(build_gold(rows).select(*GOLD.names)).count() == 0
    assert jobs.run_gold(spark, silver, gold, months=[(None, None)]) == 1
    assert read_gold(spark, gold).count() == 4
    with pytest.raises(ValueError):
        jobs.run_gold(spark, silver, gold, months=[])


def test_refreshed_months_lose_what_silver_lost(spark, rows, tmp_path):
    silver, gold, daily = (str(tmp_path / t) for t in ("silver", "gold", "daily"))
    write_partitioned(rows, silver)
    jobs.run_gold(spark, silver, gold)
    jobs.run_daily(spark, gold, daily)
    write_partitioned(rows.where("region <> 'Riohacha'").unionByName(rows.where("dt IS NULL")), silver)
    assert jobs.run_gold(spark, silver, gold, [(2024, 2)]) == 2
    refreshed = jobs.run_daily(spark, gold, daily, [(2024, 2)])
    full = str(tmp_path / "full")
    jobs.run_gold(spark, silver, full)
    assert sorted(map(str, read_gold(spark, gold).collect())) == sorted(map(str, read_gold(spark, full).collect()))
    whole = jobs.run_daily(spark, full, str(tmp_path / "d2"))
    assert sorted(map(str, refreshed.collect())) == sorted(map(str, whole.collect()))


def test_a_name_stands_for_one_path(spark, rows, tmp_path):
    for name in ("a", "b"):
        write_partitioned(build_gold(rows), str(tmp_path / name))
    assert jobs.run_table(spark, str(tmp_path / "a"), "one_path") == 3
    assert jobs.run_table(spark, str(tmp_path / "a") + "/", "one_path") == 3
    with pytest.raises(ValueError, match="already stands for"):
        jobs.run_table(spark, str(tmp_path / "b"), "one_path")
    spark.sql("DROP TABLE one_path")


def shown(spark, name) -> set[str]:
    return {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def test_a_refresh_tells_the_catalog_its_partitions(spark, rows, silver, tmp_path, monkeypatch):
    """New ones in, lost ones out, changed ones read anew, and no other folder looked at."""
    table, gold = str(tmp_path / "silver"), str(tmp_path / "it's gold")
    write_partitioned(rows, table)
    jobs.run_gold(spark, table, gold)
    jobs.run_table(spark, gold, "followed")
    before = shown(spark, "followed")
    assert spark.table("followed").where("month = 1").count() == 2
    changed = silver(
        *[(NOON + k, PATAGONIA, 1.0, 10.0, 1000, 2.0) for k in range(5)],
        (NOON + 70 * DAY, RIOHACHA, 2.0, 30.0, 1010, 3.0),
        (None, PATAGONIA, 1.0, None, None, None),
    )
    write_partitioned(changed, table)
    monkeypatch.setattr(jobs, "repair_table", None)
    assert jobs.run_gold(spark, table, gold, [(2024, 1), (2024, 2), (2024, 3)], table="followed") == 7
    null = "__HIVE_DEFAULT_PARTITION__"
    assert shown(spark, "followed") == {
        "region=Patagonia/year=2024/month=1", "region=Riohacha/year=2024/month=3",
        f"region=Patagonia/year={null}/month={null}",
    }
    assert len(before) == 3 and spark.table("followed").count() == 7
    assert spark.table("followed").exceptAll(read_gold(spark, gold).drop("timestamp")).count() == 0
    spark.sql("DROP TABLE followed")


def test_a_full_run_repairs_the_table_and_another_path_is_refused(spark, rows, tmp_path):
    table, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_partitioned(rows, table)
    with pytest.raises(ValueError, match="publish it first"):
        jobs.run_gold(spark, table, gold, table="followed")
    assert not os.path.exists(gold)
    jobs.run_gold(spark, table, gold)
    jobs.run_table(spark, gold, "followed")
    write_partitioned(rows.where("region = 'Riohacha'"), table)
    jobs.run_gold(spark, table, gold, table="followed")
    assert spark.table("followed").count() == 1 and len(shown(spark, "followed")) == 1
    with pytest.raises(ValueError, match="stands for"):
        jobs.run_gold(spark, table, str(tmp_path / "other"), table="followed")
    spark.sql("DROP TABLE followed")


@pytest.fixture
def view(spark, rows, tmp_path):
    """A published view, and how to refresh months of it from other rows."""
    table, gold, name = str(tmp_path / "silver"), str(tmp_path / "it's gold"), "switched"
    write_partitioned(rows, table)
    jobs.run_gold(spark, table, gold)
    publish_view(spark, gold, name)

    def refresh(changed, *months):
        write_partitioned(changed, table)
        return jobs.run_gold_switched(spark, table, str(tmp_path / "refreshed"), name, list(months))

    yield refresh
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def seen(spark) -> list:
    return sorted((r.region, r.year or 0, r.month or 0, r.dt or 0) for r in spark.table("switched").collect())


def as_seen(rows) -> list:
    return sorted((r.region, r.year or 0, r.month or 0, r.dt or 0) for r in rows.collect())


def test_a_view_shows_refreshed_months_and_the_rest(spark, rows, silver, view, tmp_path):
    assert spark.table("switched").columns == GOLD_TABLE.names and seen(spark) == as_seen(rows)
    assert [f.dataType for f in spark.table("switched").schema] == [f.dataType for f in GOLD_TABLE]
    changed = silver(
        *[(NOON + k, PATAGONIA, 1.0, 10.0, 1000, 2.0) for k in range(5)],
        (NOON + 40 * DAY, PATAGONIA, 2.0, 30.0, 1010, 3.0),
        (None, PATAGONIA, 1.0, None, None, None),
    )
    assert view(changed, (2024, 1)) == 6
    february = rows.where("month = 2").unionByName(changed.where("month = 1 OR month IS NULL"))
    assert seen(spark) == as_seen(february)
    assert view(changed, (2024, 2)) == 2
    assert seen(spark) == as_seen(changed)
    # A month that has gone, and all of them.
    assert view(changed.where("month = 1"), (2024, 2)) == 0
    assert seen(spark) == as_seen(changed.where("month = 1"))
    assert view(changed.where("dt IS NULL"), (2024, 1)) == 1
    assert seen(spark) == as_seen(changed.where("dt IS NULL"))
    folders = os.listdir(tmp_path / "refreshed")
    assert len(folders) <= 3, "folders that are no longer shown go with the next refresh but one"
    gold = str(tmp_path / "full")
    write_partitioned(rows, str(tmp_path / "silver"))
    jobs.run_gold(spark, str(tmp_path / "silver"), gold)
    publish_view(spark, gold, "switched")
    assert seen(spark) == as_seen(rows)


@pytest.mark.parametrize("step", ["write_partitioned", "switch_months"])
def test_a_refresh_that_fails_shows_the_old_months(spark, rows, silver, view, monkeypatch, step):
    """Before, after or while its months are written: readers see none of them until the view is replaced, then all."""
    changed = silver(*[(NOON + k * 20 * DAY, place, 1.0, 10.0, 1000, 2.0) for k in range(3) for place in (PATAGONIA, RIOHACHA)])
    months = [(2024, 1), (2024, 2)]
    real = getattr(jobs, step)

    def failing(*args, **options):
        if step == "write_partitioned":
            real(args[0].where("region = 'Patagonia'"), *args[1:], **options)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs, step, failing)
    with pytest.raises(RuntimeError):
        view(changed, *months)
    assert seen(spark) == as_seen(rows)
    monkeypatch.undo()
    assert view(changed, *months) == 6 and seen(spark) == as_seen(changed)


def test_a_reader_of_the_old_months_can_finish(spark, rows, silver, view):
    changed = silver((NOON, PATAGONIA, 1.0, 10.0, 1000, 2.0))
    view(changed, (2024, 1))
    reader = spark.table("switched")
    before = as_seen(reader)
    view(silver((NOON + 5, PATAGONIA, 1.0, 10.0, 1000, 2.0), (NOON + 6, RIOHACHA, 1.0, 10.0, 1000, 2.0)), (2024, 1))
    assert as_seen(reader) == before and len(seen(spark)) == len(before) + 1


def test_only_published_views_are_refreshed(spark, rows, tmp_path):
    table = str(tmp_path / "silver")
    write_partitioned(rows, table)
    with pytest.raises(ValueError, match="publish it first"):
        jobs.run_gold_switched(spark, table, str(tmp_path / "r"), "nothing_there", [(2024, 1)])
    spark.sql("CREATE VIEW another AS SELECT 1 AS one")
    with pytest.raises(ValueError, match="not a published view"):
        jobs.run_gold_switched(spark, table, str(tmp_path / "r"), "another", [(2024, 1)])
    spark.sql("DROP VIEW another")


def test_months_prune_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(rows, path)
    plan = plan_of(read_silver(spark, path).where(jobs.in_months([(2024, 1), (None, None)])))
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert "year" in filters and "month" in filters


def test_gold_job_does_not_shuffle(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(rows, path)
    plan = build_gold(read_silver(spark, path))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_table_and_partition_repair(spark, rows, tmp_path):
    path, name = str(tmp_path / "it's gold"), "gold_weather_metrics"
    gold = build_gold(rows)
    write_partitioned(gold, path)
    table = register_table(spark, path, name)
    assert table.columns == GOLD_TABLE.names and "timestamp" not in table.columns
    assert table.count() == 4
    text = "SELECT count(*) AS n FROM gold_weather_metrics WHERE region = 'Patagonia'"
    assert spark.sql(text).first().n == 2

    write_partitioned(gold.where("region = 'Riohacha'"), path)
    repair_table(spark, name)
    assert [r.region for r in spark.table(name).collect()] == ["Riohacha"]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1
    spark.sql(f"DROP TABLE {name}")
    assert files(path), "dropping an external table must leave its files"


def test_rollup_is_stored(spark, rows, tmp_path):
    gold, daily = str(tmp_path / "gold"), str(tmp_path / "daily")
    write_partitioned(build_gold(rows), gold)
    assert jobs.run_daily(spark, gold, daily).count() == 3
    assert len(files(daily)) == 2, "a file for each year"


def test_scratch_follows_the_cluster_setting(spark, conf):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


HISTORY = """[{"dt":1704067200,"lat":-41.81012,"lon":-68.9063,"uv_index":1,
 "main":{"temp":10,"pressure":1000,"humidity":5},"wind":{"speed":2}}]"""
FEED = (
    '{"_airbyte_data":{"lat":11.5384,"lon":-72.9168,"current":{"dt":1704070800,"uvi":2,'
    '"temp":30,"pressure":1010,"humidity":9,"wind_speed":3}}}'
)


@pytest.fixture
def bronze_dirs(tmp_path):
    for name, text in (("history", HISTORY), ("feed", FEED)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(text)
    return tmp_path


def arguments(root, *tables):
    return [word for t in tables for word in (f"--{t}", str(root / t))]


def test_command_line_runs_each_job_in_turn(spark, bronze_dirs, capsys):
    root = bronze_dirs
    assert cli.main(["silver", *arguments(root, "history", "feed", "silver")]) == 0
    assert cli.main(["gold", *arguments(root, "silver", "gold")]) == 0
    assert cli.main(["gold", *arguments(root, "silver", "gold"), "--month", "2024-01"]) == 0
    assert cli.main(["daily", *arguments(root, "gold", "daily")]) == 0
    out = capsys.readouterr().out
    assert "silver: 2 rows" in out and out.count("gold: 2 rows") == 2 and "daily: 2 rows" in out
    regions = {r.region for r in read_gold(spark, str(root / "gold")).collect()}
    assert regions == {"Patagonia", "Riohacha"}


def test_command_line_runs_all(bronze_dirs, capsys):
    tables = ("history", "feed", "silver", "gold", "daily")
    assert cli.main(["all", *arguments(bronze_dirs, *tables)]) == 0
    assert "gold: 2 rows" in capsys.readouterr().out


def test_command_line_publishes_the_table(spark, bronze_dirs, capsys):
    root = bronze_dirs
    assert cli.main(["all", *arguments(root, "history", "feed", "silver", "gold")]) == 0
    assert cli.main(["table", *arguments(root, "gold"), "--name", "from_cli"]) == 0
    assert "from_cli: 2 partitions" in capsys.readouterr().out
    assert spark.table("from_cli").count() == 2
    spark.sql("DROP TABLE from_cli")


def test_command_line_options_reach_the_jobs(spark, bronze_dirs, capsys):
    root = bronze_dirs
    line = " ".join(HISTORY.strip("[]").split())
    (root / "history" / "a.json").write_text(f"{line}\n{line}\nnot json\n")
    model = {
        "regions": [{"name": "Here", "lat": -41.8101, "lon": -68.9063, "slug": "here", "short": "h"}],
        "panel": {"efficiency": 0.36},
        "turbine": {"power_coefficient": 0.2},
    }
    (root / "model.json").write_text(json.dumps(model))
    options = ["--history-layout", "lines", "--model", str(root / "model.json"), "--dedup"]
    assert cli.main(["all", *arguments(root, "history", "feed", "silver", "gold"), *options]) == 0
    assert "silver: 3 rows" in capsys.readouterr().out
    gold = read_gold(spark, str(root / "gold"))
    here = gold.where("region = 'Here'").collect()
    assert [r.potencia_solar_w for r in here] == [pytest.approx(27.0)]
    assert gold.where("region = 'No Region'").count() == 2
    head = ["--record-head", '{"dt":']
    assert cli.main(["silver", *arguments(root, "history", "feed", "silver"), *head]) == 0
    assert "silver: 4 rows" in capsys.readouterr().out


def test_feed_increments_add_up_to_the_batch_result(spark, bronze_dirs, capsys):
    root = bronze_dirs
    nothing, later = root / "none", FEED.replace("1704070800", "1706745600")
    timeless = FEED.replace("1704070800", "null")
    nothing.mkdir()
    (nothing / "a.json").write_text("")
    assert cli.main(
        ["silver", *arguments(root, "history"), "--feed", str(nothing), *arguments(root, "silver")]
    ) == 0
    increment = [*arguments(root, "feed"), "--silver", str(root / "live"), *arguments(root, "state")]
    both = ["gold", *arguments(root, "silver"), "--silver", str(root / "live"), "--dedup"]
    assert cli.main(["feed", *increment]) == 0
    assert cli.main([*both, *arguments(root, "gold")]) == 0
    (root / "feed" / "b.json").write_text("\n".join([later, later, timeless]))
    assert cli.main(["feed", *increment]) == 0
    assert cli.main([*both, *arguments(root, "gold"), "--month", "2024-02"]) == 0
    assert "feed: 1 rows" in (out := capsys.readouterr().out) and "feed: 4 rows" in out

    batch = [*arguments(root, "history", "feed"), "--silver", str(root / "s2")]
    assert cli.main(["all", *batch, "--gold", str(root / "g2"), "--dedup"]) == 0
    stepwise, whole = (read_gold(spark, str(root / g)) for g in ("gold", "g2"))
    assert stepwise.count() == whole.count() == 4
    assert stepwise.exceptAll(whole).count() == 0


def history_file(root, name, *times):
    (root / "history").mkdir(exist_ok=True)
    records = [HISTORY.replace("1704067200", str(t)).strip()[1:-1] for t in times]
    (root / "history" / name).write_text("[" + ",".join(records) + "]")


def test_history_is_read_once(spark, tmp_path):
    root = tmp_path
    paths = [str(root / t) for t in ("history", "silver", "manifest")]

    def rows():
        return sorted(r.dt for r in read_silver(spark, paths[1]).collect())

    history_file(root, "a [1] {b} 50%.json", NOON, NOON + 1)
    history_file(root, "b.json", NOON + 2)
    assert jobs.run_history(spark, *paths, files_per_load=1) == 3
    assert rows() == [NOON, NOON + 1, NOON + 2]
    assert jobs.run_history(spark, *paths) == 0
    # What was read could not be read again: same names, sizes and times, but no JSON.
    for file in (root / "history").iterdir():
        size, time = file.stat().st_size, file.stat().st_mtime_ns
        file.write_text("x" * size)
        os.utime(file, ns=(time, time))
    history_file(root, "c.json", NOON + 3, NOON + 40 * DAY)
    assert jobs.run_history(spark, *paths) == 2
    assert rows() == [NOON, NOON + 1, NOON + 2, NOON + 3, NOON + 40 * DAY]
    whole = str(root / "gold")
    assert jobs.run_gold(spark, paths[1], whole) == 5
    assert jobs.run_gold(spark, paths[1], whole, [(2024, 2)]) == 1


def test_a_load_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / t) for t in ("history", "silver", "manifest")]
    history_file(tmp_path, "a.json", NOON)
    jobs.run_history(spark, *paths)
    history_file(tmp_path, "b.json", NOON + 1, NOON + 2)

    def fail(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, "note_files", fail)
    with pytest.raises(RuntimeError):
        jobs.run_history(spark, *paths)
    monkeypatch.undo()
    history_file(tmp_path, "c.json", NOON + 3)
    assert jobs.run_history(spark, *paths) == 3
    assert sorted(r.dt for r in read_silver(spark, paths[1]).collect()) == [NOON, NOON + 1, NOON + 2, NOON + 3]


def test_a_file_that_changes_is_refused(spark, tmp_path):
    paths = [str(tmp_path / t) for t in ("history", "silver", "manifest")]
    history_file(tmp_path, "a.json", NOON)
    jobs.run_history(spark, *paths)
    history_file(tmp_path, "a.json", NOON, NOON + 1)
    with pytest.raises(ValueError, match="changed after"):
        jobs.run_history(spark, *paths)


def test_command_line_of_increments(spark, bronze_dirs, capsys):
    root = bronze_dirs
    load = ["history", *arguments(root, "history", "silver", "manifest")]
    assert cli.main(load) == 0 and cli.main(load) == 0
    assert cli.main(["gold", *arguments(root, "silver", "gold")]) == 0
    assert cli.main(["table", *arguments(root, "gold"), "--name", "cli_view", "--view"]) == 0
    assert spark.table("cli_view").count() == 1
    refresh = ["refresh", *arguments(root, "silver", "refreshed"), "--view", "cli_view", "--month", "2024-01"]
    assert cli.main(refresh) == 0
    days = ["days", *arguments(root, "feed", "days", "rejected", "state"), "--finished-only"]
    assert cli.main(days) == 0
    out = capsys.readouterr().out
    assert "history: 1 rows" in out and "history: 0 rows" in out and "refresh: 1 rows" in out and "rejected: 0 rows" in out
    assert spark.table("cli_view").count() == 1
    spark.sql("DROP VIEW cli_view")


def test_failure_stops_the_sequence(spark, bronze_dirs, capsys):
    root = bronze_dirs
    missing = [*arguments(root, "history"), "--feed", str(root / "nowhere")]
    assert cli.main(["all", *missing, *arguments(root, "silver", "gold")]) == 1
    assert "all failed" in capsys.readouterr().err
    assert not (root / "gold").exists()


def test_exit_code_of_the_process(bronze_dirs):
    words = [sys.executable, "-m", "heliovane", "gold", *arguments(bronze_dirs, "silver", "gold")]
    done = subprocess.run(words, cwd=ROOT, env=os.environ, capture_output=True, timeout=120)
    assert done.returncode == 1
