from __future__ import annotations

import random
import threading
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from civicflow import contracts
from civicflow.operators import clean, dimensions, facts, key_sketch
from civicflow.plans import load
from civicflow.sources import entry_log, snapshots
from civicflow.sources.tables import create_exclusively

DAY = 86_400_000
START = 1_710_000_000_000
MONDAY = datetime(2024, 4, 1, tzinfo=timezone.utc)
TUESDAY = datetime(2024, 4, 2, tzinfo=timezone.utc)


@pytest.fixture
def batch(cases):
    return lambda *changes: clean.clean_requests(cases(*changes))


def keyed(df, key, *names):
    return {tuple(r[n] for n in names): r[key] for r in df.collect()}


def test_members_are_distinct_and_present(batch):
    df = batch({"OBJECTID": 1}, {"OBJECTID": 2}, {"OBJECTID": 3, "Agency": " "}, {"OBJECTID": 4, "Agency": "Water"})
    assert set(keyed(dimensions.agencies(df), "agency_key", "agency_name")) == {("Parks",), ("Water",)}


def test_a_service_type_needs_both_parts(batch):
    df = batch({"OBJECTID": 1, "Topic": None}, {"OBJECTID": 2, "Type": None}, {"OBJECTID": 3})
    assert set(keyed(dimensions.service_types(df), "service_type_key", "type_name", "topic_name")) == {
        ("Tree", "Hazard")
    }


def test_keys_are_unique_positive_and_repeatable(spark):
    members = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("name"))
    first = keyed(dimensions.assign_keys(members, "k", ["name"]), "k", "name")
    again = keyed(dimensions.assign_keys(members.orderBy(F.rand()), "k", ["name"]), "k", "name")
    assert first == again
    assert sorted(first.values()) == list(range(1, 5001))
    for ranges in (1, 3, 700):
        assert keyed(dimensions.assign_keys(members, "k", ["name"], ranges=ranges), "k", "name") == first
    above = keyed(dimensions.assign_keys(members, "k", ["name"], F.lit(70), 9), "k", "name")
    assert above == {name: number + 70 for name, number in first.items()}


def test_known_members_keep_keys_and_attributes(batch):
    old = dimensions.neighborhoods(batch({"OBJECTID": 1}))
    new = dimensions.neighborhoods(
        batch({"OBJECTID": 2, "Council_District": 9}, {"OBJECTID": 3, "Neighborhood": "Baker"}), old
    )
    before = {r["neighborhood_name"]: r for r in old.collect()}
    after = {r["neighborhood_name"]: r for r in new.collect()}
    assert after["Hilltop"] == before["Hilltop"]
    assert after["Baker"]["neighborhood_key"] > before["Hilltop"]["neighborhood_key"]


def test_districts_come_from_the_earliest_case_then_the_lowest_key(batch):
    df = batch(
        {"OBJECTID": 5, "Case_Created_Date": START, "Council_District": 5},
        {"OBJECTID": 4, "Case_Created_Date": START, "Council_District": 4},
        {"OBJECTID": 1, "Case_Created_Date": START + 1, "Council_District": 1},
        {"OBJECTID": 2, "Case_Created_Date": None, "Council_District": 2},
        {"OBJECTID": -9, "Case_Created_Date": START, "Council_District": None},
    )
    row = dimensions.neighborhoods(df).first()
    assert (row["council_district"], row["police_district"]) == (None, 2)


@pytest.mark.parametrize("low, high", [((0, 2**63 - 1), (1, -(2**63))), ((-5, 0), (0, -1)), ((3, 1), (3, 2)), ((3, 9), (None, 0))])
def test_arrival_orders_by_time_then_key(spark, low, high):
    schema = "ms bigint, k bigint"
    df = spark.createDataFrame([low, high], schema).select(
        "ms", "k", dimensions.arrival(F.timestamp_millis("ms"), F.col("k")).alias("a")
    )
    first, second = df.orderBy("a").select("ms", "k").collect()
    assert (tuple(first), tuple(second)) == (low, high)


def test_dates_are_added_once(batch):
    old = dimensions.dates(batch({"OBJECTID": 1, "Case_Created_Date": START}))
    new = dimensions.dates(
        batch({"OBJECTID": 2, "Case_Created_Date": START}, {"OBJECTID": 3, "Case_Created_Date": START + DAY}), old
    )
    assert sorted(r["date_key"] for r in new.collect()) == [20240309, 20240310]


def test_unknown_names_leave_null_keys_and_flags_default_to_false(batch, spark):
    df = batch({"OBJECTID": 1, "Agency": None, "Topic": None, "Case_Source": None})
    fact = facts.stage_facts(
        df, dimensions.agencies(df), dimensions.service_types(df), dimensions.neighborhoods(df), F.current_timestamp()
    )
    row = fact.first()
    assert (row["agency_key"], row["service_type_key"]) == (None, None)
    assert row["neighborhood_key"] is not None
    assert row["is_likely_internal"] is False
    assert fact.dtypes == contracts.STAR_TABLES["fact_service_request"]


def test_load_counts_are_attempts(batch):
    df = batch(
        {"OBJECTID": 1}, {"OBJECTID": 2, "Topic": None}, {"OBJECTID": 3, "Type": "", "Topic": " ", "Agency": ""}
    )
    assert facts.load_counts(df).first().asDict() == {
        "dim_agency_upserted": 2,
        "dim_service_type_upserted": 2,
        "dim_neighborhood_upserted": 3,
        "dim_date_upserted": 3,
        "facts_upserted": 3,
    }


@pytest.fixture
def warehouse(spark, batch, tmp_path):
    """Load batches into one warehouse; rows of the fact by key come back."""
    root = str(tmp_path / "star")

    def load_only(name, stamp, *changes):
        path = str(tmp_path / f"batch-{name}")
        batch(*changes).write.mode("overwrite").parquet(path)
        return load.load_star(spark, spark.read.parquet(path), root, batch_id=name, loaded_at=stamp, **run.options)

    def run(name, stamp, *changes):
        version = load_only(name, stamp, *changes)
        fact = load.read_table(spark, root, "fact_service_request")
        return version, {r["object_id"]: r for r in fact.collect()}

    run.root, run.load, run.options = root, load_only, {}
    return run


def test_an_upsert_replaces_only_the_state_of_a_case(warehouse):
    closed = {"Case_Closed_Date": START + DAY, "Case_Status": "Closed"}
    _, before = warehouse("a", MONDAY, {"OBJECTID": 1}, {"OBJECTID": 2, **closed}, {"OBJECTID": 3})
    _, after = warehouse(
        "b",
        TUESDAY,
        {"OBJECTID": 1, **closed, "Agency": "Water", "Latitude": 39.9, "Case_Source": "Email"},
        {"OBJECTID": 2, "Case_Status": "Reopened"},
        {"OBJECTID": 4},
    )
    assert sorted(after) == [1, 2, 3, 4]
    assert (after[1]["case_status"], float(after[1]["resolution_hours"])) == ("Closed", 24.0)
    for column in ("agency_key", "latitude", "case_source", "created_at", "is_likely_internal"):
        assert after[1][column] == before[1][column]
    assert (after[2]["closed_at"], after[2]["is_closed"], after[2]["resolution_hours"]) == (None, False, None)
    assert after[3] == before[3]
    stamps = {k: r["loaded_at"] for k, r in after.items()}
    assert stamps[1] == stamps[2] == stamps[4] != stamps[3]


def test_loading_the_same_cases_twice_equals_loading_them_once(warehouse, spark):
    rows = [{"OBJECTID": i, "Agency": f"A{i % 3}", "Neighborhood": f"N{i % 5}"} for i in range(30)]
    _, once = warehouse("a", MONDAY, *rows)
    dims = {t: sorted(load.read_table(spark, warehouse.root, t).collect()) for t in load.DIMENSIONS}
    _, twice = warehouse("b", MONDAY, *rows)
    assert once == twice
    assert dims == {t: sorted(load.read_table(spark, warehouse.root, t).collect()) for t in load.DIMENSIONS}


def test_a_committed_batch_is_not_loaded_again(warehouse):
    assert warehouse("a", MONDAY, {"OBJECTID": 1})[0] == 1
    assert warehouse("a", TUESDAY, {"OBJECTID": 2}) == warehouse("a", MONDAY, {"OBJECTID": 1})


def test_an_unfinished_version_is_invisible_and_goes(warehouse, spark):
    warehouse("a", MONDAY, {"OBJECTID": 1})
    junk = Path(warehouse.root, snapshots.new_folder(2))
    spark.range(3).write.parquet(f"{junk}/dim_agency")
    assert load.read_table(spark, warehouse.root, "dim_agency").count() == 1
    version, after = warehouse("b", TUESDAY, {"OBJECTID": 2, "Agency": "Water"})
    assert (version, sorted(after)) == (2, [1, 2])
    assert load.read_table(spark, warehouse.root, "dim_agency").count() == 2
    load.expire(spark, warehouse.root, 1)
    assert not junk.exists() and load.read_table(spark, warehouse.root, "dim_agency").count() == 2


def test_an_empty_warehouse_has_typed_empty_tables(spark, tmp_path):
    star = load.read_star(spark, str(tmp_path / "none"))
    assert {t: (df.count(), df.dtypes) for t, df in star.items()} == {
        t: (0, columns) for t, columns in contracts.STAR_TABLES.items()
    }


def fact_parts(spark, root, version=None):
    return sorted(snapshots.state(spark, root, version).of("fact_service_request"), key=lambda part: part.low)


def test_a_load_writes_only_the_parts_it_touches(warehouse, spark):
    far = START + 100 * DAY
    warehouse.options = {"part_bytes": 3000}
    warehouse("a", MONDAY, {"OBJECTID": 1}, {"OBJECTID": 2, "Case_Created_Date": far})
    first, second = fact_parts(spark, warehouse.root)
    assert (first.low, first.high, first.rows, second.low, second.high, second.rows) == (1, 1, 1, 2, 2, 1)
    stamp = Path(warehouse.root, first.path).stat().st_mtime_ns
    _, after = warehouse("b", TUESDAY, {"OBJECTID": 2, "Case_Created_Date": START, "Case_Status": "Closed"}, {"OBJECTID": 3, "Case_Created_Date": far})
    assert Path(warehouse.root, first.path).stat().st_mtime_ns == stamp
    paths = [part.path for part in fact_parts(spark, warehouse.root)]
    assert first.path in paths and second.path not in paths
    assert {k: r["case_status"] for k, r in after.items()} == {1: "Open", 2: "Closed", 3: "Open"}
    assert after[2]["created_at"].month == 6  # a known case stays when it was created
    assert not list(Path(warehouse.root).glob("v=*/*/_staged"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fact_")]
    assert {r["object_id"] for r in load.read_table(spark, warehouse.root, "fact_service_request", 1).collect()} == {1, 2}


def test_parts_grow_by_bytes_and_not_by_month(warehouse, spark):
    rows = [{"OBJECTID": i, "Case_Created_Date": START + i * 40 * DAY} for i in range(30)]
    warehouse("a", MONDAY, *rows)
    assert len(fact_parts(spark, warehouse.root)) == 1
    split = {"OBJECTID": 100, "Incident_Address_1": "x"}
    warehouse.options = {"part_bytes": 5000}
    warehouse("b", MONDAY, *[{**split, "OBJECTID": 100 + i} for i in range(40)])  # one month, several parts
    new = [part for part in fact_parts(spark, warehouse.root) if part.low >= 100]
    assert len(new) > 1 and all(a.high < b.low for a, b in zip(new, new[1:]))


def test_keys_are_looked_up_without_an_exchange_of_the_stored_ones(spark, tmp_path):
    spark.range(50_000).withColumnRenamed("id", "key").write.parquet(str(tmp_path / "known"))
    spark.range(7, 8).withColumnRenamed("id", "key").write.parquet(str(tmp_path / "one"))
    known, one = (spark.read.parquet(str(tmp_path / name)) for name in ("known", "one"))
    plan = executed_plan(load.known_cases(known, one))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_one_row_batch_reads_only_parts_whose_sketch_may_hold_it(warehouse, spark, batch, monkeypatch):
    keys = [i * 1000 + j for j in range(8) for i in range(40)]
    warehouse.options = {"part_bytes": 1200}
    warehouse("a", MONDAY, *[{"OBJECTID": k, "Case_Created_Date": START + (k % 1000) * 40 * DAY} for k in keys])
    parts = fact_parts(spark, warehouse.root)
    assert len(parts) > 3 and parts[-1].low < 20_003 < parts[0].high  # key ranges alone do not tell
    read, plain = [], load._read_parts
    monkeypatch.setattr(load, "_read_parts", lambda s, r, table, found: read.append((table, [p.path for p in found])) or plain(s, r, table, found))
    _, after = warehouse("b", TUESDAY, {"OBJECTID": 20_003, "Case_Status": "Closed"})
    opened = {path for table, paths in read[:-1] if table == "fact_service_request" for path in paths if path in {p.path for p in parts}}
    assert len(opened) < len(parts) and after[20_003]["case_status"] == "Closed"
    holding = [p for p in parts if p.path in opened]
    assert any(p.low <= 20_003 <= p.high for p in holding)


@pytest.mark.parametrize("keys, buckets", [(100, 1), (20_000, 8), (300, 4)])
def test_sketches_miss_no_key_and_name_few_others(spark, keys, buckets):
    held = spark.range(keys).select((F.col("id") % 5).cast("string").alias("part"), (F.col("id") * 7 - 900).alias("key"))
    sketch = key_sketch.sketches(held, buckets).cache()
    assert sketch.where(F.octet_length("bits") != 4096).isEmpty()
    for part in range(5):
        one = held.where(F.col("part") == str(part)).limit(1).select("key")
        assert str(part) in {r["part"] for r in key_sketch.parts_that_may_hold(sketch, one, [buckets, 2]).collect()}
    absent = spark.range(400).select((F.col("id") * 7 - 899).alias("key"))
    wrong = sum(not key_sketch.parts_that_may_hold(sketch, absent.where(F.col("key") == k), [buckets]).isEmpty() for k in (-899, -199, 5, 12, 901))
    assert wrong <= 1
    assert key_sketch.buckets_for(keys) * key_sketch.BUCKET_BITS >= 12 * keys and key_sketch.buckets_for(0) == 1


def test_small_parts_become_one(warehouse, spark, monkeypatch):
    """A table has a bounded number of files, however many loads there were."""
    monkeypatch.setattr(load, "SMALL_PARTS", 3)
    for number in range(7):
        warehouse.load(f"b{number}", MONDAY, {"OBJECTID": number, "Agency": f"A{number}", "Case_Created_Date": START + number * DAY})
        state = snapshots.state(spark, warehouse.root)
        assert all(len(state.of(table)) <= 3 for table in contracts.STAR_TABLES)
    star = load.read_star(spark, warehouse.root)
    assert {t: df.count() for t, df in star.items()} == {
        "dim_agency": 7, "dim_service_type": 1, "dim_neighborhood": 1, "dim_date": 7, "fact_service_request": 7
    }
    assert sorted(r["agency_key"] for r in star["dim_agency"].collect()) == list(range(1, 8))
    assert load.read_table(spark, warehouse.root, "dim_agency", 4).count() == 4
    load.expire(spark, warehouse.root, 2)
    assert load.read_table(spark, warehouse.root, "dim_agency", 6).count() == 6
    assert load.read_table(spark, warehouse.root, "fact_service_request").count() == 7
    assert warehouse.load("b2", MONDAY, {"OBJECTID": 2}) == 3  # still known as loaded


def test_the_log_stays_short(spark, tmp_path, monkeypatch):
    """After fifty commits a reader opens one snapshot and the entries behind it."""
    root = str(tmp_path)
    for version in range(1, 51):
        parts = [snapshots.Part("t", f"v={version:06d}/x/t", version)]
        removed = [f"v={version - 1:06d}/x/t"] if version % 10 == 0 else []
        Path(root, f"v={version:06d}/x/t").mkdir(parents=True)
        snapshots.commit(spark, root, version, f"b{version}", [f"r{version}"], parts, removed)
        assert len(entry_log.files(spark, f"{root}/_commits")) <= entry_log.SNAPSHOT_EVERY + 1
    read, plain = [], entry_log.read_text
    monkeypatch.setattr(entry_log, "read_text", lambda s, path: read.append(path) or plain(s, path))
    state = snapshots.state(spark, root)
    assert 0 < len(read) <= entry_log.SNAPSHOT_EVERY + 1
    assert (state.version, snapshots.current_version(spark, root)) == (50, 50)
    shown = [v for v in range(1, 51) if (v + 1) % 10 or v == 50]
    assert sorted(part.rows for part in state.of("t")) == shown
    assert sorted(p.rows for p in snapshots.state(spark, root, 23).of("t")) == [v for v in shown if v < 23] + [23]
    found = snapshots.commits(spark, root).collect()
    assert sorted((r["version"], r["batch_id"], r["runs"]) for r in found) == [(v, f"b{v}", [f"r{v}"]) for v in range(1, 51)]
    assert snapshots.version_of(spark, root, "b7") == 7 and not snapshots.committed(spark, root, "b70")
    snapshots.expire(spark, root, 1)
    assert len(list(Path(root, "_commits").glob("[!.]*.json"))) <= entry_log.SNAPSHOT_EVERY + 1
    assert sorted(int(p.name[2:]) for p in Path(root).glob("v=*")) == shown
    assert snapshots.state(spark, root).of("t") == state.of("t") and snapshots.commits(spark, root).count() == 50


def test_of_two_loads_of_one_version_one_commits(warehouse, spark, batch, tmp_path, monkeypatch):
    warehouse("a", MONDAY, {"OBJECTID": 1})
    for name in ("x", "y"):
        batch({"OBJECTID": 2, "Case_Status": name}).write.parquet(str(tmp_path / name))
    meet, outcome = threading.Barrier(2), {}
    create = entry_log.create_exclusively

    def together(session, path, text):
        if path.endswith("entry-00000002.json"):
            meet.wait(60)
        return create(session, path, text)

    monkeypatch.setattr(entry_log, "create_exclusively", together)

    def go(name):
        try:
            outcome[name] = load.load_star(spark, spark.read.parquet(str(tmp_path / name)), warehouse.root, batch_id=name)
        except snapshots.StaleVersionError:
            outcome[name] = "refused"

    threads = [threading.Thread(target=go, args=(name,)) for name in ("x", "y")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(map(str, outcome.values())) == ["2", "refused"]
    winner = next(name for name, result in outcome.items() if result == 2)
    fact = load.read_table(spark, warehouse.root, "fact_service_request")
    assert {r["object_id"]: r["case_status"] for r in fact.collect()} == {1: "Open", 2: winner}
    assert len(list(Path(warehouse.root, "v=000002").iterdir())) == 1


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/log/one.json"
    assert create_exclusively(spark, path, "first") and not create_exclusively(spark, path, "second")
    assert Path(path).read_text() == "first" and len(list(Path(path).parent.glob("[!.]*"))) == 1


def test_a_small_first_batch_does_not_fix_the_tasks_of_later_ones(warehouse, spark):
    warehouse("a", MONDAY, {"OBJECTID": 1})
    current = load.read_table(spark, warehouse.root, "fact_service_request")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "64")
    try:
        plan = executed_plan(facts.merge_facts(current, current))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert "hashpartitioning(object_id" in plan and ", 64)" in plan


@pytest.mark.parametrize(
    "row, copies, message",
    [
        ({"OBJECTID": 5}, 2, "1 rows repeat a key"),
        ({"OBJECTID": None}, 1, "1 rows have no key"),
        ({"OBJECTID": 7, "Case_Created_Date": None}, 1, "1 rows have no creation time"),
    ],
)
def test_a_batch_that_breaks_the_key_is_refused(warehouse, spark, batch, tmp_path, row, copies, message):
    _, before = warehouse("a", MONDAY, {"OBJECTID": 1})
    path = str(tmp_path / "broken")
    for _ in range(copies):
        batch(row).write.mode("append").parquet(path)
    with pytest.raises(load.BatchKeyError, match=message):
        load.load_star(spark, spark.read.parquet(path), warehouse.root, batch_id="b")
    fact = load.read_table(spark, warehouse.root, "fact_service_request")
    assert {r["object_id"]: r for r in fact.collect()} == before


def test_a_stale_version_is_refused(warehouse, spark):
    warehouse("a", MONDAY, {"OBJECTID": 1})
    with pytest.raises(snapshots.StaleVersionError):
        snapshots.commit(spark, warehouse.root, 1, "late")


def test_old_parts_are_deleted_on_request(warehouse, spark):
    for number in range(5):
        warehouse(f"b{number}", MONDAY, {"OBJECTID": 1, "Case_Status": str(number)}, {"OBJECTID": 10 + number})
    load.expire(spark, warehouse.root, 2)
    assert len(list(Path(warehouse.root).glob("v=*/*/fact_service_request/*.parquet"))) == 2
    assert load.read_table(spark, warehouse.root, "fact_service_request").count() == 6
    assert load.read_table(spark, warehouse.root, "fact_service_request", 4).count() == 5


def test_all_rows_of_every_table_reach_the_warehouse(warehouse, spark):
    rows = [{"OBJECTID": i, "Agency": f"A{i}", "Case_Created_Date": START + i * DAY} for i in range(25)]
    warehouse("a", MONDAY, *rows)
    star = load.read_star(spark, warehouse.root)
    joined = star["fact_service_request"].join(star["dim_agency"], "agency_key").join(
        star["dim_date"], F.col("date_key") == F.col("created_date_key")
    )
    pairs = {(r["object_id"], r["agency_name"], r["full_date"]) for r in joined.collect()}
    assert len(pairs) == 25 and all(name == f"A{key}" for key, name, _ in pairs)


def one_by_one(batches, stamps):
    """What loading row after row must give: fact rows by key with member names, and districts."""
    fact, hoods, members = {}, {}, {"agency": set(), "type": set(), "date": set()}
    for rows, stamp in zip(batches, stamps):
        for row in sorted(rows, key=lambda r: (r["Case_Created_Date"], r["OBJECTID"])):
            if row["Agency"]:
                members["agency"].add(row["Agency"])
            kind = (row["Type"], row["Topic"]) if row["Type"] and row["Topic"] else None
            if kind:
                members["type"].add(kind)
            if row["Neighborhood"]:
                hoods.setdefault(row["Neighborhood"], (row["Council_District"], row["Police_District"]))
            day = datetime.fromtimestamp(row["Case_Created_Date"] / 1000, tz=timezone.utc)
            members["date"].add(int(day.strftime("%Y%m%d")))
            closed = row["Case_Closed_Date"]
            hours = None if closed is None else round((closed - row["Case_Created_Date"]) / 3_600_000, 2)
            state = {"status": row["Case_Status"], "closed": closed, "hours": hours, "loaded": stamp}
            known = fact.setdefault(
                row["OBJECTID"],
                {"agency": row["Agency"], "kind": kind, "hood": row["Neighborhood"], "created": row["Case_Created_Date"]},
            )
            known.update(state)
    return fact, hoods, members


def random_batch(rng):
    rows = []
    for key in rng.sample(range(40), 25):
        created = START + rng.randrange(4) * DAY
        rows.append(
            {
                "OBJECTID": key,
                "Case_Created_Date": created,
                "Case_Closed_Date": rng.choice([None, created + rng.randrange(50) * 1_800_000]),
                "Case_Status": rng.choice(["New", "Closed", None]),
                "Agency": rng.choice(["A", "B", "C", None]),
                "Type": rng.choice(["t1", "t2", None]),
                "Topic": rng.choice(["x", "y", None]),
                "Neighborhood": rng.choice(["n1", "n2", "n3", None]),
                "Council_District": rng.choice([1, 2, None]),
                "Police_District": rng.choice([5, 6]),
            }
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_equal_inserting_row_by_row(warehouse, spark, seed):
    rng = random.Random(seed)
    batches, stamps = [random_batch(rng) for _ in range(3)], [MONDAY, TUESDAY, TUESDAY.replace(day=3)]
    for number, (rows, stamp) in enumerate(zip(batches, stamps)):
        warehouse(f"b{number}", stamp, *rows)
    expected, hoods, members = one_by_one(batches, stamps)

    star = load.read_star(spark, warehouse.root)
    found_hoods = {r["neighborhood_name"]: (r["council_district"], r["police_district"]) for r in star["dim_neighborhood"].collect()}
    assert found_hoods == hoods
    assert {r["agency_name"] for r in star["dim_agency"].collect()} == members["agency"]
    assert {(r["type_name"], r["topic_name"]) for r in star["dim_service_type"].collect()} == members["type"]
    assert {r["date_key"] for r in star["dim_date"].collect()} == members["date"]

    named = (
        star["fact_service_request"]
        .join(star["dim_agency"], "agency_key", "left")
        .join(star["dim_service_type"], "service_type_key", "left")
        .join(star["dim_neighborhood"], "neighborhood_key", "left")
    )
    found = {
        r["object_id"]: {
            "agency": r["agency_name"],
            "kind": (r["type_name"], r["topic_name"]) if r["type_name"] else None,
            "hood": r["neighborhood_name"],
            "created": r["created_ms"],
            "status": r["case_status"],
            "closed": r["closed_ms"],
            "hours": None if r["resolution_hours"] is None else float(r["resolution_hours"]),
            "loaded": datetime.fromtimestamp(r["loaded_ms"] / 1000, tz=timezone.utc),
        }
        for r in named.withColumns(
            {
                "created_ms": F.unix_millis("created_at"),
                "closed_ms": F.unix_millis("closed_at"),
                "loaded_ms": F.unix_millis("loaded_at"),
            }
        ).collect()
    }
    assert found == expected


def test_a_fresh_session_continues_a_warehouse(warehouse, spark):
    """Nothing of a warehouse is in the catalog."""
    warehouse("a", MONDAY, {"OBJECTID": 1}, {"OBJECTID": 2})
    assert not spark.catalog.listTables()
    _, after = warehouse("b", TUESDAY, {"OBJECTID": 2, "Case_Status": "Closed"}, {"OBJECTID": 3})
    assert {k: r["case_status"] for k, r in after.items()} == {1: "Open", 2: "Closed", 3: "Open"}


def test_the_load_report_separates_attempts_from_new_rows(warehouse, spark, tmp_path):
    warehouse("a", MONDAY, {"OBJECTID": 1}, {"OBJECTID": 2})
    warehouse("b", TUESDAY, {"OBJECTID": 2}, {"OBJECTID": 3, "Agency": "Water", "Topic": None})
    batch = spark.read.parquet(str(tmp_path / "batch-b"))
    rows = load.load_report(spark, warehouse.root, batch, 2).collect()
    assert {r["table_name"]: (r["attempted"], r["inserted"]) for r in rows} == {
        "dim_agency": (2, 1),
        "dim_service_type": (2, 0),
        "dim_neighborhood": (2, 0),
        "dim_date": (2, 0),
        "fact_service_request": (2, 1),
    }
