import pytest
from pyspark.sql import functions as F

from shopsight.contracts import RAW_TABLES, OutputContract
from shopsight.operators import quality, recommend
from shopsight.sources import catalog, concurrent, outputs, paths, scratch, tables
from tests import tables as fixtures

CONTRACTS = {
    "a": OutputContract("a.parquet", ["x"], ["x"]),
    "b": OutputContract("b.parquet", ["y"], []),
}


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def frame(spark, column="x", value=1):
    return spark.createDataFrame([(value,)], [column])


def test_parquet_wins_over_csv(spark, folder):
    frame(spark, value=1).write.parquet(f"{folder}/t.parquet")
    frame(spark, value=2).write.option("header", True).csv(f"{folder}/t.csv")
    assert tables.detect_format(spark, "t", folder) == "parquet"
    assert tables.load_table(spark, "t", folder).first().x == 1
    with pytest.raises(FileNotFoundError, match="'u'"):
        tables.load_table(spark, "u", folder)


def test_csv_is_text(spark, folder):
    with open(f"{folder}/t.csv", "w") as out:
        out.write('id,name\n007,"a ""b"", c"\n,x\n')
    rows = tables.load_table(spark, "t", folder).collect()
    assert [tuple(r) for r in rows] == [("007", 'a "b", c'), (None, "x")]


def test_load_all_names_every_missing_table(spark, folder):
    frame(spark).write.parquet(f"{folder}/users.parquet")
    with pytest.raises(FileNotFoundError) as error:
        tables.load_all_tables(spark, folder)
    assert all(t in str(error.value) for t in RAW_TABLES if t != "users")
    with pytest.raises(FileNotFoundError, match="does not exist"):
        tables.load_all_tables(spark, f"{folder}/nowhere")
    rows = fixtures.keyed(tables.input_inventory(spark, folder, ["users", "orders"]), "table_name")
    assert (rows["users"].format, rows["users"].row_count, rows["users"].complete) == ("parquet", 1, False)
    assert (rows["orders"].format, rows["orders"].row_count) == ("none", 0)


def test_catalog(spark):
    catalog.register({"odd name`s": frame(spark, value=5), "plain": frame(spark)})
    assert catalog.table_exists(spark, "plain") and not catalog.table_exists(spark, "absent")
    assert catalog.row_count(spark, "odd name`s") == 1
    catalog.register({"plain": frame(spark, value=9)})
    assert catalog.run_query(spark, "SELECT x FROM plain WHERE x > :low", {"low": 3}).first().x == 9
    with pytest.raises(FileNotFoundError):
        catalog.sql_text("absent")


def test_failed_registration_leaves_the_catalog(spark, folder):
    catalog.register({"kept": frame(spark, value=1)})

    class Broken:
        @property
        def schema(self):
            raise ValueError("unresolved")

    with pytest.raises(ValueError):
        catalog.register({"kept": frame(spark, value=2), "broken": Broken()})
    assert spark.table("kept").first().x == 1


def test_save_replaces_and_failure_keeps_old_data(spark, folder):
    path = f"{folder}/out.parquet"
    outputs.save_parquet(frame(spark, value=1), path)
    outputs.save_parquet(frame(spark, value=2), path)
    assert outputs.load_parquet(spark, path).first().x == 2
    with pytest.raises(Exception):
        outputs.save_parquet(spark.sql("SELECT raise_error('no') AS x"), path)
    assert outputs.load_parquet(spark, path).first().x == 2
    with pytest.raises(FileNotFoundError):
        outputs.load_parquet(spark, f"{folder}/absent")


def test_status_of_each_state(spark, folder):
    names = ["ready", "missing", "unreadable", "empty", "lacking", "text"]
    contracts = {n: OutputContract(f"{n}.parquet", ["x"], ["x"]) for n in names}
    frame(spark).write.parquet(f"{folder}/ready.parquet")
    frame(spark).limit(0).write.parquet(f"{folder}/empty.parquet")
    frame(spark, "z").write.parquet(f"{folder}/lacking.parquet")
    frame(spark, value="one").write.parquet(f"{folder}/text.parquet")
    with open(f"{folder}/unreadable.parquet", "wb") as out:
        out.write(b"not parquet at all")
    status = {r.output: (r.status, r.row_count) for r in outputs.validate_outputs(spark, folder, contracts).collect()}
    assert status == {
        "ready": ("ready", 1), "missing": ("missing", None), "unreadable": ("unreadable", None),
        "empty": ("empty", 0), "lacking": ("schema_mismatch", 1), "text": ("schema_mismatch", 1),
    }
    assert outputs.load_output(spark, f"{folder}/ready.parquet").count() == 1
    assert all(outputs.load_output(spark, f"{folder}/{n}.parquet") is None for n in ("missing", "unreadable", "empty"))


def test_cohort_contract_needs_numeric_months(spark):
    contract = OutputContract("c", ["cohort_month"], [])
    good = spark.createDataFrame([("2024-01", 1.0)], ["cohort_month", "0"]).schema
    none = spark.createDataFrame([("2024-01", 1.0)], ["cohort_month", "rate"]).schema
    text = spark.createDataFrame([("2024-01", "1")], ["cohort_month", "0"]).schema
    assert not outputs.schema_problems("cohort_retention", good, contract)
    assert outputs.schema_problems("cohort_retention", none, contract)
    assert outputs.schema_problems("cohort_retention", text, contract)


def read_both(spark, folder):
    return [spark.read.parquet(f"{folder}/{n}.parquet").first()[0] for n in ("a", "b")]


def test_publish_swaps_the_whole_set(spark, folder):
    for value in (1, 2):
        status = outputs.publish_outputs({"a": frame(spark, "x", value), "b": frame(spark, "y", value)}, folder, CONTRACTS)
        assert [r.status for r in status.collect()] == ["ready", "ready"]
        assert read_both(spark, folder) == [value, value]


@pytest.mark.parametrize("fault", ["empty", "schema", "incomplete"])
def test_bad_set_keeps_the_old_one(spark, folder, fault):
    outputs.publish_outputs({"a": frame(spark, "x"), "b": frame(spark, "y")}, folder, CONTRACTS)
    bad = {
        "empty": {"a": frame(spark, "x", 2), "b": frame(spark, "y", 2).limit(0)},
        "schema": {"a": frame(spark, "x", "text"), "b": frame(spark, "y", 2)},
        "incomplete": {"a": frame(spark, "x", 2)},
    }[fault]
    with pytest.raises(ValueError):
        outputs.publish_outputs(bad, folder, CONTRACTS)
    assert read_both(spark, folder) == [1, 1]


def test_failing_second_rename_rolls_back(spark, folder, monkeypatch):
    outputs.publish_outputs({"a": frame(spark, "x"), "b": frame(spark, "y")}, folder, CONTRACTS)
    real = paths.rename

    def failing(session, source, target):
        if "_staging" in source and target.endswith("b.parquet"):
            raise OSError("disk full")
        real(session, source, target)

    monkeypatch.setattr(paths, "rename", failing)
    with pytest.raises(OSError, match="disk full"):
        outputs.publish_outputs({"a": frame(spark, "x", 2), "b": frame(spark, "y", 2)}, folder, CONTRACTS)
    assert read_both(spark, folder) == [1, 1]


def test_regenerate_collects_failures(spark, folder):
    def broken():
        raise RuntimeError("no table")

    failures = outputs.regenerate({"a": broken, "b": lambda: frame(spark, "y", 3)}, folder, CONTRACTS)
    assert list(failures) == ["a"]
    assert spark.read.parquet(f"{folder}/b.parquet").first().y == 3


def test_materialize(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS g")
    stored = scratch.materialize(df, "t")
    assert stored.dtypes == df.dtypes and stored.count() == 100
    assert stored.inputFiles()[0].replace("file://", "").startswith(scratch.root(spark).replace("file:", ""))
    spread = scratch.materialize(df.groupBy("id").count(), "t", spread_by="id")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_run_all_raises_the_first_failure(spark):
    def bad():
        raise KeyError("bad")

    assert concurrent.run_all(spark, {"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    with pytest.raises(KeyError):
        concurrent.run_all(spark, {"a": lambda: 1, "b": bad})


class Session:
    """A session whose settings name no shared folder."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_folder_is_private_only_on_a_local_session(spark):
    session = Session("local[2]")
    assert scratch.root(session) == session.folder == scratch.root(session)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.root(Session("yarn"))
    named = Session("yarn")
    named.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert scratch.root(named) == "hdfs:///shared"


def test_csv_null_words_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name\n1,NA\n2,"two\nlines"\n3,nan\n4,Nan\n')
    rows = {r.id: r.name for r in tables.read_csv(spark, str(tmp_path / "t.csv"), multi_line=True).collect()}
    assert rows == {"1": None, "2": "two\nlines", "3": None, "4": "Nan"}


def test_persistent_registration_is_all_or_nothing(spark):
    name = "persistent_test_table"
    catalog.register({name: frame(spark, value=1)}, persistent=True)
    try:
        broken = spark.sql("SELECT raise_error('no') AS x")
        with pytest.raises(Exception):
            catalog.register({name: frame(spark, value=2), "persistent_test_broken": broken}, persistent=True)
        assert spark.newSession().table(name).first().x == 1
        catalog.register({name: frame(spark, value=3)}, persistent=True)
        assert spark.newSession().table(name).first().x == 3
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith("persistent_test")]
        assert left == [name]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_spread_tables_grow_with_their_rows(spark, monkeypatch):
    monkeypatch.setattr(scratch, "ROWS_PER_PART", 10)
    stored = scratch.materialize(spark.range(200).withColumnRenamed("id", "key"), "spread", spread_by="key")
    assert stored.count() == 200 and 15 <= len(stored.inputFiles()) <= 20


def test_spread_tables_fill_all_cores(spark, monkeypatch):
    """Of 5 parts on 4 cores, one would run alone after the others."""
    monkeypatch.setattr(scratch, "ROWS_PER_PART", 1000)
    stored = scratch.materialize(spark.range(4500).withColumnRenamed("id", "key"), "spread", spread_by="key")
    assert stored.count() == 4500 and len(stored.inputFiles()) == 8


class Lost(BaseException):
    """The process ends here: nothing after it runs, no handler for errors either."""


def crash_at(monkeypatch, step):
    """Ends the process at the given call of a function that changes files."""
    calls = 0

    def counted(real):
        def run(*args):
            nonlocal calls
            calls += 1
            if calls == step:
                raise Lost
            return real(*args)

        return run

    for name in ("rename", "delete", "write_new"):
        monkeypatch.setattr(paths, name, counted(getattr(paths, name)))


def publish_with_model(spark, folder, value):
    with outputs.Staging(spark, folder, CONTRACTS) as staging:
        staging.write("a", frame(spark, "x", value))
        staging.write("b", frame(spark, "y", value))
        frame(spark, "z", value).write.parquet(staging.attach(f"{folder}-model"))
        staging.publish()


def test_a_lost_process_leaves_one_set(spark, folder):
    """After a loss at any step, outputs and model are all old or all new, and the next publisher goes on."""
    seen, value = set(), 1
    publish_with_model(spark, folder, value)
    for step in range(1, 40):
        with pytest.MonkeyPatch.context() as patch:
            crash_at(patch, step)
            try:
                publish_with_model(spark, folder, value + 1)
                lost = False
            except Lost:
                lost = True
        held = [outputs.load_output(spark, f"{folder}/{n}.parquet").first()[0] for n in ("a", "b")]
        held.append(spark.read.parquet(outputs.located(spark, f"{folder}-model", folder)).first()[0])
        assert len(set(held)) == 1 and held[0] in (value, value + 1)
        status = {r.output: r.status for r in outputs.validate_outputs(spark, folder, CONTRACTS).collect()}
        assert set(status.values()) == {"ready"}
        seen.add(held[0] - value)
        outputs.finish(spark, folder)
        assert read_both(spark, folder) == held[:2]
        value = held[0]
        if not lost:
            break
    assert not lost and seen == {0, 1}
    publish_with_model(spark, folder, value + 1)
    assert read_both(spark, folder) == [value + 1, value + 1]


def test_failed_way_back_leaves_the_new_set(spark, folder, monkeypatch):
    """When not even the old set can be restored, readers go on with the committed one."""
    publish_with_model(spark, folder, 1)
    real = paths.rename

    def failing(session, source, target):
        if target.endswith(("/b.parquet", "/a.parquet")) and ("_staging" in source or ".backup-" in source) and "b.parquet" in target:
            raise OSError("gone")
        real(session, source, target)

    monkeypatch.setattr(paths, "rename", failing)
    with pytest.raises(OSError):
        publish_with_model(spark, folder, 2)
    assert [outputs.load_output(spark, f"{folder}/{n}.parquet").first()[0] for n in ("a", "b")] == [2, 2]
    monkeypatch.setattr(paths, "rename", real)
    outputs.finish(spark, folder)
    assert read_both(spark, folder) == [2, 2]


@pytest.mark.parametrize("failing", range(1, 5))
def test_failed_exchange_of_names_restores_all_tables(spark, monkeypatch, failing):
    """Each of the four renames of two persistent tables fails once; both keep their old content."""
    names = [f"exchanged_{failing}_a", f"exchanged_{failing}_b"]
    catalog.register({n: frame(spark, value=1) for n in names}, persistent=True)
    try:
        real, seen = type(spark).sql, []

        def sql(self, text, *args, **kwargs):
            if "RENAME TO" in text:
                seen.append(text)
                if len(seen) == failing:
                    raise OSError("catalog away")
            return real(self, text, *args, **kwargs)

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", sql)
            with pytest.raises(OSError):
                catalog.register({n: frame(spark, value=2) for n in names}, persistent=True)
        assert [spark.newSession().table(n).first().x for n in names] == [1, 1]
        assert sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(f"exchanged_{failing}")) == names
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def rows_read(df):
    """Rows that the scans of a collected plan have read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_one_customer_reads_one_row_group(spark, folder):
    """Of eight files, sorted and with bloom filters, a lookup reads the rows of one; an unknown key almost none."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.range(40_000).selectExpr("id * 3 as customer_id", "id % 5 as rank", "uuid() as product_name")
        outputs.save_for_lookups(table, f"{folder}/recs.parquet")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    stored = outputs.load_parquet(spark, f"{folder}/recs.parquet")
    sizes = [r[1] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8
    one = recommend.customer_recommendations(stored, 300, 3)
    assert one.count() == 1 and rows_read(one) <= max(sizes)
    assert rows_read(recommend.customer_recommendations(stored, 301, 3)) <= max(sizes)


def test_malformed_csv_records_are_counted(spark, tmp_path):
    """Short, long and empty-field records, quotes and blank lines; null words do not count."""
    lines = ["id,name,age", "1,a,2", "2,b", "3,c,4,5", '4,"d ""q"", x",9', "5", "", "6,e,nan", "7,,"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    rows, counts = tables.stored_csv(spark, str(tmp_path / "t.csv"), "t")
    assert tuple(counts.first()) == (7, 3)
    assert rows.columns == ["id", "name", "age"]
    assert {r.id: (r.name, r.age) for r in rows.collect()} == {
        "1": ("a", "2"), "2": ("b", None), "3": ("c", "4"), "4": ('d "q", x', "9"), "5": (None, None), "6": ("e", None), "7": (None, None),
    }
    check = quality.finish(quality.record_checks({"t": counts})).first()
    assert (check.table_name, check.check_name, check.severity, check.n_bad) == ("t", "malformed_record", "warning", 3)


def test_run_folder_holds_what_its_threads_store_and_goes_at_the_end(spark):
    with scratch.run_folder(spark) as run:
        one = scratch.materialize(spark.range(3), "inside")
        two = concurrent.run_all(spark, {"t": lambda: scratch.materialize(spark.range(4), "thread")})["t"]
        assert all(run.replace("file:", "") in df.inputFiles()[0].replace("file://", "") for df in (one, two))
        with scratch.run_folder(spark) as inner:
            assert inner.startswith(run)
        assert scratch.new_path(spark, "x").startswith(run)
    assert not paths.exists(spark, run)
    assert not scratch.new_path(spark, "x").startswith(run)
    with pytest.raises(KeyError), scratch.run_folder(spark) as failed:
        scratch.materialize(spark.range(3), "inside")
        raise KeyError
    assert not paths.exists(spark, failed)
