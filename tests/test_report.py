import json
import os
from dataclasses import replace
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyproof.operators.forms import COUNTED, RECORD, RECORDS, TIMES, record
from tallyproof.operators.gaps import seq_gap
from tallyproof.plans.checks import CHECKS
from tallyproof.plans.domains import BY_SLUG, DOMAINS
from tallyproof.plans import report
from tallyproof.plans.report import read_report, run_report
from tallyproof.sources.registry import JdbcSource, ParquetSource, ReadSplit, Registry
from tallyproof.sources.shared import SETTING, SharedReads, intermediates, shared_folder, store
from tallyproof.sources.layout import write_heads
from tallyproof.sources.testdata import AS_OF, TestdataSource

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return Registry({"RMS": TestdataSource(spark, SF, "RMS")})


def failing(*_):
    raise RuntimeError("no such table")


def failing_late(source, *_):
    return source.table("database_branch").selectExpr("id", "raise_error('late') AS x")


def empty(source, *_):
    return source.table("database_branch").filter("id < 0")


def test_a_failing_check_does_not_stop_the_others(spark, sources):
    checks = (
        replace(CHECKS[1], build=failing),
        replace(CHECKS[2], build=failing_late),
        replace(CHECKS[5], build=empty),
        CHECKS[20],
    )
    rows = run_report(spark, sources, AS_OF, checks=checks).collect()
    assert [row.check_title for row in rows] == [check.title for check in checks]
    assert [row.status for row in rows] == ["ERROR", "ERROR", "EMPTY", "ROWS"]
    assert rows[0].message == "no such table" and "late" in rows[1].message
    assert (rows[2].row_count, rows[2].message) == (0, "No records found")
    assert rows[3].row_count > 0 and rows[3].message is None


def test_a_report_that_is_to_be_whole_fails_with_its_sections(spark, sources):
    checks = (replace(CHECKS[1], build=failing), replace(CHECKS[2], build=failing_late), CHECKS[20])
    with pytest.raises(report.ReportFailed, match="2 of 3") as raised:
        run_report(spark, sources, AS_OF, checks=checks, whole=True)
    assert f"RMS {CHECKS[1].sheet} {CHECKS[1].title}: no such table" in str(raised.value)
    rows = run_report(spark, sources, AS_OF, checks=(CHECKS[20],), whole=True).collect()
    assert [row.status for row in rows] == ["ROWS"]


def test_report_detail_fails_with_a_section(spark, monkeypatch):
    class Broken(TestdataSource):
        def _derive(self, name):
            if name.endswith("head") and name != CHECKS[20].domain.head:
                raise OSError("no such table")
            return super()._derive(name)

    monkeypatch.setattr(contract, "_sources", lambda spark, sf_dir: Registry({"RMS": Broken(spark, sf_dir, "RMS")}))
    before = set(os.listdir(shared_folder(spark)))
    with pytest.raises(report.ReportFailed, match="no such table"):
        contract.queries()["report_detail"](spark, SF)
    assert set(os.listdir(shared_folder(spark))) == before


def test_thirty_six_checks_in_order():
    assert len(CHECKS) == 36
    assert [check.sheet for check in CHECKS[::4]] == [
        "Database_salehead",
        "Database_Purchasehead",
        "Database_b2csalehead",
        "Database_Salereturnhead",
        "Database_Purchasereturnhead",
        "Database_Expiry_inhead",
        "Database_Expiryouthead",
        "Database_Transferinhead",
        "Database_Transferouthead",
    ]
    assert [check.key for check in CHECKS[:4]] == ["seq_gap_sale", "dup_sale", "mismatch_sale", "high_qty_sale"]


@pytest.mark.parametrize("file_format", ["parquet", "json", "csv"])
def test_written_report_reads_back(spark, sources, tmp_path, file_format):
    checks, path = CHECKS[4:8], str(tmp_path / "report")
    at = datetime(2024, 3, 6, 1, 2, 3)
    status = run_report(spark, sources, AS_OF, path, file_format, generated_at=at, checks=checks).collect()
    detail = read_report(spark, path, file_format).collect()
    assert {row.generated_at for row in detail} == {at}
    for check, row in zip(checks, status):
        records = [r for r in detail if r.check_title == check.title]
        assert len(records) == row.row_count
        assert {(r.source_db, r.sheet) for r in records} <= {("RMS", check.sheet)}
        expected = check.rows(sources.open("RMS"), AS_OF)
        shown = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        assert sorted(r.record for r in records) == sorted(r[0] for r in expected.select(shown).collect())
        assert all(list(json.loads(r.record)) == expected.columns for r in records)


def test_unknown_source_is_refused(sources):
    assert sources.open("rms") is sources.open("RMS")
    with pytest.raises(ValueError, match="XYZ"):
        sources.load("XYZ", "database_branch")


def test_jdbc_reads_split_tables_in_parallel(spark):
    source = JdbcSource(
        spark, "jdbc:postgresql://db/x", {"user": "u"}, {"database_salehead": ReadSplit("id", 1, 900, 9)}
    )
    options = source.read_options("database_salehead")
    assert options["dbtable"] == "database_salehead" and options["user"] == "u"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["id", "1", "900", "9"]
    assert "numPartitions" not in source.read_options("database_branch")


def test_jdbc_conditions_are_the_databases_work_and_large_tables_need_a_split(spark):
    split = ReadSplit("id", 1, 900, 9)
    source = JdbcSource(spark, "jdbc:x", splits={"database_saleitem": split}, where={"database_saleitem": "id > 5"})
    assert source.read_options("database_saleitem")["dbtable"] == "(SELECT * FROM database_saleitem WHERE id > 5) AS t"
    with pytest.raises(ValueError, match="one task"):
        source.read_options("database_salehead")


def test_a_section_that_fails_keeps_no_rows_of_an_earlier_run(spark, sources, tmp_path):
    check, path = CHECKS[20], str(tmp_path)
    assert run_report(spark, sources, AS_OF, path, checks=(check,)).first().status == "ROWS"
    assert read_report(spark, path).count() > 0
    for build, status in ((failing, "ERROR"), (empty, "EMPTY")):
        run_report(spark, sources, AS_OF, path, checks=(check, CHECKS[2]))
        again = run_report(spark, sources, AS_OF, path, checks=(replace(check, build=build),))
        assert again.first().status == status
        left = read_report(spark, path).filter(F.col("check_title") == check.title)
        assert left.filter(F.col("sheet") == check.sheet).count() == 0


def test_a_report_leaves_nothing_in_the_shared_folder(spark, sources):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    checks = (replace(CHECKS[1], build=failing), *CHECKS[0:4])
    assert run_report(spark, sources, AS_OF, checks=checks).count() == 5
    assert set(os.listdir(folder)) == before


def test_stored_tables_go_with_their_block(spark):
    with intermediates(spark) as folder:
        assert store(spark.range(3)).frame.count() == 3 and len(os.listdir(folder)) == 1
    assert not os.path.exists(folder)


def test_without_a_named_folder_the_warehouse_is_used():
    settings = {"spark.sql.warehouse.dir": "s3a://shared/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)))
    assert shared_folder(session) == "s3a://shared/warehouse/_intermediate"


def test_the_date_is_taken_once_and_the_stamp_once_per_sheet(spark, sources, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(report, "report_date", lambda *_: asked.append(1) or AS_OF)
    path = str(tmp_path)
    run_report(spark, sources, None, path, checks=CHECKS[4:12])
    assert len(asked) == 1
    stamps = read_report(spark, path).groupBy("sheet").agg(F.countDistinct("generated_at").alias("n")).collect()
    assert stamps and {row.n for row in stamps} == {1}


@pytest.mark.parametrize("entry_date", ["notadate", "2024-03-05 10:00:00"])
@pytest.mark.parametrize("strict", [False, True])
def test_plain_and_stored_heads_agree_on_malformed_dates(spark, tmp_path, entry_date, strict):
    class Bad(TestdataSource):
        def _derive(self, name):
            found = super()._derive(name)
            if name == CHECKS[0].domain.head:
                found = found.withColumn("entry_date", F.when(F.col("id") % 97 == 0, entry_date).otherwise(F.col("entry_date")))
            return found

    class BadStored(Bad):
        folder = str(tmp_path)

        def _derive(self, name):
            found = Bad._derive(self, name)
            if name == CHECKS[0].domain.head:
                if not os.path.exists(f"{self.folder}/{name}"):
                    write_heads(found, f"{self.folder}/{name}")
                found = self._spark.read.parquet(f"{self.folder}/{name}")
            return found

    kinds = Registry({"PLAIN": Bad(spark, SF), "STORED": BadStored(spark, SF)})
    rows = run_report(spark, kinds, AS_OF, strict=strict, checks=CHECKS[1:4], at_once=1).collect()
    plain, stored = ([r.status for r in rows if r.source_db == db] for db in ("PLAIN", "STORED"))
    assert plain == stored and (("ERROR" in plain) == (strict and entry_date == "notadate"))


def test_strict_needs_ansi(spark, sources):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            CHECKS[0].rows(sources.open("RMS"), AS_OF, strict=True)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_parquet_source_reads_tables_by_name(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/database_branch")
    assert Registry({"x": ParquetSource(spark, str(tmp_path))}).load("X", "database_branch").count() == 3


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get(SETTING)


def test_store_measures_what_it_writes(spark):
    stored = store(spark.range(5), n="count(*)", highest="max(id)")
    assert stored.measures == {"n": 5, "highest": 4}
    assert stored.frame.count() == 5
    assert store(spark.range(0), n="count(*)", lowest="min(id)").measures == {"n": 0, "lowest": None}


def test_shared_reads_are_made_once_and_again_after_a_failure():
    shared, made = SharedReads(None), []

    def make(fail=False):
        made.append(fail)
        if fail:
            raise OSError
        return len(made)

    with pytest.raises(OSError):
        shared.once("a", lambda: make(fail=True))
    assert [shared.once("a", make), shared.once("a", make), shared.once("b", make)] == [2, 2, 3]


@pytest.mark.parametrize("check", CHECKS, ids=lambda check: check.key)
def test_checks_agree_on_shared_reads(spark, check, shared):
    plain = TestdataSource(spark, SF)
    expected, found = check.rows(plain, AS_OF), check.rows(shared, AS_OF)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.fixture(scope="module")
def shared(spark):
    return SharedReads(TestdataSource(spark, SF))


class Stored(TestdataSource):
    """Head tables read from the stored layout."""

    folder = ""

    def _derive(self, name):
        found = super()._derive(name)
        if name.endswith("head"):
            write_heads(found, f"{self.folder}/{name}")
            found = self._spark.read.parquet(f"{self.folder}/{name}")
        return found


def test_checks_agree_on_heads_stored_by_day_and_read_only_that_day(spark, tmp_path):
    plain, stored = TestdataSource(spark, SF), Stored(spark, SF)
    stored.folder = str(tmp_path)
    for check in (*CHECKS[0:8], CHECKS[20]):
        expected, found = check.rows(plain, AS_OF), check.rows(stored, AS_OF)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())), check.key
    plan = CHECKS[1].rows(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entry_day" in plan


# Columns beside id, entry_number, entry_date, branch_id and the four amounts.
HEAD_COLUMNS = {
    "sale": "billing_on overall_disc customer_id_id is_retail_b2b_bill",
    "purchase": "overall_disc supplier_id_id",
    "b2c_sale": "billing_on overall_disc customer_id_id",
    "sale_return": "billing_on overall_disc customer_id_id is_b2b_bill",
    "purchase_return": "billing_on supplier_id_id",
    "expiry_in": "overall_disc customer_id_id",
    "expiry_out": "billing_on overall_disc supplier_id_id",
    "transfer_in": "supplier_id_id",
    "transfer_out": "billing_on overall_disc customer_id_id",
}


class OtherColumns(TestdataSource):
    """Heads with only the columns their domain has, and some that are of no concern."""

    def _derive(self, name):
        found = super()._derive(name)
        for domain in DOMAINS:
            if name == domain.head:
                common = "id entry_number entry_date branch_id net_amount gross_total total_gst total_disc"
                used = f"{common} {HEAD_COLUMNS[domain.slug]}".split()
                others = ("name", "domain", "series", "number", "first", "g", "c", "o", "client_name")
                return found.selectExpr(*used, *[f"'x' AS {other}" for other in others])
        return found


@pytest.mark.parametrize("check", CHECKS, ids=lambda check: check.key)
def test_checks_need_only_the_columns_of_their_domain(spark, check):
    assert check.rows(OtherColumns(spark, SF), AS_OF).columns == check.rows(TestdataSource(spark, SF), AS_OF).columns


def is_product(check):
    return not check.domain.quantity.own if check.key.startswith("high_qty") else check.domain.gap.attach == "series"


PRODUCTS = [check for check in CHECKS if check.key.split("_")[0] in ("seq", "high") and is_product(check)]


@pytest.mark.parametrize("check", PRODUCTS, ids=lambda check: check.key)
def test_products_are_counted_by_document_and_recorded_in_parts(spark, check):
    source = SharedReads(TestdataSource(spark, "/root/testdata/sf0.01"))
    rows = check.rows(source, AS_OF)
    counted = check.rows(source, AS_OF, form=COUNTED)
    found = counted.agg(F.sum(TIMES).alias("n"), F.count("*").alias("rows"), F.countDistinct("id").alias("ids")).first()
    assert found.n == rows.count() > found.rows == found.ids
    assert counted.drop(TIMES).columns == rows.columns and counted.drop(TIMES).exceptAll(rows).isEmpty()
    records = check.rows(source, AS_OF, ordered=True, form=RECORDS)
    assert records.columns == ["id", RECORD]
    expected = rows.select("id", record("*").alias(RECORD))
    assert records.exceptAll(expected).isEmpty() and expected.exceptAll(records).isEmpty()


def test_status_is_the_same_with_and_without_rows(spark, sources, tmp_path):
    checks = (CHECKS[0], CHECKS[11], CHECKS[20], CHECKS[28], CHECKS[35])
    assert run_report(spark, sources, AS_OF, checks=checks).collect() == run_report(
        spark, sources, AS_OF, str(tmp_path), checks=checks
    ).collect()


def test_parts_of_a_record_keep_odd_texts(spark, heads):
    odd = 'A"\\\n\u0001é😀-'
    documents = heads(*[{"entry_number": f"{odd}{n:04}", "is_retail_b2b_bill": None} for n in (1, 2, 5)])
    branch = spark.createDataFrame([(1, None, 'x"y')], "id int, name string, domain string")
    for slug in ("sale", "transfer_in", "transfer_out"):
        rule = BY_SLUG[slug].gap
        rows = seq_gap(documents, branch, AS_OF, rule).select("id", record("*").alias(RECORD))
        records = seq_gap(documents, branch, AS_OF, rule, form=RECORDS)
        assert sorted(records.collect()) == sorted(rows.collect()) and rows.count() == 6


class Tables:
    """A source of given tables."""

    def __init__(self, **tables):
        self.table = tables.__getitem__


@pytest.fixture(scope="module")
def products(spark, heads, items):
    """A source whose series and branches have far more pairs than rows: odd texts, a branch
    that comes three times, a document that comes twice, numbers and purchases of no branch."""
    odd = 'A"\\\n\u0001é😀-'
    numbers = [{"entry_number": f"{odd}{n * 9:04}", "is_retail_b2b_bill": n % 2 == 0, "id": n % 39} for n in range(40)]
    numbers += [{"branch_id": branch, "entry_number": f"B-{n:04}"} for branch in (2, None, 99) for n in (1, 30)]
    bought = heads(*[{"branch_id": branch} for branch in (1, 2, None, 99)])
    lines = [(1 + n % 4, "1.00", None, None, None, 6000 + n, n % 3) for n in range(60)]
    rows = [(1, "North", None), (1, "North", None), (1, None, 'x"y'), (2, "South", "south.example")]
    documents = heads(*numbers)
    return Tables(
        database_branch=spark.createDataFrame(rows, "id int, name string, domain string"),
        database_purchasehead=bought,
        database_purchaseitem=items(BY_SLUG["purchase"].quantity.items, *lines),
        **{check.domain.head: documents for check in PRODUCTS},
    )


def test_a_folded_report_has_the_same_rows_and_does_not_store_them(spark, products, tmp_path, either_join):
    plain, folded = str(tmp_path / "plain"), str(tmp_path / "folded")
    # A plain section of an earlier run goes as well.
    for path, kind in ((plain, False), (folded, False), (folded, True)):
        status = run_report(
            spark, Registry({"X": products}), AS_OF, path, generated_at=datetime(2024, 3, 6), checks=PRODUCTS, folded=kind
        ).collect()
        if path == plain:
            expected_status = status
    assert status == expected_status and {row.status for row in status} == {"ROWS"}
    expected, found = read_report(spark, plain), read_report(spark, folded)
    assert found.columns == expected.columns and found.count() == sum(row.row_count for row in status) > 20_000
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    fields = ("branch_name", "missing_entry_number", "entry_number", "sum_of_pq_pf", "nothing")
    for title in {check.title for check in PRODUCTS}:
        wanted = expected.filter(F.col("check_title") == title).select("*", F.json_tuple("record", *fields).alias(*fields))
        shown = read_report(spark, folded, fields=fields, check_title=title)
        assert shown.columns == wanted.columns
        assert shown.exceptAll(wanted).isEmpty() and wanted.exceptAll(shown).isEmpty()
    stored = sum(spark.read.option("recursiveFileLookup", True).parquet(f"{folded}/_folded/{side}").count() for side in ("heads", "beside"))
    assert stored < 0.1 * found.count()


def test_a_folded_section_that_fails_keeps_no_rows_of_an_earlier_run(spark, products, tmp_path):
    path, sources = str(tmp_path), Registry({"X": products})
    run_report(spark, sources, AS_OF, path, checks=(PRODUCTS[0], PRODUCTS[-1]), folded=True)
    left = read_report(spark, path, check_title=PRODUCTS[-1].title).count()
    assert left and read_report(spark, path).count() > left
    run_report(spark, sources, AS_OF, path, checks=(replace(PRODUCTS[0], build=failing),), folded=True)
    assert read_report(spark, path).count() == left


def test_report_detail_stores_the_sides_of_products_only(spark, products, monkeypatch):
    monkeypatch.setattr(contract, "_sources", lambda spark, sf_dir: Registry({"X": products}))
    run = contract.run_report
    monkeypatch.setattr(contract, "run_report", lambda *args, **how: run(*args, **how, checks=PRODUCTS))
    before = set(os.listdir(shared_folder(spark)))
    rows = contract.queries()["report_detail"](spark, SF)
    (kept,) = [name for name in set(os.listdir(shared_folder(spark))) - before if name.startswith("report-")]
    stored = 0
    for folder, _, files in os.walk(f"{shared_folder(spark)}/{kept}"):
        stored += sum(spark.read.parquet(f"{folder}/{name}").count() for name in files if name.endswith(".parquet"))
    assert rows.count() > 20_000 and 0 < stored < 0.1 * rows.count()
