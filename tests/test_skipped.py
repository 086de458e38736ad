from collections import Counter
from datetime import datetime

import pytest

from tallyproof.plans.checks import BY_KEY, CHECKS
from tallyproof.plans.domains import DOMAINS
from tallyproof.plans.skipped import skipped_rows
from tallyproof.sources.layout import write_heads
from tallyproof.sources.registry import Registry

from tests.conftest import AS_OF, DAY

NIGHT = "2024-03-06 00:00:00"
ROWS = [
    {"entry_number": "INV-0001"},
    {"entry_number": "INV-A001"},
    {"entry_number": "INV-+012"},
    {"entry_number": "A1"},
    {"entry_number": ""},
    {"entry_number": None},
    {"entry_number": "BAD", "branch_id": None},
    {"entry_number": "BAD", "entry_date": NIGHT},
    {"entry_number": "BAD", "entry_date": "2023-01-01"},
    {"entry_number": None, "entry_date": "2023-01-01"},
    {"entry_number": "BAD", "entry_date": "notadate"},
    {"entry_number": "INV-0002", "entry_date": "2024-02-31"},
    {"entry_number": "INV-0003", "entry_date": None},
    {"entry_number": "INV-0004", "entry_date": "  "},
    {"entry_number": "INV-0005", "entry_date": ""},
]


class Heads:
    """One head table under every domain's name, or nothing under the `without` ones."""

    def __init__(self, frame, without=()):
        self.frame, self.without = frame, without

    def table(self, name):
        return self.frame.filter("false") if name in self.without else self.frame


def moment(text):
    try:
        return datetime.fromisoformat((text or "").strip()[:19])
    except ValueError:
        return None


def integer(text):
    try:
        return text[-4:].strip() != "" and int(text[-4:]) is not None
    except ValueError:
        return False


def by_hand(check):
    """The four counts of a section whose every head table has ROWS, one row at a time."""
    slug = check.domain.slug
    kind = check.key.removesuffix(f"_{slug}")
    tables = 2 if kind == "high_qty" and slug in ("b2c_sale", "expiry_in", "expiry_out", "transfer_in", "transfer_out") else 1
    found = Counter()
    for row in ROWS:
        date, number = row.get("entry_date", DAY), row["entry_number"]
        at = moment(date)
        whole = kind == "seq_gap" and slug == "expiry_in"
        if not whole:
            found["undated"] += tables * (not (date or "").strip())
            found["malformed_dates"] += tables * (bool((date or "").strip()) and at is None)
        if kind != "seq_gap" or row.get("branch_id", 1) is None:
            continue
        start, end = datetime(2024, 3, 5), datetime(2024, 3, 6)
        through = slug not in ("sale", "b2c_sale")
        if not whole and (at is None or not (start <= at < end or through and at == end)):
            continue
        if not number:
            found["unnumbered"] += 1
        elif slug in ("b2c_sale", "expiry_in"):
            found["malformed_numbers"] += not integer(number)
        else:
            found["malformed_numbers"] += not (len(number) >= 4 and number[-4:].isdigit())
    return tuple(found[name] for name in ("undated", "malformed_dates", "unnumbered", "malformed_numbers"))


def by_section(frame):
    return {(r.source_db, r.sheet, r.check_title): tuple(r[3:]) for r in frame.collect()}


@pytest.mark.parametrize("layout", ["plain", "by day"])
def test_counts_are_those_made_by_hand(spark, heads, tmp_path, layout):
    frame = heads(*ROWS)
    if layout == "by day":
        write_heads(frame, f"{tmp_path}/heads")
        frame = spark.read.parquet(f"{tmp_path}/heads")
    found = by_section(skipped_rows(spark, Registry({"RMS": Heads(frame)}), AS_OF))
    assert found == {("RMS", check.sheet, check.title): by_hand(check) for check in CHECKS}
    assert found["RMS", CHECKS[0].sheet, CHECKS[0].title] == (3, 2, 2, 3)


def test_empty_tables_have_a_row_of_zeros_and_sources_stay_apart(spark, heads):
    kinds = Registry({"FULL": Heads(heads(*ROWS)), "NONE": Heads(heads(*ROWS), [d.head for d in DOMAINS])})
    found = by_section(skipped_rows(spark, kinds, AS_OF, CHECKS[:4]))
    assert [found["NONE", c.sheet, c.title] for c in CHECKS[:4]] == [(0, 0, 0, 0)] * 4
    assert [found["FULL", c.sheet, c.title] for c in CHECKS[:4]] == [by_hand(c) for c in CHECKS[:4]]


def test_purchases_of_the_day_count_with_the_heads_beside_them(spark, heads):
    check = BY_KEY["high_qty_transfer_in"]
    kinds = Registry({"RMS": Heads(heads(*ROWS), [check.domain.head])})
    rows = skipped_rows(spark, kinds, AS_OF, (check,)).collect()
    assert [tuple(r[3:]) for r in rows] == [(3, 2, 0, 0)]


def test_only_the_windows_days_and_undated_heads_are_read(spark, heads, tmp_path):
    write_heads(heads(*ROWS), f"{tmp_path}/heads")
    source = Heads(spark.read.parquet(f"{tmp_path}/heads"))
    plan = skipped_rows(spark, Registry({"RMS": source}), AS_OF, (BY_KEY["dup_sale"],))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(entry_day" in text
    assert "net_amount" not in text and "billing_on" not in text
