from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tallyproof.operators import gaps, mismatch, quantity, spread
from tallyproof.session import local_session

AS_OF = date(2024, 3, 6)
DAY = "2024-03-05 10:00:00"

HEAD = (
    "id bigint, branch_id int, entry_number string, entry_date string, billing_on string, "
    "net_amount decimal(18,2), gross_total decimal(18,2), total_gst decimal(18,2), "
    "total_disc decimal(18,2), overall_disc decimal(18,2), customer_id_id bigint, "
    "supplier_id_id bigint, is_retail_b2b_bill boolean, is_b2b_bill boolean"
)
HEAD_NAMES = [part.split()[0] for part in HEAD.split(", ")]
DEFAULTS = {
    "branch_id": 1,
    "entry_date": DAY,
    "billing_on": "1",
    "net_amount": Decimal("100.00"),
    "gross_total": Decimal("100.00"),
    "total_gst": Decimal("0.00"),
    "total_disc": Decimal("0.00"),
}
ITEM = (
    "header bigint, value decimal(18,2), discount_amount decimal(18,2), gst string, "
    "gst_value decimal(18,2), quantity int, free int"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tests", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def heads(spark):
    """Builds a head table from dicts; columns not named take a default or NULL."""

    def build(*rows):
        filled = [{**DEFAULTS, "id": i, **row} for i, row in enumerate(rows, 1)]
        return spark.createDataFrame([[row.get(name) for name in HEAD_NAMES] for row in filled], HEAD)

    return build


@pytest.fixture(scope="session")
def branch(spark):
    return spark.createDataFrame(
        [(1, "North", "north.example", 10), (2, "South", "south.example", 20)],
        "id int, name string, domain string, client_id int",
    )


@pytest.fixture(scope="session")
def items(spark):
    """Builds an item table; tuples of (header, value, discount, gst, gst value, quantity, free)."""

    def build(names, *rows):
        built = spark.createDataFrame(
            [(h, *[None if x is None else Decimal(str(x)) for x in (v, d)], g,
              None if w is None else Decimal(str(w)), q, f) for h, v, d, g, w, q, f in rows],
            ITEM,
        )
        renamed = {"header": names.header_key, "value": names.value}
        if names.quantity:
            renamed |= {"quantity": names.quantity, "free": names.free}
        return built.withColumnsRenamed(renamed)

    return build


@pytest.fixture(params=["broadcast", "sliced"])
def either_join(request, monkeypatch):
    """Runs a test with measured sides broadcast, and again with both sides shuffled."""
    if request.param == "sliced":
        monkeypatch.setattr(spread, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(spread, "HOT_ROWS", 3)
        monkeypatch.setattr(mismatch, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(gaps, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(quantity, "BROADCAST_BYTES", -1)
    return request.param


def table(frame, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    rows = [tuple(row) for row in frame.select(*columns).collect()]
    return sorted(rows, key=lambda row: tuple((x is not None, x) for x in row))
