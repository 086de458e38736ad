"""How many head rows a report's sections pass over, and why.

A check leaves out heads whose date or number it cannot use. These counts tell how many
that were, so that a section without rows can be told from one without usable heads.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions.dates import as_of_day, audited_day, report_date, with_entry_ts
from tallyproof.functions.documents import ends_in_digits, running_number
from tallyproof.plans.checks import CHECKS, Check, gap_check, quantity_check
from tallyproof.plans.domains import BY_SLUG, Domain
from tallyproof.sources.registry import Registry

_DATES = ("undated", "malformed_dates")
_NUMBERS = ("unnumbered", "malformed_numbers")


def skipped_rows(
    spark: SparkSession,
    sources: Registry,
    as_of: date | None = None,
    checks: tuple[Check, ...] = CHECKS,
) -> DataFrame:
    """A row per section: source_db, sheet, check_title and four counts of head rows.

    undated            without a date, or with a blank one
    malformed_dates    with a text that is no date; `strict` makes these an error
    unnumbered         of the gap check's span: without a number, or with an empty one
    malformed_numbers  of the gap check's span: with a number that takes no part, because
                       it does not end in four digits or, where that is not asked for,
                       in no integer

    A section counts the heads it reads: quantity checks of the day's purchases count
    undated purchases as well, only gap checks count numbers, and a gap check over all
    history counts no dates. A head without a branch is of no span.

    Each head table is scanned once whatever the number of its sections, for three
    columns, and folded to one row in the map tasks; stored by ``entry_day``, only the
    window's days and the undated heads are read where the rules allow that. What is
    joined after that has a few rows for each section.
    """
    day = report_date(spark, as_of)
    reads = [
        (name, check.sheet, check.title, domain.slug, dates, numbers)
        for name in sources.names()
        for check in checks
        for domain, dates, numbers in _reads(check)
    ]
    domains = {domain.slug: domain for check in checks for domain, _, _ in _reads(check)}
    counted = reduce(
        DataFrame.unionByName,
        [
            _counts(sources.load(name, domain.head), domain, day).withColumns(
                {"source_db": F.lit(name), "slug": F.lit(slug)}
            )
            for name in sources.names()
            for slug, domain in domains.items()
        ],
    )
    place = ["source_db", "sheet", "check_title"]
    sections = spark.createDataFrame(
        reads, "source_db string, sheet string, check_title string, slug string, dates boolean, numbers boolean"
    )
    sums = [
        F.sum(F.when(F.col(read), F.col(name)).otherwise(0)).alias(name)
        for read, names in (("dates", _DATES), ("numbers", _NUMBERS))
        for name in names
    ]
    return counted.join(F.broadcast(sections), ["source_db", "slug"]).groupBy(*place).agg(*sums)


def _reads(check: Check) -> list[tuple[Domain, bool, bool]]:
    """The domains whose heads a check reads, and whether by date and by number."""
    if check.build is gap_check:
        return [(check.domain, check.domain.gap.windowed, True)]
    own = [(check.domain, True, False)]
    if check.build is quantity_check and not check.domain.quantity.own:
        return [*own, (BY_SLUG["purchase"], True, False)]
    return own


def _counts(heads: DataFrame, domain: Domain, day: date) -> DataFrame:
    """One row with the four counts of a head table."""
    rule = domain.gap
    start, end = audited_day(day), as_of_day(day)
    if rule.windowed and "entry_day" in heads.columns:
        heads = heads.filter(f"entry_day IS NULL OR entry_day BETWEEN {start} AND {end}")
    dated = with_entry_ts(heads)
    blank = F.expr("entry_date IS NULL OR trim(entry_date) = ''")
    span = F.expr("branch_id IS NOT NULL")
    if rule.windowed:
        until = "<=" if rule.through_midnight else "<"
        span &= F.expr(
            f"entry_ts >= cast({start} AS TIMESTAMP_NTZ) AND entry_ts {until} cast({end} AS TIMESTAMP_NTZ)"
        )
    unnumbered = F.expr("entry_number IS NULL OR entry_number = ''")
    return dated.agg(
        F.count_if(blank).alias("undated"),
        F.count_if(~blank & F.col("entry_ts").isNull()).alias("malformed_dates"),
        F.count_if(span & unnumbered).alias("unnumbered"),
        F.count_if(span & ~unnumbered & ~_usable(rule.guarded)).alias("malformed_numbers"),
    )


def _usable(guarded: bool) -> Column:
    """Whether a number takes part in a gap check."""
    return ends_in_digits("entry_number") if guarded else running_number("entry_number").isNotNull()
