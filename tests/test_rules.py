"""The rules as truth tables."""

import datetime as dt

import pytest

from millrace.plans.request import LoadError, LoadRequest
from millrace.plans.rules import check, check_interval, resolve

GOOD = dict(source="main.orders")

REFUSED = {
    "V01 no target, bare name": dict(source="orders"),
    "V01 no target, three parts": dict(source="a.b.c"),
    "V02 not files": dict(GOOD, file_incremental=True),
    "V02 no times": dict(GOOD, source_kind="files", file_incremental=True, files_have_times=False),
    "V02 replace": dict(GOOD, source_kind="files", file_incremental=True, strategy="replace"),
    "V02 no state": dict(GOOD, source_kind="files", file_incremental=True, durable_state=False),
    "V03 merge": dict(GOOD, source_kind="files", strategy="merge", primary_key=["id"]),
    "V03 scd2": dict(GOOD, source_kind="files", strategy="scd2"),
    "V03 delete+insert": dict(GOOD, source_kind="files", strategy="delete+insert", incremental_key="d"),
    "V04 cursor": dict(GOOD, strategy="scd2", incremental_key="d"),
    "V04 limit": dict(GOOD, strategy="scd2", limit=5),
    "V05 uuid": dict(GOOD, strategy="scd2", masks=["name:uuid"]),
    "V05 noise": dict(GOOD, strategy="scd2", masks=["a:sha256", "n:noise:0.1"]),
    "masked cursor": dict(GOOD, incremental_key="d", masks=["d:year_only"]),
    "masked key": dict(GOOD, strategy="merge", primary_key=["id"], masks=["id:sequential"]),
    "single file": dict(GOOD, sink_kind="single_file"),
    "V10 future": dict(GOOD, interval_end=dt.datetime(2999, 1, 1)),
    "V07 no route": dict(GOOD, multiple_tables=True),
    "V07 one collection": dict(GOOD, multiple_tables=True, route="kind", sink_kind="documents"),
    "V07 merge": dict(GOOD, multiple_tables=True, route="kind", strategy="merge", primary_key=["id"]),
    "V07 position": dict(GOOD, multiple_tables=True, route="kind", incremental_key="d"),
    "V07 masked route": dict(GOOD, multiple_tables=True, route="kind", masks=["kind:sha256"]),
    "route of one table": dict(GOOD, route="kind"),
    "nested history": dict(GOOD, nesting=1, strategy="scd2"),
    "nested partitions": dict(GOOD, nesting=1, partition_by="d"),
    "V08": dict(GOOD, format="avro"),
    "V08 csv": dict(GOOD, format="csv"),
    "collection with position": dict(GOOD, sink_kind="documents", incremental_key="d"),
    "V09 cursor": dict(GOOD, source_kind="queue", incremental_key="d"),
    "V09 key": dict(GOOD, source_kind="queue", primary_key=["id"]),
    "V10": dict(GOOD, interval_start=dt.date(2024, 2, 1), interval_end=dt.date(2024, 1, 1)),
    "V11": dict(GOOD, sink_kind="documents", strategy="merge"),
    "V11 append": dict(GOOD, sink_kind="documents", strategy="append"),
    "merge without key": dict(GOOD, strategy="merge"),
    "delete+insert without key": dict(GOOD, strategy="delete+insert"),
    "strategy": dict(GOOD, strategy="truncate"),
}


@pytest.mark.parametrize("name", list(REFUSED))
def test_refused(name):
    with pytest.raises(LoadError):
        resolve(LoadRequest(**REFUSED[name]))


ALLOWED = [
    (dict(GOOD), "replace"),
    (dict(GOOD, source_kind="files"), "append"),
    (dict(GOOD, source_kind="files", strategy="replace"), "replace"),
    (dict(GOOD, source_kind="files", file_incremental=True), "append"),
    (dict(GOOD, source_kind="queue", source_strategy="merge"), "merge"),
    (dict(GOOD, strategy="scd2", masks=["name:sha256", "n:sequential"]), "scd2"),
    (dict(GOOD, strategy="scd2", primary_key=["id"]), "scd2"),
    (dict(GOOD, strategy="delete+insert", incremental_key="d"), "delete+insert"),
    (dict(source="orders", target="t"), "replace"),
    (dict(GOOD, multiple_tables=True, route="kind"), "replace"),
    (dict(GOOD, nesting=2, strategy="merge", primary_key=["id"]), "merge"),
]


@pytest.mark.parametrize(("options", "strategy"), ALLOWED)
def test_allowed(options, strategy):
    resolved = resolve(LoadRequest(**options))
    assert resolved.strategy == strategy and resolved.target


def test_future_intervals():
    now = dt.datetime(2024, 1, 10)
    check_interval(dt.date(2024, 1, 1), dt.date(2024, 1, 10), now)
    with pytest.raises(LoadError):
        check_interval(dt.date(2024, 1, 1), dt.date(2024, 1, 11), now)
    with pytest.raises(LoadError):
        check(LoadRequest(**GOOD, interval_end=dt.datetime(2024, 1, 10, 1)), now)
