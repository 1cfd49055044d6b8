"""Masks: exact results for single values, and what random ones keep."""

import datetime as dt
import hashlib
import hmac
import random
from decimal import Decimal

import pytest

from millrace.operators import masking


def mask(spark, values, kind, config):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.v for r in masking.mask_table(frame, [f"v:{config}"]).orderBy("i").collect()]


CASES = [
    ("email", "ab@test.com", "**@test.com"),
    ("email", "jonathan@test.com", "j******n@test.com"),
    ("email", "a@b@c", "*@b@c"),
    ("email", "nomail", "no**il"),
    ("email", "", ""),
    ("email", None, None),
    ("phone", "555-123-4567", "555-***-****"),
    ("phone", "12345", "*****"),
    ("credit_card", "4111-1111-1111-1111", "************1111"),
    ("credit_card", "1234", "****"),
    ("ssn", "123-45-6789", "***-**-6789"),
    ("ssn", "12345", "*****"),
    ("partial:2", "Jonathan", "Jo****an"),
    ("partial:1", "test", "t**t"),
    ("partial:2", "ab", "**"),
    ("partial", None, None),
    ("first_letter", "Alice", "A****"),
    ("first_letter", "A", "A"),
    ("stars", "secret", "******"),
    ("stars", None, ""),
    ("redact", None, "REDACTED"),
    ("redact", "x", "REDACTED"),
    ("fixed", None, "MASKED"),
    ("fixed:gone", "x", "gone"),
    ("round:10", "no number", None),
    ("range:100", "n/a", None),
    ("year_only", "2024-03-15", "2024"),
    ("year_only", "someday", None),
    ("year_only", "5 Mar 24", "2024"),
    ("month_year", "05.03.2024", "2024-03"),
    ("date_shift", "someday", None),
    ("noise:0.5", "much", None),
    ("month_year", "2024-03-15", "2024-03"),
    ("month_year", "March 5, 2024", "2024-03"),
    ("sha256", "test@example.com", hashlib.sha256(b"test@example.com").hexdigest()),
    ("hash", None, None),
    ("md5", "test@example.com", "55502f40dc8b7c769880b10874abc9d0"),
    ("hmac:key", "v", hmac.new(b"key", b"v", hashlib.sha256).hexdigest()),
    ("hmac:" + "k" * 80, "v", hmac.new(b"k" * 80, b"v", hashlib.sha256).hexdigest()),
    ("HASH", "x", hashlib.sha256(b"x").hexdigest()),
]


def test_text_masks(spark):
    """All cases in one frame, a column each."""
    names = [f"c{i}" for i in range(len(CASES))]
    frame = spark.createDataFrame([tuple(v for _, v, _ in CASES)], ", ".join(f"{n} string" for n in names))
    out = masking.mask_table(frame, [f"{n}:{m}" for n, (m, _, _) in zip(names, CASES)]).first()
    wrong = [(m, v, out[n], want) for n, (m, v, want) in zip(names, CASES) if out[n] != want]
    assert not wrong


@pytest.mark.parametrize(
    ("config", "values", "kind", "expected"),
    [
        ("round:5000", [52300], "int", [50000]),
        ("round:10", [34, 35, 45, -35, None], "int", [30, 40, 40, -40, None]),
        ("round:10", [37.5], "double", [40]),
        ("range:10000", [45000], "int", ["40000-50000"]),
        ("range:100", [234, -5, None], "int", ["200-300", "-100-0", None]),
        ("year_only", [dt.date(2024, 3, 15), None], "date", [2024, None]),
        ("month_year", [dt.datetime(2024, 3, 15, 10)], "timestamp", ["2024-03"]),
        ("stars", [0, 12345], "int", ["", "*****"]),
        ("sha256", [True], "boolean", [hashlib.sha256(b"True").hexdigest()]),
        ("sha256", [42], "int", [hashlib.sha256(b"42").hexdigest()]),
    ],
)
def test_typed_masks(spark, config, values, kind, expected):
    assert mask(spark, values, kind, config) == expected


def test_sequential_in_order_of_arrival(spark):
    frame = spark.createDataFrame([(0, "c1"), (1, "c2"), (2, "c1"), (3, None)], "i int, v string")
    out = masking.mask_sequential(frame, "v", ["i"])
    assert [r.v for r in out.orderBy("i").collect()] == [1, 2, 1, None]


def test_numbers_are_dense_over_many_tasks(spark):
    values = [f"v{random.Random(4).random()}-{i}" for i in range(2000)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(7)
    numbers = masking.number_values(frame, "v", ["i"]).collect()
    assert sorted(r.number for r in numbers) == list(range(1, 2001))
    assert {r.value: r.number for r in numbers}[values[0]] == 1


def test_uuid_is_stable_within_a_run_only(spark):
    values = ["a", "b", "a", None]
    first, second = mask(spark, values, "string", "uuid"), mask(spark, values, "string", "uuid")
    assert first[0] == first[2] != first[1] and first[3] is None
    assert first[0] != second[0]


def test_random_masks_keep_shape(spark):
    text = mask(spark, ["hello world", "", None], "string", "random")
    assert len(text[0]) == 11 and text[0].isalnum() and text[1:] == ["", None]
    numbers = mask(spark, [7, 1234, None], "int", "random")
    assert [len(str(n)) for n in numbers[:2]] == [1, 4] and numbers[2] is None
    shifted = mask(spark, [dt.date(2024, 1, 31)], "date", "date_shift:3")[0]
    assert abs((shifted - dt.date(2024, 1, 31)).days) <= 3
    assert mask(spark, ["2024-01-31"], "string", "date_shift")[0].startswith("202")
    noisy = mask(spark, [1000], "int", "noise:0.5")[0]
    assert 500 <= noisy <= 1500


def test_random_masks_of_other_types_show_nothing(spark):
    for kind, value in (("decimal(10,2)", Decimal("1234.56")), ("date", dt.date(2024, 1, 31)), ("timestamp_ntz", dt.datetime(2024, 1, 31, 5))):
        shown = mask(spark, [value] * 30 + [None], kind, "random")
        assert shown[-1] is None and len({str(s) for s in shown}) > 20
        assert str(value) not in {str(s) for s in shown}


def test_numbers_at_the_end_of_their_type(spark):
    for kind, value in (("int", 2**31 - 1), ("bigint", 2**63 - 1), ("bigint", -(2**63)), ("smallint", 32767)):
        values = [value] * 50
        shown = mask(spark, values, kind, "random")
        assert all(len(str(n)) == len(str(abs(value))) for n in shown)
        moved = mask(spark, values, kind, "noise:0.5")
        assert all(0.49 * abs(value) <= abs(n) <= 1.51 * abs(value) for n in moved)
    small = mask(spark, [-7] * 20, "int", "noise:0.5")
    assert all(-11 <= n <= -3 for n in small)


@pytest.mark.parametrize("config", ["v", "v:a:b:c", "v:rot13", ":sha256", "v:hmac"])
def test_bad_configurations(spark, config):
    with pytest.raises(ValueError):
        masking.mask_table(spark.createDataFrame([("x",)], "v string"), [config])


def test_unknown_columns_are_passed_over(spark):
    frame = spark.createDataFrame([("x",)], "v string")
    assert masking.mask_table(frame, ["w:sha256"]).first().v == "x"


def test_stable_masks_stay_in_the_engine(spark):
    frame = spark.createDataFrame([("x", 1)], "v string, n int")
    stable = [f"v:{m}" for m in masking.MASKS if m not in masking.UNSTABLE and m != "hmac"]
    for config in stable:
        plan = masking.mask_table(frame, [config])._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan, config


def test_digits_with_null(spark):
    assert mask(spark, [None, ""], "string", "phone") == [None, ""]
