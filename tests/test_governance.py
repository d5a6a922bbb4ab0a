"""Masks, row access, classification."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdfast import operators as O

CLEAR, HIDDEN = "clear", "*** Redacted ***"
# role -> (ssn, text, age visible)
TRUTH = {
    "CLIENT_ADVISOR_RL": ("***-**-6789", CLEAR, True),
    "BUSINESS_ANALYST_RL": (HIDDEN, HIDDEN, True),
    "DATA_ENGINEER_RL": (HIDDEN, HIDDEN, False),
    "DATA_STEWARD": (HIDDEN, HIDDEN, False),
    "FISERV_ADMIN": (HIDDEN, HIDDEN, False),
    "SYSADMIN": ("123-45-6789", CLEAR, True),
    "anyone": ("123-45-6789", CLEAR, True),
}
BORN = dt.date(1990, 5, 6)
TAGS = {"ssn": "PII_HIGH", "name": "PII_MODERATE", "age": "PII_LOW", "birthdate": "PII_LOW",
        "salary": "PII_LOW", "note": "OTHER"}


@pytest.mark.parametrize("role", list(TRUTH))
def test_matrix(spark, role):
    ssn, name, visible = TRUTH[role]
    df = spark.createDataFrame(
        [("123-45-6789", "Ann", 30, BORN, "n", 5.0)],
        "ssn string, name string, age bigint, birthdate date, note string, salary double",
    )
    seen = O.apply_masks(df, TAGS, role)
    row = seen.first()
    assert row.ssn == ssn
    assert row.name == ("Ann" if name == CLEAR else name)
    assert row.age == (30 if visible else None)
    assert row.birthdate == (BORN if visible else None)
    # A tag without a policy for the type, and an unknown tag, leave columns clear.
    assert (row.salary, row.note) == (5.0, "n")
    assert seen.dtypes == df.dtypes


def test_ssn_oddities(spark):
    df = spark.createDataFrame([(None,), ("123456789",)], "ssn string")
    def seen(role):
        return [row[0] for row in df.select(O.mask_ssn(F.col("ssn"), role)).collect()]

    assert seen("BUSINESS_ANALYST_RL") == [HIDDEN, HIDDEN]
    assert seen("CLIENT_ADVISOR_RL") == [None, "123456789"]


@pytest.fixture
def tables(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint")
    links = spark.createDataFrame([(1, 10), (1, 11), (2, 11)], "customer_id bigint, advisor_id bigint")
    users = spark.createDataFrame(
        [("ANN", 10), ("ANN", 11), ("BOB", 11)], "username string, advisor_id bigint"
    )
    return customers, links, users


@pytest.mark.parametrize(
    ("user", "role", "expected"),
    [
        ("ANN", "CLIENT_ADVISOR_RL", [1, 2]),
        ("BOB", "CLIENT_ADVISOR_RL", [1, 2]),
        ("EVE", "CLIENT_ADVISOR_RL", []),
        ("EVE", "DATA_STEWARD", [1, 2, 3]),
        ("EVE", "SYSADMIN", [1, 2, 3]),
    ],
)
def test_row_access(tables, user, role, expected):
    customers, links, users = tables
    seen = O.row_access(customers, O.Principal(user, role), links, users)
    assert sorted(row.customer_id for row in seen.collect()) == expected


def test_masks_come_before_sorting(spark, tables):
    customers, links, users = tables
    people = customers.withColumn("age", F.col("customer_id") * 10)

    def query(who):
        return O.apply_masks(O.row_access(people, who, links, users), {"age": "PII_LOW"}, who.role).where(
            "age > 0"
        )

    assert O.as_principal(O.Principal("X", "DATA_STEWARD"), query).count() == 0
    assert O.as_principal(O.Principal("ANN", "CLIENT_ADVISOR_RL"), query).count() == 2


def test_classification(spark, rows):
    df = spark.createDataFrame(
        [
            ("123-45-6789", "(212) 555-0100", "a@b.com", "12 Main Street", "Ann", "x", 30, "NY", BORN, 12345),
            ("123-45-6780", "+1 212-555-0101", "c@d.org", "9 Side St", "O'Neil", "y", 31, "CA", BORN, 99999),
            (None, None, "bad", None, None, None, None, None, None, None),
        ],
        "tax string, phone_number string, contact string, street_address string, last_name string, "
        "note string, retirement_age bigint, state string, birthdate date, customer_id bigint",
    )
    assert rows(O.classify_columns(df)) == [
        ("birthdate", "DATE_OF_BIRTH", "QUASI_IDENTIFIER", 1.0),
        ("last_name", "NAME", "IDENTIFIER", 1.0),
        ("phone_number", "PHONE_NUMBER", "IDENTIFIER", 1.0),
        ("retirement_age", "AGE", "QUASI_IDENTIFIER", 1.0),
        ("state", "ADMINISTRATIVE_AREA_1", "QUASI_IDENTIFIER", 1.0),
        ("street_address", "STREET_ADDRESS", "IDENTIFIER", 1.0),
        ("tax", "NATIONAL_IDENTIFIER", "IDENTIFIER", 1.0),
    ]


def test_hint_lowers_the_threshold(spark, rows):
    values = [("a@b.com", "a@b.com"), ("c@d.org", "c@d.org"), ("none", "none")]
    df = spark.createDataFrame(values, "email string, contact string")
    assert rows(O.classify_columns(df), "column_name", "match_ratio") == [("email", 0.6667)]


def test_tags(spark, rows):
    one = spark.createDataFrame([("123-45-6789", 5.0, 30)], "ssn string, salary double, age bigint")
    two = spark.createDataFrame([(BORN, "NY")], "birthdate date, state string")
    got = O.tag_columns({"ONE": one, "TWO": two})
    assert [tuple(row) for row in got.collect()] == [
        ("ONE", "age", "PII_LOW", "age"),
        ("ONE", "ssn", "PII_HIGH", "social_security_number"),
        ("TWO", "birthdate", "PII_LOW", "date"),
    ]
    assert O.tag_columns({"ONE": one}, "PII_H%").count() == 1


def test_masks_follow_from_what_columns_hold(spark, rows):
    """No list of columns: an age, a name, a number that is no person's, and a table without personal data."""
    people = spark.createDataFrame(
        [(1, "Ann", "123-45-6789", 30, "x1"), (2, "Bob", "123-45-6780", 40, "x2")],
        "customer_id bigint, first_name string, code string, age bigint, note string",
    )
    things = spark.createDataFrame([(1, "a1")], "customer_id bigint, label string")
    governed = O.govern({"PEOPLE": people, "THINGS": things})
    assert governed.tags == {"PEOPLE": {"first_name": "PII_MODERATE", "code": "PII_HIGH", "age": "PII_LOW"}, "THINGS": {}}
    links = spark.createDataFrame([(1, 7)], "customer_id bigint, advisor_id bigint")
    users = spark.createDataFrame([("ADV7", 7)], "username string, advisor_id bigint")

    def seen(name, role):
        return rows(governed.as_seen_by(name, O.Principal("ADV7", role), links, users))

    hidden = "*** Redacted ***"
    assert seen("PEOPLE", "CLIENT_ADVISOR_RL") == [(1, "Ann", "***-**-6789", 30, "x1")]
    assert seen("PEOPLE", "DATA_STEWARD") == [(1, hidden, hidden, None, "x1"), (2, hidden, hidden, None, "x2")]
    assert seen("PEOPLE", "BUSINESS_ANALYST_RL")[0] == (1, hidden, hidden, 30, "x1")
    assert seen("THINGS", "DATA_STEWARD") == [(1, "a1")]
